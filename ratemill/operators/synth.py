"""Synthetic billing lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import with_positions

# The lists the lines pick from.
CHOICES = {
    "item": ["1001", "1002", "1003", "1004", "1005"],
    "location": ["Practice 1", "Practice 2", "Practice 3"],
    "state": ["NY", "CA", "OK", "TX"],
    "county": ["County X", "County Y"],
    "type": ["A", "B"],
}
MAX_UNITS = 10
DAYS_BACK = 25

# A multiplicative generator of full period, 2^31 - 1, one step per column.
_PRIME = 2147483647
_FACTOR = 48271
_WARM_UP = 2  # the first draws of small ids are small themselves


FIRST_CLIENT = 100


def number_clients(clients: DataFrame, order: list[Column]) -> DataFrame:
    """Clients with ``client_number`` 0, 1, … in ``order``, without a gap."""
    numbered = with_positions(clients, order, "client_number")
    return numbered.withColumn("client_number", F.col("client_number") - 1)


def made_up_clients(numbers: DataFrame) -> DataFrame:
    """Clients ``Client 0``, ``Client 1``, … for a column ``id`` of numbers without a gap."""
    return numbers.select(
        F.col("id").alias("client_number"),
        F.concat(F.lit("Client "), F.col("id").cast("string")).alias("client_name"),
    )


def client_map(clients: DataFrame) -> DataFrame:
    """``CLI-100``, ``CLI-101``, … with the name of each numbered client."""
    number = (F.col("client_number") + FIRST_CLIENT).cast("string")
    return clients.select(F.concat(F.lit("CLI-"), number).alias("internal_client_id"), "client_name")


def synthetic_billing(
    ids: DataFrame, clients: DataFrame, today: date, id_column: str = "id"
) -> DataFrame:
    """One billing line per id, each column picked evenly and only by the id.

    ``ids`` may be ``spark.range(n)`` or any column of whole numbers. Lines do
    not depend on partitions, retries or the day the job runs. Customers are drawn from ``clients``
    (client_number without a gap from 0, client_name) by an equi join with the drawn number; every
    number is drawn about equally often, so no client is hot. Without clients there is no customer.
    """
    seed = F.pmod(F.col(id_column), F.lit(_PRIME - 1)) + 1
    draws: list[Column] = []
    for _ in range(_WARM_UP + 8):
        seed = F.pmod(seed * _FACTOR, F.lit(_PRIME))
        draws.append(seed)
    draws = draws[_WARM_UP:]
    names = ["client", *CHOICES]
    drawn = ids.select(*(d.alias(f"_draw_{i}") for i, d in enumerate(draws)))

    def pick(i: int, n: int) -> Column:
        # High-order part of the draw: low-order bits of neighbours are related.
        return F.floor(F.col(f"_draw_{i}") * n / _PRIME).cast("int")

    n_clients = clients.agg(F.count("*")).scalar()
    picked = [F.floor(F.col("_draw_0") * n_clients / _PRIME).cast("long").alias("client_number")]
    picked += [
        F.element_at(F.array(*map(F.lit, values)), pick(i, len(values)) + 1).alias(name)
        for i, (name, values) in enumerate(CHOICES.items(), 1)
    ]
    n = len(names)
    lines = drawn.select(
        *picked,
        (pick(n, MAX_UNITS) + 1).cast("double").alias("units"),
        F.date_sub(F.lit(today), pick(n + 1, DAYS_BACK + 1)).alias("billing_date"),
    )
    named = clients.select(F.col("client_number").cast("long"), F.col("client_name").alias("customer"))
    drawn_clients = lines.join(named, "client_number", "left")
    return drawn_clients.select("customer", *(c for c in lines.columns if c != "client_number"))
