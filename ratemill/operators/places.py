"""Where rows of a customer meet: by the customer's key and a place.

Lines, prices and customers' ids that are shuffled by both need no further shuffle to be rated, rolled up and
looked up. All rows of a customer share one place, but for the wildcard customer, whose name can stand for any: its
lines and prices are dealt out by their items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The column, and the number of places of the wildcard customer.
PLACE = "_place"
PLACES = 1024


def place(customer_key: Column, item_key: Column, everyone: str) -> Column:
    """0, and for the customer ``everyone`` 1 to ``PLACES`` by the item."""
    dealt = F.pmod(F.hash(item_key), F.lit(PLACES)) + 1
    return F.when(customer_key == everyone, dealt).otherwise(0)


def in_all_places(rows: DataFrame, customer_key: str, everyone: str) -> DataFrame:
    """Rows of customers without an item: those of ``everyone`` once in each of its places."""
    places = F.when(F.col(customer_key) == everyone, F.sequence(F.lit(1), F.lit(PLACES)))
    return rows.withColumn(PLACE, F.explode(places.otherwise(F.array(F.lit(0)))))
