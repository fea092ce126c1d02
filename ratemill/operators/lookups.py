"""Lookups of ids, line order and prices.

The joins carry no broadcast hint. The lookup tables grow with the business,
so the choice between broadcast and shuffle join is left to Spark, which makes
it on the tables' sizes and revises it on the sizes it sees at run time, and
which splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import item_key, item_key_text, level_key, match_key
from .places import PLACE, in_all_places, place


def _payload(df: DataFrame, keys: list[str], order: str) -> Column:
    return F.struct(*(c for c in df.columns if c not in keys and c != order))


def required_order(order: str) -> Column:
    """The order column; a NULL in it fails the job, since no row may be picked by chance."""
    missing = F.raise_error(F.lit(f"a row has no {order}"))
    return F.coalesce(F.col(order), missing.cast("long"))


def first_per_key(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """One row per key, the one that comes first in ``order``.

    ``dropDuplicates`` would keep an arbitrary row.
    """
    picked = F.min_by(_payload(df, keys, order), required_order(order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")


def last_per_key(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """One row per key, the one that comes last in ``order``."""
    picked = F.max_by(_payload(df, keys, order), required_order(order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")


def stored_keys(table: str) -> dict[str, Column]:
    """The normalised key columns that a bucketed table of this name has."""
    customer = {"customer_key": match_key(F.col("customer_name"))}
    item = {"item_key": item_key(F.col("item_code"))}
    level = {"level_key": level_key(F.col("price_level_name"))}
    return {"customers_db": customer, "items_db": item, "prices_db": customer | item | level}.get(table, {})


def _key(table: DataFrame, name: str, made: Column) -> Column:
    """A stored key column, if the table has it, else the key made from its name."""
    return (F.col(name) if name in table.columns else made).alias(name)


def customer_ids(customers: DataFrame, dedupe: bool = True) -> DataFrame:
    """``customer_key``, ``customer_id``; the first customer of a key unless told otherwise."""
    ids = customers.select(
        _key(customers, "customer_key", match_key(F.col("customer_name"))),
        F.col("netsuite_id").alias("customer_id"),
        "seq",
    )
    return first_per_key(ids, ["customer_key"]) if dedupe else ids.drop("seq")


def item_ids(
    items: DataFrame, dedupe: bool = True, text_keys: bool = False
) -> DataFrame:
    """``item_key``, ``item_id``, ``line_order``; as ``customer_ids``."""
    code = F.col("item_code")
    key = item_key_text(code).alias("item_key") if text_keys else _key(items, "item_key", item_key(code))
    ids = items.select(
        key,
        F.col("netsuite_internal_id").alias("item_id"),
        "line_order",
        "seq",
    )
    return first_per_key(ids, ["item_key"]) if dedupe else ids.drop("seq")


def price_keys(prices: DataFrame, text_keys: bool = False) -> DataFrame:
    """Prices under normalised keys. Not deduplicated: equal keys multiply lines."""
    code = F.col("item_code")
    key = item_key_text(code).alias("item_key") if text_keys else _key(prices, "item_key", item_key(code))
    return prices.select(
        _key(prices, "customer_key", match_key(F.col("customer_name"))),
        key,
        _key(prices, "level_key", level_key(F.col("price_level_name"))),
        "price",
    )


#: The columns that ``add_match_keys`` adds.
MATCH_KEYS = ("customer_key", "item_key", "level_key")


def add_match_keys(sheet: DataFrame, text_keys: bool = False) -> DataFrame:
    """The keys of customer, item and price level; a customer's key that is there stays, and rows with it."""
    key = item_key_text if text_keys else item_key
    keys = {
        "customer_key": match_key(F.col("customer")),
        "item_key": key(F.col("item")),
        "level_key": level_key(F.col("price_level")),
    }
    if "customer_key" in sheet.columns:
        del keys["customer_key"]
    return sheet.withColumns(keys)


def join_customer(
    sheet: DataFrame, customers: DataFrame, dedupe: bool = True, everyone: str | None = None
) -> DataFrame:
    """With ``everyone``, the key of the wildcard customer, rows meet by customer and ``PLACE``."""
    ids = customer_ids(customers, dedupe)
    if everyone is None:
        return sheet.join(ids, "customer_key", "left")
    return sheet.join(in_all_places(ids, "customer_key", everyone), ["customer_key", PLACE], "left")


def join_item(
    sheet: DataFrame, items: DataFrame, dedupe: bool = True, text_keys: bool = False
) -> DataFrame:
    return sheet.join(item_ids(items, dedupe, text_keys), "item_key", "left")


def join_price(
    sheet: DataFrame, prices: DataFrame, text_keys: bool = False, everyone: str | None = None
) -> DataFrame:
    """With ``everyone`` as in ``join_customer``."""
    keys = ["customer_key", "item_key", "level_key"]
    keyed = price_keys(prices, text_keys)
    if everyone is not None:
        keyed = keyed.withColumn(PLACE, place(F.col("customer_key"), F.col("item_key"), everyone))
        keys.append(PLACE)
    return sheet.join(keyed, keys, "left")


def join_price_strict(
    sheet: DataFrame, prices: DataFrame, everyone: str | None = None
) -> DataFrame:
    """Price of exactly this customer, item and level, as written; with ``everyone`` as in ``join_customer``."""
    exact = prices.select(
        F.col("customer_name").alias("customer"),
        F.col("item_code").alias("item"),
        F.col("price_level_name").alias("price_level"),
        "price",
    )
    keys = ["customer", "item", "price_level"]
    if everyone is not None:
        exact = exact.withColumn(PLACE, place(F.col("customer"), F.col("item"), everyone))
        keys.append(PLACE)
    return sheet.join(exact, keys, "left")


def lookup_last(
    sheet: DataFrame,
    key: str,
    table: DataFrame,
    table_key: str,
    value: str,
    as_name: str,
    everyone: str | None = None,
) -> DataFrame:
    """Add the value the table last gave to the key; NULL where it has none.

    With ``everyone`` as in ``join_customer``, for a key that is the customer.
    """
    pairs = table.select(
        F.col(table_key).alias(key), F.col(value).alias(as_name), "seq"
    ).dropna(subset=[key])
    last = last_per_key(pairs, [key])
    if everyone is None:
        return sheet.join(last, key, "left")
    return sheet.join(in_all_places(last, key, everyone), [key, PLACE], "left")


def default_customer_id(customers: DataFrame, name: str = "DEFAULT") -> Column:
    """The id of the default customer as a scalar subquery; NULL if there is none."""
    rows = customers.filter(F.col("customer_name") == name)
    return rows.agg(F.max_by("netsuite_id", "seq")).scalar()


def fill_missing(
    sheet: DataFrame, line_order: int, customer_id: str | Column, price: float
) -> DataFrame:
    """Fallbacks after the lookups. A missing item id has none and stays missing."""
    fallback_id = F.lit(customer_id) if isinstance(customer_id, str) else customer_id
    return sheet.withColumns(
        {
            "line_order": F.coalesce("line_order", F.lit(line_order)),
            "customer_id": F.coalesce("customer_id", fallback_id),
            "price": F.coalesce("price", F.lit(price)),
        }
    )


def line_value(qty: Column, price: Column) -> Column:
    return qty * price
