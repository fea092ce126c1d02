"""Quantity rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLLUP_KEYS = ("customer", "item", "price_level", "ca_line")


def drop_null_keys(lines: DataFrame) -> DataFrame:
    """Lines without customer or item are not billed; the filter reaches the scan."""
    return lines.filter("customer IS NOT NULL AND item IS NOT NULL")


def combine_lines(lines: DataFrame) -> DataFrame:
    """Add up the units of lines that no later step can tell apart."""
    return lines.groupBy("customer", "item", "county", "type", "ca_line").agg(
        F.sum("units").alias("units")
    )


def quantity_rollup(rated: DataFrame, placed_by: Sequence[str] = ()) -> DataFrame:
    """Units per customer, item, price level and flag, as written in the lines.

    A group whose units are all missing has quantity 0. ``placed_by`` names columns that follow from customer and
    item; lines that are shuffled by them already stay where they are.
    """
    return (
        drop_null_keys(rated)
        .groupBy(*placed_by, *ROLLUP_KEYS)
        .agg(F.coalesce(F.sum("units"), F.lit(0.0)).alias("qty"))
    )
