"""Positions in an order over all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, stored


def with_positions(
    rows: DataFrame, order: list[Column], as_name: str, wide: bool = False
) -> DataFrame:
    """The rows with their position 1, 2, … in ``order``, which has to be total for fixed results.

    A range sort deals the rows out by their order, so a frequent value is spread if later columns of the
    order tell its rows apart. The sorted rows are saved with their partition, the rows before each
    partition are added up from one summary row per partition, and each row adds its place in its own.
    ``wide`` rows are saved as Parquet and not shuffled again: the summary is broadcast to them.
    """
    saved = (stored if wide else checkpointed)(
        rows.orderBy(*order).withColumns(
            {"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}
        )
    )
    parts = saved.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return (
        saved.join(F.broadcast(shifts) if wide else shifts, "_part")
        .withColumn(as_name, F.col("_id") + F.col("_shift"))
        .drop("_part", "_id", "_shift")
    )
