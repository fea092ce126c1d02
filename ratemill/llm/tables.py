"""Reading tables, keeping intermediate tables, and whole-text batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.session import shared_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Later steps start from the files, so a lost executor costs no more than the
    step at hand.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text as long; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts as bytes; NULL is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], most: int = 1 << 20) -> Iterator[slice]:
    """Slices of at most ``most`` bytes, or of one longer text."""
    return slices(map(len, texts), most)


def slices(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Slices that add up to at most ``most``, or hold one larger size."""
    start = end = total = 0
    for end, size in enumerate(sizes, 1):
        if total and total + size > most:
            yield slice(start, end - 1)
            start, total = end - 1, 0
        total += size
    if start < end:
        yield slice(start, end)


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder, and the folder's path there."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder)
