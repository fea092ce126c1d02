"""Sharding by extendible hashing.

A document's hash names a path of bits. A bucket is a prefix of that path; one
that is too large splits on the next bit, others are left alone, until every
bucket fits the byte limit or holds one document. The directory of buckets is
found from sums over hash cells, twelve bits a round, so rows move once for each
round in which their bucket is still too large.

Documents that share all 60 bits (equal ids) are hashed anew together with
a row number, so that a repeated id cannot overfill a bucket. A NULL id is hashed
as a value of its own; a NULL text has 0 bytes. A document above the limit has
a shard to itself. An empty table has no shards. The input's columns are kept;
added ones are prefixed with ``shard``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

BITS = 60
ROUND_BITS = 12


def hash_bits(text: Column) -> Column:
    """The first 60 bits of the text's MD5, as a non-negative long."""
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _bits(value: Column, n: Column) -> Column:
    """The low ``n`` bits of a value as a text of zeros and ones; empty for none."""
    return F.when(n == 0, "").otherwise(F.expr("lpad(bin(prefix), cast(depth as int), '0')"))


def _settled(cells: DataFrame, first: bool, max_bytes: int) -> DataFrame:
    """For each cell of each open bucket the shortest prefix that fits; NULL if none does."""
    depths = F.sequence(F.lit(0 if first else 1), F.lit(ROUND_BITS))
    levels = cells.select("path", "cell", "bytes", "docs", F.explode(depths).alias("depth"))
    levels = levels.withColumn(
        "prefix", F.expr(f"shiftright(cell, {ROUND_BITS} - cast(depth as int))")
    )
    sums = levels.groupBy("path", "depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")
    )
    fits = sums.where((F.col("shard_bytes") <= max_bytes) | (F.col("shard_docs") == 1))
    found = levels.join(fits, ["path", "depth", "prefix"]).groupBy("path", "cell").agg(
        F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("best")
    )
    return found.select("path", "cell", "best.*")


def assign_shards(
    docs: DataFrame, max_bytes: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """shard_doc_id, shard_doc_bytes, shard, shard_depth, shard_bytes and shard_docs of every row."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("doc_bytes"),
        hash_bits(name).alias("bits"),
        F.lit("").alias("path"),
    )
    done: list[DataFrame] = []
    used, first = 0, True
    opened = stored(rows)
    while first or not opened.isEmpty():
        if used == BITS:
            own = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
            salted = F.concat_ws("#", own, F.monotonically_increasing_id().cast("string"))
            opened, used = stored(opened.withColumn("bits", hash_bits(salted))), 0
        used += ROUND_BITS
        cut = opened.withColumn(
            "cell", F.expr(f"shiftright(bits, {BITS - used}) & {(1 << ROUND_BITS) - 1}")
        )
        cells = stored(
            cut.groupBy("path", "cell").agg(
                F.sum("doc_bytes").alias("bytes"), F.count("*").alias("docs")
            )
        )
        settled = _settled(cells, first, max_bytes)
        placed = stored(cut.join(settled, ["path", "cell"], "left"))
        done.append(
            placed.where(F.col("depth").isNotNull()).select(
                F.col("doc_id").alias("shard_doc_id"),
                F.col("doc_bytes").alias("shard_doc_bytes"),
                F.concat("path", _bits(F.col("prefix"), F.col("depth"))).alias("shard"),
                (F.length("path") + F.col("depth")).alias("shard_depth"),
                "shard_bytes",
                "shard_docs",
            )
        )
        longer = F.concat("path", F.lpad(F.bin("cell"), ROUND_BITS, "0"))
        opened = placed.where(F.col("depth").isNull()).select(
            "doc_id", "doc_bytes", "bits", longer.alias("path")
        )
        first = False
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def write_shards(docs: DataFrame, shards: DataFrame, path: str) -> None:
    """One folder of Parquet per shard, written by one task each.

    ``docs`` needs unique ids (doc_id). A shard is bounded, so no task is.
    """
    placed = docs.join(
        shards.select(F.col("shard_doc_id").alias("doc_id"), "shard"), "doc_id"
    ).withColumn("shard", F.concat(F.lit("s"), "shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
