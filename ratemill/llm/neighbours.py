"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by a pseudo-random rotation (three rounds of random signs
and a fast Hadamard transform) and hashed to the nearest signed axis. Several such
hashes, the last one over as many coordinates as still fit, make a bucket; every
table has rotations of its own. Buckets become finer as the vectors become more, so that
a bucket holds about ``per_bucket`` of them at every size. A query looks into the
buckets of its next-nearest axes too, best first, and what it meets is ranked by
exact cosine in double precision.

How many buckets a query looks into follows from the vectors at hand: for a bounded
sample of queries of each length the true neighbours are found by comparing with every
vector, and ``probes`` is doubled until the sample's queries meet the share ``recall`` of
them, at the latest when they look into every bucket.

Equal vectors are one class with its rows' ids; as ties go to the smaller id, the six
smallest ids of a class are all that five neighbours can need. Buckets above
``piece_rows`` are cut into pieces, and so are the queries that look into them; every piece of
queries visits every piece of members, so a dense region is spread and nothing is dropped.

Vectors that are NULL, empty or zero, or hold NULL or non-finite components take no
part. Vectors meet only those of their own length. A repeated row is a row of its own:
it can be its copy's neighbour. A NULL id is no query and is not returned. An
empty table has no neighbours. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored


def _rotated(unit: np.ndarray, seed: list[int]) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform of the rows."""
    n, width = unit.shape
    rng = np.random.default_rng(seed)
    out = unit
    for _ in range(3):
        out = out * rng.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            pairs = out.reshape(n, -1, 2, step)
            out = np.concatenate(
                [pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2
            ).reshape(n, width)
            step *= 2
        out = out / np.sqrt(width)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit rows, padded with zeros to a power of two."""
    width = 1 << max(vectors.shape[1] - 1, 1).bit_length()
    # Largest component first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return np.pad(unit, ((0, 0), (0, width - vectors.shape[1])))


def hash_widths(width: int, rows: int, per_bucket: int) -> list[int]:
    """Coordinates of each hash of a table: their signed axes multiply to rows / per_bucket."""
    left = max(int(np.ceil(np.log2(max(rows, 1) / per_bucket))), 1)
    whole, out = int(np.log2(2 * width)), []
    while left > 0:
        out.append(1 << (min(left, whole) - 1))
        left -= whole
    return out


def buckets(vectors: np.ndarray, table: int, widths: list[int], probes: int) -> np.ndarray:
    """(n, probes) bucket numbers of a table, nearest first; -1 where there are fewer."""
    unit = _unit(vectors)
    few = max(2, int(np.ceil(probes ** (1 / len(widths)))) + 1) if probes > 1 else 1
    number, cost = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for level, width in enumerate(widths):
        turned = _rotated(unit, [table, level, unit.shape[1]])[:, :width]
        both = np.concatenate([turned, -turned], axis=1)
        most = min(2 * width, probes if len(widths) == 1 else few * 2)
        if probes >= every_bucket(widths):
            most = 2 * width
        order = np.argsort(-both, axis=1, kind="stable")[:, :most]
        value = np.take_along_axis(both, order, axis=1)
        # The best of all levels start with the best of the levels so far.
        number = (number[:, :, None] * (2 * width) + order[:, None, :]).reshape(len(unit), -1)
        cost = (cost[:, :, None] + ((value[:, :1] - value) ** 2)[:, None, :]).reshape(len(unit), -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        number = np.take_along_axis(number, best, axis=1)
        cost = np.take_along_axis(cost, best, axis=1)
    return number


def every_bucket(widths: list[int]) -> int:
    return math.prod(2 * width for width in widths)


def probes_for(
    queries: np.ndarray, members: np.ndarray, tables: int, widths: list[int], least: int, recall: float
) -> int:
    """Probes, doubled from ``least``, with which queries meet that share of their members."""
    probes, every = least, every_bucket(widths)
    while probes < every and len(queries):
        met = np.zeros(len(queries), bool)
        for at in _few_rows(len(queries), probes):
            for table in range(tables):
                looked = buckets(queries[at], table, widths, probes)
                met[at] |= (looked == buckets(members[at], table, widths, 1)).any(axis=1)
        if met.mean() >= recall:
            break
        probes *= 2
    return min(probes, max(every, least))


def _few_rows(rows: int, probes: int) -> Iterator[slice]:
    """Slices of rows whose probes fit the memory together."""
    step = max(1, (1 << 17) // probes)
    return (slice(at, at + step) for at in range(0, rows, step))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _hashed(
    batches: Iterator[pa.RecordBatch], tables: int, sizes: dict, probes: dict, carried: list[str]
):
    for batch in batches:
        for part in _pieces(batch, probes):
            vectors = _matrix(part.column("vector"))
            length = vectors.shape[1]
            for table in range(tables):
                found = buckets(vectors, table, sizes[length], probes.get(length, 1))
                row = np.repeat(np.arange(len(found)), found.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), length, np.int64)),
                        pa.array(np.full(len(row), table, np.int64)),
                        pa.array(found.ravel()),
                        *part.select(carried).take(pa.array(row)).columns,
                    ],
                    names=["length", "table", "bucket", *carried],
                )


def _by_length(batch: pa.RecordBatch):
    lengths = np.array([len(v) for v in batch.column("vector").to_pylist()], np.int64)
    for length in np.unique(lengths):
        yield batch.take(pa.array(np.flatnonzero(lengths == length)))


def _pieces(batch: pa.RecordBatch, probes: dict):
    for part in _by_length(batch):
        for at in _few_rows(part.num_rows, probes.get(len(part.column("vector")[0]), 1)):
            yield part.slice(at.start, at.stop - at.start)


def _compared(batches: Iterator[pa.RecordBatch], samples: dict, most: int):
    """Per task: the nearest other vectors to each sampled query, of all vectors."""
    best: dict[int, tuple] = {}
    for batch in batches:
        for part in _by_length(batch):
            vectors = _matrix(part.column("vector"))
            length = vectors.shape[1]
            if length not in samples:
                continue
            keys, unit = samples[length]
            scores = unit @ _unit(vectors).T
            scores[np.array(keys)[:, None] == np.array(part.column("k").to_pylist())] = -np.inf
            vectors = np.broadcast_to(vectors, (len(keys), *vectors.shape))
            if length in best:
                scores = np.concatenate([best[length][0], scores], axis=1)
                vectors = np.concatenate([best[length][1], vectors], axis=1)
            top = np.argsort(-scores, axis=1, kind="stable")[:, :most]
            best[length] = (
                np.take_along_axis(scores, top, axis=1),
                np.take_along_axis(vectors, top[:, :, None], axis=1),
            )
    for length, (scores, vectors) in best.items():
        at, place = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(at), length, np.int64)),
                pa.array(at),
                pa.array(scores[at, place]),
                pa.array(list(vectors[at, place]), pa.list_(pa.float64())),
            ],
            names=["length", "at", "score", "vector"],
        )


def _probes(
    classes: DataFrame, asked: DataFrame, sizes: dict, neighbours: int, tables: int, least: int,
    recall: float, sample: int,
) -> dict[int, int]:
    """Probes by vector length, from true neighbours of ``sample`` queries of each length."""
    partial = [n for n, widths in sizes.items() if every_bucket(widths) > least]
    probes = dict.fromkeys(sizes, least)
    if not partial:
        return probes
    # Spark keeps the first rows of each length per task before it shuffles them.
    by_hash = Window.partitionBy("length").orderBy(F.xxhash64("k", F.lit(3)), "k")
    drawn = (
        asked.withColumn("length", F.size("vector"))
        .where(F.col("length").isin(partial))
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= sample)
        .orderBy("length", "place")
        .collect()
    )
    vectors: dict[int, list] = defaultdict(list)
    keys: dict[int, list] = defaultdict(list)
    for row in drawn:
        vectors[row["length"]].append(row["vector"])
        keys[row["length"]].append(row["k"])
    samples = {n: (keys[n], _unit(np.array(vectors[n], np.float64))) for n in vectors}
    near = classes.select("k", "vector").mapInArrow(
        lambda batches: _compared(batches, samples, neighbours),
        "length long, at long, score double, vector array<double>",
    )
    by_score = Window.partitionBy("length", "at").orderBy(F.desc("score"), "vector")
    pairs = defaultdict(list)
    for row in (
        near.withColumn("place", F.row_number().over(by_score))
        .where(F.col("place") <= neighbours)
        .collect()
    ):
        pairs[row["length"]].append((row["at"], row["vector"]))
    for length, found in pairs.items():
        asking = np.array([vectors[length][at] for at, _ in found], np.float64)
        members = np.array([vector for _, vector in found], np.float64)
        probes[length] = probes_for(asking, members, tables, sizes[length], least, recall)
    return probes


def _in_range(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, exactly, so that their squares are neither lost nor infinite."""
    _, exponents = np.frexp(np.abs(rows).max(axis=1, initial=0.0))
    # In two steps, as a factor itself may leave the range.
    half = -exponents // 2
    return np.ldexp(np.ldexp(rows, half[:, None]), (-exponents - half)[:, None])


def _best(queries: pa.Table, members: pa.Table, most: int) -> pa.Table:
    """The nearest rows to each query among the members of a bucket piece."""
    out: list[tuple] = []
    if queries.num_rows and members.num_rows:
        m = _in_range(_matrix(members.column("vector")))
        norms = np.sqrt((m * m).sum(axis=1))
        rows = [list(zip(*x)) for x in zip(*(members.column(c).to_pylist() for c in ("ids", "rows")))]
        for query, q in zip(queries.column("k").to_pylist(), _in_range(_matrix(queries.column("vector")))):
            scores = (m * q).sum(axis=1) / (norms * np.sqrt((q * q).sum()))
            near = np.arange(len(scores))
            if len(scores) > most:
                # Ties at the last place stay in until ids decide.
                near = np.flatnonzero(scores >= np.partition(scores, -most)[-most])
            best = sorted((-scores[i], *row) for i in near.tolist() for row in rows[i])[:most]
            out.extend((query, vec_id, row, -score) for score, vec_id, row in best)
    columns = zip(*out) if out else ([],) * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.float64())
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["k", "vec_id", "row", "score"]
    )


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _pieces_of(piece_rows: int) -> Column:
    return F.ceil(F.count("*") / piece_rows).cast("int")


def _piece_of(pieces: str) -> Column:
    return F.pmod(F.xxhash64("k", F.lit(2)), F.col(pieces)).cast("int")


def _every(pieces: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    neighbours: int = 5,
    tables: int = 12,
    probes: int = 16,
    per_bucket: int = 128,
    piece_rows: int = 4096,
    recall: float = 0.95,
    sample: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row (vec_id, embedding) its nearest other rows.

    ``is_query`` is a condition on vec_id; ``probes`` is the least number of buckets of a table
    that a query looks into. Of each vector length one row, ``sample`` queries and their
    neighbours reach the driver.
    """
    usable = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    usable = usable.where(F.coalesce(_usable(F.col("vector")), F.lit(False)) & F.col("vec_id").isNotNull())
    usable = usable.withColumn(
        "k",
        F.concat_ws("-", F.hex(F.xxhash64("vector")), F.hex(F.xxhash64("vector", F.lit(1)))),
    )
    usable = stored(usable.withColumn("row", F.monotonically_increasing_id()))
    most = neighbours + 1
    # Spark keeps the first rows of each group per task before it shuffles them.
    first = usable.withColumn(
        "at", F.row_number().over(Window.partitionBy("k").orderBy("vec_id", "row"))
    ).where(F.col("at") <= most)
    same = F.sort_array(F.collect_list(F.struct("vec_id", "row")))
    classes = first.groupBy("k").agg(F.any_value("vector").alias("vector"), same.alias("same"))
    classes = stored(
        classes.select(
            "k", "vector", F.col("same.vec_id").alias("ids"), F.col("same.row").alias("rows")
        )
    )
    queries = usable.where(is_query).select(
        "k", F.col("vec_id").alias("query_id"), F.col("row").alias("query_row")
    )
    asked = classes.join(queries.select("k").distinct(), "k", "left_semi").select("k", "vector")
    sizes = {
        r["length"]: hash_widths(1 << max(r["length"] - 1, 1).bit_length(), r["n"], per_bucket)
        for r in classes.groupBy(F.size("vector").alias("length")).agg(
            F.count("*").alias("n")
        ).collect()
    }
    key = ["length", "table", "bucket"]
    place = "length long, table long, bucket long"
    fields = f"{place}, k string, vector array<double>"
    entries = ["k", "vector", "ids", "rows"]
    index = stored(
        classes.mapInArrow(
            lambda b: _hashed(b, tables, sizes, {}, entries),
            f"{fields}, ids array<long>, rows array<long>",
        )
    )
    looked = _probes(classes, asked, sizes, neighbours, tables, probes, recall, sample)
    seen = asked.mapInArrow(lambda b: _hashed(b, tables, sizes, looked, ["k", "vector"]), fields)
    # Counted without the vectors; both counts are small beside what they count.
    asking = asked.mapInArrow(lambda b: _hashed(b, tables, sizes, looked, []), place)
    cuts = index.groupBy(*key).agg(_pieces_of(piece_rows).alias("pieces"))
    cuts = cuts.join(asking.groupBy(*key).agg(_pieces_of(piece_rows).alias("asking")), key)
    cuts = stored(cuts)
    members, visits = index.join(cuts, key), seen.join(cuts, key)
    members = members.withColumn("piece", _piece_of("pieces")).withColumn("part", _every("asking"))
    visits = visits.withColumn("part", _piece_of("asking")).withColumn("piece", _every("pieces"))
    group = [*key, "piece", "part"]
    met = (
        visits.select(*group, "k", "vector")
        .groupBy(*group)
        .cogroup(members.select(*group, "vector", "ids", "rows").groupBy(*group))
        .applyInArrow(
            lambda q, m: _best(q, m, most), "k string, vec_id long, row long, score double"
        )
    )
    # A row that was met in several tables counts once.
    order = [F.desc("score"), "vec_id", "row"]
    top = (
        met.distinct()
        .withColumn("at", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
        .where(F.col("at") <= most)
        .drop("at")
    )
    found = queries.join(top, "k").where("row != query_row")
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_row").orderBy(*order))
    ).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
