"""Hard negatives by threshold joins over an inverted index with norm bounds.

The score of two rows is the integer inner product of their scaled vectors. An anchor's positives are the rows
of its own label that score highest; its negatives for a positive are the highest rows of other
labels whose score lies in a window, given as shares of the positive's score.

Anchors and rows are dealt into blocks, and every block of anchors meets every block of rows: a stated
set of queries against all rows. Where they meet, all pairs that reach a threshold are found, in the manner of L2AP:

- Dimensions come in the order of their weight in the table, heaviest first. A row is listed under its leading dimensions
  only: by Cauchy and Schwarz the rest is left out as soon as its norm, times the longest anchor's, is below
  the threshold. A row whose whole norm is too small is listed nowhere.
- Partial scores are added up list by list. After some lists the rows that cannot reach any threshold, even with all
  of the remaining norms, are dropped.
- What is left is scored exactly.

Thresholds start high and are lowered, for the anchors that need it, until the windows of the block are full or the
threshold has passed the window's end. So a block gives the first rows of each window among its own, and the first
of these are the first of all. Scores below zero are in no window: a positive with a negative score has none,
so thresholds end at zero.

Rows with a NULL id or label, a NULL vector, or NULL or non-finite components take no part; zero vectors
do, and vectors meet those of their own length. Rows that repeat an id are rows of their own; ties go to the smaller id, then
to the earlier row of the table. A label or block may hold any share of the rows. Scores are exact: products beyond
2^53 are added up as Python integers, and a score that no long can hold fails the job. An empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

#: Components of a block of rows or anchors, and the least and most rows it has.
BLOCK_VALUES, FEWEST, MOST = 1 << 20, 256, 1 << 14
#: Anchors that are scored at a time, and dimensions after which rows are dropped.
TOGETHER, STEP = 128, 16
#: Sums below this are exact in double precision.
EXACT = float(1 << 53)


def _matrix(column: pa.ChunkedArray, scale: int, order: list[int]) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = np.floor(scale * flat.reshape(len(column), -1)) if len(order) else np.zeros((len(column), 0))
    return np.ascontiguousarray(rows[:, order])


def _rest_norms(rows: np.ndarray) -> np.ndarray:
    """Norms of what remains of each row from each dimension on, and zero at the end."""
    with np.errstate(over="ignore"):
        squares = np.cumsum(rows[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(rows), 1))], axis=1))


class Index:
    """Rows of a block, listed by dimension."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.rest = rows, _rest_norms(rows)

    def reaching(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, scores): the rows that may reach the threshold of an anchor, with exact scores.

        Every row that reaches a threshold is among them.
        """
        width = self.rows.shape[1]
        own_rest = _rest_norms(anchors)
        largest = own_rest[:, 0].max(initial=0) * self.rest[:, 0].max(initial=0)
        if not largest < EXACT:
            # Beyond exact doubles nothing is pruned, and whole numbers of any size are added up.
            return np.arange(len(self.rows)), _integers(anchors) @ _integers(self.rows).T
        # The leading dimensions that a row is listed under: the others cannot make up a threshold.
        longest = np.max(own_rest[:, 0] / np.maximum(thresholds, 1e-300), initial=0)
        listed = (self.rest[:, :-1] * longest * (1 + 1e-9) >= 1).sum(axis=1)
        numbers = np.argsort(-listed, kind="stable")
        numbers = numbers[: int((listed > 0).sum())] if (thresholds > 0).all() else numbers
        rows, listed = self.rows[numbers], listed[numbers]
        sums = np.zeros((len(anchors), len(numbers)))
        for start in range(0, width, STEP):
            end = min(start + STEP, width)
            # Rows listed under any of these dimensions come first.
            n = int(np.searchsorted(-listed, -start, side="left"))
            if not n:
                break
            sums[:, :n] += anchors[:, start:end] @ rows[:n, start:end].T
            # A row that is listed no further still has the norm from where its lists end.
            known = np.minimum(-(-listed // STEP) * STEP, width)
            known[:n] = end
            most = sums + own_rest[:, known] * self.rest[numbers, known] * (1 + 1e-9) + 0.5
            alive = (most >= thresholds[:, None]).any(axis=0)
            if not alive.all():
                numbers, listed, rows, sums = numbers[alive], listed[alive], rows[alive], sums[:, alive]
        return numbers, anchors @ rows.T


def _integers(rows: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    return np.array([[int(x) for x in row] for row in rows.tolist()], object).reshape(rows.shape)


def _windows_of(
    anchors: np.ndarray,
    index: Index,
    allowed: np.ndarray,
    starts: np.ndarray,
    uppers: np.ndarray,
    lowers: np.ndarray,
    most: int,
) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """(anchor, window, row numbers, scores): the first rows of each anchor's windows.

    ``uppers`` and ``lowers`` (anchors, windows) bound the scores; a window whose upper end is below its lower one
    or NaN is empty. ``starts`` are the first thresholds, ``allowed`` (anchors, rows) the pairs that count.
    Rows of equal score come in the order of the index.
    """
    open_, thresholds = np.arange(len(anchors)), np.array(starts, np.float64)
    there = uppers >= lowers
    floors = np.where(there, lowers, np.inf).min(axis=1, initial=np.inf)
    open_ = open_[np.isfinite(floors)]
    thresholds = np.maximum(thresholds, floors)
    while len(open_):
        numbers, scores = index.reaching(anchors[open_], thresholds[open_])
        # Back to the order of the index, which decides ties.
        order = np.argsort(numbers)
        numbers, scores = numbers[order], scores[:, order]
        short = []
        for i, anchor in enumerate(open_):
            own = np.flatnonzero((scores[i] >= thresholds[anchor]) & allowed[anchor, numbers])
            own = own[np.argsort(-scores[i, own], kind="stable")]
            ordered = -scores[i, own]
            cuts = []
            for window in np.flatnonzero(there[anchor]):
                first = np.searchsorted(ordered, -uppers[anchor, window], side="left")
                last = np.searchsorted(ordered, -max(lowers[anchor, window], thresholds[anchor]), side="right")
                if last - first < most and thresholds[anchor] > lowers[anchor, window]:
                    break
                cuts.append((window, own[first : min(last, first + most)]))
            else:
                for window, found in cuts:
                    yield int(anchor), int(window), numbers[found], scores[i, found].tolist()
                continue
            short.append(anchor)
        open_ = np.array(short, np.int64)
        # Half of the way to the floor, and to the floor itself when little is left.
        lowered = np.floor((thresholds[open_] + floors[open_]) / 2)
        near = lowered - floors[open_] < starts[open_] / 8
        thresholds[open_] = np.where(near, floors[open_], lowered)


def _met(
    key: tuple, anchors: pa.Table, members: pa.Table, scale: int, order: dict[int, list[int]], most: int, shares: tuple | None
) -> pa.Table:
    """Candidates of a block of anchors in a block of rows: positives, or negatives where ``shares`` are given."""
    out: list[tuple] = []
    if anchors.num_rows and members.num_rows:
        members = members.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        dims = order[key[0].as_py()]
        index = Index(_matrix(members.column("vector"), scale, dims))
        ids, rows = (members.column(c).to_numpy() for c in ("vec_id", "row"))
        labels = members.column("label").to_numpy()
        for start in range(0, anchors.num_rows, TOGETHER):
            some = anchors.slice(start, TOGETHER)
            matrix = _matrix(some.column("vector"), scale, dims)
            own_rows, own_labels = some.column("row").to_numpy(), some.column("label").to_numpy()
            same = own_labels[:, None] == labels[None, :]
            squares = np.minimum((matrix**2).sum(axis=1), np.finfo(np.float64).max)
            if shares is None:
                allowed = same & (own_rows[:, None] != rows[None, :])
                uppers = np.full((len(matrix), 1), np.inf)
                lowers, starts = np.zeros((len(matrix), 1)), np.floor(squares / 4)
            else:
                allowed = ~same
                scores = some.column("scores").to_pylist()
                ends = [[_window(p, *shares) for p in own] for own in scores]
                width = max(map(len, ends))
                ends = [own + [(1, 0)] * (width - len(own)) for own in ends]
                lowers = np.array([[low for low, _ in own] for own in ends], np.float64)
                uppers = np.array([[high for _, high in own] for own in ends], np.float64)
                starts = np.floor(np.where(uppers >= lowers, uppers, np.inf).min(axis=1, initial=np.inf) * 3 / 4)
                starts[~np.isfinite(starts)] = 0
            for anchor, window, found, values in _windows_of(matrix, index, allowed, starts, uppers, lowers, most):
                out.extend(
                    (int(own_rows[anchor]), window, int(ids[i]), int(rows[i]), int(s))
                    for i, s in zip(found.tolist(), values)
                )
    columns = zip(*out) if out else ([],) * 5
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["anchor", "place", "vec_id", "row", "score"]
    )


def _window(positive: int, least: int, most: int, of: int) -> tuple[int, int]:
    """The least and largest score with least * positive <= of * score <= most * positive."""
    return -(-least * positive // of), most * positive // of


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of squares by vector length and dimension, of a task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        for length in np.unique(lengths).tolist():
            own = batch.column("vector").filter(pa.array(lengths == length))
            rows = own.flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1) if length else np.zeros((1, 0))
            with np.errstate(over="ignore"):
                sums[length] = sums.get(length, 0) + (rows**2).sum(axis=0)
    for length, found in sums.items():
        n = len(found)
        yield pa.record_batch(
            [np.full(n, length, np.int32), np.arange(n, dtype=np.int32), found], ["length", "dim", "weight"]
        )


def _usable(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _blocks(n: Column, length: Column) -> Column:
    """Into how many blocks so many rows are dealt."""
    rows = F.greatest(
        F.lit(FEWEST), F.least(F.lit(MOST), F.floor(F.lit(BLOCK_VALUES) / F.greatest(length, F.lit(1))))
    )
    return F.greatest(F.ceil(n / rows), F.lit(1)).cast("int")


def _dealt(rows: DataFrame, anchors: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Anchors and rows with the blocks in which they meet; equal keys meet, all blocks of theirs."""
    counted = []
    for df, name in ((rows, "row_blocks"), (anchors, "anchor_blocks")):
        n = df.groupBy(*keys).agg(F.count("*").alias("n"))
        counted.append(n.select(*keys, _blocks(F.col("n"), F.col("length")).alias(name)))
    blocks = stored(counted[0].join(counted[1], keys))
    own = lambda n: F.pmod(F.xxhash64("row", F.lit(1)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.join(blocks, keys).withColumn("row_block", own("row_blocks"))
    members = members.withColumn("anchor_block", every("anchor_blocks"))
    asking = anchors.join(blocks, keys).withColumn("anchor_block", own("anchor_blocks"))
    asking = asking.withColumn("row_block", every("row_blocks"))
    return members, asking, [*keys, "anchor_block", "row_block"]


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int, int] = (30, 90, 100),
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, embedding, label; ``is_anchor`` and ``label`` are expressions over vec_id and label.
    ``window`` (a, b, c) takes scores s with a p <= c s <= b p, where p is the positive's score.
    A component x counts as floor(scale * x). For each vector length one number per dimension reaches the driver.
    """
    base = vectors.select(
        "vec_id", label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    base = base.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull()
        & F.coalesce(_usable(F.col("vector")), F.lit(False))
    )
    base = stored(
        base.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "label",
            F.size("vector").alias("length"), "vector",
        )
    )
    weights = (
        base.select("length", "vector")
        .mapInArrow(_weights, "length int, dim int, weight double")
        .groupBy("length", "dim")
        .agg(F.sum("weight").alias("weight"))
        .collect()
    )
    order: dict[int, list[int]] = {0: []}
    for r in sorted(weights, key=lambda r: (-r["weight"], r["dim"])):
        order.setdefault(r["length"], []).append(r["dim"])
    anchors = base.where(is_anchor)
    result = "anchor long, place int, vec_id long, row long, score long"
    first = [F.desc("score"), "vec_id", "row"]

    def meeting(asking: DataFrame, keys: list[str], carried: list[str], most: int, shares: tuple | None) -> DataFrame:
        members, asking, group = _dealt(base, asking, keys)
        columns = [c for c in ("row", "vec_id", "label", "vector") if c not in keys]
        met = (
            # Columns of their own: anchors are rows of the same table.
            asking.select(*(F.col(c).alias(c) for c in [*group, *columns, *carried]))
            .groupBy(*group)
            .cogroup(members.select(*group, *columns).groupBy(*group))
            .applyInArrow(lambda key, a, m: _met(key, a, m, scale, order, most, shares), result)
        )
        by_window = Window.partitionBy("anchor", "place").orderBy(*first)
        return met.withColumn("rank", F.row_number().over(by_window)).where(F.col("rank") <= most)

    found = meeting(anchors, ["length", "label"], [], positives, None)
    own = found.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("vec_id").alias("positive_id"), "score"))).alias("positives")
    )
    asking = stored(
        anchors.join(own, anchors["row"] == own["anchor"])
        .drop("anchor")
        .withColumn("scores", F.col("positives.score"))
    )
    chosen = meeting(asking, ["length"], ["scores"], negatives, window)
    named = asking.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positives")
    pairs = chosen.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(named, "anchor")
    positive = F.col("positives")[F.col("place")]
    return pairs.select(
        "anchor_id",
        positive["positive_id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        positive["score"].alias("positive_score"),
        "negative_score",
    )
