"""Removing repeated byte strings by prefix-free parsing.

Every byte that a string of ``length`` bytes covers which also starts anywhere else
is removed. Texts are parsed at triggers: places where a rolling hash of the next
``WIDTH`` bytes is 0 modulo ``every``. What follows a trigger depends on the bytes
alone, so equal strings are parsed alike wherever they stand, and each string is
owned by the first trigger within it: its place is its distance to that trigger.

The order of all suffixes is needed only down to depth ``length``, and only as far as
which suffixes agree there. So instead of sorting positions one by one, runs of
consecutive strings with the same owner are compared as classes, coarse to fine:

- the core of a run, what all its strings share, is unique: none of them repeats;
- the whole span of a run occurs again: all of them repeat;
- otherwise the run is cut into finer runs, down to single strings.

A span that is settled stands for its class in finer rounds where other runs with its
core are still open. All comparisons are grouped counts of 128-bit hashes,
combined before they are shuffled; no group is gathered anywhere.

Runs that are equal within the texts a task holds at once repeat, whatever else the corpus
has. They are settled there, and one of them goes on for all, so that a long run of one
character or a passage in every text does not send its runs to one task.

Strings without a trigger (long runs of one character, say) are owned by the place in
them whose rolling hash is smallest, the leftmost of equals.

Texts are written once to the shared folder. A round sends the open runs to the
file that holds their text, so texts are not shuffled.

A NULL text is an empty one. Strings never cross documents. Repeated rows
are documents of their own: their strings start elsewhere, too. Texts of any length are
parsed whole, long ones in overlapping pieces that share no string. An empty table gives
no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.session import shared_dir

from .tables import filesystem, stored, utf8

WIDTH = 32
#: Distances to the owner that runs of the first rounds cover, from and up to.
NEAR, FAR = (0, 95), (96, 511)
#: Strings per run in the following rounds.
FINER = (16, 4, 1)
PIECE = 1 << 20
#: Runs with one core from which on the first round looks for equal ones among them.
MANY = 8
#: A place is packed as offset, low and high distance.
BITS, MASK = 9, 511
ROW_BITS = 40

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_BYTES = np.random.default_rng(20_240_101).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


@lru_cache(4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Rolling hashes of some bytes."""

    def __init__(self, data: np.ndarray, which: int) -> None:
        n, base = len(data), _MULTIPLIERS[which]
        room = 1 << max(n + 1, 1 << 16).bit_length()
        self.inverse = _powers(pow(base, -1, 1 << 64), room)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[which][data] * _powers(base, room)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, piece): every string of ``length`` bytes is whole in exactly one piece."""
    for start in range(0, len(text) - length + 1, PIECE):
        yield start, text[start : start + PIECE + length - 1]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in every window."""
    windows = np.lib.stride_tricks.sliding_window_view(values, width)
    step = 1 << 14
    found = [windows[i : i + step].argmin(axis=1) for i in range(0, len(windows), step)]
    return np.concatenate(found) + np.arange(len(windows))


def owned_runs(data: np.ndarray, ends: np.ndarray, length: int, every: int, hashes: Hashes):
    """(owner, low, high) of the runs of all strings in pieces laid end to end.

    A string is named by its distance to its owner; a run holds all distances from low
    to high. Runs stay within NEAR or FAR.
    """
    n, starts = len(data), np.concatenate([[0], ends[:-1]])
    at = np.arange(n - WIDTH + 1)
    grams = hashes.of(at, at + WIDTH)
    found = np.flatnonzero((grams >> np.uint64(20)) % np.uint64(every) == 0)
    piece = np.searchsorted(ends, found, side="right")
    inside = found + WIDTH <= ends[piece]
    found, piece = found[inside], piece[inside]
    before = np.concatenate([[-1], found[:-1]])
    first = np.maximum(np.maximum(before + 1, starts[piece]), found - (length - WIDTH))
    last = np.minimum(found, ends[piece] - length)
    some = first <= last
    runs = [np.stack([found, found - last, found - first])[:, some]]
    # Strings without a trigger: what the runs above leave of all strings.
    free = np.zeros(n + 1, np.int64)
    whole = ends - starts >= length
    np.add.at(free, starts[whole], 1)
    np.add.at(free, ends[whole] - length + 1, -1)
    np.add.at(free, first[some], -1)
    np.add.at(free, last[some] + 1, 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(free)])))
    for a, b in edges.reshape(-1, 2):
        owner = _smallest(grams[a : b + length - WIDTH], length - WIDTH + 1) + a
        cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        stop = np.append(cut[1:], b - a)
        runs.append(np.stack([owner[cut], owner[cut] - (a + stop - 1), owner[cut] - (a + cut)]))
    owner, low, high = np.concatenate(runs, axis=1)
    near, far = low <= NEAR[1], high >= FAR[0]
    return np.concatenate(
        [
            np.stack([owner, low, np.minimum(high, NEAR[1])])[:, near],
            np.stack([owner, np.maximum(low, FAR[0]), high])[:, far],
        ],
        axis=1,
    )


def cores(low: np.ndarray, high: np.ndarray, length: int, width: int | None):
    """The class of each run: least distance, and greatest, that a run of its kind can have."""
    if width is None:
        near, farthest = low <= NEAR[1], length - WIDTH
        return np.where(near, NEAR[0], FAR[0]), np.where(near, min(NEAR[1], farthest), farthest)
    floor = low // width * width
    return floor, floor + width - 1


def _packed(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return at << 2 * BITS | low << BITS | high


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 2 * BITS, place >> BITS & MASK, place & MASK


def _spans(hashes: list[Hashes], at, low, high, length: int) -> list[np.ndarray]:
    """128 bits for all that the strings of each run cover, and their distances."""
    kind = (low << BITS | high).astype(np.uint64)
    return [h.of(at - high, at - low + length) + kind for h in hashes]


def _stands_for(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How many equal keys each first one stands for, 0 for the others; and which are not alone."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    head = np.flatnonzero(new)
    counts = np.diff(np.append(head, len(order)))
    n, several = np.zeros(len(order), np.int32), np.zeros(len(order), bool)
    n[order[head]] = counts
    several[order] = np.repeat(counts > 1, counts)
    return n, several


def _joined(rows, at, low, high) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the same strings in fewer places; those of neighbours become one."""
    order = np.lexsort((at - high, rows))
    rows, start, end = rows[order], (at - high)[order], (at - low)[order] + 1
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (start[1:] != end[:-1])
    head = np.flatnonzero(new)
    rows, start, end = rows[head], start[head], end[np.append(head[1:], len(end)) - 1]
    run, start, end = _cut_up(start, end, MASK + 1)
    return rows[run], _packed(end - 1, np.zeros_like(start), end - 1 - start)


def _cut_up(start, end, width):
    """(which, start, end) of stretches cut to at most ``width``."""
    parts = -(-(end - start) // width)
    run = np.repeat(np.arange(len(start)), parts)
    step = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = start[run] + step * width
    return run, start, np.minimum(start + width, end[run])


def _gathered(items: Iterator[tuple], most: int = PIECE) -> Iterator[list[tuple]]:
    """Lists of pieces (last element) of about ``most`` bytes."""
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _laid_out(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(x[-1] for x in held), np.uint8)
    ends = np.cumsum([len(x[-1]) for x in held])
    return data, ends, np.concatenate([[0], ends[:-1]])


def _first_round(batches: Iterator[pa.RecordBatch], length: int, every: int):
    """Rows of FIRST: every run of all texts, one for those that are equal in a task's texts."""
    for batch in batches:
        texts = zip(batch.column("row").to_pylist(), utf8(batch.column("text")))
        cut = ((row, offset, p) for row, text in texts for offset, p in pieces(text, length))
        for held in _gathered(cut):
            data, ends, starts = _laid_out(held)
            hashes = Hashes(data, 0)
            at, low, high = owned_runs(data, ends, length, every, hashes)
            least, most = cores(low, high, length, None)
            core = hashes.of(at - least, at - most + length) + least.astype(np.uint64)
            piece = np.searchsorted(ends, at, side="right")
            rows = np.array([x[0] for x in held], np.int64)[piece]
            moved = (np.array([x[1] for x in held], np.int64) - starts)[piece]
            n, several = np.ones(len(at), np.int32), np.zeros(len(at), bool)
            _, number, count = np.unique(core, return_inverse=True, return_counts=True)
            hot = np.flatnonzero(count[number] >= MANY)
            if len(hot):
                both = [hashes, Hashes(data, 1)]
                keys = [core[hot], *_spans(both, at[hot], low[hot], high[hot], length)]
                n[hot], several[hot] = _stands_for(keys)
            yield from _split([core], rows, at + moved, low, high, n, several, FIRST)


def _split(keys, rows, at, low, high, n, several, schema: str):
    """Runs that go on, with how many they stand for, and the places of those that repeat, for which n is 0."""
    names, on = [f.split()[0] for f in schema.split(", ")], n > 0
    columns = [k[on].view(np.int64) for k in keys]
    yield pa.record_batch([*columns, rows[on], _packed(at, low, high)[on], n[on]], names)
    if several.any():
        rows, places = _joined(rows[several], at[several], low[several], high[several])
        none = np.zeros(len(rows), np.int64)
        yield pa.record_batch([*[none] * len(keys), rows, places, none.astype(np.int32)], names)


FIRST = "core long, row long, place long, n int"
RUNS = "core long, span long, span2 long, row long, place long, n int"


def _finer(at, low, high, width):
    """Runs cut at multiples of the width, so that runs of any two places line up."""
    parts = high // width - low // width + 1
    run = np.repeat(np.arange(len(at)), parts)
    step = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    floor = (low[run] // width + step) * width
    return at[run], np.maximum(low[run], floor), np.minimum(high[run], floor + width - 1)


def _listed(texts: Iterator[tuple[int, bytes, list[int]]], length: int):
    """(row, offset, places, piece) of the pieces that hold listed runs."""
    for row, text, listed in texts:
        places = np.unique(np.array(listed, np.int64))
        at, _, high = _unpacked(places)
        number = (at - high) // PIECE
        for n in np.unique(number):
            start = int(n) * PIECE
            yield row, start, places[number == n], text[start : start + PIECE + length - 1]


def _hashed_runs(texts: Iterator[tuple], width: int | None, length: int):
    """Rows of RUNS for the listed runs, cut to at most ``width`` strings, one for those that are equal."""
    for held in _gathered(_listed(texts, length)):
        data, _, starts = _laid_out(held)
        hashes = [Hashes(data, which) for which in (0, 1)]
        counts = [len(x[2]) for x in held]
        moved = np.repeat(starts - np.array([x[1] for x in held], np.int64), counts)
        rows = np.repeat(np.array([x[0] for x in held], np.int64), counts)
        at, low, high = _unpacked(np.concatenate([x[2] for x in held]))
        if width is not None:
            index = np.repeat(np.arange(len(at)), high // width - low // width + 1)
            at, low, high = _finer(at, low, high, width)
            moved, rows = moved[index], rows[index]
        local = at + moved
        least, most = cores(low, high, length, width)
        core = hashes[0].of(local - least, local - most + length) + least.astype(np.uint64)
        keys = [core, *_spans(hashes, local, low, high, length)]
        yield from _split(keys, rows, at, low, high, *_stands_for(keys), RUNS)


class TextStore:
    """Texts written once; tasks read the file that holds a row."""

    def __init__(self, docs: DataFrame) -> None:
        spark: SparkSession = docs.sparkSession
        self.folder = shared_dir(spark)
        docs.select("doc_id", "text").write.option("compression", "zstd").parquet(self.folder)
        number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
        self.rows = (
            spark.read.schema(docs.select("doc_id", "text").schema)
            .parquet(self.folder)
            .select("doc_id", "text", (number * (1 << ROW_BITS) + F.col("_metadata.row_index")).alias("row"))
        )
        # All files of one write are named alike but for their number.
        names = spark.read.parquet(self.folder).select("_metadata.file_name").limit(1).collect()
        self.suffix = names[0][0].split("-", 2)[2] if names else ""
        self.files = self.rows.agg(F.max("row")).first()[0] or 0
        self.files = (self.files >> ROW_BITS) + 1

    def visit(self, lists: DataFrame, work, schema: str) -> DataFrame:
        """Run ``work`` on (row, doc_id, text, places) of every file that ``lists`` (row, place) names.

        One file is open at a time, its lists are held in memory; they are bounded by
        its texts. A NULL place names a file without listing a row.
        """
        folder, suffix = self.folder, self.suffix

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, base = filesystem(folder)
            for number, listed in _by_file(batches):
                path = f"{base}/part-{number:05d}-{suffix}"
                with system.open_input_file(path) as file:
                    yield from work(_texts_of(file, number, listed))

        block = F.shiftright("row", ROW_BITS).cast("int")
        dealt = lists.select("row", "place", block.alias("file"))
        dealt = dealt.repartitionById(self.files, F.col("file"))
        return dealt.sortWithinPartitions("file", "row").mapInArrow(run, schema)


def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[int]]]]:
    number, listed = None, {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("file", "row", "place"))
        for file, row, place in zip(*columns):
            if file != number:
                if number is not None:
                    yield number, listed
                number, listed = file, {}
            places = listed.setdefault(row, [])
            if place is not None:
                places.append(place)
    if number is not None:
        yield number, listed


def _texts_of(file, number: int, listed: dict[int, list[int]]):
    """(row, doc_id, text, places) of every row of a file; no places for unlisted rows."""
    row = number << ROW_BITS
    for batch in pq.ParquetFile(file).iter_batches(512, columns=["doc_id", "text"]):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
            yield row, doc_id, text, listed.get(row, [])
            row += 1


def _settled(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, place) of the runs that repeat as a whole, and of those that stay open.

    Open are spans that occur once while their core occurs again, and, for each span that
    repeats under such a core, one run that stands for it.
    """
    classes = stored(
        runs.where("n > 0").groupBy("core", "span", "span2").agg(
            F.sum("n").alias("n"), F.min(F.struct("row", "place")).alias("first")
        )
    )
    groups = classes.groupBy("core").agg(
        F.sum("n").alias("total"), F.sum((F.col("n") == 1).cast("int")).alias("single")
    )
    # Stored, so that the join deals out both sides anew and can split a common core.
    groups = stored(groups.where("total > 1 AND single > 0").select("core"))
    still_open = classes.join(groups, "core", "left_semi").select("first.row", "first.place")
    whole = classes.where("n > 1").select("core", "span", "span2")
    # Of runs that stand for others, the places are among those with n = 0.
    repeated = runs.where("n = 1").join(whole, ["core", "span", "span2"], "left_semi")
    return repeated.unionByName(runs.where("n = 0")).select("row", "place"), still_open


def repeated_runs(store: TextStore, length: int, every: int) -> DataFrame:
    """(row, place) of runs of strings that start elsewhere, too; together they are all of them."""
    first = stored(
        store.rows.select("row", "text").mapInArrow(lambda batches: _first_round(batches, length, every), FIRST)
    )
    runs = first.where("n > 0")
    shared = runs.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    still_open = runs.join(stored(shared), "core", "left_semi").select("row", "place")
    done = [first.where("n = 0").select("row", "place")]
    for width in (None, *FINER):
        runs = stored(store.visit(still_open, _round(width, length), RUNS))
        repeated, still_open = _settled(runs)
        done.append(repeated)
    return reduce(DataFrame.unionByName, done)


def _round(width: int | None, length: int):
    def work(texts):
        listed = ((row, text, places) for row, _, text, places in texts if places)
        yield from _hashed_runs(listed, width, length)

    return work


def kept_text(text: bytes, places: list[int], length: int) -> tuple[list[bytes], int]:
    """What is left of a text, in parts, and the number of removed stretches."""
    if not places:
        return [text], 0
    at, low, high = _unpacked(np.array(places, np.int64))
    order = np.argsort(at - high)
    start, end = (at - high)[order], np.maximum.accumulate((at - low + length)[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    starts, ends = start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
    edges = [0, *np.stack([starts, ends]).T.ravel().tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])], len(starts)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(texts, length: int, with_text: bool, size: int = 1 << 23):
    names = [f.split()[0] for f in RESULT.split(", ")]
    rows, held = [], 0
    for _, doc_id, text, places in texts:
        parts, spans = kept_text(text, places, length)
        kept = b"".join(parts)
        digest = sha256(kept).hexdigest()
        rows.append((doc_id, len(text), len(text) - len(kept), spans, digest, kept if with_text else None))
        held += 200 + (len(kept) if with_text else 0)
        if held >= size:
            yield _batch(rows, names)
            rows, held = [], 0
    if rows:
        yield _batch(rows, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def remove_repeats(
    docs: DataFrame, length: int = 400, every: int = 96, with_text: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) of every row (doc_id, text)."""
    if not 2 * WIDTH <= length <= MASK - 100:
        raise ValueError("a distance has to fit its bits")
    store = TextStore(docs)
    found = repeated_runs(store, length, every)
    every_file = store.rows.select(
        F.expr(f"shiftright(row, {ROW_BITS}) << {ROW_BITS}").alias("row")
    ).distinct().withColumn("place", F.lit(None).cast("long"))
    return store.visit(
        found.unionByName(every_file), lambda texts: _cut(texts, length, with_text), RESULT
    )
