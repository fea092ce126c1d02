"""Phrase collocations by mergeable Misra-Gries summaries and an exact second pass.

A text is lower-cased (A-Z only), cut into pieces at sentence marks and line breaks, and a piece into
words. Every run of two to ``longest`` words in a piece is an n-gram, known by a 64-bit hash of its
language and words. The hashes are dealt into parts; a part has one summary, merged from
the counts that the tasks bring. A summary holds ``capacity`` counters; when there are more,
the count of the next largest is taken from all of them and those at zero go. So a count is too small by at most what
was taken in all, which is below the part's mass over its capacity. Parts are so many
that this stays below the threshold, and every n-gram whose count plus the loss reaches the threshold goes on: none that
is frequent is missing. Should the loss of a part reach the threshold all the same, the summaries are made
again with four times the parts.

An n-gram is frequent only if its word pairs are, so pairs are summed up first, and longer
n-grams only where all their pairs went on. What went on is kept as a table of bits, of fixed size
(``BITS``), that goes to the executors; a bit set by another n-gram costs work but
changes nothing, because the second pass counts phrases by their words and drops those below the threshold.

Of a text with no language the language is ``und``. NULL and empty texts have no words. Very long texts
are read slice by slice. Repeated rows count each. Ties are broken by phrase, in byte order. An empty
table gives no rows. Extra columns are not read. Counts are longs; products are decimals of 38
digits and fail rather than round.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

#: Bytes that end a piece become a byte that no text holds, tabs become spaces.
BREAK = b"\xff"
_MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
_CLEAN = bytes.maketrans(_MARKS + b"\t", BREAK * len(_MARKS) + b" ")

#: Bytes of text that a task works on at a time, and bytes that are split into words at a time.
CHUNK, SLICE = 1 << 23, 1 << 20
#: Size of the table of bits: eight megabytes.
BITS = 1 << 26
#: N-grams that a part is meant for.
PART_MASS = 1 << 22

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
UNKNOWN = "und"


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text with ``BREAK`` between pieces, some at a time."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].lower().translate(_CLEAN).replace(BREAK, b" \xff ").split()
        at = end


class Chunk:
    """Texts as word numbers, one row of numbers per language; number 0 ends a piece."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.numbers[BREAK]
        self.rows: dict[str, list[np.ndarray]] = defaultdict(list)
        self.bytes = 0

    def add(self, lang: str | None, text: bytes) -> None:
        rows = self.rows[UNKNOWN if lang is None else lang]
        for words in split_words(text):
            rows.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        rows.append(np.zeros(1, np.int32))
        self.bytes += len(text) + 64

    def languages(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Each language with its row of numbers and the hash of each word in it."""
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.numbers], np.uint64)
        for lang, rows in self.rows.items():
            seed = np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))
            yield lang, np.concatenate(rows), hashes ^ seed


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    chunk = Chunk()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang"), texts):
            chunk.add(lang.as_py(), text.as_py() or b"")
            if chunk.bytes >= CHUNK:
                yield chunk
                chunk = Chunk()
    if chunk.bytes:
        yield chunk


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def grams(row: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, hash of the n-gram that starts at each place, whether there is one), for n from 1 on."""
    own, inside = hashes[row], row != 0
    whole, there = own, inside
    yield 1, whole, there
    for n in range(2, longest + 1):
        if len(row) < n:
            return
        whole = _mixed(whole[:-1] * _STEP + own[n - 1 :])
        there = there[:-1] & inside[n - 1 :]
        yield n, whole, there


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(BITS)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def _counted(
    batches: Iterator[pa.RecordBatch], sizes: range, parts: int, pairs: Broadcast | None
) -> Iterator[pa.RecordBatch]:
    """(part, gram, n): counts of the n-grams of these sizes, of a chunk at a time."""
    for chunk in _chunks(batches):
        for _, row, hashes in chunk.languages():
            marked = None
            for size, whole, there in grams(row, hashes, sizes[-1]):
                if size == 2 and pairs is not None:
                    marked = frequent = _marked(pairs.value, whole)
                elif size > 2 and marked is not None:
                    frequent = frequent[:-1] & marked[size - 2 :]
                if size not in sizes:
                    continue
                found, n = np.unique(
                    whole[there if marked is None else there & frequent], return_counts=True
                )
                part = (found >> np.uint64(32)) % np.uint64(parts)
                yield pa.record_batch(
                    [part.astype(np.int32), found.view(np.int64), n.astype(np.int64)],
                    ["part", "gram", "n"],
                )


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters; ``lost`` is what any count may be short of."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._new.append((keys, counts))
        self._waiting += len(keys)
        if self._waiting >= max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        """Counts that wait join the counters; beyond the capacity all counters are lowered."""
        keys = np.concatenate([self.keys, *(k for k, _ in self._new)])
        counts = np.concatenate([self.counts, *(c for _, c in self._new)])
        self._new, self._waiting = [], 0
        if not len(keys):
            return
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        if len(keys) > self.capacity:
            place = len(counts) - self.capacity - 1
            lowered = int(np.partition(counts, place)[place])
            self.lost += lowered
            left = counts > lowered
            keys, counts = keys[left], counts[left] - lowered
        self.keys, self.counts = keys, counts


def _summed(batches: Iterator[pa.RecordBatch], capacity: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """(part, gram, lost) for what may reach the threshold; one row with a NULL gram per part besides."""
    summaries: dict[int, Summary] = defaultdict(lambda: Summary(capacity))
    for batch in batches:
        part, keys, counts = (batch.column(c).to_numpy() for c in ("part", "gram", "n"))
        order = np.argsort(part, kind="stable")
        part, keys, counts = part[order], keys[order], counts[order]
        for own in np.unique(part).tolist():
            run = slice(*np.searchsorted(part, [own, own + 1]))
            summaries[own].add(keys[run], counts[run])
    for part, summary in summaries.items():
        summary.merge()
        kept = summary.keys[summary.counts + summary.lost >= threshold]
        n = len(kept) + 1
        yield pa.record_batch(
            [
                pa.array(np.full(n, part, np.int32)),
                pa.concat_arrays([pa.array(kept), pa.nulls(1, pa.int64())]),
                pa.array(np.full(n, summary.lost, np.int64)),
            ],
            ["part", "gram", "lost"],
        )


def survivors(
    texts: DataFrame, sizes: range, threshold: int, n_words: int, part_mass: int, pairs: Broadcast | None = None
) -> DataFrame:
    """``gram``: the hashes of all n-grams of these sizes that may occur ``threshold`` times or more."""
    capacity = max(2 * part_mass // threshold, 1)
    parts = max(1, -(-n_words * len(sizes) // part_mass))
    while True:
        counts = texts.mapInArrow(
            lambda batches, parts=parts: _counted(batches, sizes, parts, pairs),
            "part int, gram long, n long",
        )
        found = stored(
            counts.repartition(parts, "part").mapInArrow(
                lambda batches: _summed(batches, capacity, threshold),
                "part int, gram long, lost long",
            )
        )
        lost = found.agg(F.max("lost")).first()[0] or 0
        if lost < threshold:
            return found.where("gram IS NOT NULL").select("gram")
        parts *= 4


def bit_table(found: DataFrame) -> np.ndarray:
    """The table of bits of these hashes; at most ``BITS`` / 64 numbers reach the driver."""
    # Remainders of the unsigned hash: BITS is a power of two.
    at = F.col("gram").bitwiseAND(F.lit(BITS - 1))
    rows = (
        found.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, int(gram & 63))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(BITS // 64, np.int64)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint64)


def _phrases(batches: Iterator[pa.RecordBatch], longest: int, bits: Broadcast) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, n): all words, and marked n-grams, with their counts in a chunk.

    A row with an empty phrase has the number of words.
    """
    for chunk in _chunks(batches):
        words = np.array(list(chunk.numbers), object)
        for lang, row, hashes in chunk.languages():
            yield _phrase_rows(lang, 0, [b""], [int((row != 0).sum())])
            for size, whole, there in grams(row, hashes, longest):
                if size == 1:
                    n = np.bincount(row, minlength=len(words))
                    n[0] = 0
                    used = np.flatnonzero(n)
                    yield _phrase_rows(lang, 1, words[used].tolist(), n[used])
                    continue
                at = np.flatnonzero(there)
                at = at[_marked(bits.value, whole[at])]
                first, n = _equal(row, at, whole[at], size)
                columns = [words[row[first + i]] for i in range(size)]
                for some in range(0, len(first), 1 << 17):
                    cut = slice(some, some + (1 << 17))
                    joined = list(map(b" ".join, zip(*(c[cut] for c in columns))))
                    yield _phrase_rows(lang, size, joined, n[cut])


def _equal(row: np.ndarray, at: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different n-gram among those that start at ``at``, and how often it is there."""
    _, first, group, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    if all((row[at + i] == row[at[first]][group] if i == 0 else row[at + i] == row[at[first] + i][group]).all() for i in range(size)):
        return at[first], n
    # Different words under one hash: tell them apart by the words.
    _, first, n = np.unique(
        np.stack([row[at + i] for i in range(size)], axis=1), axis=0, return_index=True, return_counts=True
    )
    return at[first], n


def _phrase_rows(lang: str, size: int, phrases: list[bytes], n) -> pa.RecordBatch:
    m = len(phrases)
    return pa.record_batch(
        [
            pa.array([lang] * m, pa.string()),
            pa.array(phrases, pa.binary()).cast(pa.string()),
            pa.array(np.full(m, size, np.int32)),
            pa.array(np.asarray(n, np.int64)),
        ],
        ["lang", "phrase", "words", "n"],
    )


def frequent_phrases(
    docs: DataFrame, threshold: int = 100, longest: int = 5, part_mass: int = PART_MASS
) -> DataFrame:
    """lang, phrase, words, f: all phrases of up to ``longest`` words that occur ``threshold`` times.

    Besides, each language has one row with an empty phrase of no words and the number of all its words.
    """
    spark = docs.sparkSession
    texts = docs.select("lang", "text")
    # Words are counted roughly, for the number of parts only.
    n_words = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    bits = np.zeros(BITS // 64, np.uint64)
    if longest >= 2:
        pairs = bit_table(survivors(texts, range(2, 3), threshold, n_words, part_mass))
        bits = bits | pairs
    if longest >= 3:
        marked = spark.sparkContext.broadcast(pairs)
        longer = survivors(texts, range(3, longest + 1), threshold, n_words, part_mass, marked)
        bits = bits | bit_table(longer)
    sent = spark.sparkContext.broadcast(bits)
    counted = texts.mapInArrow(
        lambda batches: _phrases(batches, longest, sent), "lang string, phrase string, words int, n long"
    )
    return stored(
        counted.groupBy("lang", "phrase", "words")
        .agg(F.sum("n").alias("f"))
        .where((F.col("f") >= threshold) | (F.col("words") == 0))
    )


def collocations(
    docs: DataFrame,
    threshold: int = 100,
    longest: int = 5,
    cover_percent: int = 100,
    most: int = 2000,
    part_mass: int = PART_MASS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``most`` phrases of each language.

    The score is floor(1000 a n / (l r)) of the cut that scores lowest. A phrase that lies inside a
    longer one with at least ``cover_percent`` percent of its count is left out.
    """
    found = frequent_phrases(docs, threshold, longest, part_mass)
    totals = found.where("words = 0").select("lang", F.col("f").alias("n"))
    counts = found.where("words > 0")
    phrases = counts.where("words > 1").withColumnRenamed("f", "a")
    cuts = phrases.select(
        "lang", "phrase", "words", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k")
    ).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # Totals have a row per language.
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", F.expr(
            "(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * 1000) div"
            " (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
        ))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    words = F.split("phrase", " ")
    longer = counts.where("words > 2")
    inside = (
        longer.withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("start", F.explode(F.expr("sequence(1, words - size + 1)")))
        .select("lang", F.array_join(F.slice(words, F.col("start"), F.col("size")), " ").alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("cover"))
    )
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("a"))
    )
    ranked = kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score").withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ),
    )
    return ranked.where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
