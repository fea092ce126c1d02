"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed to ``buckets`` classes. One multinomial is
fitted to trusted texts, one to the whole corpus; a document's score is the mean,
over its n-grams, of the logarithm of the ratio of the two. It is kept if the score
reaches a threshold that is fixed before documents are judged, so a verdict
depends on the document and the model alone. Log ratios are rounded to integers of
1/65,536, whose sums do not depend on their order.

The corpus side counts every document, the trusted side every document labelled good
and not toxic. One in ``held_out`` of these, by hash, is kept out of the fit; the
threshold is a low quantile of their scores, lowered by ``spread`` times the way from
their median down to that quantile. Texts are joined with labels once; the labelled ones are
written to the shared folder, and quantiles are read off a range sort of the scores.

A NULL or empty text has no words and fails the base rules. Texts of any length
are counted whole. Repeated rows get the same verdict each. Without any labels,
or in an empty table, the ratio is the same for all and only base rules decide. If
no labelled row is held out, the threshold is taken from those of the fit.
The input's columns are not carried beyond those asked for.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import with_positions
from .tables import chunks, stored, utf8

SYMBOLS = b"#*$%&|<>"
#: ASCII white space and UTF-8 continuation bytes: what remains are the word characters.
NOT_WORD_STARTS = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])
SCALE = 1 << 16
WINDOW = 8
#: Rows of the table of bits that spares texts without a label the shuffle; 64 bits each.
SLOTS = 1 << 17


@dataclass(frozen=True)
class Model:
    """Integer log ratios by bucket and the least mean that is kept."""

    ratios: np.ndarray
    threshold: float


def _word_ids(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Number of each word in order, the distinct words, and the words per text."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    split = [text.split() for text in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ids = np.fromiter(
        (numbers[w] for words in split for w in words), np.int64, int(sizes.sum())
    )
    return ids, list(numbers), sizes


def _owner(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def ngram_buckets(
    ids: np.ndarray, words: list[bytes], sizes: np.ndarray, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every unigram and bigram."""
    hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))[ids]
    owner = _owner(sizes)
    pair = owner[1:] == owner[:-1]
    mixed = hashes[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:][pair]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    both = np.concatenate([hashes * np.uint64(0x94D049BB133111EB) >> np.uint64(32), mixed >> np.uint64(32)])
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate([owner, owner[1:][pair]])


def _repeat_words(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Words per text that lie in a window of eight that occurs twice in the text.

    Windows get exact numbers by joining numbers of half the length, three times.
    """
    n = len(ids)
    owner = _owner(sizes)
    out = np.zeros(len(sizes), np.int64)
    if n < WINDOW:
        return out
    rank, width = ids, 1
    while width < WINDOW:
        pairs = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank, width = np.unique(pairs, return_inverse=True)[1], 2 * width
    inside = owner[: len(rank)] == owner[WINDOW - 1 :]
    keys = rank[inside] + owner[: len(rank)][inside] * (int(rank.max()) + 1)
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(inside)[times[inverse] > 1]
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    np.add.at(out, owner[np.cumsum(edges[:n]) > 0], 1)
    return out


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per task: n-grams by bucket, of all texts and of the trusted ones."""
    raw, trusted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in batches:
        texts = utf8(batch.column("text"))
        marks = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for part in chunks(texts):
            ids, words, sizes = _word_ids(texts[part])
            if not len(ids):
                continue
            bucket, owner = ngram_buckets(ids, words, sizes, buckets)
            raw += np.bincount(bucket, minlength=buckets)
            trusted += np.bincount(bucket[marks[part][owner]], minlength=buckets)
    some = np.flatnonzero(raw)
    yield pa.record_batch([some, raw[some], trusted[some]], ["bucket", "raw", "trusted"])


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled good and not toxic."""
    return labels.where("quality = 1 AND toxic = 0").select("doc_id").distinct()


def _with_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) that ``ids`` names, with the columns of ``ids``.

    Ids grow with the labels, so they are not broadcast. A table of a bit per hash, ``SLOTS`` rows at
    most, is; texts without a bit are not shuffled.
    """
    hashed = F.xxhash64("doc_id", F.lit(2))
    slot = F.pmod(hashed, F.lit(SLOTS)).alias("_slot")
    bit = F.shiftrightunsigned(hashed, 58).cast("int")
    marks = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits")
    table = F.broadcast(ids.groupBy(slot).agg(marks))
    near = docs.withColumns({"_slot": slot, "_bit": bit}).join(table, "_slot")
    near = near.where(F.call_function("shiftright", "_bits", F.col("_bit")).bitwiseAND(F.lit(1)) == 1)
    return near.select("doc_id", "text").join(ids.hint("merge"), "doc_id")


def _bucket_sums(marked: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket, of all rows of ``marked`` (text, trusted) and of the trusted ones."""
    counts = marked.mapInArrow(
        lambda batches: _counted(batches, buckets), "bucket long, raw long, trusted long"
    )
    sums = counts.groupBy("bucket").agg(F.sum("raw"), F.sum("trusted")).toArrow()
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    at = sums.column(0).to_numpy()
    raw[at], trusted[at] = sums.column(1).to_numpy(), sums.column(2).to_numpy()
    return raw, trusted


def _quantiles(rows: DataFrame, name: str, wanted: list[float]) -> list[float] | None:
    """What ``percentile`` gives, without one task that holds all values; None without rows."""
    placed = with_positions(rows.select(name), [F.col(name)], "_place")
    last = placed.agg(F.max("_place")).first()[0]
    if last is None:
        return None
    at = [q * (last - 1) for q in wanted]
    places = {int(f(a)) + 1 for a in at for f in (np.floor, np.ceil)}
    value = {r["_place"]: r[name] for r in placed.where(F.col("_place").isin(*places)).collect()}
    found = []
    for a in at:
        low, high = np.floor(a), np.ceil(a)
        lower, higher = value[int(low) + 1], value[int(high) + 1]
        found.append(lower if lower == higher else float((high - a) * lower + (a - low) * higher))
    return found


def fit(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = 1 << 16,
    quantile: float = 0.01,
    held_out: int = 5,
    spread: float = 1.0,
) -> Model:
    """The model of a corpus (doc_id, text) and labels (doc_id, quality, toxic).

    ``buckets`` rows reach the driver twice, and at most four scores for the threshold.
    """
    good = trusted_ids(labels).withColumn(
        "trusted", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(held_out)) != 0
    )
    labelled = stored(_with_texts(docs.select("doc_id", "text"), good).select("text", "trusted"))
    _, trusted = _bucket_sums(labelled, buckets)
    if not trusted.sum():
        return Model(np.zeros(buckets, np.int64), float("-inf"))
    raw, _ = _bucket_sums(docs.select("text", F.lit(False).alias("trusted")), buckets)
    # The trusted side leans on the corpus where it has few counts.
    prior = (raw + 1) / (raw.sum() + buckets)
    target = (trusted + buckets * prior) / (trusted.sum() + buckets)
    ratios = np.rint(np.log(target / prior) * SCALE).astype(np.int64)
    model = Model(ratios, float("-inf"))
    threshold = float("-inf")
    for part in ("NOT trusted", "trusted"):
        some = labelled.where(part).select(F.lit(None).cast("long").alias("doc_id"), "text")
        found = _quantiles(score(some, model).where("NOT base_failed"), "llr", [quantile, 0.5])
        if found is not None:
            low, middle = found
            threshold = low - spread * (middle - low)
            break
    return Model(ratios, threshold)


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, llr double, kept boolean"
)


def _judged(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text"))
        columns: list[list] = []
        for part in chunks(texts):
            some = texts[part]
            ids, words, sizes = _word_ids(some)
            repeats = _repeat_words(ids, sizes)
            bucket, owner = ngram_buckets(ids, words, sizes, len(model.ratios))
            sums = np.zeros(len(some), np.int64)
            np.add.at(sums, owner, model.ratios[bucket])
            grams = np.maximum(2 * sizes - 1, 1)
            mean = sums / (grams * SCALE)
            failed = (sizes < 20) | (100 * repeats > 30 * sizes)
            columns.append(
                [
                    sizes,
                    np.array([len(t.translate(None, NOT_WORD_STARTS)) for t in some], np.int64),
                    np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in some], np.int64),
                    np.array([_duplicate_lines(t) for t in some], np.int64),
                    repeats,
                    failed,
                    mean,
                    ~failed & (mean >= model.threshold),
                ]
            )
        if columns:
            yield pa.record_batch(
                [batch.column("doc_id"), *(np.concatenate(c) for c in zip(*columns))],
                [field.split()[0] for field in RESULT.split(", ")],
            )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, mean log ratio and verdict of every row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _judged(batches, model), RESULT
    )


def _passed(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = pa.record_batch(
            [pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], ["doc_id", "text"]
        )
        for judged in _judged(iter([plain]), model):
            yield batch.filter(judged.column("kept"))


def filter_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are kept, with all their columns."""
    return docs.mapInArrow(lambda batches: _passed(batches, model), docs.schema)


