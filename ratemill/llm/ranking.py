"""Document quality by Bradley-Terry ranking.

A document's strength is a weighted sum of features of its whole text; of two documents
the stronger one is preferred with the logistic probability of the difference. The
weights are fitted to preference pairs, a trusted document (label 1) against a rejected one
(label 0), by the logistic loss of the feature differences, so whatever all documents
have in common cancels out.

The decision threshold is a quantile of the strengths of the rows that were fitted: the one
that leaves as large a share below it as the share of rejected labels. It lies midway
between the two strengths next to it. The score is the logistic function of the strength, shifted so that
the threshold has the score ``CUT``.

Pairs are made from a bounded sample: of each label about ``most_labelled`` ids, those with the
smallest hashes. Only their features reach the driver. All else is done where the texts
are, one pass over them.

NULL and empty texts have features too (all counts zero) and are scored like others, very long
texts are read whole. A row whose id is NULL is scored, not held out and in no pair. Rows that
repeat an id are scored each, and one of them is fitted; labels that repeat count once. NULL labels, and labels other than 0 and 1, are not
used. Without a pair, all documents score 0.5 and none is predicted good. Equal texts
have equal scores. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import utf8

#: The score from which a document is predicted good.
CUT = 0.7
#: Ids whose CRC-32 leaves this remainder are never learnt from.
FOLDS, HELD_OUT = 4, 2

#: Byte classes whose shares are features.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n\r",
    "stop": b".?;:",
    "comma": b",",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#*$%&<>@^~=+_\\/{}[]",
    "quote": b"'\"()-",
    "other": bytes(range(0x80, 0x100)),
}
_IN_CLASS = np.zeros((256, len(CLASSES)))
for _i, _members in enumerate(CLASSES.values()):
    _IN_CLASS[list(_members), _i] = 1

#: Counts of a text that features are made of.
_SHARES = [*CLASSES, "new_words", "top_word", "twice_in_a_row", "new_lines", "capitals", "all_caps"]
FEATURES = [*_SHARES, *(f"root_{name}" for name in _SHARES), "length", "short", "word_length", "word_spread"]


def features(text: bytes) -> np.ndarray:
    """Shares of byte classes, repetition of words and lines, lengths; in the order of ``FEATURES``."""
    n = max(len(text), 1)
    classes = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _IN_CLASS / n
    words = text.split()
    n_words = max(len(words), 1)
    seen = Counter(words)
    # The number of different words grows with the length of a text like a power of it.
    new_words = len(seen) / n_words**0.85
    top = max(seen.values(), default=0) / n_words
    twice = sum(map(bytes.__eq__, words, words[1:])) / n_words
    lines = [line for line in text.split(b"\n") if line]
    new_lines = len(set(lines)) / max(len(lines), 1)
    weights = np.fromiter(seen.values(), np.float64, len(seen))
    lengths = np.fromiter(map(len, seen), np.float64, len(seen))
    mean = float(weights @ lengths) / n_words
    spread = (max(float(weights @ lengths**2) / n_words - mean**2, 0.0)) ** 0.5
    capitals = sum(c for word, c in seen.items() if word[:1].isupper()) / n_words
    all_caps = sum(c for word, c in seen.items() if len(word) > 1 and word.isupper()) / n_words
    shares = np.array([*classes, new_words, top, twice, new_lines, capitals, all_caps])
    length = np.log1p(len(words))
    rest = [length, max(0.0, 4.0 - length), np.log1p(mean), np.log1p(spread)]
    return np.concatenate([shares, np.sqrt(shares), rest])


@dataclass(frozen=True)
class Ranking:
    """Weights of the standardised features and the threshold of the strength; None without pairs."""

    mean: np.ndarray | None = None
    weights: np.ndarray | None = None
    threshold: float = 0.0

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), 0.5)
        strength = (rows - self.mean) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(strength + np.log(CUT / (1 - CUT)), -700, 700)))


def pair_differences(good: np.ndarray, bad: np.ndarray, per_row: int) -> np.ndarray:
    """Feature differences of preference pairs: every row meets ``per_row`` of the other label, at least.

    Partners are taken in turn, so that each row of a label is met about equally often.
    """
    most = max(len(good), len(bad))
    at = np.arange(most)
    shifts = range(min(per_row, len(good) * len(bad)))
    # The larger side goes round once per shift; the smaller one starts further on each time.
    return np.concatenate(
        [
            good[(at + (s if len(good) < most else 0)) % len(good)]
            - bad[(at + (s if len(good) == most else 0)) % len(bad)]
            for s in shifts
        ]
    )


def fit_weights(differences: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Minimise the mean of log(1 + exp(-w.d)) plus the penalty, by Newton steps.

    A step that does not lower the loss is halved.
    """
    n, width = differences.shape
    weights = np.zeros(width)

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, -differences @ w).mean() + penalty * (w @ w) / 2)

    now = loss(weights)
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(differences @ weights, -700, 700)))
        gradient = -(lost @ differences) / n + penalty * weights
        curve = (differences * (lost * (1 - lost))[:, None]).T @ differences / n
        step = np.linalg.solve(curve + penalty * np.eye(width), gradient)
        size = 1.0
        while size > 1e-6 and loss(weights - size * step) > now:
            size /= 2
        weights = weights - size * step
        before, now = now, loss(weights)
        if before - now < 1e-10:
            break
    return weights


def quantile_cut(strengths: np.ndarray, n_below: int) -> float:
    """The strength midway between the ``n_below`` lowest ones and the rest."""
    ordered = np.sort(strengths)
    return float((ordered[n_below - 1] + ordered[n_below]) / 2)


def rank(good: np.ndarray, bad: np.ndarray, per_row: int = 8) -> Ranking:
    """Fit features of trusted and rejected documents."""
    if not (len(good) and len(bad)):
        return Ranking()
    rows = np.concatenate([good, bad])
    mean, spread = rows.mean(axis=0), rows.std(axis=0)
    scale = 1 / np.where(spread > 1e-9, spread, np.inf)
    weights = fit_weights(pair_differences((good - mean) * scale, (bad - mean) * scale, per_row)) * scale
    return Ranking(mean, weights, quantile_cut((rows - mean) @ weights, len(bad)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(text) for text in utf8(batch.column("text"))]
        flat = np.concatenate(rows) if rows else np.zeros(0)
        edges = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("quality"), lists],
            ["doc_id", "quality", "features"],
        )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = 10_000) -> Ranking:
    """Learn from ``docs`` (doc_id, text) with ``labels`` (doc_id, quality) outside the held-out fold.

    Of a label with more than ``most_labelled`` ids, those with the smallest hashes are used, so
    many on average. The cut of the hashes follows from a count, so no task sorts the labels.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .distinct()
    )
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("quality") == label, F.lit(most_labelled / n)).otherwise(share)
    hashes = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(hashes)) / hashes
    sampled = usable.where(place < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (
        texts.join(F.broadcast(sampled), "doc_id")
        .mapInArrow(_featured, "doc_id long, quality int, features array<double>")
        .groupBy("doc_id", "quality")
        .agg(F.min("features").alias("features"))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    )
    flat = rows.column("features").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    quality = rows.column("quality").to_numpy()
    return rank(flat[quality == 1], flat[quality == 0])


def _scored(batches: Iterator[pa.RecordBatch], ranking: Ranking) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(text) for text in utf8(batch.column("text"))]
        scores = ranking.scores(np.array(rows).reshape(-1, len(FEATURES)))
        yield pa.record_batch([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _scored(batches, ranking), "doc_id long, score double"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
