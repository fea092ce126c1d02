"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a page are added up as logarithms:

- its text: hashed byte trigrams under one multinomial per language, as a mean per
  trigram times at most ``most_evidence``, since neighbouring trigrams repeat each
  other;
- the language its markup declares, and the suffix of its address, as likelihoods
  given the language;
- its host, as a prior: counts of the host, smoothed towards those of its domain,
  these towards all pages.

The counts behind the last three come from grouped aggregation of all pages by what
their texts say; a page's own vote is taken out before it is judged. Groups
combine before they are shuffled, so a host with most of the pages is one row
per task.

The text model counts all labelled documents (text, lang); rows with a NULL text or
language teach nothing. ``languages`` are those of the documents, at most
``most_languages`` (more are an error: each is a dense vector). A page with NULL or
empty html has no text evidence, and the others decide; a NULL or odd url has the
empty host. Ties go to the language first by code point. Repeated rows are judged
alike. Without documents every language is NULL. Empty tables give no rows.
Extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import chunks, stored, utf8

HIDDEN = re.compile(r"<(script|style|head|nav)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
TAG = re.compile(r"<[^>]*>")
DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass(frozen=True)
class TextModel:
    """Languages in order and the log probabilities of trigram buckets."""

    languages: list[str]
    logs: np.ndarray


def trigram_buckets(text: bytes, buckets: int) -> np.ndarray:
    """Bucket of each byte trigram; ASCII letters in lower case."""
    b = np.frombuffer(text.lower(), np.uint8).astype(np.uint64)
    code = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
    return (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets)


def visible_text(page: str | None) -> str:
    """The text of a page without scripts, styles, head, navigation, comments and tags."""
    return entities.unescape(TAG.sub(" ", HIDDEN.sub(" ", page or "")))


def _counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = utf8(batch.column("text")), batch.column("lang").to_pylist()
        for part in chunks(texts):
            for lang in set(langs[part]):
                own = b"\x00\x00".join(t for t, x in zip(texts[part], langs[part]) if x == lang)
                found = np.bincount(
                    trigram_buckets(own, buckets).astype(np.int64), minlength=buckets
                )
                total[lang] = total.get(lang, 0) + found
    for lang, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array([lang] * len(some)), some, counts[some]], ["lang", "bucket", "n"])


def fit(docs: DataFrame, buckets: int = 1 << 14, most_languages: int = 64) -> TextModel:
    """Count trigrams of all documents by language; languages x buckets rows reach the driver."""
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    rows = known.mapInArrow(lambda b: _counts(b, buckets), "lang string, bucket long, n long")
    sums = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = stored(sums)
    languages = [r[0] for r in sums.select("lang").distinct().limit(most_languages + 1).collect()]
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages.sort()
    table = sums.toArrow()
    logs = np.ones((len(languages), buckets))
    at = np.searchsorted(languages, table.column("lang").to_pylist()) if languages else []
    logs[at, table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    return TextModel(languages, np.log(logs / logs.sum(axis=1, keepdims=True)))


def text_evidence(text: str, model: TextModel, most_evidence: int) -> list[float]:
    """Log likelihood of a text by language; zeros without a trigram."""
    bucket = trigram_buckets(text.encode("utf-8", "replace"), model.logs.shape[1])
    if not len(bucket):
        return [0.0] * len(model.languages)
    counts = np.bincount(bucket.astype(np.int64), minlength=model.logs.shape[1])
    some = np.flatnonzero(counts)
    mean = (model.logs[:, some] * counts[some]).sum(axis=1) / len(bucket)
    return (mean * min(len(bucket), most_evidence)).tolist()


def _texts(batches: Iterator[pa.RecordBatch], model: TextModel, most: int):
    for batch in batches:
        rows = [
            text_evidence(visible_text(page), model, most)
            for page in batch.column("html").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("page_id", "host", "domain", "suffix", "declared")),
                pa.array(rows, pa.list_(pa.float64())),
            ],
            names=["page_id", "host", "domain", "suffix", "declared", "text_log"],
        )


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _votes(judged: DataFrame, key: str, n: int) -> DataFrame:
    """Pages by key and language of their text, as an array per key."""
    sums = [F.sum((F.col("vote") == i).cast("double")) for i in range(n)]
    return judged.groupBy(key).agg(F.array(*sums).alias(f"{key}_votes"))


def identify(
    pages: DataFrame, model: TextModel, most_evidence: int = 100, smoothing: float = 10.0
) -> DataFrame:
    """page_id, host, suffix, declared, text_lang, lang, posterior of every page (page_id, url, html)."""
    n = len(model.languages)
    host = F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")))
    pages = pages.select("page_id", "html", host.alias("host"))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), DECLARED, 1))
    pages = pages.select(
        "page_id",
        "html",
        "host",
        F.substring_index("host", ".", -2).alias("domain"),
        F.substring_index("host", ".", -1).alias("suffix"),
        declared.alias("declared"),
    )
    if not n:
        nothing = [F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")]
        return pages.select(
            "page_id", "host", "suffix", "declared", *nothing,
            F.lit(None).cast("double").alias("posterior"),
        )
    fields = (
        "page_id long, host string, domain string, suffix string, declared string, "
        "text_log array<double>"
    )
    scored = pages.mapInArrow(lambda b: _texts(b, model, most_evidence), fields)
    best = F.array_max("text_log")
    # A text without evidence has no vote.
    vote = F.when(best < 0, F.array_position("text_log", best).cast("int") - 1).otherwise(-1)
    judged = stored(scored.withColumn("vote", vote))
    own = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == F.col("vote")).cast("double")
    )
    total = judged.agg(
        *[F.sum((F.col("vote") == i).cast("double")).alias(f"n{i}") for i in range(n)]
    ).select(F.array(*[F.coalesce(f"n{i}", F.lit(0.0)) for i in range(n)]).alias("all_votes"))
    joined = judged.crossJoin(F.broadcast(total)).withColumn("own", own)  # one row
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(_votes(judged, key, n), key)
    for key in ("all", "host", "domain", "suffix", "declared"):
        less = F.zip_with(F.col(f"{key}_votes"), F.col("own"), lambda x, y: x - y)
        joined = joined.withColumn(f"{key}_votes", less)
    whole = F.aggregate("all_votes", F.lit(0.0), lambda a, x: a + x)
    prior = F.transform("all_votes", lambda x: (x + 1) / (whole + n))
    for key in ("domain", "host"):
        votes = F.col(f"{key}_votes")
        size = F.aggregate(votes, F.lit(0.0), lambda a, x: a + x)
        prior = F.zip_with(votes, prior, _smoothed(size, smoothing))
    joined = joined.withColumn("prior", prior)
    evidence = _plus(F.col("text_log"), F.transform("prior", lambda x: F.log(x)))
    for key in ("suffix", "declared"):
        votes = F.col(f"{key}_votes")
        share = (F.aggregate(votes, F.lit(0.0), lambda a, x: a + x) + 1) / (whole + 2)
        likelihood = F.zip_with(votes, F.col("all_votes"), _likelihood(share, smoothing))
        none = F.transform("all_votes", lambda x: F.lit(0.0))
        evidence = _plus(evidence, F.when(F.col(key) == "", none).otherwise(likelihood))
    joined = joined.withColumn("evidence", evidence)
    top = F.array_max("evidence")
    names = F.array(*[F.lit(x) for x in model.languages])
    spread = F.aggregate("evidence", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return joined.select(
        "page_id",
        "host",
        "suffix",
        "declared",
        F.when(F.col("vote") >= 0, F.get(names, F.col("vote"))).alias("text_lang"),
        F.get(names, F.array_position("evidence", top).cast("int") - 1).alias("lang"),
        (1 / spread).alias("posterior"),
    )


def _smoothed(size: Column, smoothing: float):
    return lambda votes, above: (votes + smoothing * above) / (size + smoothing)


def _likelihood(share: Column, smoothing: float):
    """How often pages of a language carry this value, smoothed towards all pages' share."""
    return lambda votes, pages: F.log((votes + smoothing * share) / (pages + smoothing))
