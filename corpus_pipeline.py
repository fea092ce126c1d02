"""A training corpus from raw documents: five stages, each over all its predecessor kept.

Each stage's rows are written as Parquet to the shared folder and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.llm import bpe, mixing, quality, secrets, simhash
from ratemill.llm.queries import tokenizer_spec
from ratemill.llm.tables import read, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents they reject go, NULL and empty texts with them, as they have no words."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.filter_documents(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: of each group the row with the smallest id stays.

    NULL ids come last, so a group without any id keeps a row too. Rows that repeat an
    id are rows of their own: different texts under one id all stay.
    """
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: spans are replaced by a mark. NULL and empty texts stay as they are."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's budget takes it.

    A NULL source is a source of its own; a NULL text has size 0.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: one row per document and copy, with its token ids and the MD5 of the text they decode to."""
    spec = tokenizer_spec()
    docs = docs.select("doc_id", "source", "text")
    found = bpe.encode_and_decode(docs, spec, bpe.build_lexicon(docs, spec))
    n_tokens = F.size("token_ids").cast("long").alias("n_tokens")
    return found.select("doc_id", "source", n_tokens, "token_ids", "decoded_md5")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", good_documents),
    ("simhash near-dedup", distinct_documents),
    ("secret scans", without_secrets),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: The stages hash, fit and tokenize; they are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
