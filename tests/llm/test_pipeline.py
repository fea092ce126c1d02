import hashlib

import corpus_pipeline
from ratemill.llm import quality, queries
from ratemill.llm.tables import stored
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, sample):
    """Each stage against brute force on its own input."""
    good = stored(corpus_pipeline.good_documents(spark, sample, SF))
    assert good.schema == sample.schema
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.score(sample, quality.fit(sample, labels)).where("kept")
    assert {r[0] for r in judged.select("doc_id").collect()} == {r["doc_id"] for r in good.collect()}

    distinct = stored(corpus_pipeline.distinct_documents(spark, good, SF))
    rows = good.orderBy("doc_id").collect()
    roots = brute.linked([brute.simhash(r["text"]) for r in rows])
    first = {rows[i]["doc_id"] for i in set(roots)}
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(first)

    clean = stored(corpus_pipeline.without_secrets(spark, distinct, SF))
    before = {r["doc_id"]: r["text"] for r in distinct.collect()}
    for r in clean.collect():
        *counts, _, listed = brute.secrets(before[r["doc_id"]])
        if not any(counts):
            continue
        assert r["text"] != before[r["doc_id"]]
        for span in listed.split(","):
            _, a, b = span.split(":")
            assert before[r["doc_id"]][int(a) : int(b)] not in r["text"]
    assert clean.count() == distinct.count()

    mixed = stored(corpus_pipeline.mixed(spark, clean, SF))
    assert mixed.schema.names == sample.schema.names
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(copies.values()) <= {1, 2} and set(copies) <= first

    library = Tokenizer.from_str(queries.tokenizer_spec())
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    tokens = corpus_pipeline.tokens(spark, mixed, SF).collect()
    assert len(tokens) == mixed.count()
    for r in tokens:
        assert r["token_ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["token_ids"])


def test_distinct_documents_without_or_with_repeated_ids(spark):
    """Long texts with NULL ids and different texts under one id stay, one row a group."""
    text = lambda n: " ".join(f"word{n}x{i}" for i in range(200))
    rows = [
        (None, text(1)),  # alone, without an id
        (None, text(2)), (None, text(2)),  # a group without any id
        (None, text(3)), (4, text(3)),  # one of the group has an id
        (5, text(5)), (5, text(6)),  # different texts under one id
        (7, text(7)), (7, text(7)),  # a repeated row
        (8, text(8)), (9, text(8)), (9, text(9)),  # the larger id stands for another text too
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.distinct_documents(spark, docs, SF)
    assert kept.schema == docs.schema
    expected = [(None, 1), (None, 2), (4, 3), (5, 5), (5, 6), (7, 7), (8, 8), (9, 9)]
    found = sorted((r["text"], r["doc_id"]) for r in kept.collect())
    assert found == sorted((text(n), i) for i, n in expected)


def test_tokens_are_decoded(spark, sample):
    docs = sample.limit(20).union(sample.limit(1).selectExpr("doc_id", "'é 😀  x\n' AS text", "lang", "source", "n_chars"))
    found = corpus_pipeline.tokens(spark, docs, SF).collect()
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert sorted(r["decoded_md5"] for r in found) == sorted(digest(r["text"]) for r in docs.collect())


def test_run_is_its_stages(spark, sample):
    docs = sample
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
    digest = lambda df: sorted(
        (r["doc_id"], r["n_tokens"], hashlib.md5(str(r["token_ids"]).encode()).hexdigest())
        for r in df.collect()
    )
    assert digest(corpus_pipeline.run(spark, SF)) == digest(docs)


def test_odd_and_empty_documents(spark, odd, no_docs):
    """Columns with the operators' own names are carried by all stages but the last."""
    names = ["was_null", "merged", "token_ids", "mix_copy", "mix_size", "simhash_row", "row", "whole", "decoded_md5"]
    for docs in (odd, no_docs):
        docs = docs.withColumns({name: F.lit("own") for name in names})
        schema = docs.schema
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF))
            assert docs.schema.names == schema.names
            assert all(r[name] == "own" for r in docs.collect() for name in names)
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
