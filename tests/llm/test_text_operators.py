import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratemill.llm import bpe, lexicon, quality, queries, secrets, simhash

from . import brute
from .conftest import sorted_rows, texts


@pytest.fixture(scope="module", params=["odd", "sample"])
def docs(request):
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="module")
def model(spark, sample):
    return quality.fit(sample, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))


def test_quality_base_counts(docs, model):
    found = quality.score(docs, model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = [tuple(r) for r in found.select("doc_id", *names).collect()]
    assert sorted_rows(rows) == sorted_rows([(i, *brute.base_counts(t)) for i, t in texts(docs)])
    assert found.where("base_failed AND kept").isEmpty()


def test_quality_score_is_the_mean_log_ratio(sample, model):
    rows = {r["doc_id"]: r["llr"] for r in quality.score(sample, model).collect()}
    for doc_id, text in texts(sample)[:40]:
        ids, words, sizes = quality._word_ids([text.encode()])
        bucket, _ = quality.ngram_buckets(ids, words, sizes, len(model.ratios))
        assert len(bucket) == max(2 * len(ids) - 1, 0)
        expected = int(sum(int(model.ratios[b]) for b in bucket)) / max(len(bucket), 1) / quality.SCALE
        assert rows[doc_id] == pytest.approx(expected, abs=1e-12)


def test_quality_corpus_counts_are_whole(spark, sample):
    """Counts per bucket, in any split, are those of all texts at once."""
    found = sample.withColumn("trusted", sample.doc_id % 2 == 0).repartition(5).mapInArrow(
        lambda batches: quality._counted(batches, 512), "bucket long, raw long, trusted long"
    ).groupBy("bucket").sum("raw", "trusted").collect()
    expected = {}
    for doc_id, text in texts(sample):
        bucket, _ = quality.ngram_buckets(*quality._word_ids([text.encode()]), 512)
        for b in bucket.tolist():
            raw, good = expected.get(b, (0, 0))
            expected[b] = (raw + 1, good + (doc_id % 2 == 0))
    assert {r[0]: (r[1], r[2]) for r in found} == expected


def test_quality_separates_labels(spark):
    """Documents labelled bad score lower; those labelled good are kept."""
    folder = "/root/testdata/sf0.01"
    judged = queries.registered()["op1_quality_rules"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = judged.where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(
        {"kept": "any_value", "llr": "avg"}
    ).collect()
    by = {r["quality"]: r["avg(llr)"] for r in rows}
    assert by[1] > by[0] + 0.2
    kept = judged.join(labels.where("quality = 1"), "doc_id")
    assert kept.where("kept").count() >= 0.97 * kept.count()


def test_quality_on_labels_that_were_not_fitted(spark):
    """Of labels the model has not seen, junk goes and clean documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 4 != 0"))
    judged = quality.score(docs, model).where("NOT base_failed")
    rows = judged.join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert len(junk) > 50 and sum(junk) <= 0.03 * len(junk)
    assert len(clean) > 500 and sum(clean) >= 0.99 * len(clean)


def test_quality_trusts_all_labelled_documents(spark):
    """Above the 20,000 ids that once were the most, every one still counts in the fit or the threshold."""
    n = 21_000
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.trusted_ids(labels.union(labels)).count() == n
    docs = spark.range(n).selectExpr("id AS doc_id", "'good words ' || id AS text")
    model = quality.fit(docs, labels, buckets=1 << 12, held_out=1 << 40)
    raw, trusted = quality._bucket_sums(docs.selectExpr("text", "true AS trusted"), 1 << 12)
    assert (raw == trusted).all() and raw.sum() == 5 * n
    prior = (raw + 1) / (raw.sum() + len(raw))
    target = (trusted + len(raw) * prior) / (trusted.sum() + len(raw))
    assert (model.ratios == np.rint(np.log(target / prior) * quality.SCALE)).all()


def test_quality_joins_all_labelled_texts(spark, monkeypatch):
    """Whatever the table of bits lets through, the rows are those of a join; repeated ids give rows of their own."""
    docs = spark.range(3000).selectExpr("if(id % 50 = 0, null, id % 1500) AS doc_id", "'text ' || id AS text")
    ids = spark.range(0, 2000, 3).selectExpr("if(id % 5 = 0, null, id) AS doc_id", "id % 2 = 0 AS trusted").distinct()
    expected = sorted_rows(docs.join(ids, "doc_id").select("doc_id", "text", "trusted").collect())
    assert len(expected) > 500
    for slots in (1, 8, 1 << 17):
        monkeypatch.setattr(quality, "SLOTS", slots)
        assert sorted_rows(quality._with_texts(docs, ids).select("doc_id", "text", "trusted").collect()) == expected


@pytest.mark.parametrize("n", [1, 2, 101, 1000])
def test_quality_quantiles_are_percentiles(spark, n):
    rows = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(701)).cast("double").alias("x"))
    expected = rows.agg(F.percentile("x", F.array(F.lit(0.01), F.lit(0.5)))).first()[0]
    assert quality._quantiles(rows, "x", [0.01, 0.5]) == pytest.approx(list(expected), abs=1e-9)
    assert quality._quantiles(rows.where("false"), "x", [0.5]) is None


def test_quality_filter_keeps_columns_and_nulls(odd, model):
    kept = quality.filter_documents(odd, model)
    assert kept.schema == odd.schema
    expected = quality.score(odd, model).where("kept").count()
    assert kept.count() == expected


def test_quality_without_labels_or_rows(spark, odd, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(no_docs, quality.fit(no_docs, labels)).count() == 0
    judged = quality.score(odd, quality.fit(odd, labels))
    assert judged.where("kept = base_failed").isEmpty()


def test_simhash(docs):
    rows = texts(docs)
    prints = [brute.simhash(t) for _, t in rows]
    roots = brute.linked(prints)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    expected = [
        (doc_id, f"{p:016x}", least[root]) for (doc_id, _), p, root in zip(rows, prints, roots)
    ]
    found = simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_digits("fingerprint"), "component_id"
    )
    assert sorted_rows(map(tuple, found.collect())) == sorted_rows(expected)


def test_simhash_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_golay_keys_meet_at_every_distance():
    import numpy as np

    rng = np.random.default_rng(7)
    a = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    b = a.copy()
    for n in range(len(a)):
        for bit in rng.choice(64, n % 5, replace=False):
            b[n] ^= np.uint64(1) << np.uint64(bit)
    left, right = (set(zip(*(x.tolist() for x in simhash.join_keys(p)))) for p in (a, b))
    assert {row for row, _ in left & right} == set(range(len(a)))
    assert simhash._N_ERRORS.max() == 6 and simhash._N_ERRORS.min() == 1


def test_simhash_dense_groups_and_chains(spark):
    """A ball of prints around one, and a chain whose ends are far apart."""
    import random

    rnd = random.Random(3)
    ball = [(1 << 63 | 5) ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(30)]
    chain = [(1 << 4 * i) - 1 for i in range(1, 16)]
    far = [rnd.getrandbits(64) for _ in range(200)]
    prints = sorted({p - 2**64 if p >= 2**63 else p for p in ball + chain + far})
    nodes = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    from ratemill.llm.links import components

    links = simhash.near_links(nodes).collect()
    mask = 2**64 - 1
    assert all(((a ^ b) & mask).bit_count() <= 4 for a, b in links)
    found = dict(map(tuple, components(simhash.near_links(nodes)).collect()))
    expected = brute.linked([p & mask for p in prints])
    assert [found.get(p, p) for p in prints] == [prints[r] for r in expected]


@pytest.mark.parametrize("sampled", [10**9, 1])
def test_simhash_hot_keys_meet_at_centres(spark, monkeypatch, sampled):
    """A dense ball under small limits: keys known as hot from a sample, and keys found hot on reading."""
    import random

    from ratemill.llm.links import components

    monkeypatch.setattr(simhash, "SAMPLED", sampled)
    rnd = random.Random(5)
    ball = {0x123456789ABCDEF0}
    for _ in range(3):
        ball |= {x ^ (1 << rnd.randrange(64)) for x in ball for _ in range(6)}
    islands = {x ^ (0xFFFF << 20) for x in sorted(ball)[:40]}
    far = {rnd.getrandbits(64) for _ in range(100)}
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in ball | islands | far)
    nodes = spark.createDataFrame([(p,) for p in prints], "fingerprint long").repartition(3)
    assert bool(len(simhash._hot_keys(nodes, 20))) == (sampled == 1)
    links = simhash.near_links(nodes, dense_run=20)
    mask = 2**64 - 1
    pairs = [tuple(r) for r in links.collect()]
    assert all(b is not None and ((a ^ b) & mask).bit_count() <= 4 for a, b in pairs)
    found = dict(map(tuple, components(links).collect()))
    expected = brute.linked([p & mask for p in prints])
    assert [found.get(p, p) for p in prints] == [prints[r] for r in expected]

    # Runs that go on over batches are passed on whole, whatever the cuts.
    keys = np.repeat(np.arange(6), [3, 50, 2, 30, 21, 4])
    values = np.arange(len(keys)) << 5
    for step in (1, 7, 40, 1000):
        batches = [
            pa.record_batch([keys[i : i + step], values[i : i + step]], ["key", "fingerprint"])
            for i in range(0, len(keys), step)
        ]
        out = pa.Table.from_batches(
            [b.cast(pa.schema([("a", "int64"), ("b", "int64")])) for b in simhash._meetings(iter(batches), 0, 20)]
        ).to_pylist()
        assert sorted(r["a"] for r in out if r["b"] is None) == [
            v for k, v in zip(keys.tolist(), values.tolist()) if k in (1, 3, 4)
        ]


def test_secrets(docs):
    found = secrets.span_digests(secrets.find_secrets(docs)).collect()
    got = []
    for r in found:
        base = [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        got.append((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], ",".join(base)))
    expected = [(i, *brute.secrets(t)) for i, t in texts(docs)]
    assert sorted_rows(got) == sorted_rows(expected)


def test_secrets_more_rules(odd):
    found = secrets.span_digests(secrets.find_secrets(odd))
    spans = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert spans[13].startswith("github:0:44,")
    assert "private_key:45:76" in spans[13] and "slack:77:94" in spans[13]


def test_redaction(odd):
    rows = {r["doc_id"]: r for r in secrets.redact(odd).collect()}
    before = dict(texts(odd))
    assert rows[6]["text"] == before[6] and rows[6]["n_chars"] == -1
    assert rows[14]["text"] == " ".join(["[SECRET]"] * 700)
    assert rows[14]["n_chars"] == len(rows[14]["text"])
    assert rows[13]["text"] == "[SECRET] [SECRET] [SECRET]"
    assert rows[None] is not None and secrets.redact(odd).where("text IS NULL").count() == 1
    assert secrets.redact(odd).schema == odd.schema


def test_trigram_queries():
    query = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert query["hex"] == []
    assert query["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in query["assign"] and len(query["assign"]) == 6
    assert secrets.trigram_query(r"a.?bcd+") == [] and secrets.trigram_query("(?:abc)?x*") == []
    assert secrets.trigram_query("(?:abcd|xyz).*qrst") == sorted(
        [frozenset({"abc", "bcd", "qrs", "rst"}), frozenset({"xyz", "qrs", "rst"})], key=sorted
    )


def test_trigram_candidates_lose_no_match(sample):
    """Every text that a rule matches holds all trigrams of one of its clauses."""
    for _, text in texts(sample):
        for rule in secrets.RULES:
            clauses = secrets.trigram_query(rule.pattern)
            if clauses and re.search(rule.pattern, text):
                folded = text.lower()
                assert any(all(t in folded for t in c) for c in clauses)


def test_secrets_of_nothing(no_docs):
    assert secrets.find_secrets(no_docs).count() == 0


@pytest.fixture(scope="module")
def spec():
    return queries.tokenizer_spec()


@pytest.mark.parametrize("most", [0, 50, 1 << 16])
def test_bpe(docs, spec, most):
    library = Tokenizer.from_str(spec)
    expected = []
    for doc_id, text in texts(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        whole = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(whole.encode()).hexdigest(),
            )
        )
    found = bpe.encode_digests(docs, spec, bpe.build_lexicon(docs, spec, most_words=most))
    assert sorted_rows(map(tuple, found.collect())) == sorted_rows(expected)


def test_bpe_round_trip(odd, spec):
    tokens = bpe.encode(odd, spec, bpe.build_lexicon(odd, spec))
    rows = bpe.decode(tokens, spec).select("text", "decoded").collect()
    assert all((r["text"] or "") == r["decoded"] for r in rows)
    assert len(rows) == odd.count()


def test_bpe_every_character_class(spark, spec):
    """Each character between others, where pattern and library could disagree."""
    library = Tokenizer.from_str(spec)
    encoder = bpe.Encoder(spec, None)
    encoder.lexicon = type("None", (), {"numbers": lambda _, w: np.full(len(w), -1)})()
    points = [c for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    for shape in ("a{0}b", "a {0} b", "1{0}{0}2", "{0}\n{0}", " {0}", "a{0} {0} {0}b"):
        texts_ = ["".join(shape.format(chr(c)) for c in points[i : i + 64]) for i in range(0, len(points), 64)]
        for text in texts_:
            ids, order, _ = encoder.batch([text])
            assert [i for p in order.tolist() for i in ids[p]] == library.encode(
                text, add_special_tokens=False
            ).ids


def test_bpe_characters_of_all_planes(spec):
    """Letters and numbers in doubt, and others, with an apostrophe before and after."""
    library = Tokenizer.from_str(spec)
    encoder = bpe.Encoder(spec, None)
    encoder.lexicon = type("None", (), {"numbers": lambda _, w: np.full(len(w), -1)})()
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    doubt = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    points = [*doubt, *every[::97]]
    shaped = [f"a{c}b {c}{c}'s 1{c}'s '{c} {c}'ll{c}" for c in points]
    ids, order, sizes = encoder.batch(shaped)
    rows = ids.take(order).within(sizes)
    expected = library.encode_batch(shaped, add_special_tokens=False)
    assert [c for i, c in enumerate(points) if rows[i].tolist() != expected[i].ids] == []


def test_lexicon_takes_whole_classes_of_counts(spark, spec, monkeypatch):
    """The most frequent words, as many as fit; words with equal counts stay together."""
    docs = spark.createDataFrame([("a a a a bb bb bb ccc ccc dddd eeeee",)], "text string")
    taken = []
    monkeypatch.setattr(bpe, "compile_lexicon", lambda entries: taken.append(set(entries)) or b"")
    for most in (0, 1, 2, 3, 5, 9):
        bpe.build_lexicon(docs, spec, most_words=most)
    words = [b" a", b" bb", b"a", b" ccc", b" dddd", b" eeeee"]
    assert taken[0] == set() and taken[-1] == set(words)
    assert all(a <= b for a, b in zip(taken, taken[1:]))
    assert taken[2] == {b" a", b" bb"}


def test_decode_in_parts(spark, spec, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 7)
    texts_ = ["é 😀  x", "", "a long text of words", "x"]
    library = Tokenizer.from_str(spec)
    rows = [(t, library.encode(t, add_special_tokens=False).ids) for t in texts_] + [(None, None)]
    table = pa.table({"text": [t for t, _ in rows], "token_ids": pa.array([i for _, i in rows], pa.list_(pa.int32()))})
    found = pa.Table.from_batches(bpe._decoded(iter(table.to_batches()), spec)).to_pylist()
    assert [r["decoded"] for r in found] == [*texts_, ""]


def test_bpe_of_nothing(no_docs, spec):
    assert bpe.encode(no_docs, spec, bpe.build_lexicon(no_docs, spec)).count() == 0


def test_lexicon_shares_endings(tmp_path):
    words = {f"{a}{b}ing".encode(): (len(a), len(b)) for a in "abcdef" for b in ("", "x", "yz")}
    path = tmp_path / "words"
    path.write_bytes(lexicon.compile_lexicon(words))
    built = lexicon.Lexicon(str(path))
    asked = [*words, b"", b"a", b"aing_", b"zing", b"axin"]
    numbers = built.numbers(asked).tolist()
    assert sorted(numbers[: len(words)]) == list(range(len(words)))
    assert numbers[len(words) :] == [-1] * 5
    assert all(tuple(built.ids_of(n)) == words[w] for n, w in zip(numbers, words))
    assert len(built.final) < 10  # states; a trie has over sixty
