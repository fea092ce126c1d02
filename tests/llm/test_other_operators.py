import hashlib
import io
import math
import struct
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ratemill.llm import language, mixing, neighbours, queries, sharding, warc
from ratemill.session import shared_dir
from starbench.compare import compare, duck

from .conftest import sorted_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_oracle(spark, name):
    problem, n = compare(queries.registered()[name](spark, SF), duck(SF), queries.oracle_sql()[name])
    assert not problem and n > 0


# --- mixing ---------------------------------------------------------------------


def fair_targets(sizes, weights, share, most):
    """Shares by weight; those above their cap stop there and the rest is shared again."""
    left, capped = share * sum(sizes.values()), {}
    while True:
        open_ = {s: w for s, w in weights.items() if s not in capped}
        unit = left / sum(open_.values()) if open_ else 0
        over = [s for s, w in open_.items() if w * unit > most * sizes[s]]
        if not over:
            return capped | {s: w * unit for s, w in open_.items()}
        for s in over:
            capped[s] = Fraction(most * sizes[s])
            left -= capped[s]


def test_mixing(odd):
    rows = mixing.mix(odd, keep=["doc_id", "source", "key", "size"]).collect()
    assert len(rows) == odd.count()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["mix_size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["mix_size"] * r["mix_copies"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["mix_size"])
        assert 0 <= r["mix_copies"] <= 2 and (r["key"], r["size"]) == ("k", 5)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    expected = fair_targets(sizes, weights, Fraction(3, 2), 2)
    for r in rows:
        assert r["mix_source_size"] == sizes[r["source"]]
        assert r["mix_target"] == pytest.approx(float(expected[r["source"]]))
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= Fraction(largest[s], 2)
    again = mixing.mix(odd.repartition(7), keep=["doc_id"]).select("doc_id", "mix_copies")
    first = [(r["doc_id"], r["mix_copies"]) for r in rows]
    assert sorted_rows(map(tuple, again.collect())) == sorted_rows(first)


def test_mixed_documents_repeat_rows(odd, no_docs):
    mixed = mixing.mixed_documents(odd)
    assert mixed.schema.names == odd.schema.names
    assert mixed.count() == sum(r["mix_copies"] for r in mixing.mix(odd).collect())
    assert mixing.mixed_documents(no_docs).count() == 0


# --- sharding -------------------------------------------------------------------


def split(rows, limit, depth=0, path=""):
    if sum(b for _, _, b in rows) <= limit or len(rows) == 1:
        yield from ((i, b, path, depth, sum(x[2] for x in rows), len(rows)) for i, _, b in rows)
        return
    for bit in "01":
        part = [r for r in rows if r[1][depth] == bit]
        if part:
            yield from split(part, limit, depth + 1, path + bit)


@pytest.mark.parametrize("limit", [1, 3_000, 60_000, 10**9])
def test_sharding(sample, limit):
    rows = []
    for r in sample.select("doc_id", "text").collect():
        digest = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16)
        rows.append((r["doc_id"], f"{digest:060b}", len((r["text"] or "").encode())))
    found = [tuple(r) for r in sharding.assign_shards(sample, limit).collect()]
    assert sorted_rows(found) == sorted_rows(split(rows, limit))


def test_sharding_repeated_ids(spark):
    docs = spark.createDataFrame(
        [(i % 3 or None, "x" * 100, "p") for i in range(300)], "doc_id long, text string, path string"
    )
    rows = sharding.assign_shards(docs, 1000).collect()
    assert len(rows) == 300 and all(r["shard_bytes"] <= 1000 for r in rows)
    sums = {}
    for r in rows:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["shard_doc_bytes"]
    assert all(sums[r["shard"]] == r["shard_bytes"] for r in rows)


def test_sharding_odd_and_empty(odd, no_docs):
    rows = sharding.assign_shards(odd, 20_000).collect()
    assert len(rows) == odd.count()
    assert all(r["shard_bytes"] <= 20_000 or r["shard_docs"] == 1 for r in rows)
    assert sharding.assign_shards(no_docs, 10).count() == 0


def test_shard_files(spark, sample):
    path = shared_dir(spark)
    sharding.write_shards(sample, sharding.assign_shards(sample, 60_000), path)
    back = spark.read.parquet(path)
    assert back.count() == sample.count()
    heavy = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n"))
    assert heavy.where("b > 60000 AND n > 1").isEmpty()


# --- neighbours -------------------------------------------------------------------


def exact(rows, every, most=5):
    """Nearest rows by plain cosine."""
    usable = [
        (i, np.array(v, np.float64)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    for at, (i, v) in enumerate(usable):
        if i % every:
            continue
        scores = sorted(
            (-float((v * w).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum()))), j)
            for b, (j, w) in enumerate(usable) if b != at and len(w) == len(v)
        )
        yield from ((i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:most]))


def test_neighbours_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    rows += [(40 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(30)]  # equal vectors
    rows += [(0, rows[0][1]), (40, rows[40][1])]  # repeated rows
    rows += [(100, None), (110, []), (120, [0.0] * 6), (130, [1.0, None, 1, 1, 1, 1]),
             (140, [nan] * 6), (150, [inf, 1, 1, 1, 1, 1]), (None, [1.0] * 6),
             (160, [1.0, 2.0]), (161, [2.0, 1.0]), (170, [1e300, 1.0, 1.0])]
    rows = [(i, v and [None if x is None else float(x) for x in v], "x") for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, k string")
    found = neighbours.nearest(df, F.col("vec_id") % 10 == 0, probes=64, piece_rows=7)
    got = [(r[0], r[1], r[2], round(r[3], 12)) for r in found.collect()]
    expected = [(a, b, c, round(d, 12)) for a, b, c, d in exact([r[:2] for r in rows], 10)]
    assert sorted_rows(got) == sorted_rows(expected)
    assert neighbours.nearest(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_neighbours_of_a_dense_region(spark):
    """All rows ask and lie in few buckets: both sides are cut into several pieces."""
    rng = np.random.default_rng(9)
    rows = [(i, (100.0 + rng.normal(size=5)).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.lit(True), tables=3, probes=64, piece_rows=20)
    got = [(r[0], r[1], r[2]) for r in found.collect()]
    assert sorted_rows(got) == sorted_rows((a, b, c) for a, b, c, _ in exact(rows, 1))


def test_neighbours_recall(spark):
    """At least nine of ten exact neighbours are found, and scores are exact."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    expected = {(a, c): d for a, _, c, d in exact(rows, 50)}
    found = queries.registered()["op4_cross_polytope"](spark, "/root/testdata/sf0.1").collect()
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in found}
    hits = set(got) & set(expected)
    assert len(hits) >= 0.9 * len(expected) and len(found) == len(expected)
    assert all(got[x] == pytest.approx(expected[x], abs=1e-14) for x in hits)


def test_neighbours_recall_with_many_buckets(spark):
    """8,000 vectors in 4,096 buckets: a query has to look into more of them."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(8000, 64))
    vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>"
    )
    found = neighbours.nearest(df, F.col("vec_id") % 50 == 0, per_bucket=2).collect()
    scores = vectors[::50] @ vectors.T
    scores[np.arange(160), np.arange(0, 8000, 50)] = -1
    expected = {
        (50 * i, j) for i, row in enumerate(np.argsort(-scores)[:, :5].tolist()) for j in row
    }
    assert len({(r["query_id"], r["vec_id"]) for r in found} & expected) >= 0.9 * len(expected)


def test_buckets_follow_the_rows():
    assert neighbours.hash_widths(64, 100, 128) == [1]
    assert neighbours.hash_widths(64, 128 * 128, 128) == [64]
    assert neighbours.hash_widths(64, 128 * 1024, 128) == [64, 4]
    assert neighbours.hash_widths(64, 128 * 128**3, 128) == [64, 64, 64]


# --- language ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    html = "<html lang='{}'><body><p>{}</p></body></html>".format
    rows = [
        (1, "https://a.b.example.fr/x", html("fr", "le chat et la souris dans la maison")),
        (2, "https://a.b.example.fr/y", html("en", "le chien et la poule")),
        (3, "http://user@c.example.de:80/", html("de", "der Hund und die Katze im Haus")),
        (4, "http://c.example.de", None),
        (5, None, html("xx", "the cat and the mouse in the house")),
        (5, None, html("xx", "the cat and the mouse in the house")),
        (None, "not a url", ""),
        (6, "http://d.example.fr/", "<script>the the the</script>"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture(scope="module")
def model(spark):
    rows = [
        ("the cat and the dog in the house with the mouse", "en"),
        ("le chat et le chien dans la maison avec la souris", "fr"),
        ("der Hund und die Katze in dem Haus mit der Maus", "de"),
        (None, "en"), ("nothing", None),
    ]
    return language.fit(spark.createDataFrame(rows, "text string, lang string"), buckets=4096)


def fused(pages, model, most=100, smoothing=10.0):
    """The posterior of each page, spelled out."""
    import re

    n, rows = len(model.languages), []
    for r in pages.collect():
        host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", r["url"] or "")
        host = host[1].lower() if host else ""
        declared = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", r["html"] or "", re.I)
        log = language.text_evidence(language.visible_text(r["html"]), model, most)
        keys = (host, ".".join(host.split(".")[-2:]), host.split(".")[-1],
                declared[1].lower() if declared else "")
        rows.append((r["page_id"], keys, log, int(np.argmax(log)) if max(log) < 0 else None))
    for i, (page_id, keys, log, _) in enumerate(rows):
        others = [x for j, x in enumerate(rows) if j != i and x[3] is not None]
        votes = lambda k: np.bincount([x[3] for x in others if k is None or x[1][k] == keys[k]], minlength=n)
        all_ = votes(None)
        prior = (all_ + 1) / (all_.sum() + n)
        for k in (1, 0):
            prior = (votes(k) + smoothing * prior) / (votes(k).sum() + smoothing)
        score = np.array(log) + np.log(prior)
        for k in (2, 3):
            if keys[k]:
                share = (votes(k).sum() + 1) / (all_.sum() + 2)
                score += np.log((votes(k) + smoothing * share) / (all_ + smoothing))
        share = np.exp(score - score.max())
        yield page_id, model.languages[int(np.argmax(score))], float(1 / share.sum())


def test_language(pages, model):
    found = language.identify(pages, model).select("page_id", "lang", "posterior").collect()
    got = [(r[0], r[1], round(r[2], 9)) for r in found]
    assert sorted_rows(got) == sorted_rows((a, b, round(c, 9)) for a, b, c in fused(pages, model))
    by = {r[0]: r[1] for r in found}
    assert by[1] == "fr" and by[2] == "fr" and by[3] == "de" and by[4] == "de" and by[5] == "en"


def test_language_of_nothing(spark, pages, model):
    assert language.identify(pages.where("false"), model).count() == 0
    empty = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert language.identify(pages, empty).where("lang IS NOT NULL").isEmpty()


def test_language_held_out(spark):
    """Trained without the fifth of the documents that is judged, by text alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.where("doc_id % 5 != 0"))
    rows = docs.where("doc_id % 5 = 0").select("text", "lang").collect()
    right = sum(
        model.languages[int(np.argmax(language.text_evidence(r["text"], model, 100)))] == r["lang"]
        for r in rows
    )
    assert right >= 0.97 * len(rows)


# --- WARC -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def web(spark):
    big = "é<p>" * 400
    rows = [
        (1, "http://a/ b\r\nX: y", big), (5, None, big), (5, "http://c/é", big), (None, "http://d", big),
        (2, "http://e", None), (3, "http://f", ""), (4, "http://g", "short"), (6, "http://h", "short"),
        (7, "http://i", "x" * 2_000_000), (8, "http://j", "\r\n\r\nWARC/1.1\r\n" + "z" * 1000),
        (9, "http://k", "a" * 999), (10, "http://l", "a" * 999),
    ]
    rows += [(100 + i, f"http://m/{i}", f"<html>{i % 7} page " * 120) for i in range(300)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def expected_records(web):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in web.collect()]
    last = {}
    for i, p in rows:
        if i is not None:
            last[p] = max(last.get(p, i), i)
    for i, p in rows:
        shared = len(p) >= 1000 and p in last and (i is None or i < last[p])
        yield (i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if shared else "response",
               last[p] if shared else None)


@pytest.mark.parametrize("limits", [{}, {"most_bytes": 5000, "sample_bytes": 20_000}])
def test_warc_round_trip(spark, web, limits):
    manifest = warc.write_archives(warc.plan_records(web), shared_dir(spark), **limits)
    records = warc.read_archives(manifest)
    assert records.where("problem IS NOT NULL").isEmpty()
    rows = records.collect()
    number = lambda r, name: None if r["headers"].get(name) is None else int(r["headers"][name])
    got = [
        (number(r, "page-id"), r["payload_bytes"], r["payload_digest"], r["headers"]["warc-type"],
         number(r, "refers-to-page-id"))
        for r in rows
    ]
    assert sorted_rows(got) == sorted_rows(expected_records(web))
    for r in rows:
        if r["headers"]["warc-type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
        else:
            assert r["payload"] is None
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    first = open(manifest.first()["path"].removeprefix("file:"), "rb").read(4)
    assert struct.unpack("<I", first)[0] == warc.DICTIONARY


def test_warc_of_nothing(spark, web):
    manifest = warc.write_archives(warc.plan_records(web.where("false")), shared_dir(spark))
    assert warc.read_archives(manifest).count() == 0


RECORD = warc.record_bytes(
    {"page_id": 1, "url": "http://a", "payload": b"hello", "payload_bytes": 5,
     "digest": hashlib.sha1(b"hello").hexdigest(), "record_type": "response", "refers_to": None}
)


@pytest.mark.parametrize(
    "broken",
    [
        RECORD.replace(b"WARC/1.1", b"WARC/9.9"),
        RECORD.replace(b"WARC-Date", b"WARC-Dote"),
        RECORD.replace(b"hello", b"hullo"),
        RECORD.replace(b"hello", b"helloo"),
        RECORD[:-2],
        RECORD + b"x",
        RECORD.replace(b"HTTP/1.1 200", b"GOPHER 200xx"),
        RECORD.replace(b"Content-Length: 5", b"Content-Length: 6"),
        b"",
    ],
)
def test_warc_refuses(broken):
    assert warc.parse_record(RECORD)["payload"] == b"hello"
    with pytest.raises(ValueError):
        warc.parse_record(broken)


def test_warc_frames(spark, tmp_path):
    plain = zstandard.ZstdCompressor().compress(RECORD)
    skipped = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    assert [x for _, x in warc.frames(io.BytesIO(plain + skipped + plain))] == [RECORD] * 2
    path = tmp_path / "broken.warc.zst"
    path.write_bytes(plain + zstandard.ZstdCompressor().compress(b"WARC/1.1\r\n") + plain[:-5])
    rows = warc.read_archives(spark.createDataFrame([(str(path),)], "path string")).collect()
    assert [r["problem"] is None for r in rows] == [True, False, False]


# --- cases that reviews have found ------------------------------------------


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e-310])
def test_neighbours_of_very_large_and_small_vectors(spark, size):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * size).tolist()) for i in range(12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, F.col("vec_id") % 4 == 0, neighbours=3).collect()
    assert len(found) == 9
    unit = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    unit = {i: v / np.sqrt(v @ v) for i, v in unit.items()}
    for query in (0, 4, 8):
        expected = sorted((-float(unit[query] @ unit[i]), i) for i in unit if i != query)[:3]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        assert [i for _, i, _ in own] == [i for _, i in expected]
        assert np.allclose([s for *_, s in own], [-s for s, _ in expected], rtol=1e-12)


def test_shards_of_repeated_ids_under_another_name(spark):
    rows = [(i % 2, "x" * 40) for i in range(9)] + [(None, "y" * 40)] * 3
    pages = spark.createDataFrame(rows, "page_id long, html string")
    found = sharding.assign_shards(pages, 100, "page_id", "html").collect()
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["shard_doc_bytes"]
    assert len(found) == 12 and all(n <= 100 for n in sizes.values())


def test_archives_are_read_by_as_many_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for n in (0, 1, 5, 3 * cores):
        rows = [(f"file:{tmp_path / f'{i}.warc.zst'}", i) for i in range(n)]
        for i in range(n):
            (tmp_path / f"{i}.warc.zst").write_bytes(b"no frame")
        manifest = spark.createDataFrame(rows, "path string, bytes long").repartition(4)
        found = warc.read_archives(manifest)
        tasks = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(tasks) == min(n, cores) and sum(tasks) == n  # each such file is one problem row
        assert max(tasks, default=0) <= 3
