"""One query per operator over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.session import shared_dir

from . import (
    bpe,
    collocations,
    language,
    mixing,
    negatives,
    neighbours,
    quality,
    ranking,
    repeats,
    secrets,
    sharding,
    simhash,
    warc,
)
from .tables import read

#: Small shards, so that the small tables fill several; a parameter of the operator.
SHARD_BYTES = 1 << 20

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    _QUERIES[run.__name__] = run
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def tokenizer_spec() -> str:
    """The text of the public byte-level tokenizer's file."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spec = read(spark, sf_dir, "documents"), tokenizer_spec()
    return bpe.encode_digests(docs, spec, bpe.build_lexicon(docs, spec))


@query
def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(
        read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, neighbours=5
    )


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.withColumn("fingerprint", simhash.hex_digits(F.col("fingerprint")))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(read(spark, sf_dir, "documents"), SHARD_BYTES)
    return shards.select(
        F.col("shard_doc_id").alias("doc_id"),
        F.col("shard_doc_bytes").alias("doc_bytes"),
        "shard",
        F.col("shard_depth").cast("long").alias("shard_depth"),
        "shard_bytes",
        "shard_docs",
    )


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return repeats.remove_repeats(docs, length=400, with_text=False).drop("kept")


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages, the text model from all documents."""
    model = language.fit(read(spark, sf_dir, "documents"))
    return language.identify(read(spark, sf_dir, "pages"), model)


@query
def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.plan_records(read(spark, sf_dir, "pages"), least_shared=1000)
    manifest = warc.write_archives(records, shared_dir(spark))
    found = warc.read_archives(manifest, payloads=False)
    return found.select(
        F.col("headers")["page-id"].cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("headers")["warc-type"].alias("record_type"),
        F.col("headers")["refers-to-page-id"].cast("long").alias("refers_to"),
        "problem",
    )


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(secrets.find_secrets(read(spark, sf_dir, "documents")))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), vec_id % 100 == 0, shifted)


@query
def op12_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return ranking.score(docs, ranking.fit(docs, read(spark, sf_dir, "labels")))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def oracle_sql() -> dict[str, str]:
    return {
        "op11_hard_negatives": """
            WITH usable AS (
              SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v,
                     CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
              FROM embeddings
              WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            scored AS (
              SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                     CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
              FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
            positives AS (
              SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
            SELECT p.anchor_id, positive_id,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                           ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id AS negative_id, positive_score, score AS negative_score
            FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
              AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
            QUALIFY rank <= 10""",
        "op13_collocations": r"""
            WITH pieces AS (
              SELECT coalesce(lang, 'und') AS lang,
                     unnest(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
              FROM documents),
            words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
            totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
            grams AS (
              SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
                       lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
              FROM words, (VALUES (1), (2), (3), (4), (5)) sizes(size) WHERE len(w) >= size),
            counts AS (
              SELECT lang, size, phrase, count(*) AS f FROM grams
              GROUP BY lang, size, phrase HAVING count(*) >= 100),
            split AS (SELECT *, string_split(phrase, ' ') AS w FROM counts),
            cuts AS (
              SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first,
                     array_to_string(w[k + 1:], ' ') AS rest
              FROM split, (VALUES (1), (2), (3), (4)) ks(k) WHERE k < size),
            scored AS (
              SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, n,
                     CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
              FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.first
              JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest
              JOIN totals t ON t.lang = c.lang),
            lowest AS (
              SELECT * FROM scored
              QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
            inside AS (
              SELECT lang, f, unnest(list_transform(range(1, size - m + 2),
                       lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
              FROM split, (VALUES (2), (3), (4)) ms(m) WHERE m < size),
            covers AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase)
            SELECT b.lang, row_number() OVER (PARTITION BY b.lang
                     ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank,
                   b.phrase, a, l, r, n, score
            FROM lowest b LEFT JOIN covers c ON c.lang = b.lang AND c.phrase = b.phrase
            WHERE c.f IS NULL OR 100 * c.f < 100 * a
            QUALIFY rank <= 2000""",
        "op9_warc_zstd": """
            WITH sized AS (
              SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                     sha1(coalesce(html, '')) AS payload_digest
              FROM pages),
            last AS (
              SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM sized),
            typed AS (
              SELECT *, payload_bytes >= 1000 AND last_id IS NOT NULL
                        AND coalesce(page_id < last_id, true) AS again
              FROM last)
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN again THEN last_id END AS refers_to,
                   CAST(NULL AS VARCHAR) AS problem
            FROM typed""",
        "op2_mix_sources": r"""
            WITH docs AS (
              SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
                     CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)
                       AS size
              FROM documents),
            sources AS (
              SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                     CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                       WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
              FROM docs GROUP BY source),
            levels AS (
              SELECT *, 2 * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio,
                     CAST(3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) OVER (
                       ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS num,
                     CAST(2 * sum(weight) OVER (
                       ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS den
              FROM sources),
            level AS (
              SELECT num / gcd(num, den) AS num, den / gcd(num, den) AS den FROM levels
              WHERE num <= ratio * den ORDER BY ratio LIMIT 1),
            targets AS (
              SELECT source, source_size,
                     CASE WHEN level.num * weight >= cap * level.den THEN CAST(cap AS DOUBLE)
                          ELSE CAST(level.num AS DOUBLE) / CAST(level.den AS DOUBLE) * weight
                     END AS target,
                     CASE WHEN level.num * weight >= cap * level.den THEN 2
                          WHEN level.num * weight >= source_size * level.den THEN 1
                          ELSE 0 END AS epochs
              FROM levels CROSS JOIN level),
            placed AS (
              SELECT d.*, source_size, target, epochs, target - epochs * source_size AS rest,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
            SELECT doc_id, size, source_size, target,
                   CAST(size * (epochs + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest
                                              THEN 1 ELSE 0 END) AS BIGINT) AS taken
            FROM placed""",
        "op6_sharding": f"""
            WITH docs AS (
              SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS doc_bytes,
                     CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)
                       AS BIGINT) AS bits
              FROM documents),
            levels AS (
              SELECT d.*, depth, bits >> CAST(60 - depth AS INTEGER) AS prefix
              FROM docs d, range(0, 61) r(depth)),
            sums AS (
              SELECT depth, prefix, CAST(sum(doc_bytes) AS BIGINT) AS shard_bytes,
                     count(*) AS shard_docs
              FROM levels GROUP BY depth, prefix),
            best AS (
              SELECT l.doc_id, l.doc_bytes, l.bits, min(l.depth) AS depth
              FROM levels l JOIN sums s ON l.depth = s.depth AND l.prefix = s.prefix
              WHERE s.shard_bytes <= {SHARD_BYTES} OR s.shard_docs = 1
              GROUP BY l.doc_id, l.doc_bytes, l.bits)
            SELECT b.doc_id, b.doc_bytes,
                   CASE WHEN b.depth = 0 THEN ''
                        ELSE lpad(bin(s.prefix), CAST(b.depth AS INTEGER), '0') END AS shard,
                   b.depth AS shard_depth, s.shard_bytes, s.shard_docs
            FROM best b JOIN sums s
              ON b.depth = s.depth AND s.prefix = b.bits >> CAST(60 - b.depth AS INTEGER)""",
    }
