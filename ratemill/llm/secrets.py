"""Secret scans with a trigram inverted index.

Every rule's regex yields a Boolean query over trigrams that each of its
matches must hold. Postings (trigram, text) are kept for the trigrams that occur
in some query, sorted by trigram; intersecting them gives the texts in which
a rule can match, and only there its regex runs. A rule without a mandatory
trigram runs on every text.

Positions are code points, ends exclusive. Matches of a rule are leftmost and do
not overlap; those that fail the rule's length test are dropped after matching.
A NULL text counts as empty; empty and NULL texts have no spans. Equal texts share
their postings and keep their own rows. The input's columns are kept as asked;
added ones are prefixed with ``secret``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

_parser = re._parser  # the library's own regex parser; the rules use what Java reads alike

#: More alternatives than this are not followed: their text is not mandatory then.
MOST_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, and the least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    # Formats that issuers have published.
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
BASE = 3


def _literals(items) -> set[str] | None:
    """All texts that a parsed pattern can match, in lower case, or None if too many."""
    found = {""}
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            options = {chr(value).lower()}
        elif name == "SUBPATTERN":
            options = _literals(value[-1])
        elif name == "BRANCH":
            parts = [_literals(part) for part in value[1]]
            options = None if None in parts else set().union(*parts)
        elif name == "IN" and all(str(kind) == "LITERAL" for kind, _ in value):
            options = {chr(c).lower() for _, c in value}
        elif name == "MAX_REPEAT" and value[1] <= 2:
            once = _literals(value[2])
            options = once and {
                "".join(x) for n in range(value[0], value[1] + 1) for x in product(once, repeat=n)
            }
        else:
            options = None
        if not options or len(found) * len(options) > MOST_LITERALS:
            return None
        found = {a + b for a, b in product(found, options)}
    return found


def _stretches(items):
    """The longest stretches of a concatenation that have few matches."""
    stretch: list = []
    for item in items:
        name, value = str(item[0]), item[1]
        if _literals([*stretch, item]) is not None:
            stretch.append(item)
            continue
        yield stretch
        stretch = []
        if name == "SUBPATTERN":
            yield from _stretches(value[-1])
        elif _literals([item]) is not None:
            stretch = [item]
    yield stretch


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of trigrams; a match holds all of at least one set. Empty: nothing is mandatory."""
    clauses = [frozenset()]
    for stretch in _stretches(_parser.parse(pattern)):
        options = {
            frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in _literals(stretch)
        }
        if frozenset() in options or len(clauses) * len(options) > MOST_LITERALS:
            continue
        clauses = [a | b for a, b in product(clauses, options)]
    least = {c for c in clauses if not any(other < c for other in clauses)}
    return sorted(least, key=sorted) if frozenset() not in least else []


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, k1, k2) for every text that holds the trigram.

    Case is folded. A common trigram's list is spread by the text's key.
    """
    # A generated column is computed once a text; a plain one would be put into every condition.
    folded = texts.select("k1", "k2", F.explode(F.array(F.lower("text"))).alias("folded"))
    held = F.array_compact(
        F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams])
    )
    rows = folded.select("k1", "k2", F.explode(held).alias("trigram"))
    return stored(rows.distinct().sort("trigram", "k1", "k2"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(k1, k2, rules): texts in whose postings some clause of a rule is complete."""
    wanted = [
        (kind, n, len(clause), trigram)
        for kind, clauses in queries.items()
        for n, clause in enumerate(clauses)
        for trigram in sorted(clause)
    ]
    clauses = index.sparkSession.createDataFrame(
        wanted, "kind string, clause int, needed int, trigram string"
    )
    # The clauses come from the rules alone: a fixed handful of rows.
    held = index.join(F.broadcast(clauses), "trigram")
    whole = held.groupBy("k1", "k2", "kind", "clause", "needed").agg(F.count("*").alias("n"))
    return whole.where("n = needed").groupBy("k1", "k2").agg(F.collect_set("kind").alias("rules"))


def _running(lengths: Column) -> Column:
    """Running totals of an array, in blocks, so that long arrays stay cheap."""
    block = 256

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def running(values: Column, start: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(start.alias("sum"), F.array().cast("array<int>").alias("out")),
            lambda a, x: F.struct(
                (a["sum"] + x).alias("sum"), F.array_append(a["out"], a["sum"] + x).alias("out")
            ),
            lambda a: a["out"],
        )

    n = F.ceil(F.size(lengths) / F.lit(block)).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        lambda i: F.slice(lengths, i * block + 1, F.lit(block)),
    )
    ends = running(F.transform(parts, total), F.lit(0))
    return F.flatten(
        F.transform(
            parts,
            lambda part, i: running(
                part, F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1))
            ),
        )
    )


SPANS = "array<struct<start:int,rule:int,end:int>>"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Matches of one rule with their places.

    The pieces between matches and the matches alternate, so running totals of
    their lengths are the ends of the matches.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    counted = (
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
        if rule.group
        else matches
    )
    steps = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: m + g)
    found = F.zip_with(
        F.arrays_zip(matches.alias("match"), counted.alias("counted")),
        _running(steps),
        lambda m, end: F.struct(
            (end - m["match"]).alias("start"),
            F.lit(number).alias("rule"),
            end.alias("end"),
            m["counted"].alias("counted"),
        ),
    )
    kept = F.filter(found, lambda x: x["counted"] >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["start"], x["rule"], x["end"])).cast(SPANS)


def _shorter_scan(rule: Rule) -> Rule:
    """One class repeated: its maximal runs can be asked for their length while matching."""
    plain = re.fullmatch(r"\[[^\]]*\]\+", rule.pattern)
    return Rule(rule.kind, f"{rule.pattern[:-1]}{{{rule.least},}}", 0, 1) if plain else rule


def _scanned(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``row`` and ``text`` of every row, with ``secret_spans``, sorted by start, then rule."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: clauses for kind, clauses in queries.items() if clauses}
    keyed = texts.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64("text", F.lit(1))})
    if indexed:
        index = postings(keyed, sorted({t for c in indexed.values() for s in c for t in s}))
        keyed = keyed.join(candidates(index, indexed), ["k1", "k2"], "left")
    none = F.array().cast(SPANS)
    parts = []
    for number, rule in enumerate(rules):
        spans = _spans(F.col("text"), _shorter_scan(rule), number)
        if rule.kind in indexed:
            spans = F.when(F.array_contains("rules", rule.kind), spans).otherwise(none)
        parts.append(spans)
    return keyed.select("row", "text", F.sort_array(F.concat(*parts)).alias("secret_spans"))


def _wrapped(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in one struct, so that no name of theirs meets one of this module's."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row, its text and secret_spans."""
    return _scanned(_wrapped(docs, list(keep)), rules).select("row.*", "text", "secret_spans")


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", kinds[x["rule"]], x["start"], x["end"])), ","
    )


def _of_rule(spans: Column, number: int) -> Column:
    return F.filter(spans, lambda x: x["rule"] == number)


def span_digests(found: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = BASE) -> DataFrame:
    """Counts of the first ``base`` rules, the digest of their spans, and all spans as text."""
    spans = F.col("secret_spans")
    counts = [
        F.size(_of_rule(spans, n)).cast("long").alias(f"n_{rule.kind}")
        for n, rule in enumerate(rules[:base])
    ]
    first = F.filter(spans, lambda x: x["rule"] < base)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(first, rules), 256).alias("base_sha256"),
        _listed(spans, rules).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span, overlaps joined, replaced by ``mark``.

    Rows and columns stay; ``n_chars``, if there, follows the new text. NULL stays NULL.
    """
    others = [c for c in docs.columns if c != "text"]
    wrapped = docs.select(
        F.struct(
            F.col("text").isNull().alias("no_text"),
            F.struct(F.lit(0).alias("secret"), *[F.col(f"`{c}`") for c in others]).alias("own"),
        ).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = _scanned(wrapped, rules)
    spans = F.col("secret_spans")
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda a, x: F.when(
            (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["end"] >= x["start"]),
            F.array_append(
                F.slice(a, 1, F.size(a) - 1),
                F.struct(
                    F.get(a, F.size(a) - 1)["start"].alias("start"),
                    F.greatest(F.get(a, F.size(a) - 1)["end"], x["end"]).alias("end"),
                ),
            ),
        ).otherwise(F.array_append(a, F.struct(x["start"], x["end"]))),
    )
    text = F.col("text")
    pieces = F.transform(
        F.col("merged"),
        lambda x, i: F.concat(
            text.substr(
                F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("merged"), i - 1)["end"]) + 1,
                x["start"]
                - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("merged"), i - 1)["end"]),
            ),
            F.lit(mark),
        ),
    )
    tail = text.substr(F.element_at(F.col("merged"), -1)["end"] + 1, F.length(text))
    whole = F.size("merged") == 0
    cut = found.withColumn("merged", merged).select(
        "row",
        whole.alias("whole"),
        F.when(F.col("row.no_text"), None)
        .when(whole, text)
        .otherwise(F.concat(F.array_join(pieces, ""), tail))
        .alias("text"),
    )
    columns = []
    for name in docs.columns:
        column = F.col("text") if name == "text" else F.col("row.own")[name]
        if name == "n_chars":
            length = F.length("text").cast(docs.schema[name].dataType)
            column = F.when(F.col("whole"), column).otherwise(length)
        columns.append(column.alias(name))
    return cut.select(*columns)
