"""Best-rule matching with wildcards.

A rule names a customer, a county and a type, and any of the three may be a
wildcard. A line takes the rule with the highest score, where a dimension
that is equal counts 2 and one that only meets the wildcard counts 1; equal
scores go to the lowest ``rule_id``.

Written as one join condition this is an OR per dimension, which no hash or
merge join can use. But a rule's wildcards are known: every rule has one of
eight *shapes* (which dimensions it fixes), and inside one shape the match is
a plain equality on the fixed dimensions. So the match becomes at most eight
equi joins with one hit each, and the best hit is a row-wise maximum: no
nested loop, no pairs of lines and rules, no regrouping of the lines.

How the joins run depends on measured sizes (see ``assign_price_level``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import match_key, strip_text
from ..session import shared_dir
from .places import PLACE, place

DIMENSIONS = ("customer", "county", "type")
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024

#: Most triples whose level is broadcast to the lines, and the parts their lines are dealt into.
HOT_TRIPLES = 1000
SALTS = 4096

#: Most rules of one customer that lines of it meet as one row.
CUSTOMER_RULES = 64

_RULE_TYPE = "struct<rule_id:bigint,price_level_name:string>"


@dataclass(frozen=True)
class MatchMode:
    """How values are compared: ``NORMALISED`` spelling or ``STRICT`` text."""

    normalise: bool
    any_customer: str
    any_value: str

    def wildcard(self, dimension: str) -> str:
        return self.any_customer if dimension == "customer" else self.any_value

    def key(self, dimension: str, column: Column) -> Column:
        if not self.normalise:
            return column
        if dimension == "customer":
            return match_key(column)
        # A missing county or type is the text ``nan`` to the comparison, so
        # it meets the wildcard, or a rule spelled exactly so.
        return F.coalesce(strip_text(column), F.lit("nan"))


NORMALISED = MatchMode(normalise=True, any_customer="default", any_value="ANY")
STRICT = MatchMode(normalise=False, any_customer="DEFAULT", any_value="ANY")


@dataclass(frozen=True)
class RuleShape:
    """The rules that fix the same dimensions, at most one per key."""

    fixed: tuple[str, ...]
    rules: DataFrame
    n_rules: int
    n_bytes: int

    @property
    def hit(self) -> str:
        return "_hit_" + ("_".join(self.fixed) or "none")


def _key(dimension: str) -> str:
    return f"_{dimension}_key"


def _with_keys(df: DataFrame, columns: dict[str, str], mode: MatchMode) -> DataFrame:
    return df.withColumns(
        {_key(d): mode.key(d, F.col(columns[d])) for d in DIMENSIONS}
    )


def first_rule_per_key(rules: DataFrame, mode: MatchMode) -> DataFrame:
    """Rules under their keys and ``shape``.

    Rules with equal keys tie on every line and only the first can ever win,
    so there is one per key.
    """
    columns = {"customer": "customer_name", "county": "county", "type": "type"}
    keyed = _with_keys(rules, columns, mode).dropna(subset=[_key(d) for d in DIMENSIONS])
    first = keyed.groupBy(*map(_key, DIMENSIONS)).agg(
        F.min(F.struct("rule_id", "price_level_name")).alias("_rule")
    )
    fixed = (F.when(F.col(_key(d)) != mode.wildcard(d), d) for d in DIMENSIONS)
    shape = F.coalesce(F.nullif(F.concat_ws("_", *fixed), F.lit("")), F.lit("none"))
    return first.withColumn("shape", shape)


def rule_shapes(rules: DataFrame, mode: MatchMode) -> list[RuleShape]:
    """Split the rules by shape and measure each one; shapes without rules are left out.

    The split rules are written to the shared folder, one partition per shape,
    so that up to eight joins read their own rules only and none of them
    repeats the work behind ``rules``. What comes back to the driver is one
    count and size per shape, eight rows at most.
    """
    spark = rules.sparkSession
    keyed = first_rule_per_key(rules, mode)
    path = shared_dir(spark)
    keyed.write.partitionBy("shape").parquet(path)
    split = spark.read.schema(keyed.schema).parquet(path)
    texts = [*(F.col(_key(d)) for d in DIMENSIONS), F.col("_rule.price_level_name")]
    row_bytes = F.lit(16)
    for text in texts:
        row_bytes = row_bytes + F.coalesce(F.octet_length(text), F.lit(0))
    measured = (
        split.groupBy("shape")
        .agg(F.count("*").alias("n_rules"), F.sum(row_bytes).alias("n_bytes"))
        .collect()
    )
    shapes = [
        RuleShape(
            tuple(d for d in DIMENSIONS if d in row["shape"].split("_")),
            split.filter(F.col("shape") == row["shape"]),
            row["n_rules"],
            row["n_bytes"],
        )
        for row in measured
    ]
    return sorted(shapes, key=lambda s: (-len(s.fixed), s.fixed))


def _join_shapes(
    keyed_lines: DataFrame,
    shapes: list[RuleShape],
    hints: dict[tuple[str, ...], str | None],
) -> DataFrame:
    """Add each shape's matching rule as a column, NULL where none matches."""
    matched = keyed_lines
    for shape in shapes:
        hit = F.col("_rule").alias(shape.hit)
        if not shape.fixed:
            # Every dimension is a wildcard: one key, hence one rule, for all lines.
            matched = matched.withColumn(shape.hit, shape.rules.select(hit).scalar())
            continue
        keys = [_key(d) for d in shape.fixed]
        side = shape.rules.select(*keys, hit)
        how = hints[shape.fixed]
        matched = matched.join(side.hint(how) if how else side, keys, "left")
    return matched


def _inner_key(shape: RuleShape) -> Column:
    """One text for the dimensions besides the customer that a shape fixes; NULL if one is."""
    return F.concat(
        *(c for d in shape.fixed if d != "customer" for c in (F.length(_key(d)), F.lit(":"), F.col(_key(d))))
    )


def _rules_by_customer(shapes: list[RuleShape], everyone: str) -> DataFrame:
    """One row per customer key: a map from the other keys to the rule for each shape, or the one rule.

    The key, never missing here, is made anew, so the rows are shuffled once more for their join: rows known to be
    shuffled by the customer's key alone would have lines shuffled likewise, whatever their place, and adaptive
    execution splits a hot customer only between two shuffles. All have place 0, as none is for ``everyone``; a
    literal would be taken out of the join's keys.
    """
    parts = []
    for shape in shapes:
        inner = _inner_key(shape) if len(shape.fixed) > 1 else F.lit("")
        parts.append(
            shape.rules.select(
                _key("customer"), F.lit(shape.hit).alias("_shape"), inner.alias("_inner"), F.col("_rule")
            )
        )
    rules = reduce(DataFrame.unionByName, parts)
    maps = []
    for shape in shapes:
        entry = F.when(F.col("_shape") == shape.hit, F.struct("_inner", "_rule"))
        maps.append(F.map_from_entries(F.collect_list(entry)).alias(shape.hit + "_map"))
    grouped = rules.groupBy(_key("customer")).agg(*maps)
    key = F.coalesce(_key("customer"), F.lit(""))
    ruled_place = F.when(key == everyone, 1).otherwise(0)
    return grouped.select(
        key.alias("_ruled_customer"), ruled_place.alias("_ruled_place"), *(s.hit + "_map" for s in shapes)
    )


def _best_hit(shapes: list[RuleShape]) -> Column:
    """The hit with the highest score, or NULL.

    The score is 3 plus the number of fixed dimensions. A line that itself
    holds a wildcard's text scores one more with every rule that has that
    wildcard; but no other rule matches such a line, so the order is the same.
    Hence the hits of the shapes that fix most win, and within equally many
    fixed dimensions the lowest ``rule_id``, the first field of a hit.
    """
    best = []
    for n in range(len(DIMENSIONS), -1, -1):
        tied = [F.col(s.hit) for s in shapes if len(s.fixed) == n]
        if tied:
            best.append(F.least(*tied) if len(tied) > 1 else tied[0])
    return F.coalesce(*best, F.lit(None).cast(_RULE_TYPE))


def _score(shape: RuleShape, mode: MatchMode) -> Column:
    """The score of the shape's rule for a line it matches.

    Equality is tested before the wildcard, so a line that itself holds the
    wildcard's text counts 2.
    """
    score = F.lit(2 * len(shape.fixed))
    for d in DIMENSIONS:
        if d not in shape.fixed:
            equal = F.col(_key(d)) == mode.wildcard(d)
            score = score + F.when(equal, 2).otherwise(1)
    return score


def _hints(
    shapes: list[RuleShape], strategy: str, broadcast_bytes: int
) -> dict[tuple[str, ...], str | None]:
    """Broadcast the smallest shapes as long as all of them fit the limit."""
    if strategy == "shuffle":
        return {shape.fixed: "merge" for shape in shapes}
    left, hints = broadcast_bytes, {}
    for shape in sorted(shapes, key=lambda s: s.n_bytes):
        fits = shape.n_bytes <= left
        hints[shape.fixed] = "broadcast" if fits else None
        left -= shape.n_bytes if fits else 0
    return hints


class Rater:
    """Rules, split and measured once, ready to rate lines.

    ``in_place`` tells whether every shape is small enough to be broadcast. If
    so lines are rated where they are, without any shuffle. ``by_customer`` tells whether
    those without a customer are, and no customer has more than ``CUSTOMER_RULES`` rules: then the
    rules of a customer are one row, and lines are shuffled once to meet it. Otherwise the
    distinct (customer, county, type) triples are rated, written once and joined back.
    """

    def __init__(
        self,
        rules: DataFrame,
        mode: MatchMode = NORMALISED,
        strategy: str = "auto",
        broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    ):
        if strategy not in ("auto", "shuffle"):
            raise ValueError(f"strategy is 'auto' or 'shuffle', not {strategy!r}")
        self.mode = mode
        self.shapes = rule_shapes(rules, mode)
        self._hint = _hints(self.shapes, strategy, broadcast_bytes)
        self.in_place = all(self._hint[s.fixed] == "broadcast" for s in self.shapes if s.fixed)
        self._own = [s for s in self.shapes if "customer" in s.fixed]
        self._common = [s for s in self.shapes if "customer" not in s.fixed]
        self.by_customer = (
            strategy == "auto"
            and not self.in_place
            and all(self._hint[s.fixed] == "broadcast" for s in self._common if s.fixed)
            and self._most_rules() <= CUSTOMER_RULES
        )

    def _most_rules(self) -> int:
        """The number of rules of the customer that has most."""
        own = reduce(DataFrame.unionByName, (s.rules.select(_key("customer")) for s in self._own))
        return own.groupBy(_key("customer")).count().agg(F.max("count")).first()[0] or 0

    def rate(
        self,
        lines: DataFrame,
        default_level: str,
        triples_from: DataFrame | None = None,
        item_key: Column | None = None,
    ) -> DataFrame:
        """``lines`` with their ``price_level``.

        Rules that are all broadcast are matched where the lines are. Otherwise lines meet the rules of their
        customer in one shuffle join, if ``by_customer``; partitions with very many lines of a customer are
        split by adaptive execution. If not, the triples of the lines are
        counted, rated and written once, and lines get the level of their triple: the most frequent triples, at most
        ``HOT_TRIPLES``, by broadcast, the others by a shuffle join. Lines of hot triples find nothing in that
        join, so their keys are salted, and they are dealt out evenly.

        ``triples_from`` may name a cheaper source of the same triples, if
        ``lines`` is the result of an aggregation.

        With ``item_key`` lines that meet the rules of their customer also get ``PLACE`` and, if names are
        normalised, ``customer_key``: by place and key, or else name, they were shuffled, so later steps find them
        where they are. It is for lines that have a customer.
        """
        if self.in_place:
            return self._match(lines, default_level)
        if self.by_customer:
            return self._rate_by_customer(lines, default_level, item_key)
        triples = self._rated_triples(lines if triples_from is None else triples_from, default_level)
        keys = [f"_rated_{d}" for d in DIMENSIONS]
        hot = F.broadcast(triples.where("_hot").select(*keys, F.col("price_level").alias("_hot_level")))
        rest = triples.where("NOT _hot").select(*keys, F.col("price_level").alias("_level"), F.lit(0).alias("_no_salt"))
        same = lambda side: [lines[d].eqNullSafe(side[k]) for d, k in zip(DIMENSIONS, keys)]
        salt = F.when(
            F.col("_hot_level").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)) + 1
        ).otherwise(0)
        marked = lines.join(hot, same(hot), "left").select(lines["*"], "_hot_level", salt.alias("_salt"))
        joined = marked.join(
            rest,
            [*(marked[d].eqNullSafe(rest[k]) for d, k in zip(DIMENSIONS, keys)), marked["_salt"] == rest["_no_salt"]],
            "left",
        )
        level = F.coalesce("_hot_level", "_level")
        return joined.select(*(marked[c] for c in lines.columns), level.alias("price_level"))

    def _rate_by_customer(
        self, lines: DataFrame, default_level: str, item_key: Column | None = None
    ) -> DataFrame:
        """Lines with the best of their customer's rules and the broadcast ones.

        Without ``item_key`` the customer's key is made where it is compared, so the shuffled lines do not carry
        it. Lines without customer or with the wildcard's text meet no such rule and are dealt out evenly. Each
        customer has one row of rules, so a hash table of a partition's rows is small and lines need no sort.
        """
        key = self.mode.key("customer", F.col("customer"))
        everyone = self.mode.wildcard("customer")
        if item_key is None:
            apart = key.isNull() | (key == everyone)
            salt = F.when(apart, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)) + 1).otherwise(0)
        else:
            # An expression is rewritten here and there, so rows are known to be shuffled by a column only.
            if self.mode.normalise:
                lines, key = lines.withColumn("customer_key", key), F.col("customer_key")
            salt = place(key, item_key, everyone)
        marked = lines.withColumn(PLACE, salt)
        rules = _rules_by_customer(self._own, everyone)
        joined = marked.join(
            rules.hint("shuffle_hash"),
            (key == F.col("_ruled_customer")) & (F.col(PLACE) == F.col("_ruled_place")),
            "left",
        )
        kept = lines.columns if item_key is None else [*lines.columns, PLACE]
        keyed = _with_keys(joined, {d: d for d in DIMENSIONS}, self.mode)
        hits = {
            s.hit: F.try_element_at(s.hit + "_map", _inner_key(s) if len(s.fixed) > 1 else F.lit(""))
            for s in self._own
        }
        matched = _join_shapes(keyed.withColumns(hits), self._common, self._hint)
        return self._with_level(matched, kept, default_level)

    def _rated_triples(self, lines: DataFrame, default_level: str) -> DataFrame:
        """The triples of ``lines`` with their level, written to the shared folder, and whether they are hot.

        A triple is hot if it has more than one in ``HOT_TRIPLES`` of the lines, so there can be no more of them.
        Counts are combined map-side before they are shuffled.
        """
        spark, path = lines.sparkSession, shared_dir(lines.sparkSession)
        counted = lines.groupBy(*DIMENSIONS).agg(F.count("*").alias("_lines"))
        rated = self._match(counted, default_level).select(
            *(F.col(d).alias(f"_rated_{d}") for d in DIMENSIONS), "_lines", "price_level"
        )
        rated.write.parquet(path)
        saved = spark.read.schema(rated.schema).parquet(path)
        total = saved.agg(F.sum("_lines")).first()[0] or 0
        return saved.withColumn("_hot", F.col("_lines") > F.lit(total / HOT_TRIPLES)).drop("_lines")

    def _match(self, lines: DataFrame, default_level: str) -> DataFrame:
        return self._with_level(self._join(lines), lines.columns, default_level)

    def _with_level(self, matched: DataFrame, columns: list[str], default_level: str) -> DataFrame:
        level = F.coalesce(_best_hit(self.shapes)["price_level_name"], F.lit(default_level))
        return matched.select(*columns, level.alias("price_level"))

    def _join(self, lines: DataFrame) -> DataFrame:
        keyed = _with_keys(lines, {d: d for d in DIMENSIONS}, self.mode)
        return _join_shapes(keyed, self.shapes, self._hint)

    def candidates(self, lines: DataFrame) -> DataFrame:
        """Every distinct triple of ``lines`` with each matching rule and its score.

        Of rules with equal keys only the first is listed, so a triple has at
        most eight rows, one per shape.
        """
        hits = []
        for shape in self.shapes:
            rule = F.col(shape.hit)
            scored = F.struct(
                rule["rule_id"].alias("rule_id"),
                rule["price_level_name"].alias("price_level"),
                _score(shape, self.mode).alias("score"),
            )
            hits.append(F.when(rule.isNotNull(), scored))
        return (
            self._join(lines.select(*DIMENSIONS).distinct())
            .select(*DIMENSIONS, F.explode(F.array(*hits)).alias("_candidate"))
            .filter("_candidate IS NOT NULL")
            .select(*DIMENSIONS, "_candidate.*")
        )


def assign_price_level(
    lines: DataFrame,
    rules: DataFrame,
    mode: MatchMode = NORMALISED,
    default_level: str = "Base Price",
    strategy: str = "auto",
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``price_level``, the level of the best rule, to every line.

    ``lines`` has ``customer``, ``county`` and ``type``; ``rules`` has
    ``rule_id``, ``customer_name``, ``county``, ``type``, ``price_level_name``.

    With ``auto`` the rules are measured first. Shapes are broadcast, smallest
    first, as long as together they stay within ``broadcast_bytes``; the rest
    goes through a shuffle join on the customer or shuffle joins on the distinct
    triples (see ``Rater``). ``shuffle`` makes all of them shuffle joins on triples.
    """
    return Rater(rules, mode, strategy, broadcast_bytes).rate(lines, default_level)
