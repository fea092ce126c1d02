"""The rating against a direct statement of its rules, line by line."""

import random

import pytest
from pyspark.sql import functions as F

from ratemill.operators.rating import NORMALISED, STRICT, Rater, assign_price_level

from .seeds import rows, rules

LINES = "id int, customer string, county string, type string"
CUSTOMERS = ["Acme, Inc", "ACME Inc.", "Beta", "beta ", "Default", "DEFAULT", "Gamma", "", None]
COUNTIES = ["X", " X", "Y", "ANY", "nan", "any", None]
TYPES = ["A", "B", "A ", "ANY", None]


def plain(value):
    return None if value is None else value.lower().strip().translate({ord(c): None for c in ",. "})


def matches(line, rule, mode):
    """Number of points per dimension, or None where the rule is out."""
    points = []
    for i, (have, want) in enumerate(zip(line, rule)):
        if mode is NORMALISED:
            if i == 0:
                have, want, wild = plain(have) or "", plain(want), "default"
            else:
                have, want, wild = str("nan" if have is None else have).strip(), want.strip(), "ANY"
        else:
            wild = "DEFAULT" if i == 0 else "ANY"
        if have is not None and have == want:
            points.append(2)
        elif want == wild:
            points.append(1)
        else:
            return None
    return points


def best_level(line, rule_rows, mode, default="none"):
    scored = []
    for i, rule in enumerate(rule_rows):
        points = matches(line, rule, mode)
        if points:
            scored.append((-sum(points), i, rule[3]))
    return min(scored)[2] if scored else default


def random_case(seed):
    rng = random.Random(seed)
    lines = [
        (i, rng.choice(CUSTOMERS), rng.choice(COUNTIES), rng.choice(TYPES)) for i in range(120)
    ]
    named = [c for c in CUSTOMERS if c]
    rule_rows = [
        (
            rng.choice(named),
            rng.choice(COUNTIES[:-1] + ["ANY", "ANY"]),
            rng.choice(TYPES[:-1] + ["ANY", "ANY"]),
            f"L{n}",
        )
        for n in range(rng.randint(0, 30))
    ]
    return lines, rule_rows


STRATEGIES = [
    {"strategy": "auto"},
    {"strategy": "shuffle"},
    {"strategy": "auto", "broadcast_bytes": 0},
    {"strategy": "auto", "broadcast_bytes": 150},
]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", [NORMALISED, STRICT], ids=["normalised", "strict"])
def test_all_strategies_agree_with_the_direct_statement(spark, seed, mode):
    lines, rule_rows = random_case(seed)
    df, table = spark.createDataFrame(lines, LINES), rules(spark, rule_rows)
    want = {i: best_level(line, rule_rows, mode) for i, *line in lines}
    for options in STRATEGIES:
        rated = assign_price_level(df, table, mode, "none", **options)
        assert rated.columns == [*df.columns, "price_level"]
        assert {r.id: r.price_level for r in rated.collect()} == want, options


def test_candidates_have_their_scores(spark):
    lines, rule_rows = random_case(7)
    df, table = spark.createDataFrame(lines, LINES), rules(spark, rule_rows)
    found = rows(Rater(table).candidates(df), "customer", "county", "type", "rule_id", "score")
    want, seen = [], set()
    for line in sorted({tuple(line) for _, *line in lines}, key=repr):
        for i, rule in enumerate(rule_rows, 1):
            points = matches(line, rule, NORMALISED)
            key = (line, plain(rule[0]), rule[1].strip(), rule[2].strip())
            if points and key not in seen:
                want.append((*line, i, sum(points)))
                seen.add(key)
    assert found == sorted(want, key=repr)


@pytest.mark.parametrize(
    "line, rule_rows, level",
    [
        # Scores add up: two equal dimensions beat an equal customer alone.
        (("C", "X", "A"), [("C", "ANY", "ANY", "one"), ("DEFAULT", "X", "A", "two")], "two"),
        # One dimension that does not match rejects the rule.
        (("C", "X", "A"), [("C", "X", "B", "no")], "none"),
        # A line that holds the wildcard's text.
        (("default", "X", "A"), [("DEFAULT", "ANY", "ANY", "d"), ("Default.", "X", "ANY", "e")], "e"),
        (("C", "ANY", "A"), [("DEFAULT", "ANY", "A", "first"), ("C", "ANY", "ANY", "late")], "first"),
        # Ties go to the first rule.
        (("C", "X", "A"), [("C", "X", "ANY", "first"), ("C", "ANY", "A", "late")], "first"),
        (("C", "X", "A"), [("DEFAULT", "X", "A", "first"), ("C", "ANY", "A", "late")], "first"),
        # A missing county meets the wildcard or the text nan.
        (("C", None, "A"), [("C", "nan", "A", "text"), ("C", "ANY", "A", "any")], "text"),
        # The wildcard is case-sensitive for counties.
        (("C", "X", "A"), [("C", "any", "A", "no")], "none"),
        (("C", "X", "A"), [], "none"),
    ],
)
def test_single_rules(spark, line, rule_rows, level):
    df = spark.createDataFrame([(1, *line)], LINES)
    rated = assign_price_level(df, rules(spark, rule_rows), default_level="none")
    assert [r.price_level for r in rated.collect()] == [level]


def test_equal_lines_are_kept(spark):
    df = spark.createDataFrame([(1, "C", "X", "A")] * 50 + [(2, None, None, None)] * 50, LINES)
    table = rules(spark, [("C", "X", "A", "L")])
    for options in STRATEGIES:
        rated = assign_price_level(df, table, default_level="none", **options)
        counts = {r.price_level: r["count"] for r in rated.groupBy("price_level").count().collect()}
        assert counts == {"L": 50, "none": 50}


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        Rater(rules(spark, []), strategy="fast")


def test_one_customer_with_most_lines(spark):
    """Shuffle strategy on lines of which most belong to one customer."""
    ids = spark.range(60000)
    df = ids.select(
        F.when(F.col("id") % 3 > 0, "Hot").otherwise(F.concat(F.lit("C"), F.col("id") % 500)).alias("customer"),
        F.concat(F.lit("X"), F.col("id") % 7).alias("county"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("type"),
    )
    table = rules(spark, [("HOT", "X3", "ANY", "hot"), ("C9", "ANY", "ANY", "nine"), ("DEFAULT", "ANY", "B", "b")])
    one = assign_price_level(df, table, strategy="shuffle").groupBy("customer", "price_level").count()
    two = assign_price_level(df, table).groupBy("customer", "price_level").count()
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.agg(F.sum("count")).first()[0] == 60000


# --- hot triples in the shuffle form ----------------------------------------


def _hot_lines(spark, n=30_000):
    """A third of the lines have one triple."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'Hot' ELSE concat('C', id % 5000) END AS customer",
        "CASE WHEN id % 3 = 0 THEN 'X' WHEN id % 11 = 0 THEN NULL ELSE concat('N', id % 7) END AS county",
        "CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B' END AS type",
        "id",
    )


def _some_rules(spark):
    rules = [(1, "DEFAULT", "ANY", "ANY", "all"), (2, "Hot", "X", "ANY", "hot"), (3, "C10", "ANY", "B", "ten")]
    rules += [(i + 4, f"C{i}", f"N{i % 7}", "ANY", f"L{i}") for i in range(0, 5000, 3)]
    return spark.createDataFrame(rules, "rule_id long, customer_name string, county string, type string, price_level_name string")


def test_shuffled_rating_of_hot_triples_is_even_and_right(spark):
    from pyspark.sql import functions as F

    lines, rules = _hot_lines(spark), _some_rules(spark)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # no splitting at run time
    try:
        rated = assign_price_level(lines, rules, strategy="shuffle")
        sizes = sorted(r["count"] for r in rated.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sizes[-1] < 1.5 * sizes[len(sizes) // 2]
    expected = assign_price_level(lines, rules)
    assert sorted(map(str, rated.collect())) == sorted(map(str, expected.collect()))


def test_shuffled_rating_scans_the_lines_once(spark, tmp_path):
    """The triples come from a written table; the result's plan reads the lines once."""
    path = str(tmp_path / "lines")
    _hot_lines(spark, 3000).write.parquet(path)
    rated = assign_price_level(spark.read.parquet(path), _some_rules(spark), strategy="shuffle")
    rated.collect()
    plan = rated._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count(f"{path}]") == 1


# --- rules of a customer as one row -----------------------------------------


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", [NORMALISED, STRICT], ids=["normalised", "strict"])
def test_rating_by_customer_agrees_with_the_direct_statement(spark, monkeypatch, seed, mode):
    lines, rule_rows = random_case(seed + 20)
    rule_rows += [("Acme, Inc", "X", "ANY", "cc"), ("Acme, Inc", "ANY", "A", "ct"), ("Beta", "X", "A", "cct")]
    rule_rows += [("Gamma", "ANY", "ANY", "c"), ("DEFAULT", "X", "A", "both"), ("Acme, Inc", "X", "A", "all")]
    rater = Rater(rules(spark, rule_rows), mode)
    monkeypatch.setattr(rater, "in_place", False)
    df = spark.createDataFrame(lines, LINES)
    rater.by_customer = True
    rated = rater.rate(df, "none")
    assert rated.columns == [*df.columns, "price_level"]
    want = {i: best_level(line, rule_rows, mode) for i, *line in lines}
    assert {r.id: r.price_level for r in rated.collect()} == want


def test_rating_by_customer_shuffles_the_lines_once(spark, executed_plans, tmp_path):
    """No job reads the lines before the result's, whose plan reads and shuffles them once."""
    path = str(tmp_path / "lines")
    _hot_lines(spark, 3000).write.parquet(path)
    rater = Rater(_some_rules(spark), broadcast_bytes=1000)
    assert rater.by_customer
    rated = rater.rate(spark.read.parquet(path), "none")
    assert not any(f"{path}]" in plan for plan in executed_plans()[1:])
    one = rated.groupBy("customer", "county", "type", "price_level").count().collect()
    two = assign_price_level(spark.read.parquet(path), _some_rules(spark), default_level="none")
    assert sorted(map(str, one)) == sorted(
        map(str, two.groupBy("customer", "county", "type", "price_level").count().collect())
    )
    plan = rated._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{path}]") == 1


def test_customer_with_many_rules_is_rated_by_triples(spark, monkeypatch):
    from ratemill.operators import rating

    monkeypatch.setattr(rating, "CUSTOMER_RULES", 2)
    rows_ = [("C", "X", "ANY", "one"), ("C", "Y", "ANY", "two"), ("C", "Z", "ANY", "three"), ("DEFAULT", "ANY", "ANY", "d")]
    rater = Rater(rules(spark, rows_), broadcast_bytes=30)
    assert not rater.in_place and not rater.by_customer
