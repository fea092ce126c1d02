"""Every registered query against its oracle, and the shape of its plan."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from starbench.compare import compare, duck
from starbench.queries import registered
from starbench.views import Star

SF_DIR = "/root/testdata/sf0.001"
#: Rules with a customer that is constant in a branch of their view go into a store: Spark plans the
#: semi and anti joins with the customers in that branch as nested loops.
CONSTANT_KEYS = {"reference_tables", "reference_tables_enforced", "load_rules"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", registered())
def test_query(spark, connection, executed_plans, name):
    df = queries()[name](spark, SF_DIR)
    problem, n = compare(df, connection, oracle_sql()[name])
    assert not problem
    assert n > 0
    plans = executed_plans()
    assert plans
    for plan in plans:
        # No Python in any job of the query, those before its last read included; no nested loops or
        # products. Rows given by the driver carry a name with Python in it, but need no worker.
        plan = plan.replace("applySchemaToPythonRDD", "")
        assert not re.search(r"Python|ArrowEval|InPandas|InArrow", plan)
        loops = set(re.findall(r"(?m)^[^(\n].*?(NestedLoopJoin \w+|CartesianProduct)", plan))
        allowed = {"NestedLoopJoin LeftSemi", "NestedLoopJoin LeftAnti"} if name in CONSTANT_KEYS else set()
        assert loops <= allowed
    assert not re.search(r"NestedLoop|CartesianProduct", plan_of(df))


def test_executed_plans_hold_earlier_jobs(spark, executed_plans):
    left, right = spark.range(3), spark.range(4)
    left.join(right, left.id < right.id).count()
    assert any("NestedLoop" in plan for plan in executed_plans())
    assert spark.range(2).mapInArrow(lambda batches: batches, "id long").count() == 2
    assert any("InArrow" in plan for plan in executed_plans())


def test_every_query_has_an_oracle():
    assert set(registered()) <= set(oracle_sql())
    assert set(registered()) <= set(queries())


def test_views_drop_no_row(spark):
    from starbench.views import Star

    star = Star(spark, SF_DIR)
    bought = star.lineitem.join(star.orders, star.lineitem.l_orderkey == star.orders.o_orderkey)
    pairs = bought.select("o_custkey", "l_partkey").distinct().count()
    assert star.sold.count() == pairs
    customers, parts = star.customer.count(), star.part.count()
    assert star.customers_db.where("netsuite_id LIKE 'CUST-%'").count() == customers
    assert star.items_db.where("netsuite_internal_id LIKE 'ITEM-%'").count() == parts
    assert star.price_levels_db.count() == customers + 1
    assert star.rules.where("rule_id BETWEEN 11 AND 15").count() == star.region.count()
    flags = star.lineitem.select("l_returnflag").distinct().count()
    assert star.rules.where("rule_id BETWEEN 1000000000000 AND 1999999999999").count() == flags


def test_entry(spark):
    assert entry(spark).count() > 0


def test_shuffled_rating_broadcasts_no_rules(spark):
    from ratemill.operators.rating import DIMENSIONS, Rater
    from starbench.views import Star

    # Triples are rated in a job of its own, before the lines are joined to them.
    star = Star(spark, SF_DIR)
    rater = Rater(star.rules, strategy="shuffle")
    plan = plan_of(rater._match(star.billing.select(*DIMENSIONS).distinct(), "Base Price"))
    joins = re.findall(r"(\w+Join) \[([^\]]*)_key#", plan)
    assert joins and {kind for kind, _ in joins} == {"SortMergeJoin"}


def test_rating_small_rules_does_not_shuffle_lines(spark):
    plan = plan_of(queries()["rate_lines"](spark, SF_DIR))
    assert "SortMergeJoin" not in plan
    assert not re.search(r"Exchange (hash|range|RoundRobin)", plan)


def test_rollup_with_small_rules_shuffles_lines_once(spark):
    from ratemill.plans.sheet import rated_quantities
    from ratemill.session import shared_dir
    from starbench.queries import NORMALISED, OPTIONS
    from starbench.views import Star

    path, star = shared_dir(spark), Star(spark, SF_DIR)
    star.billing.write.parquet(path)
    lines = spark.read.parquet(path)
    rolled = rated_quantities(lines, star.rules, OPTIONS, NORMALISED, OPTIONS.default_level)
    assert len(re.findall(r"Exchange (hash|range|RoundRobin)", plan_of(rolled))) == 1


def test_missing_keys_are_filtered_at_the_scan(spark):
    from ratemill.operators.rollup import drop_null_keys, quantity_rollup
    from starbench.views import Star
    from ratemill.session import shared_dir

    path = shared_dir(spark)
    Star(spark, SF_DIR).billing.selectExpr(
        "*", "'L' AS price_level", "'NO' AS ca_line"
    ).write.parquet(path)
    plan = plan_of(quantity_rollup(drop_null_keys(spark.read.parquet(path))))
    assert "PushedFilters: [IsNotNull(customer), IsNotNull(item)]" in plan
    assert "location" not in plan and "billing_date" not in plan


def test_partitions_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    """Twice the input gives twice the partitions of a shuffle, each with as many rows."""
    from pyspark.sql import functions as F

    from ratemill import session

    keys = (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize",
    )
    before = {k: spark.conf.get(k, None) for k in keys}
    monkeypatch.setattr(session, "SHUFFLED_BYTES", 20_000)
    monkeypatch.setattr(session, "ADVISORY_BYTES", 10_000)
    largest = {}
    try:
        spark.conf.set(keys[3], "1000b")
        for n in (200_000, 400_000):
            folder = f"{tmp_path}/{n}"
            spark.range(n).selectExpr("id AS l_orderkey").write.parquet(f"{folder}/lineitem.parquet")
            Star(spark, folder)
            assert spark.conf.get(keys[1]) == "10000"
            assert int(spark.conf.get(keys[2])) <= session.SCANNED_BYTES
            rows = spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_orderkey").count()
            sizes = [r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n
            largest[n] = max(sizes)
        assert largest[400_000] < 1.2 * largest[200_000] < 50_000
        spark.conf.set(keys[1], "5000b")
        session.size_partitions(spark, [])
        assert spark.conf.get(keys[1]) == "5000"  # finer already
        assert spark.conf.get(keys[0]) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_orders_meet_their_customer_before_their_lines(spark):
    """Lines are joined by order key only, and the planned views hold the rows of the stated ones."""
    from starbench.views import PLANNED, VIEWS, _used

    star = Star(spark, SF_DIR)
    for name in PLANNED:
        rows = getattr(star, name)
        tables = {t: getattr(star, t) for t in _used(name)}
        stated = spark.sql(VIEWS[name], **tables)
        assert rows.columns == stated.columns
        assert rows.exceptAll(stated).isEmpty() and stated.exceptAll(rows).isEmpty()
        above = str(rows._jdf.queryExecution().optimizedPlan()).split("l_orderkey")[0]
        assert "o_custkey" not in above


def _lines_shuffled(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum("Exchange hashpartitioning" in a and "ca_line#" in b for a, b in zip(plan, plan[1:]))


def test_fallbacks_shuffle_lines_for_their_customer_and_for_their_item_only(spark, connection, monkeypatch):
    from dataclasses import replace

    from starbench import queries as star

    monkeypatch.setattr(star, "OPTIONS", replace(star.OPTIONS, broadcast_bytes=2_000))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries()["fallback_fill"](spark, SF_DIR)
        assert _lines_shuffled(df) == 2
        problem, n = compare(df, connection, oracle_sql()["fallback_fill"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not problem and n > 0


@pytest.mark.parametrize("name", ["scan_reference", "sheet_csv_roundtrip", "sheet_order"])
def test_what_is_written_leaves_no_shuffle(spark, name):
    from .test_sheet import _shuffle_files

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files = _shuffle_files(spark)
        df = queries()[name](spark, SF_DIR)
        assert _shuffle_files(spark) <= files
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    if name == "sheet_csv_roundtrip":
        assert df.inputFiles() and all(f.endswith(".csv.gz") for f in df.inputFiles())
    assert df.count() > 0


def test_what_was_sold_is_read_once_for_its_prices(spark):
    from starbench.views import VIEWS

    star = Star(spark, SF_DIR)
    stated = spark.sql(VIEWS["prices_db"], sold=star.sold, part=star.part)
    assert star.prices_db.schema == stated.schema
    assert star.prices_db.exceptAll(stated).isEmpty() and stated.exceptAll(star.prices_db).isEmpty()
    scans = [str(f._jdf.queryExecution().optimizedPlan()).count("l_orderkey#") for f in (star.prices_db, star.sold)]
    assert scans[0] == scans[1] > 0
