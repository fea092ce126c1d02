from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratemill import schemas
from ratemill.plans import sheet as plans
from ratemill.session import free_shuffles, share_shuffles

from .seeds import JOHNSON, POWELL, RULES_FILE, billing, numbered, rows, rules, seed_frames, tables

SHORT = ["customer", "item", "ca_line", "qty", "price_level", "customer_id", "item_id", "price"]


def test_worked_example(spark):
    lines = billing(
        spark,
        (JOHNSON, "1001", "CA", "County X", "A", 4.0),
        (JOHNSON, "1001", "CA", "County X", "A", 3.0),
    )
    sheet = plans.billing_sheet(lines, tables(spark))
    assert sheet.columns == schemas.SHEET_COLUMNS
    assert [tuple(r) for r in sheet.collect()] == [
        (
            "0526-J", "5/31/2026", JOHNSON, "1001", 1, "YES", 7.0, "JC-CX-TypeA",
            "NS-CUST-9902", "NS-ITEM-101", "Net 15", "6/15/2026", 110.0, 770.0,
        )
    ]


def test_fallbacks(spark):
    lines = billing(
        spark,
        ("Nobody Ltd", "7777", None, "County X", "A", 2.0),
        ("Peterson Inc", "1002", "NY", "County X", "B", 1.0),
    )
    sheet = plans.billing_sheet(lines, tables(spark))
    assert rows(sheet, *SHORT, "line_order", "total_value") == [
        ("Nobody Ltd", "7777", "NO", 2.0, "Base Price", "NS-CUST-0000", None, 100.0, 1, 200.0),
        # A level without a price, and no fallback to the default customer's prices.
        ("Peterson Inc", "1002", "NO", 1.0, "PI-CX", "NS-CUST-9904", "NS-ITEM-102", 100.0, 2, 100.0),
    ]


def test_missing_values(spark):
    lines = billing(
        spark,
        (None, "1001", "CA", "County X", "A", 1.0),
        (POWELL, None, "CA", "County X", "A", 1.0),
        (POWELL, "1001", "CA", None, None, None),
    )
    sheet = plans.billing_sheet(lines, tables(spark))
    assert rows(sheet, "customer", "item", "qty", "price", "total_value") == [
        (POWELL, "1001", 0.0, 150.0, 0.0)
    ]


def test_spellings_stay_apart_but_share_lookups(spark):
    lines = billing(
        spark,
        (POWELL, "1001", "NY", "County X", "A", 1.0),
        ("powell barnes AND owens.", "01001.0", "NY", "County X", "A", 2.0),
    )
    sheet = plans.billing_sheet(lines, tables(spark))
    assert rows(sheet, "customer", "item", "qty", "customer_id", "item_id", "price") == [
        (POWELL, "1001", 1.0, "NS-CUST-9901", "NS-ITEM-101", 150.0),
        ("powell barnes AND owens.", "01001.0", 2.0, "NS-CUST-9901", "NS-ITEM-101", 150.0),
    ]


def _twice(spark):
    seeds = seed_frames(spark)
    return {
        "customers_db": seeds["customers_db"].unionByName(
            numbered(spark, [("JOHNSON-CLARK", "SECOND")], schemas.CUSTOMERS).withColumn(
                "seq", F.lit(99).cast("long")
            )
        ),
        "items_db": seeds["items_db"].unionByName(
            numbered(spark, [("1001.0", "SECOND", 9)], schemas.ITEMS).withColumn(
                "seq", F.lit(99).cast("long")
            )
        ),
    }


def test_duplicates_first_row_or_fan_out(spark):
    lines = billing(spark, (JOHNSON, "1001", "NY", "County X", "A", 1.0))
    reference = tables(spark, **_twice(spark))
    one = plans.billing_sheet(lines, reference)
    assert rows(one, "customer_id", "item_id", "line_order") == [("NS-CUST-9902", "NS-ITEM-101", 1)]
    four = plans.billing_sheet_text_keys(lines, reference)
    assert rows(four, "customer_id", "item_id", "line_order") == [
        ("NS-CUST-9902", "NS-ITEM-101", 1),
        ("NS-CUST-9902", "SECOND", 9),
        ("SECOND", "NS-ITEM-101", 1),
        ("SECOND", "SECOND", 9),
    ]


def test_equal_price_keys_repeat_the_line(spark):
    prices = numbered(
        spark,
        [(JOHNSON, "1001", "JC-CX-TypeA", 110.0), (JOHNSON, "01001", " JC-CX-TypeA", 111.0)],
        schemas.PRICES,
    )
    lines = billing(spark, (JOHNSON, "1001", "NY", "County X", "A", 2.0))
    sheet = plans.billing_sheet(lines, tables(spark, prices_db=prices))
    assert rows(sheet, "price", "total_value") == [(110.0, 220.0), (111.0, 222.0)]


def test_strict_variant(spark):
    lines = billing(
        spark,
        (JOHNSON, "1001", "NY", "County X", "A", 1.0),
        ("johnson-clark", "1001", "NY", "County X", "A", 1.0),
        (JOHNSON, "01001", "NY", "County X", "B", 1.0),
        (JOHNSON, "1002", "NY", None, "A", 1.0),
    )
    sheet = plans.billing_sheet_strict(lines, tables(spark))
    assert sheet.columns == schemas.SHEET_COLUMNS
    assert rows(sheet, *SHORT, "line_order") == sorted(
        [
            (JOHNSON, "1001", "NO", 1.0, "JC-CX-TypeA", "NS-CUST-9902", "NS-ITEM-101", 110.0, 1),
            ("johnson-clark", "1001", "NO", 1.0, "Base Price", "NS-CUST-0000", "NS-ITEM-101", 100.0, 1),
            (JOHNSON, "01001", "NO", 1.0, "JC-CX-TypeB", "NS-CUST-9902", None, 100.0, 1),
            (JOHNSON, "1002", "NO", 1.0, "Base Price", "NS-CUST-9902", "NS-ITEM-102", 100.0, 1),
        ],
        key=repr,
    )


def test_strict_variant_without_default_customer(spark):
    customers = seed_frames(spark)["customers_db"].filter("customer_name <> 'DEFAULT'")
    lines = billing(spark, ("Nobody", "1001", "NY", "County X", "A", 1.0))
    sheet = plans.billing_sheet_strict(lines, tables(spark, customers_db=customers))
    assert rows(sheet, "customer_id") == [(None,)]


def test_prototype(spark):
    lines = billing(
        spark,
        (POWELL, "1001", "CA", "County Y", "B", 1.0),
        ("Barnes LLC", "1002", "TX", "County X", "A", 5.0),
        (None, "1002", "TX", "County X", "A", 5.0),
    )
    sheet = plans.upload_prototype(lines, rules(spark, RULES_FILE))
    assert sheet.columns == schemas.PROTOTYPE_COLUMNS
    assert rows(sheet, "external_id", "price_level", "ca_line", "customer_id", "item_id", "line_order") == [
        ("0526-BL", "Barnes LLC Flat Rate Rule", "NO", "", "", 1),
        ("0526-PBA", "Powell Flat Rate Rule", "YES", "", "", 1),
    ]
    no_rules = plans.upload_prototype(lines, rules(spark, []))
    assert {r.price_level for r in no_rules.collect()} == {
        f"{POWELL} Flat Rate Rule", "Barnes LLC Flat Rate Rule",
    }


def test_rated_lines_keep_every_line(spark):
    lines = billing(
        spark,
        (JOHNSON, "1001", "CA", "County Y", "B", 1.0),
        (JOHNSON, "1001", "CA", "County Y", "B", 1.0),
        (None, "1002", None, "County X", "A", 5.0),
    )
    rated = plans.rated_lines(lines, rules(spark, RULES_FILE))
    assert rated.columns == [*lines.columns, "price_level", "ca_line"]
    assert rows(rated, "customer", "price_level", "ca_line") == [
        (JOHNSON, "JC-CY-TypeB", "YES"), (JOHNSON, "JC-CY-TypeB", "YES"), (None, None, "NO"),
    ]


def test_order_and_preview(spark):
    lines = billing(
        spark,
        *((c, i, s, "County X", "A", 1.0) for c in ("b", "a") for i in ("10", "9", "x") for s in ("CA", "NY")),
    )
    sheet = plans.billing_sheet(lines, tables(spark))
    ordered = [(r.customer, r.item, r.ca_line) for r in plans.in_sheet_order(sheet).collect()]
    want = [(c, i, f) for c in ("a", "b") for i in ("x", "9", "10") for f in ("NO", "YES")]
    assert ordered == want
    first = plans.preview(sheet, 5)
    assert [(r.customer, r.item, r.ca_line) for r in first.collect()] == want[:5]


@pytest.mark.parametrize("limits", [{"strategy": "shuffle"}, {"broadcast_bytes": 0}])
def test_sheet_is_the_same_with_shuffled_rules(spark, limits):
    lines = billing(
        spark,
        *((c, str(1000 + n % 7), "CA", f"County {'XY'[n % 2]}", "AB"[n % 3 % 2], float(n))
          for n in range(60) for c in (POWELL, JOHNSON, "Peterson Inc", "Other")),
    )
    want = rows(plans.billing_sheet(lines, tables(spark)), *schemas.SHEET_COLUMNS)
    found = plans.billing_sheet(lines, tables(spark), plans.SheetOptions(**limits))
    assert rows(found, *schemas.SHEET_COLUMNS) == want
    assert sum(r[6] for r in want) == 4 * sum(range(60))


def test_options(spark):
    from datetime import date

    options = plans.SheetOptions(period_end=date(2026, 12, 20), net_days=30, flagged_state="NY")
    lines = billing(spark, (JOHNSON, "1001", "NY", "County X", "A", 1.0))
    row = plans.billing_sheet(lines, tables(spark), options).first()
    assert (row.external_id, row.invoice_date, row.trade_credit, row.due_date, row.ca_line) == (
        "1226-J", "12/20/2026", "Net 30", "1/19/2027", "YES",
    )


def test_no_shuffle_of_the_sheet_carries_keys_of_another_lookup(spark):
    import re

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = billing(spark, (JOHNSON, "1001", "NY", "County X", "A", 2.0))
        sheet = plans.billing_sheet(lines, tables(spark))
        plan = sheet._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with_lines = [line for line in plan.splitlines() if "Project [" in line and "qty#" in line]
    assert len(with_lines) > 3
    assert not [line for line in with_lines if re.search(r"(?<!AS )\b(customer|item|level)_key#", line)]


# --- one shuffle by customer -------------------------------------------------

#: Rules with a customer do not fit, so lines are shuffled to meet them.
BY_CUSTOMER = plans.SheetOptions(broadcast_bytes=0)


@pytest.fixture
def settings(spark):
    """A function that changes settings of the session until the test ends."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = f"spark.sql.{key.replace('__', '.')}"
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _with_everyone(spark):
    """Lines of customers, of one without rules and of the wildcard customer's name; reference tables with copies."""
    customers = (POWELL, JOHNSON, "johnson-clark", "Other", "DEFAULT", " default.", "Default")
    lines = billing(
        spark,
        *((c, item, "CA", f"County {'XY'[n % 2]}", "AB"[n % 3 % 2], float(n))
          for n, c in enumerate(customers * 6) for item in ("1001", "01002.0", str(1000 + n), "fee", "1001.0")),
    )
    prices = [("DEFAULT", str(1000 + n), "Base Price", float(n)) for n in range(40)]
    prices += [("default", "01001", "Base Price", 7.0), (None, "1001", "Base Price", 8.0), ("Other", "fee", "Base Price", 9.0)]
    later = numbered(spark, [("default", "SECOND"), ("other", "OTHER"), (None, "NONE")], schemas.CUSTOMERS)
    customers_db = seed_frames(spark)["customers_db"].unionByName(later.withColumn("seq", F.col("seq") + 90))
    return lines, tables(spark, prices_db=numbered(spark, prices, schemas.PRICES), customers_db=customers_db)


@pytest.mark.parametrize(
    "build", [plans.billing_sheet, plans.billing_sheet_text_keys, plans.billing_sheet_strict]
)
def test_sheet_by_customer_is_the_same(spark, settings, build):
    settings(autoBroadcastJoinThreshold="-1")
    lines, reference = _with_everyone(spark)
    want = rows(build(lines, reference), *schemas.SHEET_COLUMNS)
    assert rows(build(lines, reference, BY_CUSTOMER), *schemas.SHEET_COLUMNS) == want
    assert {r[8] for r in want} >= {"SECOND" if build is plans.billing_sheet_text_keys else "NS-CUST-0000"}


@pytest.mark.parametrize(
    "build", [plans.billing_sheet, plans.billing_sheet_text_keys, plans.billing_sheet_strict]
)
def test_lines_are_shuffled_for_their_customer_and_for_their_item_only(spark, settings, build):
    settings(autoBroadcastJoinThreshold="-1")
    lines, reference = _with_everyone(spark)
    sheet = build(lines, reference, BY_CUSTOMER)
    plan = sheet._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [b for a, b in zip(plan, plan[1:]) if "Exchange " in a]
    assert len([b for b in below if "ca_line#" in b]) == 2


def test_lines_of_everyone_are_dealt_out(spark, settings):
    """The wildcard customer's lines, prices and id meet in many tasks, without splitting at run time."""
    settings(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    lines = billing(spark, *(("Default", str(n), "CA", "County X", "A", 1.0) for n in range(4000)))
    prices = numbered(spark, [("DEFAULT", str(n), "Base Price", float(n)) for n in range(4000)], schemas.PRICES)
    key = plans.item_key(F.col("item"))
    placed = plans.rated_quantities(
        lines, tables(spark).rules, BY_CUSTOMER, plans.NORMALISED, "Base Price", item_key=key
    )
    found = plans.join_price(plans.add_match_keys(placed), prices, everyone="default")
    found = plans.join_customer(found, tables(spark).customers, everyone="default")
    found = found.withColumn("part", F.spark_partition_id()).collect()
    assert {(r.price, r.customer_id) for r in found} == {(float(n), "NS-CUST-0000") for n in range(4000)}
    sizes = sorted(Counter(r.part for r in found).values())
    assert len(sizes) == 8 and sizes[-1] < 1.5 * sizes[4]


def test_hot_customer_is_split_at_run_time(spark, settings, tmp_path):
    share_shuffles(spark)
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__forceOptimizeSkewedJoin="true",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        adaptive__advisoryPartitionSizeInBytes="10000",
        adaptive__coalescePartitions__minPartitionSize="1000",
    )
    lines = billing(
        spark,
        *((JOHNSON, str(n), "CA", "County X", "A", 1.0) for n in range(20000)),
        *((f"Client {n}", "1001", "CA", "County X", "B", 1.0) for n in range(2000)),
    )
    lines.repartition(8).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    sheet = plans.billing_sheet(lines, tables(spark), BY_CUSTOMER)
    found = rows(sheet, *schemas.SHEET_COLUMNS)
    assert found == rows(plans.billing_sheet(lines, tables(spark)), *schemas.SHEET_COLUMNS)
    shown = sheet.select("customer", "item", "price", "customer_id", "item_id")
    shown.collect()
    assert "skew=true" in shown._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


# --- what is kept on disk ----------------------------------------------------


def _shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (found.apply(i) for i in range(found.size())) if f.getName().endswith(".data")}


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"strategy": "shuffle"}])
def test_sheet_in_steps_is_the_same_and_leaves_no_shuffle(spark, settings, limits):
    settings(autoBroadcastJoinThreshold="-1", classic__shuffleDependency__fileCleanup__enabled="false")
    lines, reference = _with_everyone(spark)
    options = plans.SheetOptions(**limits)
    want = rows(plans.billing_sheet(lines, reference, options), *schemas.SHEET_COLUMNS)
    free_shuffles(spark)
    before = _shuffle_files(spark)
    sheet = plans.billing_sheet(lines, reference, options, in_steps=True)
    assert _shuffle_files(spark) <= before
    assert rows(sheet, *schemas.SHEET_COLUMNS) == want
    plan = sheet._jdf.queryExecution().executedPlan().toString()
    assert "prices" not in plan and "partial_sum(units" not in plan  # what it was made of is not read again


def test_positions_of_the_sheet_are_kept_as_parquet(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    lines, reference = _with_everyone(spark)
    sheet = plans.billing_sheet(lines, reference)
    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(shared.rglob("rdd-*"))
    placed = plans.with_sheet_positions(sheet)
    assert set(shared.rglob("rdd-*")) == before
    assert all(".parquet" in name for name in placed.inputFiles()) and placed.inputFiles()
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    found = placed.orderBy("position").collect()
    assert [r.position for r in found] == [*range(1, sheet.count() + 1)]
    want = [tuple(r) for r in plans.in_sheet_order(sheet).select("customer", "item", "price_level").collect()]
    assert [(r.customer, r.item, r.price_level) for r in found] == want
