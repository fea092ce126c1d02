import pytest
from pyspark.sql import functions as F

from ratemill.sources.reference import read_table

from ratemill import schemas
from ratemill.operators import checks, lookups, refdata
from ratemill.sources import reference

from .seeds import PRICES, RULES, billing, numbered, rows, seed_frames, tables
from ratemill.plans.sheet import billing_sheet


def customers(spark, *pairs):
    return numbered(spark, pairs, schemas.CUSTOMERS)


def test_insert_or_ignore(spark):
    old = customers(spark, ("A", "old"))
    batch = customers(
        spark, ("A", "new"), ("B", None), ("B", "first"), ("B", "second"), (None, "n1"), (None, "n2")
    )
    new = refdata.new_rows(old, batch, ["customer_name"], ["netsuite_id"])
    want = [("B", "first"), (None, "n1"), (None, "n2")]
    assert rows(new, "customer_name", "netsuite_id") == sorted(want, key=repr)
    again = refdata.new_rows(old.unionByName(new), batch, ["customer_name"], ["netsuite_id"])
    assert rows(again, "customer_name") == [(None,), (None,)]


def test_insert_with_a_composite_key(spark):
    batch = numbered(
        spark,
        [("A", "1", "L", 5.0), ("A", "1", "L", 6.0), ("A", None, "L", 7.0), ("A", None, "L", 7.0),
         ("A", "1", "M", None)],
        schemas.PRICES,
    )
    new = refdata.new_rows(
        batch.limit(0), batch, refdata.KEYS["prices_db"], refdata.REQUIRED["prices_db"]
    )
    assert sorted(r.seq for r in new.collect()) == [1, 3, 4]


def test_first_and_last_per_key(spark):
    table = customers(spark, ("A", "one"), ("A", None), ("B", None), ("B", "two"))
    first = lookups.first_per_key(table, ["customer_name"])
    last = lookups.last_per_key(table, ["customer_name"])
    assert rows(first, "customer_name", "netsuite_id") == [("A", "one"), ("B", None)]
    assert rows(last, "customer_name", "netsuite_id") == [("A", None), ("B", "two")]


def test_rule_ids(spark):
    batch = seed_frames(spark)["price_level_rules"]
    none = refdata.assign_rule_ids(spark.createDataFrame([], schemas.RULES), batch)
    assert [r.rule_id for r in none.orderBy("rule_id").collect()] == [1, 2, 3, 4, 5]
    some = refdata.assign_rule_ids(none, batch)
    assert sorted(r.rule_id for r in some.collect()) == [6, 7, 8, 9, 10]


def test_build_and_use_a_store(spark, tmp_path):
    location = str(tmp_path / "store")
    for _ in range(2):  # building anew replaces what was there
        refdata.build_reference_store(spark, location, seed_frames(spark))
    counts = {n: reference.read_table(spark, location, n).count() for n in reference.TABLES}
    assert counts == {
        "customers_db": 6, "items_db": 5, "price_levels_db": 5, "price_level_rules": 5, "prices_db": 6,
    }
    lines = billing(spark, ("Johnson-Clark", "1001", "CA", "County X", "A", 2.0))
    stored = billing_sheet(lines, reference.read_reference(spark, location))
    assert rows(stored, *schemas.SHEET_COLUMNS) == rows(
        billing_sheet(lines, tables(spark)), *schemas.SHEET_COLUMNS
    )
    reference.register_tables(spark, location, "billing_ref")
    assert spark.table("billing_ref.prices_db").count() == len(PRICES)
    named = billing_sheet(lines, reference.read_reference_catalog(spark, "billing_ref"))
    assert named.first().price == 110.0


def test_loading_rules(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    batch = numbered(
        spark, [("Barnes LLC", "ANY", "ANY", "BL"), ("Barnes LLC", None, "ANY", "x")], schemas.RULES
    ).withColumnRenamed("rule_id", "seq")
    refdata.load_rules(spark, location, batch)
    stored = reference.read_table(spark, location, "price_level_rules")
    assert stored.count() == len(RULES) + 1
    assert stored.filter("price_level_name = 'BL'").first().rule_id == 6
    unknown = numbered(spark, [("Who?", "ANY", "ANY", "x")], schemas.RULES).withColumnRenamed(
        "rule_id", "seq"
    )
    with pytest.raises(refdata.UnknownReference, match="Who"):
        refdata.load_rules(spark, location, unknown)
    refdata.load_rules(spark, location, unknown, skip_unknown=True)
    assert reference.read_table(spark, location, "price_level_rules").count() == len(RULES) + 1


def test_store_with_an_unknown_item(spark, tmp_path):
    seeds = seed_frames(spark)
    seeds["items_db"] = seeds["items_db"].filter("item_code <> '1002'")
    with pytest.raises(refdata.UnknownReference, match="item_code"):
        refdata.build_reference_store(spark, str(tmp_path / "store"), seeds)


def test_key_checks(spark):
    table = customers(spark, ("A", "1"), ("A", "2"), ("B", "3"), (None, "4"))
    assert rows(checks.key_violations(table, "customer_name"), "key", "n_rows", "problem") == [
        ("A", 2, "duplicate key"), (None, 1, "null key"),
    ]
    prices = numbered(
        spark, [("A", "1", "L", 1.0), ("A", "1", "L", 2.0), ("A", None, "L", 1.0), ("A", None, "L", 1.0)],
        schemas.PRICES,
    )
    found = checks.composite_key_violations(prices, refdata.KEYS["prices_db"])
    assert rows(found, "customer_name", "item_code", "n_rows") == [("A", "1", 2)]


def test_null_and_orphan_checks(spark):
    table = customers(spark, ("A", None), ("B", None), ("C", "1"))
    found = checks.null_violations(table, "customers_db", ["netsuite_id", "customer_name"])
    assert rows(found, "table_name", "column_name", "n_null") == [
        ("customers_db", "customer_name", 0), ("customers_db", "netsuite_id", 2),
    ]
    child = customers(spark, ("A", "1"), ("Z", "1"), ("Z", "2"), (None, "3"))
    found = checks.orphans(child, "child", "customer_name", table, "customer_name")
    assert rows(found, "table_name", "column_name", "value", "n_rows") == [
        ("child", "customer_name", "Z", 2)
    ]


def test_price_key_duplicates(spark):
    prices = numbered(
        spark,
        [("A Co.", "1", "L", 1.0), ("a co", "01.0", " L", 2.0), ("A Co.", "2", "L", 1.0)],
        schemas.PRICES,
    )
    found = checks.price_key_duplicates(prices)
    assert rows(found, "customer_key", "item_key", "level_key", "n_rows") == [("aco", "1", "L", 2)]


def test_lookup_of_a_missing_key(spark):
    lines = spark.createDataFrame([("A",), (None,)], "customer string")
    table = customers(spark, ("A", "1"), (None, "2"))
    found = lookups.lookup_last(lines, "customer", table, "customer_name", "netsuite_id", "id")
    assert rows(found, "customer", "id") == [("A", "1"), (None, None)]


def test_default_customer_is_the_last_one(spark):
    table = customers(spark, ("DEFAULT", "1"), ("DEFAULT", "2"))
    found = spark.range(1).select(lookups.default_customer_id(table).alias("id"))
    assert found.first().id == "2"
    none = spark.range(1).select(lookups.default_customer_id(table, "X").alias("id"))
    assert none.first().id is None


def test_failed_build_leaves_the_old_store(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    before = {n: sorted(map(str, read_table(spark, location, n).collect())) for n in refdata.REQUIRED}
    seeds = seed_frames(spark)
    seeds["items_db"] = seeds["items_db"].where("false")
    with pytest.raises(refdata.UnknownReference):
        refdata.build_reference_store(spark, location, seeds)
    after = {n: sorted(map(str, read_table(spark, location, n).collect())) for n in refdata.REQUIRED}
    assert before == after


def test_rows_without_order_fail(spark):
    from ratemill.operators import lookups

    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, None)], "k string, v int, seq long")
    for pick in (lookups.first_per_key, lookups.last_per_key):
        with pytest.raises(Exception, match="a row has no seq"):
            pick(rows, ["k"]).collect()
    with pytest.raises(Exception, match="a row has no seq"):
        refdata.new_rows(rows.where("false"), rows, ["k"], ["v"]).collect()


# --- commits of the store ---------------------------------------------------


def contents(spark, location):
    return {n: sorted(map(str, read_table(spark, location, n).collect())) for n in reference.TABLES}


@pytest.mark.parametrize("dies_at", [1, 3, 5])
def test_a_build_that_dies_leaves_the_old_store(spark, tmp_path, monkeypatch, dies_at):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    before = contents(spark, location)
    held = read_table(spark, location, "prices_db")
    write, calls = reference.write_table, []

    def dying(rows, folder, name):
        calls.append(name)
        path = write(rows, folder, name)
        if len(calls) == dies_at:
            raise KeyboardInterrupt("killed")
        return path

    monkeypatch.setattr(reference, "write_table", dying)
    with pytest.raises(KeyboardInterrupt):
        refdata.build_reference_store(spark, location, seed_frames(spark))
    monkeypatch.undo()
    assert contents(spark, location) == before
    # What the dead job has written is no part of any commit.
    assert len(reference.remove_unused(spark, location)) == 1
    assert contents(spark, location) == before and held.count() == len(PRICES)


def test_a_commit_that_dies_halfway_is_not_read(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    before = contents(spark, location)
    commits = tmp_path / "store" / "commits"
    (commits / f"{2:020d}.json.abc").write_text('{"number": 2, "tab')
    assert contents(spark, location) == before
    refdata.build_reference_store(spark, location, seed_frames(spark))
    assert reference.current(spark, location).number == 2


def test_of_two_changes_at_a_time_one_fails(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    seen = reference.current(spark, location)
    more = read_table(spark, location, "customers_db").limit(1)
    reference.append_rows(more, location, "customers_db")
    after = contents(spark, location)
    with pytest.raises(reference.ConcurrentChange):
        reference.publish(spark, location, seen)
    assert contents(spark, location) == after
    assert reference.current(spark, location).number == 2


def test_rows_read_before_a_change_stay_readable(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    held = read_table(spark, location, "customers_db")
    n = held.count()
    reference.replace_rows(held.limit(1), location, "customers_db")
    assert held.count() == n and read_table(spark, location, "customers_db").count() == 1
    reference.remove_unused(spark, location)
    assert read_table(spark, location, "customers_db").count() == 1
    assert reference.remove_unused(spark, location) == []


def test_rule_ids_do_not_come_back(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    rules = read_table(spark, location, "price_level_rules")
    last = max(r.rule_id for r in rules.collect())
    reference.replace_rows(rules.where("rule_id = 1"), location, "price_level_rules")
    batch = numbered(spark, [("DEFAULT", "ANY", "ANY", "New")], schemas.RULES)
    batch = batch.withColumnRenamed("rule_id", "seq") if "rule_id" in batch.columns else batch
    refdata.load_rules(spark, location, batch)
    ids = sorted(r.rule_id for r in read_table(spark, location, "price_level_rules").collect())
    assert ids == [1, last + 1]


def test_a_repeated_load_numbers_once(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark))
    batch = seed_frames(spark)["price_level_rules"]
    assert refdata.load_rules(spark, location, batch, load_id="monday")
    once = contents(spark, location)
    assert not refdata.load_rules(spark, location, batch, load_id="monday")
    assert contents(spark, location) == once
    assert refdata.load_rules(spark, location, batch, load_id="tuesday")
    assert read_table(spark, location, "price_level_rules").count() == 3 * len(RULES)
    assert reference.current(spark, location).loads == ("monday", "tuesday")


# --- all checks in one pass -------------------------------------------------


def _broken(spark):
    """Tables that break every constraint."""
    seeds = seed_frames(spark)
    tables_ = {
        name: seeds[name].drop(*({"seq", "rule_id"} - set(schema.names))) for name, schema in reference.TABLES.items()
    }
    tables_["price_level_rules"] = seeds["price_level_rules"].withColumnRenamed("seq", "rule_id").select(
        *reference.TABLES["price_level_rules"].names
    )
    more = spark.createDataFrame(
        [(90, "Nobody", "1001", "Base Price", 1.0), (91, "Nobody", "1001", "Base Price", None),
         (92, " nobody. ", "1001.0", "Base Price", 2.0), (93, None, "9999", "No Level", 3.0)],
        schemas.PRICES,
    )
    tables_["prices_db"] = tables_["prices_db"].unionByName(more)
    again = tables_["customers_db"].limit(1).withColumn("netsuite_id", F.lit(None).cast("string"))
    tables_["customers_db"] = tables_["customers_db"].unionByName(again)
    unknown = tables_["price_level_rules"].limit(1).withColumn("customer_name", F.lit("Who"))
    tables_["price_level_rules"] = tables_["price_level_rules"].unionByName(unknown)
    return tables_


def test_all_checks_agree_with_the_single_ones(spark):
    tables_ = _broken(spark)
    found = dict(refdata.check_reference(tables_))
    for name, keys in refdata.KEYS.items():
        single = checks.composite_key_violations(tables_[name], keys)
        assert rows(found[f"{name}: repeated key"], *single.columns) == rows(single, *single.columns)
    for name, columns in refdata.REQUIRED.items():
        single = checks.null_violations(tables_[name], name, columns).where("n_null > 0")
        assert rows(found[f"{name}: missing value"], *single.columns) == rows(single, *single.columns)
    order = ("customers_db", "items_db", "price_levels_db", "price_level_rules", "prices_db")
    single = checks.reference_orphans(*(tables_[n] for n in order))
    assert rows(found["unknown reference"], *single.columns) == rows(single, *single.columns)
    single = checks.price_key_duplicates(tables_["prices_db"])
    assert rows(found["prices_db: equal after normalising"], *single.columns) == rows(single, *single.columns)
    assert all(df.count() for title, df in found.items() if "customers" in title or "prices" in title or "unknown" in title)


def test_all_checks_read_each_table_once(spark, tmp_path):
    """The violations come from the written counts; no plan of theirs reads a table."""
    tables_ = {}
    for name, df in _broken(spark).items():
        df.write.parquet(str(tmp_path / name))
        tables_[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    found = refdata.check_reference(tables_)
    for _, violations in found:
        plan = violations._jdf.queryExecution().toString()
        assert str(tmp_path) not in plan
        violations.collect()


# --- bucketed tables --------------------------------------------------------


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_bucketed_tables_stay_where_they_are(spark, tmp_path):
    location = str(tmp_path / "store")
    refdata.build_reference_store(spark, location, seed_frames(spark), buckets=8)
    plain = str(tmp_path / "plain")
    refdata.build_reference_store(spark, plain, seed_frames(spark))
    stored, other = (reference.read_reference(spark, at) for at in (location, plain))
    lines = billing(spark, ("Johnson-Clark", "1001", "NY", "X", "A", 2.0), ("Nobody", "7", "CA", "Y", "B", 1.0))
    sheet = billing_sheet(lines, stored)
    assert rows(sheet, *sheet.columns) == rows(billing_sheet(lines, other), *sheet.columns)
    keyed = lookups.add_match_keys(
        lines.selectExpr("customer", "item", "type AS price_level", "state")
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "1000"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        batch = seed_frames(spark)["customers_db"].unionByName(
            customers(spark, ("New, Inc.", "n1"), (None, "n2"))
        )
        args = (batch, refdata.KEYS["customers_db"], refdata.REQUIRED["customers_db"])
        for at, moved in ((stored, 0), (other, 1)):
            # The sheet's side moves, and the table's only where it is not bucketed.
            assert _exchanges(lookups.join_customer(keyed, at.customers)) == 1 + moved
            assert _exchanges(lookups.join_item(keyed, at.items)) == 1 + moved
            assert _exchanges(lookups.join_price(keyed, at.prices)) == 1 + moved
            # The batch moves to be grouped, and to meet the table.
            assert _exchanges(refdata.new_rows(at.customers, *args)) == 2 + moved
        new, want = (refdata.new_rows(at.customers, *args) for at in (stored, other))
        assert "Bucketed: true" in new._jdf.queryExecution().executedPlan().toString()
        assert rows(new, "customer_name") == rows(want, "customer_name")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
