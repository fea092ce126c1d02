"""One query per operator and pipeline, over the views of the star schema.

Every query runs over whole tables. Where an operator works line by line and
its lines are not the point, the result is summed up per distinct value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill import schemas
from ratemill.functions import keys, register_functions
from ratemill.operators import checks, lookups, refdata, rollup, synth
from ratemill.operators.rating import NORMALISED, Rater, assign_price_level
from ratemill.plans import sheet as plans
from ratemill.session import shared_dir
from ratemill.sources import csvfiles, reference

from .views import FLAGGED_STATE, Star

OPTIONS = plans.SheetOptions(flagged_state=FLAGGED_STATE)
PERIOD_END = date(2026, 5, 31)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[Star], DataFrame]):
    """Register a function over the views under its own name."""
    _QUERIES[run.__name__] = lambda spark, sf_dir: run(Star(spark, sf_dir))
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _tables(star: Star) -> plans.ReferenceTables:
    return plans.ReferenceTables(star.rules, star.customers_db, star.items_db, star.prices_db)


def _distinct(*columns: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, columns).distinct()


# --- scalar functions -------------------------------------------------------


@query
def fn_match_key(star: Star) -> DataFrame:
    names = _distinct(
        star.billing.select(F.col("customer").alias("name")),
        star.rules.select("customer_name"),
        star.customers_db.select("customer_name"),
    )
    return names.select("name", keys.match_key(F.col("name")).alias("match_key"))


def _items(star: Star) -> DataFrame:
    return _distinct(
        star.billing.select("item"),
        star.items_db.select("item_code"),
        star.prices_db.select("item_code"),
    )


@query
def fn_item_key(star: Star) -> DataFrame:
    return _items(star).select("item", keys.item_key(F.col("item")).alias("item_key"))


@query
def fn_item_key_text(star: Star) -> DataFrame:
    return _items(star).select("item", keys.item_key_text(F.col("item")).alias("item_key"))


@query
def fn_level_key(star: Star) -> DataFrame:
    levels = _distinct(
        star.rules.select(F.col("price_level_name").alias("level")),
        star.prices_db.select("price_level_name"),
    )
    return levels.select("level", keys.level_key(F.col("level")).alias("level_key"))


@query
def fn_external_id(star: Star) -> DataFrame:
    names = _distinct(
        star.billing.select(F.col("customer").alias("name")), star.part.select("p_name")
    )
    return names.select(
        "name", keys.external_id(F.col("name"), F.lit(PERIOD_END)).alias("external_id")
    )


@query
def fn_level_template(star: Star) -> DataFrame:
    return star.rules.select(
        "rule_id",
        keys.fill_level_template(F.col("price_level_name"), F.col("customer_name")).alias("level"),
    )


@query
def fn_sql_registered(star: Star) -> DataFrame:
    """The SQL forms of the functions, over all lines."""
    register_functions(star.spark)
    return star.spark.sql(
        """
        SELECT customer, item, match_key(customer) AS match_key, item_key(item) AS item_key,
               item_key_text(item) AS item_key_text, level_key(county) AS level_key,
               external_id(customer, DATE'2026-05-31') AS external_id,
               fill_level_template('{{Customer}}: ' || type, customer) AS level,
               count(*) AS n_lines
        FROM {billing} GROUP BY customer, item, county, type
        """,
        billing=star.billing,
    )


# --- row operators ----------------------------------------------------------


@query
def state_flag(star: Star) -> DataFrame:
    flagged = star.billing.withColumn("ca_line", keys.state_flag(F.col("state"), FLAGGED_STATE))
    return flagged.groupBy("state", "ca_line").agg(F.count("*").alias("n_lines"))


@query
def invoice_terms(star: Star) -> DataFrame:
    days = star.billing.select("billing_date").distinct()
    return days.withColumns(plans.invoice_terms(F.col("billing_date"), 15))


@query
def drop_null_keys(star: Star) -> DataFrame:
    kept = rollup.drop_null_keys(star.billing)
    return kept.groupBy("customer").agg(
        F.count("*").alias("n_lines"), F.sum("units").alias("units")
    )


@query
def rule_scores(star: Star) -> DataFrame:
    return Rater(star.rules, NORMALISED).candidates(star.billing)


def _rollup(star: Star) -> DataFrame:
    return plans.rated_quantities(
        star.billing, star.rules, OPTIONS, NORMALISED, OPTIONS.default_level
    )


def _looked_up(star: Star) -> DataFrame:
    sheet = lookups.add_match_keys(_rollup(star))
    sheet = lookups.join_customer(sheet, star.customers_db)
    sheet = lookups.join_item(sheet, star.items_db)
    return lookups.join_price(sheet, star.prices_db)


@query
def fallback_fill(star: Star) -> DataFrame:
    found = plans.looked_up(star.billing, _tables(star), OPTIONS)
    filled = lookups.fill_missing(found, 1, "NS-CUST-0000", 100.0)
    return filled.select(
        *rollup.ROLLUP_KEYS, "line_order", "customer_id", "item_id", "price"
    )


@query
def line_value(star: Star) -> DataFrame:
    filled = lookups.fill_missing(_looked_up(star), 1, "NS-CUST-0000", 100.0)
    value = lookups.line_value(F.col("qty"), F.col("price"))
    return filled.select(*rollup.ROLLUP_KEYS, "qty", "price", value.alias("total_value"))


@query
def customer_default_lookup(star: Star) -> DataFrame:
    names = star.billing.select("customer").distinct()
    found = lookups.lookup_last(
        names, "customer", star.customers_db, "customer_name", "netsuite_id", "customer_id"
    )
    default = lookups.default_customer_id(star.customers_db)
    return found.withColumn("customer_id", F.coalesce("customer_id", default))


# --- rating and lookups -----------------------------------------------------


@query
def rate_lines(star: Star) -> DataFrame:
    return assign_price_level(star.billing, star.rules)


@query
def rate_lines_probe(star: Star) -> DataFrame:
    return assign_price_level(star.billing, star.rules, strategy="shuffle")


@query
def join_customer(star: Star) -> DataFrame:
    joined = lookups.join_customer(lookups.add_match_keys(_rollup(star)), star.customers_db)
    return joined.select(*rollup.ROLLUP_KEYS, "qty", "customer_id")


@query
def join_item(star: Star) -> DataFrame:
    joined = lookups.join_item(lookups.add_match_keys(_rollup(star)), star.items_db)
    return joined.select(*rollup.ROLLUP_KEYS, "qty", "item_id", "line_order")


@query
def join_price(star: Star) -> DataFrame:
    joined = lookups.join_price(lookups.add_match_keys(_rollup(star)), star.prices_db)
    return joined.select(*rollup.ROLLUP_KEYS, "qty", "price")


@query
def join_price_strict(star: Star) -> DataFrame:
    joined = lookups.join_price_strict(_rollup(star), star.prices_db)
    return joined.select(*rollup.ROLLUP_KEYS, "qty", "price")


@query
def join_fanout(star: Star) -> DataFrame:
    sheet = lookups.add_match_keys(_rollup(star), text_keys=True)
    sheet = lookups.join_item(sheet, star.items_db, dedupe=False, text_keys=True)
    sheet = lookups.join_customer(sheet, star.customers_db, dedupe=False)
    return sheet.select(*rollup.ROLLUP_KEYS, "qty", "customer_id", "item_id", "line_order")


@query
def lookup_keep_last(star: Star) -> DataFrame:
    names = star.billing.select("customer").distinct()
    return lookups.lookup_last(
        names, "customer", star.incoming_customers, "customer_name", "netsuite_id", "customer_id"
    )


# --- aggregates and order ---------------------------------------------------


@query
def quantity_rollup(star: Star) -> DataFrame:
    return _rollup(star)


@query
def dedupe_first(star: Star) -> DataFrame:
    keyed = star.incoming_customers.select(
        "seq",
        "netsuite_id",
        keys.match_key(F.col("customer_name")).alias("customer_key"),
    )
    return lookups.first_per_key(keyed, ["customer_key"])


@query
def sheet_preview(star: Star) -> DataFrame:
    return plans.preview(plans.billing_sheet(star.billing, _tables(star), OPTIONS), 10)


@query
def sheet_order(star: Star) -> DataFrame:
    """Every sheet line with its position in the order in which the sheet is written."""
    sheet = plans.billing_sheet(star.billing, _tables(star), OPTIONS, in_steps=True)
    return plans.with_sheet_positions(sheet)


# --- pipelines --------------------------------------------------------------


@query
def billing_sheet(star: Star) -> DataFrame:
    return plans.billing_sheet(star.billing, _tables(star), OPTIONS)


@query
def billing_sheet_text_keys(star: Star) -> DataFrame:
    return plans.billing_sheet_text_keys(star.billing, _tables(star), OPTIONS)


@query
def billing_sheet_strict(star: Star) -> DataFrame:
    return plans.billing_sheet_strict(star.billing, _tables(star), OPTIONS)


@query
def upload_prototype(star: Star) -> DataFrame:
    return plans.upload_prototype(star.billing, star.rules, OPTIONS)


@query
def rated_lines(star: Star) -> DataFrame:
    return plans.rated_lines(star.billing, star.rules, OPTIONS)


# --- reference data ---------------------------------------------------------


@query
def pk_violations(star: Star) -> DataFrame:
    return checks.key_violations(star.incoming_customers, "customer_name")


@query
def pk_composite_violations(star: Star) -> DataFrame:
    return checks.composite_key_violations(
        star.incoming_rules, ["customer_name", "county", "type"]
    )


@query
def price_key_duplicates(star: Star) -> DataFrame:
    return checks.price_key_duplicates(star.prices_db)


@query
def null_violations(star: Star) -> DataFrame:
    tables = {
        "customers_db": star.incoming_customers,
        "items_db": star.items_db,
        "price_levels_db": star.price_levels_db,
        "price_level_rules": star.incoming_rules,
        "prices_db": star.prices_db,
    }
    found = [checks.null_violations(t, n, refdata.REQUIRED[n]) for n, t in tables.items()]
    return reduce(DataFrame.union, found)


@query
def fk_orphans(star: Star) -> DataFrame:
    return checks.reference_orphans(
        star.customers_db, star.items_db, star.price_levels_db, star.rules, star.prices_db
    )


@query
def insert_or_ignore(star: Star) -> DataFrame:
    return refdata.insert_or_ignore(
        star.customers_db,
        star.incoming_customers,
        refdata.KEYS["customers_db"],
        refdata.REQUIRED["customers_db"],
    )


@query
def assign_rule_ids(star: Star) -> DataFrame:
    return refdata.assign_rule_ids(star.rules, star.incoming_rules)


def _rule_batch(star: Star) -> DataFrame:
    return star.rules.withColumnRenamed("rule_id", "seq")


def _seeds(star: Star) -> dict[str, DataFrame]:
    later = star.incoming_customers.withColumn("seq", F.col("seq") + 1000000000000)
    return {
        "customers_db": star.customers_db.unionByName(later),
        "items_db": star.items_db,
        "price_levels_db": star.price_levels_db,
        "price_level_rules": _rule_batch(star),
        "prices_db": star.prices_db,
    }


@query
def reference_tables(star: Star) -> DataFrame:
    """Build the store, then list all five tables in one layout."""
    location = shared_dir(star.spark)
    refdata.build_reference_store(star.spark, location, _seeds(star), skip_unknown=True)
    return _table_contents(star, location)


def _table_contents(star: Star, location: str) -> DataFrame:
    parts = []
    for name, schema in reference.TABLES.items():
        texts = [f.name for f in schema if f.dataType.typeName() == "string"]
        numbers = [c for c in ("line_order", "price") if c in schema.names]
        number = F.col(numbers[0]) if numbers else F.lit(None)
        padded = [F.col(c) for c in texts] + [F.lit(None)] * (4 - len(texts))
        parts.append(
            reference.read_table(star.spark, location, name).select(
                F.lit(name).alias("table_name"),
                F.col(schema.names[0]).alias("position"),
                *(c.cast("string").alias(f"text_{i}") for i, c in enumerate(padded, 1)),
                number.cast("double").alias("number"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def reference_tables_enforced(star: Star) -> DataFrame:
    """Build the store with all foreign keys checked, from seeds without orphans."""
    seeds = _seeds(star)
    for child, column, parent, key in (
        ("price_level_rules", "customer_name", "customers_db", "customer_name"),
        ("prices_db", "customer_name", "customers_db", "customer_name"),
        ("prices_db", "item_code", "items_db", "item_code"),
        ("prices_db", "price_level_name", "price_levels_db", "price_level_name"),
    ):
        stored = seeds[parent].dropna(subset=refdata.REQUIRED[parent])
        known = stored.select(F.col(key).alias(column)).distinct()
        seeds[child] = seeds[child].join(known, column, "left_semi")
    location = shared_dir(star.spark)
    refdata.build_reference_store(star.spark, location, seeds)
    return _table_contents(star, location)


@query
def load_rules(star: Star) -> DataFrame:
    """Append a batch of rules to a store that has some, and read the table."""
    spark, location = star.spark, shared_dir(star.spark)
    refdata.build_reference_store(spark, location, _seeds(star), skip_unknown=True)
    refdata.load_rules(spark, location, star.incoming_rules, skip_unknown=True)
    return reference.read_table(spark, location, "price_level_rules")


# --- files ------------------------------------------------------------------


@query
def scan_billing(star: Star) -> DataFrame:
    """Write the lines as CSV, read them back, count distinct lines."""
    path = shared_dir(star.spark)
    header = {inner: outer for outer, inner in schemas.BILLING_HEADER.items()}
    csvfiles.write_csv(star.billing, path, header)
    lines = csvfiles.read_billing(star.spark, path)
    return lines.groupBy(*lines.columns).agg(F.count("*").alias("n_lines"))


@query
def scan_billing_rejects(star: Star) -> DataFrame:
    """Lines as CSV, some of them broken; kept and rejected ones are counted by reason."""
    path, rejects = shared_dir(star.spark), shared_dir(star.spark)
    header = {inner: outer for outer, inner in schemas.BILLING_HEADER.items()}
    texts = {c: F.col(c).cast("string") for c in header}
    texts["units"] = F.expr("CASE WHEN item LIKE '%7' THEN 'seven' ELSE CAST(units AS STRING) END")
    texts["billing_date"] = F.expr(
        "CASE WHEN item LIKE '%8' THEN 'soon' ELSE CAST(billing_date AS STRING) END"
    )
    whole, cut = (
        F.to_csv(F.struct(*(texts[c].alias(c) for c in names)), {"escape": '"'})
        for names in (list(header), list(header)[:4])
    )
    line = F.when(F.col("item").endswith("5"), F.concat(whole, F.lit(",more")))
    line = line.when(F.col("item").endswith("6"), cut).otherwise(whole)
    # One column whose name is the header; the separator and quote occur nowhere in it.
    star.billing.select(line.alias(",".join(header.values()))).write.options(
        header=True, sep="\x01", quote="\x02", escape="\x03"
    ).csv(path)
    kept = csvfiles.read_billing(star.spark, path, rejects=rejects)
    lost = csvfiles.read_rejects(star.spark, rejects)
    both = kept.select("item", "units", F.lit(None).cast("string").alias("reject_reason"))
    both = both.unionByName(lost.select("item", F.lit(None).cast("double").alias("units"), "reject_reason"))
    return both.groupBy("item", "reject_reason").agg(
        F.count("*").alias("n_lines"), F.sum("units").alias("units")
    )


@query
def scan_rules(star: Star) -> DataFrame:
    """Write the rules in priority order as CSV; their positions come back as ids."""
    path = shared_dir(star.spark)
    header = {inner: outer for outer, inner in schemas.RULES_HEADER.items()}
    csvfiles.write_csv(star.rules.orderBy("rule_id"), path, header)
    return csvfiles.read_rules(star.spark, path)


@query
def scan_reference(star: Star) -> DataFrame:
    """The sheet from tables that were written to a store and read from there."""
    spark, location = star.spark, shared_dir(star.spark)
    reference.create_tables(spark, location)
    for name, rows in {
        "price_level_rules": star.rules,
        "customers_db": star.customers_db,
        "items_db": star.items_db,
        "prices_db": star.prices_db,
    }.items():
        reference.append_rows(rows, location, name)
    return plans.billing_sheet(star.billing, reference.read_reference(spark, location), OPTIONS)


@query
def sheet_csv_roundtrip(star: Star) -> DataFrame:
    """Write the sheet as CSV in its order and read it back."""
    path = shared_dir(star.spark)
    sheet = plans.billing_sheet(star.billing, _tables(star), OPTIONS, in_steps=True)
    csvfiles.write_csv(plans.in_sheet_order(sheet), path, schemas.SHEET_HEADER, compression="gzip")
    return csvfiles.read_sheet(star.spark, path, schemas.SHEET_HEADER)


def _numbered_clients(star: Star) -> DataFrame:
    names = star.customer.select("c_custkey", F.col("c_name").alias("client_name"))
    return synth.number_clients(names, [F.col("c_custkey")])


@query
def client_ids(star: Star) -> DataFrame:
    """The client map of all customers, in the order of their keys."""
    return synth.client_map(_numbered_clients(star))


@query
def synth_clients(star: Star) -> DataFrame:
    """One synthetic line per order line, customers drawn from the client table."""
    return synth.synthetic_billing(_line_ids(star), _numbered_clients(star), PERIOD_END)


def _line_ids(star: Star) -> DataFrame:
    return star.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))


@query
def synth_billing(star: Star) -> DataFrame:
    """One synthetic line per order line, seeded by its order and position."""
    clients = synth.made_up_clients(star.spark.range(5))
    return synth.synthetic_billing(_line_ids(star), clients, PERIOD_END)
