"""Loading reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import reference
from .checks import Constraints, check_tables, orphans, price_constraints, reference_orphans
from .lookups import required_order, stored_keys

# Keys and required columns of the tables to be matched.
KEYS = {
    "customers_db": ["customer_name"],
    "items_db": ["item_code"],
    "price_levels_db": ["price_level_name"],
    "prices_db": ["customer_name", "item_code", "price_level_name"],
}
REQUIRED = {
    "customers_db": ["netsuite_id"],
    "items_db": ["netsuite_internal_id", "line_order"],
    "price_levels_db": ["netsuite_internal_id_pl"],
    "price_level_rules": ["customer_name", "county", "type", "price_level_name"],
    "prices_db": ["price"],
}


REFERENCES = {
    "price_level_rules": {"customer_name": "customers_db"},
    "prices_db": {
        "customer_name": "customers_db",
        "item_code": "items_db",
        "price_level_name": "price_levels_db",
    },
}


class UnknownReference(ValueError):
    """A row names a customer, item or level that its table lacks."""


def new_rows(
    existing: DataFrame, batch: DataFrame, keys: list[str], required: list[str]
) -> DataFrame:
    """The rows of ``batch`` that insert-or-ignore would insert.

    Rows with a NULL in a required column are skipped, then the first row
    (lowest ``seq``) of each key counts, and keys the table has are skipped.
    A key with a NULL part equals no other key, so all its rows go in.
    """
    payload = [c for c in batch.columns if c not in keys]
    incomplete = F.greatest(F.lit(False), *(F.col(k).isNull() for k in keys))
    first = (
        batch.dropna(subset=required)
        .groupBy(*keys, F.when(incomplete, F.col("seq")).alias("_own"))
        .agg(F.min_by(F.struct(*payload), required_order("seq")).alias("_row"))
        .select(*keys, "_row.*")
    )
    # Equal names have equal normalised keys; where the table is bucketed by these, only the batch moves.
    made = {k: c for names in KEYS for k, c in stored_keys(names).items() if k in existing.columns}
    made = {k: c for k, c in made.items() if k not in batch.columns}
    on = [*made, *keys]
    return first.withColumns(made).join(existing.select(*on), on, "left_anti").select(*batch.columns)


def insert_or_ignore(existing: DataFrame, batch: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """The table after the insert."""
    return existing.unionByName(new_rows(existing, batch, keys, required))


def assign_rule_ids(existing: DataFrame, batch: DataFrame, last_given: int = 0) -> DataFrame:
    """Give each rule of ``batch`` an id above all existing ones, in ``seq`` order.

    Ids up to ``last_given`` were given before and do not come back, even if their rules are gone.
    The ids rise with ``seq`` and are as dense as it is; nothing is sorted.
    """
    last = existing.agg(F.coalesce(F.max("rule_id"), F.lit(0))).scalar()
    return batch.withColumn("rule_id", F.greatest(last, F.lit(last_given)) + F.col("seq")).drop("seq")


def accept_rules(
    existing: DataFrame,
    batch: DataFrame,
    customers: DataFrame,
    skip_unknown: bool = False,
    last_given: int = 0,
) -> DataFrame:
    """The rules of ``batch`` that may be loaded, with their ids.

    Rules with a missing field are skipped. A rule for an unknown customer
    raises, or is skipped if so asked.
    """
    complete = batch.dropna(subset=REQUIRED["price_level_rules"])
    unknown = orphans(complete, "price_level_rules", "customer_name", customers, "customer_name")
    if skip_unknown:
        known = customers.select("customer_name")
        complete = complete.join(known, "customer_name", "left_semi")
    else:
        _raise_if_any(unknown)
    return assign_rule_ids(existing, complete, last_given)


def load_rules(
    spark: SparkSession,
    location: str,
    batch: DataFrame,
    skip_unknown: bool = False,
    load_id: str | None = None,
) -> bool:
    """Check a batch of rules, number it and append it to the reference store, all or nothing.

    Ids go on above the highest that the store has ever given. A load whose ``load_id`` the store
    knows has been made before and changes nothing; the result tells whether rules were added.
    """
    before = reference.current(spark, location)
    if load_id is not None and load_id in before.loads:
        return False
    table = {
        name: reference.read_folders(spark, name, before.tables[name])
        for name in ("price_level_rules", "customers_db")
    }
    rules = accept_rules(
        table["price_level_rules"], batch, table["customers_db"], skip_unknown, before.last_rule_id
    )
    reference.append_load(rules, location, before, load_id)
    return True


def build_reference_store(
    spark: SparkSession,
    location: str,
    seeds: dict[str, DataFrame],
    skip_unknown: bool = False,
    buckets: int | None = None,
) -> None:
    """Create the reference tables anew and load the seeds, parents before children.

    ``seeds`` maps table names to rows with a ``seq``. With ``skip_unknown``
    the foreign keys are not checked, except that rules of unknown customers
    are left out. All tables are written to folders of their own and checked there; one commit then
    makes them the store. A store that is at ``location`` stays as it is until then, whatever fails.
    With ``buckets`` customers, items and prices are bucketed and sorted by normalised key, so that lookups
    in them, and later inserts, shuffle the other side only.
    """
    before, folder = reference.current(spark, location), reference.new_folder(location)
    tables, bucketed = {}, {}
    for name, keys in KEYS.items():
        nothing = spark.createDataFrame([], reference.TABLES[name])
        rows = new_rows(nothing, seeds[name], keys, REQUIRED[name])
        if buckets and stored_keys(name):
            reference.write_bucketed(rows, folder, name, buckets)
            bucketed[f"{folder}/{name}"] = buckets
        else:
            reference.write_table(rows, folder, name)
        tables[name] = reference.read_folders(spark, name, [f"{folder}/{name}"], bucketed)
    name = "price_level_rules"
    nothing = spark.createDataFrame([], reference.TABLES[name])
    rules = accept_rules(nothing, seeds[name], tables["customers_db"], skip_unknown)
    tables[name] = reference.read_folders(spark, name, [reference.write_table(rules, folder, name)])
    if not skip_unknown:
        parents = (tables[n] for n in ("customers_db", "items_db", "price_levels_db"))
        _raise_if_any(reference_orphans(*parents, tables[name], tables["prices_db"]))
    built = reference.Commit(
        before.number,
        {n: [f"{folder}/{n}"] for n in tables},
        reference.highest_rule_id(tables[name]),
        buckets=bucketed,
    )
    reference.publish(spark, location, built)


def check_reference(tables: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """All constraints of the reference tables, each table read once; see ``checks.check_tables``."""
    constraints = {}
    for name in reference.TABLES:
        parts = KEYS.get(name, []), REQUIRED[name], REFERENCES.get(name, {})
        constraints[name] = price_constraints(*parts) if name == "prices_db" else Constraints(*parts)
    return check_tables(tables, constraints)


def _raise_if_any(found: DataFrame) -> None:
    for row in found.limit(1).collect():
        raise UnknownReference(f"{row.table_name}.{row.column_name} has {row.value!r}")
