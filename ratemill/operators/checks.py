"""The reference tables' constraints as queries that list what violates them.

Spark tables do not enforce keys. Every check aggregates before it shuffles or
joins, so one key that holds much of a table is one row by then.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import item_key, level_key, match_key
from ..session import shared_dir
from .lookups import price_keys


def key_violations(table: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and the NULL key, with their row counts.

    A NULL key is allowed, any number of times, but worth knowing.
    """
    return (
        table.groupBy(F.col(key).alias("key"))
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1 OR key IS NULL")
        .withColumn("problem", F.when(F.col("key").isNull(), "null key").otherwise("duplicate key"))
    )


def composite_key_violations(table: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once; those with a NULL part are exempt."""
    return (
        table.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
    )


def null_violations(table: DataFrame, table_name: str, required: list[str]) -> DataFrame:
    """One row per required column with the number of its NULLs, in one pass."""
    counts = table.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required))
    return counts.select(
        F.lit(table_name).alias("table_name"),
        F.explode(
            F.array(
                *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in required)
            )
        ).alias("_c"),
    ).select("table_name", "_c.*")


def orphans(
    child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Values of a foreign key that its parent table lacks, with their row counts."""
    used = child.dropna(subset=[column]).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n_rows")
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return used.join(known, "value", "left_anti").select(
        F.lit(child_name).alias("table_name"),
        F.lit(column).alias("column_name"),
        "value",
        "n_rows",
    )


def reference_orphans(
    customers: DataFrame,
    items: DataFrame,
    price_levels: DataFrame,
    rules: DataFrame,
    prices: DataFrame,
) -> DataFrame:
    """All foreign keys of the reference tables. A rule may name an unknown level."""
    found = [
        orphans(rules, "price_level_rules", "customer_name", customers, "customer_name"),
        orphans(prices, "prices_db", "customer_name", customers, "customer_name"),
        orphans(prices, "prices_db", "item_code", items, "item_code"),
        orphans(prices, "prices_db", "price_level_name", price_levels, "price_level_name"),
    ]
    return reduce(DataFrame.unionByName, found)


def price_key_duplicates(prices: DataFrame) -> DataFrame:
    """Prices that become one after normalising; each extra one repeats sheet lines."""
    return composite_key_violations(
        price_keys(prices), ["customer_key", "item_key", "level_key"]
    )


# --- all checks of a table in one pass ---------------------------------------


@dataclass(frozen=True)
class Constraints:
    """Key, required columns and references (column: parent table) of a table."""

    key: list[str]
    required: list[str]
    references: dict[str, str] = field(default_factory=dict)
    #: Expressions that are to be unique after normalising, by name.
    normalised: dict[str, Column] = field(default_factory=dict)


def price_constraints(key: list[str], required: list[str], references: dict[str, str]) -> Constraints:
    """Those of the prices, which are to be unique under normalised keys too."""
    return Constraints(
        key,
        required,
        references,
        {
            "customer_key": match_key(F.col("customer_name")),
            "item_key": item_key(F.col("item_code")),
            "level_key": level_key(F.col("price_level_name")),
        },
    )


def check_tables(
    tables: dict[str, DataFrame], constraints: dict[str, Constraints]
) -> list[tuple[str, DataFrame]]:
    """Every check of every table, as (title, violations); each table is read once.

    A row gives its key, its references and its normalised key, tagged, to one aggregate,
    which is written to the shared folder; NULLs are counted on the way. Repeated keys and unknown
    references are found from the written counts alone: the keys of a parent are those counted for it.
    """
    counts: dict[str, DataFrame] = {}
    found = []
    for name, rules in constraints.items():
        counts[name], missing = _counted(name, tables[name], rules)
        if rules.key:
            found.append((f"{name}: repeated key", _repeated(counts[name], "key", rules.key)))
        found.append((f"{name}: missing value", missing))
    orphaned = [
        _unknown(name, counts[name], column, counts[parent])
        for name, rules in constraints.items()
        for column, parent in rules.references.items()
    ]
    if orphaned:
        found.append(("unknown reference", reduce(DataFrame.unionByName, orphaned)))
    for name, rules in constraints.items():
        if rules.normalised:
            again = _repeated(counts[name], "normalised", list(rules.normalised))
            found.append((f"{name}: equal after normalising", again))
    return found


def _counted(name: str, table: DataFrame, rules: Constraints) -> tuple[DataFrame, DataFrame]:
    """(tag, values, n_rows) of a table, and its required columns with NULLs."""
    spark, seen = table.sparkSession, Observation()
    watched = table.observe(
        seen, F.count("*").alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in rules.required)
    )
    tagged = [("key", [F.col(c) for c in rules.key])] if rules.key else []
    tagged += [(column, [F.col(column)]) for column in rules.references]
    tagged += [("normalised", list(rules.normalised.values()))] if rules.normalised else []
    tags = [
        F.struct(F.lit(tag).alias("tag"), F.array(*(c.cast("string") for c in columns)).alias("values"))
        for tag, columns in tagged
    ]
    path = shared_dir(spark)
    rows = watched.select(F.explode(F.array(*tags)).alias("t"))
    counted = rows.groupBy("t.tag", "t.values").agg(F.count("*").alias("n_rows"))
    counted.write.parquet(path)
    missing = [(name, c, n) for c, n in seen.get.items() if c != "n_rows" and n]
    return (
        spark.read.schema(counted.schema).parquet(path),
        spark.createDataFrame(missing, "table_name string, column_name string, n_null long"),
    )


def _repeated(counts: DataFrame, tag: str, names: list[str]) -> DataFrame:
    """Value combinations that occur more than once; those with a NULL part are exempt."""
    values = F.col("values")
    repeated = counts.where((F.col("tag") == tag) & (F.col("n_rows") > 1) & ~F.exists(values, F.isnull))
    return repeated.select(*(values[i].alias(n) for i, n in enumerate(names)), "n_rows")


def _unknown(name: str, counts: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    used = counts.where(F.col("tag") == column)
    used = used.select(F.col("values")[0].alias("value"), "n_rows").where("value IS NOT NULL")
    known = parent.where("tag = 'key'").select(F.col("values")[0].alias("value"))
    return used.join(known, "value", "left_anti").select(
        F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "value", "n_rows"
    )
