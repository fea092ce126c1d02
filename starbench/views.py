"""Billing lines and reference tables as views over the star schema.

One SQL text per view, read by Spark and by DuckDB alike: the views are the
input of the queries, not what is tested. The billing view reads whole tables;
its CASEs put odd spellings, missing values and wildcard texts into some lines,
chosen by column values, and drop none. The reference tables drop none either: their gaps,
which fallbacks, lookups and orphan checks are about, are keys under `NO-` that match nothing. Item
numbers are compared by their digits alone, so theirs is one that no part has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratemill.session import free_shuffles, share_shuffles, size_partitions

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# State whose lines are flagged, in place of CA.
FLAGGED_STATE = "NATION_3"

_NAME = "c_name || ', ' || c_mktsegment || ' Co.'"

VIEWS = {
    # Customer names of several words, so that keys and initials have work to do.
    "client": f"""
        SELECT c_custkey, {_NAME} AS name, c_mktsegment AS segment, c_acctbal, r_name
        FROM {{customer}}
        JOIN {{nation}} ON c_nationkey = n_nationkey
        JOIN {{region}} ON n_regionkey = r_regionkey
    """,
    # Odd customers and items are among the lines with the highest tax, odd
    # counties, types, units and states among the untaxed ones.
    "line": f"""
        SELECT {_NAME} AS name, CAST(l_partkey AS STRING) AS part, o_orderpriority, n_name,
               r_name, l_returnflag, l_quantity, l_discount, l_tax, l_shipdate
        FROM {{lineitem}}
        JOIN {{orders}} ON l_orderkey = o_orderkey
        JOIN {{customer}} ON o_custkey = c_custkey
        JOIN {{supplier}} ON l_suppkey = s_suppkey
        JOIN {{nation}} ON s_nationkey = n_nationkey
        JOIN {{region}} ON n_regionkey = r_regionkey
    """,
    "billing": """
        SELECT CASE WHEN l_tax < 0.08 THEN name
                    WHEN l_discount = 0.0 THEN NULL
                    WHEN l_discount = 0.01 THEN ' ' || upper(name) || '.'
                    WHEN l_discount = 0.02 THEN 'Default'
                    WHEN l_discount = 0.03 THEN 'DEFAULT'
                    ELSE name END AS customer,
               CASE WHEN l_tax < 0.08 THEN part
                    WHEN l_discount = 0.04 THEN NULL
                    WHEN l_discount = 0.05 THEN part || '.0'
                    WHEN l_discount = 0.06 THEN 'setup fee'
                    ELSE part END AS item,
               o_orderpriority AS location,
               CASE WHEN l_tax = 0.0 AND l_discount = 0.07 THEN NULL ELSE n_name END AS state,
               CASE WHEN l_tax > 0.0 THEN r_name
                    WHEN l_discount = 0.0 THEN NULL
                    WHEN l_discount = 0.01 THEN 'ANY'
                    WHEN l_discount = 0.02 THEN ' ' || r_name || ' '
                    ELSE r_name END AS county,
               CASE WHEN l_tax > 0.0 THEN l_returnflag
                    WHEN l_discount = 0.03 THEN NULL
                    WHEN l_discount = 0.04 THEN 'ANY'
                    WHEN l_discount = 0.05 THEN ' ' || l_returnflag
                    ELSE l_returnflag END AS type,
               CASE WHEN l_tax = 0.0 AND l_discount = 0.06 THEN NULL
                    ELSE l_quantity END AS units,
               CAST(l_shipdate AS DATE) AS billing_date
        FROM {line}
    """,
    # All eight shapes of a rule, ties between shapes, and late copies that never win.
    "rules": """
        SELECT c_custkey * 10 + 1000 + kind AS rule_id,
               CASE kind WHEN 1 THEN lower(name) WHEN 2 THEN upper(name)
                         ELSE name END AS customer_name,
               CASE WHEN kind IN (2, 3) THEN r_name WHEN kind = 4 THEN ' ' || r_name
                    ELSE 'ANY' END AS county,
               CASE kind WHEN 2 THEN 'A' WHEN 3 THEN 'N' WHEN 5 THEN 'R'
                         ELSE 'ANY' END AS type,
               CASE kind WHEN 0 THEN 'FLAT-' || CAST(c_custkey AS STRING)
                         WHEN 1 THEN 'LATE'
                         WHEN 2 THEN 'TYPEA'
                         WHEN 3 THEN 'TYPEN '
                         WHEN 4 THEN 'COUNTY-' || r_name
                         WHEN 5 THEN 'RETURN'
                         ELSE '{{Customer}} / {{Customer}} list' END AS price_level_name
        FROM {client}
        JOIN (VALUES ('BUILDING', 0), ('BUILDING', 1), ('MACHINERY', 2), ('MACHINERY', 3),
                     ('FURNITURE', 4), ('FURNITURE', 5), ('AUTOMOBILE', 4), ('AUTOMOBILE', 5),
                     ('HOUSEHOLD', 6)) AS kinds(of_segment, kind) ON segment = of_segment
        UNION ALL
        SELECT CAST(r_regionkey AS BIGINT) + 1, 'DEFAULT', r_name, 'A', r_name || '-A'
        FROM {region}
        UNION ALL
        SELECT CAST(r_regionkey AS BIGINT) + 11, 'Default.',
               CASE WHEN r_name = 'ASIA' THEN 'NO-' || r_name ELSE r_name END, 'ANY', r_name
        FROM {region}
        UNION ALL
        SELECT DISTINCT 1000000000000 + ascii(l_returnflag), 'DEFAULT', 'ANY',
               CASE WHEN l_returnflag = 'N' THEN 'NO-' || l_returnflag ELSE l_returnflag END,
               'ALL-' || l_returnflag
        FROM {lineitem}
        UNION ALL
        SELECT 2000000000000, 'DEFAULT', 'ANY', 'ANY', 'Base Price'
    """,
    # Some clients stand under a key that matches nothing; some twice, under another spelling.
    "customers_db": """
        SELECT c_custkey * 2 AS seq,
               CASE WHEN c_acctbal >= 0 THEN name ELSE 'NO-' || name END AS customer_name,
               'CUST-' || CAST(c_custkey AS STRING) AS netsuite_id
        FROM {client}
        UNION ALL
        SELECT c_custkey * 2 + 1, upper(name), 'DUP-' || CAST(c_custkey AS STRING)
        FROM {client} WHERE segment = 'HOUSEHOLD'
        UNION ALL
        SELECT CAST(-1 AS BIGINT), 'DEFAULT', 'NS-CUST-0000'
    """,
    "items_db": """
        SELECT p_partkey * 2 AS seq,
               CASE p_type WHEN 'ECONOMY' THEN '0' || CAST(p_partkey AS STRING) || '.0'
                           WHEN 'LARGE' THEN 'IT-' || CAST(p_partkey AS STRING)
                           WHEN 'PROMO' THEN 'NO-' || CAST(p_partkey + 1000000000000 AS STRING)
                           ELSE CAST(p_partkey AS STRING) END AS item_code,
               'ITEM-' || CAST(p_partkey AS STRING) AS netsuite_internal_id,
               p_size AS line_order
        FROM {part}
        UNION ALL
        SELECT p_partkey * 2 + 1, CAST(p_partkey AS STRING) || '.0',
               'DUP-' || CAST(p_partkey AS STRING), p_size + 100
        FROM {part} WHERE p_type = 'SMALL'
    """,
    "price_levels_db": """
        SELECT c_custkey AS seq,
               CASE WHEN segment = 'BUILDING' THEN 'FLAT-' ELSE 'NO-FLAT-' END
                 || CAST(c_custkey AS STRING) AS price_level_name,
               'PL-' || CAST(c_custkey AS STRING) AS netsuite_internal_id_pl
        FROM {client}
        UNION ALL
        SELECT CAST(-1 AS BIGINT), 'Base Price', 'PL-BASE'
    """,
    # Prices of what clients bought, at a level that matches nothing unless they have a flat
    # rate and the part is small enough; medium parts are priced twice, under codes and
    # levels that are equal only after normalising.
    "prices_db": """
        SELECT c_custkey * 10000000 + l_partkey * 2 AS seq, name AS customer_name,
               CAST(l_partkey AS STRING) AS item_code,
               level AS price_level_name, price
        FROM {sold}
        UNION ALL
        SELECT c_custkey * 10000000 + l_partkey * 2 + 1, name,
               '0' || CAST(l_partkey AS STRING),
               ' ' || level || ' ', price + 1
        FROM {sold} WHERE p_type = 'MEDIUM'
        UNION ALL
        SELECT CAST(-1 AS BIGINT) - p_partkey, 'DEFAULT', CAST(p_partkey AS STRING),
               'Base Price', round(p_retailprice / 10, 2)
        FROM {part}
    """,
    "sold": f"""
        SELECT DISTINCT c_custkey, {_NAME} AS name, l_partkey, p_type,
               round(p_retailprice, 2) AS price,
               CASE WHEN c_mktsegment = 'BUILDING' AND p_size <= 40 THEN 'FLAT-'
                    ELSE 'NO-FLAT-' END || CAST(c_custkey AS STRING) AS level
        FROM {{lineitem}}
        JOIN {{orders}} ON l_orderkey = o_orderkey
        JOIN {{customer}} ON o_custkey = c_custkey
        JOIN {{part}} ON l_partkey = p_partkey
    """,
    # A load with repeated keys, missing ids and missing keys: every order brings
    # its customer along.
    "incoming_customers": f"""
        SELECT o_orderkey AS seq,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
                    ELSE {_NAME} END AS customer_name,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                    ELSE 'NEW-' || CAST(o_orderkey AS STRING) END AS netsuite_id
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
    """,
    "incoming_rules": f"""
        SELECT o_orderkey + 1 AS seq, {_NAME} AS customer_name,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS county,
               o_orderstatus AS type, 'ORDER-' || o_orderpriority AS price_level_name
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
    """,
}

# The same rows as the views of these names, for Spark, which joins in the order of the text: orders find
# their customer before lines find their order, so lines are shuffled once however many customers there are.
# It does not always find out by itself that two branches of a union read the same.
PLANNED = {
    "line": f"""
        SELECT name, CAST(l_partkey AS STRING) AS part, o_orderpriority, n_name,
               r_name, l_returnflag, l_quantity, l_discount, l_tax, l_shipdate
        FROM {{lineitem}}
        JOIN (SELECT o_orderkey, o_orderpriority, {_NAME} AS name
              FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
        JOIN {{supplier}} ON l_suppkey = s_suppkey
        JOIN {{nation}} ON s_nationkey = n_nationkey
        JOIN {{region}} ON n_regionkey = r_regionkey
    """,
    "sold": f"""
        SELECT DISTINCT c_custkey, name, l_partkey, p_type,
               round(p_retailprice, 2) AS price,
               CASE WHEN c_mktsegment = 'BUILDING' AND p_size <= 40 THEN 'FLAT-'
                    ELSE 'NO-FLAT-' END || CAST(c_custkey AS STRING) AS level
        FROM {{lineitem}}
        JOIN (SELECT o_orderkey, c_custkey, c_mktsegment, {_NAME} AS name
              FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
        JOIN {{part}} ON l_partkey = p_partkey
    """,
    # What was sold is read once for both its prices.
    "prices_db": """
        SELECT c_custkey * 10000000 + l_partkey * 2 + again AS seq, name AS customer_name,
               CASE again WHEN 0 THEN '' ELSE '0' END || CAST(l_partkey AS STRING) AS item_code,
               CASE again WHEN 0 THEN level ELSE ' ' || level || ' ' END AS price_level_name,
               price + again AS price
        FROM {sold}
        LATERAL VIEW explode(CASE WHEN p_type = 'MEDIUM' THEN array(0, 1) ELSE array(0) END) AS again
        UNION ALL
        SELECT CAST(-1 AS BIGINT) - p_partkey, 'DEFAULT', CAST(p_partkey AS STRING),
               'Base Price', round(p_retailprice / 10, 2)
        FROM {part}
    """,
}


def _used(name: str) -> list[str]:
    return [n for n in [*STAR_TABLES, *VIEWS] if "{" + n + "}" in VIEWS[name]]


class Star:
    """The views as DataFrames; ``Star(spark, dir).billing`` and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        size_partitions(spark, [f"{self._sf_dir}/{name}.parquet" for name in STAR_TABLES])
        share_shuffles(spark)
        free_shuffles(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS and name not in STAR_TABLES:
            raise AttributeError(name)
        if name in STAR_TABLES and name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        elif name not in self._frames:
            needed = {n: getattr(self, n) for n in _used(name)}
            self._frames[name] = self.spark.sql(PLANNED.get(name, VIEWS[name]), **needed)
        return self._frames[name]


def with_clause(*names: str) -> list[str]:
    """``name AS (SELECT …)`` for the named views and all they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in STAR_TABLES or name in ordered:
            return
        for n in _used(name):
            visit(n)
        ordered.append(name)

    for name in names:
        visit(name)
    plain = {n: n for n in [*STAR_TABLES, *VIEWS]}
    return [f"{n} AS ({VIEWS[n].format(**plain)})" for n in ordered]
