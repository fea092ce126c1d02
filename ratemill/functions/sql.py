"""The scalar functions for SQL users.

They are SQL functions, not Python ones: Spark inlines their bodies into the
plan, so a query that calls them costs what the written-out expression costs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .keys import WHITESPACE

_WS_SQL = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)

_SQL_FUNCTIONS = {
    "match_key(name STRING) RETURNS STRING": (
        f"coalesce(translate(trim(BOTH '{_WS_SQL}' FROM lower(name)), ',. ', ''), '')"
    ),
    "item_key(item STRING) RETURNS STRING": (
        "coalesce(nullif(trim(LEADING '0' FROM "
        "regexp_replace(substring_index(item, '.', 1), '[^0-9]', '')), ''), '0')"
    ),
    "item_key_text(item STRING) RETURNS STRING": (
        f"replace(trim(BOTH '{_WS_SQL}' FROM item), '.0', '')"
    ),
    "level_key(level STRING) RETURNS STRING": f"trim(BOTH '{_WS_SQL}' FROM level)",
    "external_id(name STRING, period_end DATE) RETURNS STRING": (
        "concat(date_format(period_end, 'MMyy'), '-', substring(upper(regexp_replace("
        "replace(name, ',', ''), "
        r"r'(?U)[\s\x1c-\x1f]*([^\s\x1c-\x1f])[^\s\x1c-\x1f]*|[\s\x1c-\x1f]+', '$1')), 1, 3))"
    ),
    "fill_level_template(level STRING, customer STRING) RETURNS STRING": (
        "replace(level, '{Customer}', customer)"
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the scalar functions as temporary SQL functions; returns their names."""
    for signature, body in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.partition("(")[0] for signature in _SQL_FUNCTIONS]
