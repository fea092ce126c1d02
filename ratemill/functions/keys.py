"""Scalar functions of the billing pipeline as plain Column expressions.

Everything here is built from JVM-side functions, so it stays inside
whole-stage code generation; there is no Python UDF in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when text is stripped or split.
# Spark's default trim() removes the ASCII space only.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The same set as a Java character class: (?U)\s lacks U+001C..U+001F.
_WS = r"[\s\x1c-\x1f]"
_NON_WS = r"[^\s\x1c-\x1f]"


def strip_text(text: Column) -> Column:
    """Text without leading and trailing white space; NULL stays NULL.

    Trimming a set of characters looks up both ends in the whole set. Nearly
    all texts begin and end with a printable ASCII character, which two
    comparisons find out; they are left as they are.
    """
    last = F.right(text, F.lit(1))
    clean = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def match_key(name: Column) -> Column:
    """Spelling-insensitive company key: case, commas, points and blanks do not count.

    A missing name has the empty key, so the result is never NULL.
    """
    key = strip_text(F.lower(name))
    for mark in (",", ".", " "):
        key = F.replace(key, F.lit(mark), F.lit(""))
    return F.coalesce(key, F.lit(""))


def item_key(item: Column) -> Column:
    """Item number without sign, letters, leading zeros and decimals.

    The number stays text, so codes longer than a bigint neither fail nor
    collide. Items without any digit, and missing items, share the key ``0``.
    """
    whole = F.substring_index(item.cast("string"), ".", 1)
    digits = F.ltrim(F.regexp_replace(whole, "[^0-9]", ""), F.lit("0"))
    return F.coalesce(F.nullif(digits, F.lit("")), F.lit("0"))


def item_key_text(item: Column) -> Column:
    """Item text without any ``.0``; wherever it stands."""
    return F.replace(strip_text(item.cast("string")), F.lit(".0"), F.lit(""))


def level_key(level: Column) -> Column:
    """Price level name without surrounding white space."""
    return strip_text(level)


def external_id(name: Column, period_end: Column) -> Column:
    """``MMyy-`` of the billing period and up to three initials of the customer."""
    initials = F.regexp_replace(
        F.replace(name, F.lit(","), F.lit("")),
        f"(?U){_WS}*({_NON_WS}){_NON_WS}*|{_WS}+",
        "$1",
    )
    return F.concat(
        F.date_format(period_end, "MMyy"),
        F.lit("-"),
        F.substring(F.upper(initials), 1, 3),
    )


def fill_level_template(level: Column, customer: Column) -> Column:
    """Put the customer's name in place of every ``{Customer}`` of a level name."""
    return F.replace(level, F.lit("{Customer}"), customer)


def invoice_date_text(day: Column) -> Column:
    """A date as ``M/D/YYYY`` without padding."""
    return F.date_format(day, "M/d/yyyy")


def state_flag(state: Column, flagged: str) -> Column:
    """``YES`` for lines of the flagged state, ``NO`` for all others and for missing."""
    return F.when(state.eqNullSafe(F.lit(flagged)), "YES").otherwise("NO")
