import pytest
from datetime import date
from pyspark.sql import functions as F

from ratemill.functions import keys, register_functions

MATCH = [
    (None, ""),
    ("", ""),
    ("Acme, Inc.", "acmeinc"),
    ("  ACME   Inc ", "acmeinc"),
    ("\tAcme\n", "acme"),
    (" Acme　", "acme"),
    ("\x1cAcme\x1f", "acme"),
    ("A\tB", "a\tb"),
    (",\tA", "\ta"),
    ("Ärzte & Co.", "ärzte&co"),
    ("DEFAULT", "default"),
]
ITEM = [
    (None, "0"),
    ("", "0"),
    ("1001", "1001"),
    ("01001", "1001"),
    ("1001.0", "1001"),
    ("-1001.99", "1001"),
    ("IT-10x01", "1001"),
    ("setup fee", "0"),
    (".5", "0"),
    ("0", "0"),
    ("123456789012345678901234567890", "123456789012345678901234567890"),
]
ITEM_TEXT = [("1001", "1001"), (" 1001.0 ", "1001"), ("10.05.0", "105"), ("0123", "0123")]
EXTERNAL = [
    ("Powell, Barnes and Owens", "0526-PBA"),
    ("Johnson-Clark", "0526-J"),
    ("  peterson \t inc ", "0526-PI"),
    ("\x1cpeterson\x1finc", "0526-PI"),
    ("a,b c", "0526-AC"),
    ("ßeta gamma delta", "0526-SSG"),
    (" , ", "0526-"),
    ("", "0526-"),
    (None, None),
]
TEMPLATE = [
    ("{Customer} Flat Rate Rule", "Acme", "Acme Flat Rate Rule"),
    ("{Customer}/{Customer}", "A$1", "A$1/A$1"),
    ("PI-CX", "Acme", "PI-CX"),
    ("PI-CX", None, None),
]


def apply(spark, cases, function, sql):
    """The results of both forms of a function, which must be equal."""
    df = spark.createDataFrame(
        [(i, *c[:-1]) for i, c in enumerate(cases)],
        "i int, " + ", ".join(f"x{k} string" for k in range(len(cases[0]) - 1)),
    )
    register_functions(spark)
    arguments = [F.col(c) for c in df.columns[1:]]
    found = df.select("i", function(*arguments).alias("a"), F.expr(sql).alias("b"))
    out = found.orderBy("i").collect()
    assert [r.a for r in out] == [r.b for r in out]
    return [r.a for r in out]


def expected(cases):
    return [c[-1] for c in cases]


def test_match_key(spark):
    assert apply(spark, MATCH, keys.match_key, "match_key(x0)") == expected(MATCH)


def test_item_key(spark):
    assert apply(spark, ITEM, keys.item_key, "item_key(x0)") == expected(ITEM)


def test_item_key_text(spark):
    found = apply(spark, ITEM_TEXT, keys.item_key_text, "item_key_text(x0)")
    assert found == expected(ITEM_TEXT)


def test_strip_agrees_with_python(spark):
    blanks = keys.WHITESPACE
    cases = [(f"{c}a{c}b{c}", f"a{c}b") for c in blanks] + [(c, "") for c in blanks]
    cases += [(f"é{c}", "é") for c in blanks] + [("", ""), (None, None), ("\x00a", "\x00a")]
    assert all(text is None or text.strip() == want for text, want in cases)
    assert apply(spark, cases, keys.level_key, "level_key(x0)") == expected(cases)


def test_external_id(spark):
    period = F.lit(date(2026, 5, 31))
    found = apply(
        spark,
        EXTERNAL,
        lambda name: keys.external_id(name, period),
        "external_id(x0, DATE'2026-05-31')",
    )
    assert found == expected(EXTERNAL)


def test_level_template(spark):
    found = apply(spark, TEMPLATE, keys.fill_level_template, "fill_level_template(x0, x1)")
    assert found == expected(TEMPLATE)


@pytest.mark.parametrize("state, flag", [("CA", "YES"), ("ca", "NO"), (None, "NO"), ("", "NO")])
def test_state_flag(spark, state, flag):
    df = spark.createDataFrame([(state,)], "state string")
    assert df.select(keys.state_flag(F.col("state"), "CA")).first()[0] == flag


def test_invoice_terms(spark):
    from ratemill.plans.sheet import invoice_terms

    df = spark.createDataFrame([(date(2026, 5, 31),), (date(2026, 12, 20),)], "d date")
    found = [tuple(r) for r in df.select(*invoice_terms(F.col("d"), 15).values()).collect()]
    assert found == [
        ("5/31/2026", "Net 15", "6/15/2026"),
        ("12/20/2026", "Net 15", "1/4/2027"),
    ]
