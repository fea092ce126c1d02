"""Small tables with known results."""

from datetime import date

from ratemill import schemas
from ratemill.plans.sheet import ReferenceTables

# The demonstration tables whose results are to be matched.
POWELL, JOHNSON = "Powell, Barnes and Owens", "Johnson-Clark"
CUSTOMERS = [
    (POWELL, "NS-CUST-9901"),
    (JOHNSON, "NS-CUST-9902"),
    ("Barnes LLC", "NS-CUST-9903"),
    ("Peterson Inc", "NS-CUST-9904"),
    ("Baird, Hayes and Arias", "NS-CUST-9905"),
    ("DEFAULT", "NS-CUST-0000"),
]
ITEMS = [(str(1000 + n), f"NS-ITEM-{100 + n}", n) for n in range(1, 6)]
LEVELS = [
    ("Powell Flat Rate Rule", "NS-PL-01"),
    ("JC-CX-TypeA", "NS-PL-02"),
    ("JC-CX-TypeB", "NS-PL-03"),
    ("PI-CX", "NS-PL-04"),
    ("Base Price", "NS-PL-00"),
]
RULES = [
    (POWELL, "ANY", "ANY", "Powell Flat Rate Rule"),
    (JOHNSON, "County X", "A", "JC-CX-TypeA"),
    (JOHNSON, "County X", "B", "JC-CX-TypeB"),
    ("Peterson Inc", "County X", "ANY", "PI-CX"),
    ("DEFAULT", "ANY", "ANY", "Base Price"),
]
RULES_FILE = [
    *RULES[:3],
    (JOHNSON, "County Y", "A", "JC-CY-TypeA"),
    (JOHNSON, "County Y", "B", "JC-CY-TypeB"),
    RULES[3],
    ("Peterson Inc", "County Y", "ANY", "PI-CY"),
    ("DEFAULT", "ANY", "ANY", "{Customer} Flat Rate Rule"),
]
PRICES = [
    (POWELL, "1001", "Powell Flat Rate Rule", 150.0),
    (POWELL, "1002", "Powell Flat Rate Rule", 175.0),
    (JOHNSON, "1001", "JC-CX-TypeA", 110.0),
    (JOHNSON, "1001", "JC-CX-TypeB", 130.0),
    ("DEFAULT", "1001", "Base Price", 100.0),
    ("DEFAULT", "1002", "Base Price", 100.0),
]


def numbered(spark, rows, schema):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows, 1)], schema)


def rules(spark, rows):
    return numbered(spark, rows, schemas.RULES)


def seed_frames(spark):
    """Seed rows per table, each with a ``seq``."""
    return {
        "customers_db": numbered(spark, CUSTOMERS, schemas.CUSTOMERS),
        "items_db": numbered(spark, ITEMS, schemas.ITEMS),
        "price_levels_db": numbered(spark, LEVELS, schemas.PRICE_LEVELS),
        "price_level_rules": rules(spark, RULES).withColumnRenamed("rule_id", "seq"),
        "prices_db": numbered(spark, PRICES, schemas.PRICES),
    }


def tables(spark, **changed):
    frames = seed_frames(spark)
    frames["price_level_rules"] = rules(spark, RULES)
    frames.update(changed)
    return ReferenceTables(
        frames["price_level_rules"],
        frames["customers_db"],
        frames["items_db"],
        frames["prices_db"],
    )


def billing(spark, *lines):
    """Lines of (customer, item, state, county, type, units)."""
    rows = [
        (customer, item, "Practice 1", state, county, kind, units, date(2026, 5, 1))
        for customer, item, state, county, kind, units in lines
    ]
    return spark.createDataFrame(rows, schemas.BILLING)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
