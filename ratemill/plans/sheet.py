"""The billing sheet and its variants.

All variants are the same steps with different options: rate the lines, flag
them by state, roll quantities up, look ids and prices up, fill what is
missing, add the invoice columns. Lines are rolled up before any lookup, so
the lookups see one row per sheet line and not one per billing line.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import (
    external_id,
    fill_level_template,
    invoice_date_text,
    item_key,
    item_key_text,
    state_flag,
)
from ..operators.lookups import (
    MATCH_KEYS,
    add_match_keys,
    default_customer_id,
    fill_missing,
    join_customer,
    join_item,
    join_price,
    join_price_strict,
    line_value,
    lookup_last,
)
from ..operators.order import with_positions
from ..operators.places import PLACE
from ..operators.rating import (
    DEFAULT_BROADCAST_BYTES,
    NORMALISED,
    STRICT,
    MatchMode,
    Rater,
)
from ..operators.rollup import combine_lines, drop_null_keys, quantity_rollup
from ..schemas import PROTOTYPE_COLUMNS, SHEET_COLUMNS
from ..session import stored


# The defaults below are those of the sheet to be matched.
@dataclass(frozen=True)
class SheetOptions:
    period_end: date = date(2026, 5, 31)
    net_days: int = 15
    flagged_state: str = "CA"
    default_level: str = "Base Price"
    default_level_template: str = "{Customer} Flat Rate Rule"
    default_customer_name: str = "DEFAULT"
    default_customer_id: str = "NS-CUST-0000"
    default_price: float = 100.0
    default_line_order: int = 1
    strategy: str = "auto"
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES


@dataclass(frozen=True)
class ReferenceTables:
    """What the sheet looks up; see ``ratemill.schemas`` for the columns."""

    rules: DataFrame
    customers: DataFrame | None = None
    items: DataFrame | None = None
    prices: DataFrame | None = None


def invoice_terms(period_end: Column, net_days: int) -> dict[str, Column]:
    """Date, terms and due date of an invoice, as text."""
    return {
        "invoice_date": invoice_date_text(period_end),
        "trade_credit": F.lit(f"Net {net_days}"),
        "due_date": invoice_date_text(F.date_add(period_end, net_days)),
    }


def rated_quantities(
    billing: DataFrame,
    rules: DataFrame,
    options: SheetOptions,
    mode: MatchMode,
    default_level: str,
    from_template: bool = False,
    item_key: Column | None = None,
) -> DataFrame:
    """Customer, item, price level, flag and quantity.

    Where all rules are broadcast, lines are rated where they are, and the rollup's
    shuffle is the only one of the lines; it combines map-side, so a hot customer
    weighs no more than its rows of the sheet per task. Where lines meet the rules of
    their customer, they are shuffled for that and then for the rollup. Where rules are shuffled by triples,
    lines that no later step can tell apart are added up first, and what remains is
    rated.

    With ``item_key`` lines that meet the rules of their customer are rolled up where they
    are, and the rows keep ``PLACE`` (and ``customer_key``, if names are normalised) for lookups by customer
    in the same shuffle; a customer with very many lines is left to adaptive execution, which splits its partition.
    """
    rater = Rater(rules, mode, options.strategy, options.broadcast_bytes)
    flag = state_flag(F.col("state"), options.flagged_state)
    billed = drop_null_keys(billing).withColumn("ca_line", flag)
    if rater.in_place or rater.by_customer:
        rated = rater.rate(billed, default_level, item_key=item_key)
    else:
        rated = rater.rate(combine_lines(billed), default_level, triples_from=billed)
    if from_template:
        rated = rated.withColumn(
            "price_level", fill_level_template(F.col("price_level"), F.col("customer"))
        )
    return quantity_rollup(rated, [c for c in ("customer_key", PLACE) if c in rated.columns])


def _finish(sheet: DataFrame, options: SheetOptions, columns: list[str]) -> DataFrame:
    period_end = F.lit(options.period_end)
    return sheet.withColumns(
        {
            "external_id": external_id(F.col("customer"), period_end),
            **invoice_terms(period_end, options.net_days),
        }
    ).select(*columns)


def looked_up(
    billing: DataFrame,
    tables: ReferenceTables,
    options: SheetOptions = SheetOptions(),
    text_item_keys: bool = False,
    dedupe: bool = True,
    in_steps: bool = False,
) -> DataFrame:
    """The rollup with prices, customers and items looked up; what is not found is NULL.

    ``in_steps`` as in ``billing_sheet``.
    """
    step = stored if in_steps else lambda rows: rows
    key = item_key_text if text_item_keys else item_key
    sheet = rated_quantities(
        billing, tables.rules, options, NORMALISED, options.default_level, item_key=key(F.col("item"))
    )
    if PLACE in sheet.columns:
        # Rows are with their customer: prices and ids come to them, and only items need another shuffle.
        everyone = NORMALISED.wildcard("customer")
        sheet = join_price(add_match_keys(sheet, text_item_keys), tables.prices, text_item_keys, everyone)
        sheet = step(join_customer(sheet, tables.customers, dedupe, everyone).drop(*MATCH_KEYS, PLACE))
        sheet = join_item(add_match_keys(sheet, text_item_keys), tables.items, dedupe, text_item_keys)
        return sheet.drop(*MATCH_KEYS)
    # The widest key first, while rows are narrow; keys are made anew for each lookup, so no shuffle carries
    # those of another.
    sheet = join_price(add_match_keys(sheet, text_item_keys), tables.prices, text_item_keys)
    sheet = step(sheet.drop(*MATCH_KEYS))
    sheet = join_item(add_match_keys(sheet, text_item_keys), tables.items, dedupe, text_item_keys)
    sheet = join_customer(add_match_keys(sheet.drop(*MATCH_KEYS)), tables.customers, dedupe)
    return sheet.drop(*MATCH_KEYS)


def billing_sheet(
    billing: DataFrame,
    tables: ReferenceTables,
    options: SheetOptions = SheetOptions(),
    text_item_keys: bool = False,
    dedupe: bool = True,
    in_steps: bool = False,
) -> DataFrame:
    """The invoice-import sheet, 14 columns, one row per customer, item, level and flag.

    Not sorted; ``in_sheet_order`` and the CSV sink do that. With ``in_steps`` the rows are written to the shared
    folder once they have their prices, so what was shuffled for that need not be kept while the sheet is sorted
    and written (see ``session.free_shuffles``).
    """
    sheet = fill_missing(
        looked_up(billing, tables, options, text_item_keys, dedupe, in_steps),
        options.default_line_order,
        options.default_customer_id,
        options.default_price,
    ).withColumn("total_value", line_value(F.col("qty"), F.col("price")))
    return _finish(sheet, options, SHEET_COLUMNS)


def billing_sheet_text_keys(
    billing: DataFrame, tables: ReferenceTables, options: SheetOptions = SheetOptions()
) -> DataFrame:
    """The sheet with items matched as text and duplicate customers and items kept.

    A customer or item that stands twice in its table doubles its sheet lines.
    """
    return billing_sheet(billing, tables, options, text_item_keys=True, dedupe=False)


def billing_sheet_strict(
    billing: DataFrame, tables: ReferenceTables, options: SheetOptions = SheetOptions()
) -> DataFrame:
    """The sheet with all names compared exactly as written."""
    sheet = rated_quantities(
        billing, tables.rules, options, STRICT, options.default_level, item_key=F.col("item")
    )
    everyone = STRICT.wildcard("customer") if PLACE in sheet.columns else None
    sheet = join_price_strict(sheet, tables.prices, everyone)
    sheet = lookup_last(
        sheet, "customer", tables.customers, "customer_name", "netsuite_id", "customer_id", everyone
    ).drop(PLACE)
    sheet = lookup_last(
        sheet, "item", tables.items, "item_code", "netsuite_internal_id", "item_id"
    )
    sheet = fill_missing(
        sheet.withColumn("line_order", F.lit(options.default_line_order)),
        options.default_line_order,
        default_customer_id(tables.customers, options.default_customer_name),
        options.default_price,
    ).withColumn("total_value", line_value(F.col("qty"), F.col("price")))
    return _finish(sheet, options, SHEET_COLUMNS)


def upload_prototype(
    billing: DataFrame, rules: DataFrame, options: SheetOptions = SheetOptions()
) -> DataFrame:
    """The sheet before any lookup, 12 columns, with empty ids and no prices."""
    sheet = rated_quantities(
        billing,
        rules,
        options,
        STRICT,
        options.default_level_template,
        from_template=True,
    ).withColumns(
        {
            "line_order": F.lit(options.default_line_order),
            "customer_id": F.lit(""),
            "item_id": F.lit(""),
        }
    )
    return _finish(sheet, options, PROTOTYPE_COLUMNS)


def rated_lines(
    billing: DataFrame, rules: DataFrame, options: SheetOptions = SheetOptions()
) -> DataFrame:
    """Every billing line with its price level (names filled in) and state flag."""
    rater = Rater(rules, STRICT, options.strategy, options.broadcast_bytes)
    rated = rater.rate(billing, options.default_level_template)
    return rated.withColumns(
        {
            "price_level": fill_level_template(F.col("price_level"), F.col("customer")),
            "ca_line": state_flag(F.col("state"), options.flagged_state),
        }
    )


def sheet_order() -> list[Column]:
    """Customer, item by number, price level, flag."""
    number = item_key(F.col("item"))
    return [
        F.col("customer"),
        F.length(number),
        number,
        F.col("item"),
        F.col("price_level"),
        F.col("ca_line"),
    ]


def in_sheet_order(sheet: DataFrame) -> DataFrame:
    return sheet.orderBy(*sheet_order())


def _total_order(sheet: DataFrame) -> list[Column]:
    """Sheet order, then all other columns: rows that are still equal are the same row twice."""
    rest = [c for c in sheet.columns if c not in ("customer", "item", "price_level", "ca_line")]
    return [*sheet_order(), *map(F.col, rest)]


def with_sheet_positions(sheet: DataFrame) -> DataFrame:
    """The sheet with each row's ``position`` in sheet order, from 1."""
    return with_positions(sheet, _total_order(sheet), "position", wide=True)


def preview(sheet: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in sheet order; each task keeps no more than ``n``."""
    return sheet.orderBy(*_total_order(sheet)).limit(n)
