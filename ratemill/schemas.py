"""Table and sheet layouts."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

BILLING = _schema(
    ("customer", _S),
    ("item", _S),
    ("location", _S),
    ("state", _S),
    ("county", _S),
    ("type", _S),
    ("units", _D),
    ("billing_date", T.DateType()),
)

# ``seq`` and ``rule_id`` carry the insertion order, which a Spark table does
# not have by itself and which decides ties and duplicates.
CUSTOMERS = _schema(("seq", _L), ("customer_name", _S), ("netsuite_id", _S))
ITEMS = _schema(
    ("seq", _L), ("item_code", _S), ("netsuite_internal_id", _S), ("line_order", _I)
)
PRICE_LEVELS = _schema(
    ("seq", _L), ("price_level_name", _S), ("netsuite_internal_id_pl", _S)
)
RULES = _schema(
    ("rule_id", _L),
    ("customer_name", _S),
    ("county", _S),
    ("type", _S),
    ("price_level_name", _S),
)
PRICES = _schema(
    ("seq", _L),
    ("customer_name", _S),
    ("item_code", _S),
    ("price_level_name", _S),
    ("price", _D),
)

# Header names of the files that come in and go out.
BILLING_HEADER = {
    "Customer": "customer",
    "Item": "item",
    "Location": "location",
    "State": "state",
    "County": "county",
    "Type": "type",
    "Units": "units",
    "billing_date": "billing_date",
}
RULES_HEADER = {
    "Customer": "customer_name",
    "County": "county",
    "Type": "type",
    "Price_Level_Name": "price_level_name",
}
CLIENTS_HEADER = {
    "internal_client_id": "internal_client_id",
    "client_name": "client_name",
}
PROTOTYPE_HEADER = {
    "external_id": "External ID",
    "invoice_date": "Date",
    "customer": "Customer",
    "item": "Item",
    "line_order": "Line Order",
    "ca_line": "CA Line?",
    "qty": "Qty",
    "price_level": "Price Level",
    "customer_id": "Customer ID",
    "item_id": "Item ID",
    "trade_credit": "Trade Credit",
    "due_date": "Due Date",
}
SHEET_HEADER = PROTOTYPE_HEADER | {
    "price": "price",
    "total_value": "Total_Calculated_Value",
}
RATED_HEADER = {inner: outer for outer, inner in BILLING_HEADER.items()} | {
    "price_level": "NetSuite_Price_Level",
    "ca_line": "CA Line?",
}
REJECTS_HEADER = {inner: outer for outer, inner in BILLING_HEADER.items()} | {
    "reject_reason": "Reason",
    "raw_line": "Line",
}

PROTOTYPE_COLUMNS = list(PROTOTYPE_HEADER)
SHEET_COLUMNS = list(SHEET_HEADER)
