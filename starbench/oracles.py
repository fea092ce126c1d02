"""The queries' results stated in SQL for DuckDB.

The statements share the views with the Spark queries and nothing else. The
rating is written the direct way: every rule that matches a triple is scored
and the best one taken, without the split into shapes.
"""

from __future__ import annotations

from .views import FLAGGED_STATE, with_clause

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _strip(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _match_key(x: str) -> str:
    return f"coalesce(regexp_replace({_strip(f'lower({x})')}, '[,. ]', '', 'g'), '')"


def _item_key(x: str) -> str:
    digits = f"regexp_replace(split_part({x}, '.', 1), '[^0-9]', '', 'g')"
    return f"coalesce(CAST(CAST(nullif({digits}, '') AS HUGEINT) AS VARCHAR), '0')"


def _item_key_text(x: str) -> str:
    return f"replace({_strip(x)}, '.0', '')"


def _external_id(x: str, prefix: str = "'0526'") -> str:
    first = rf"regexp_replace(replace({x}, ',', ''), '\s*(\S)\S*\s*', '\1', 'g')"
    return f"{prefix} || '-' || substr(upper({first}), 1, 3)"


def _day(x: str) -> str:
    return f"strftime({x}, '%-m/%-d/%Y')"


_FLAG = f"CASE WHEN state = '{FLAGGED_STATE}' THEN 'YES' ELSE 'NO' END"


def _rating(normalise: bool) -> list[str]:
    """CTEs ``triples``, ``hits`` and ``best``: the best rule per triple."""
    if normalise:
        line = (_match_key("customer"), *(f"coalesce({_strip(c)}, 'nan')" for c in ("county", "type")))
        rule = (_match_key("customer_name"), *(_strip(c) for c in ("county", "type")))
        wild = "default"
    else:
        line, rule, wild = ("customer", "county", "type"), ("customer_name", "county", "type"), "DEFAULT"

    def score(key: str, token: str) -> str:
        return f"CASE WHEN r.{key} = t.{key} THEN 2 WHEN r.{key} = '{token}' THEN 1 END"

    total = " + ".join((score("k1", wild), score("k2", "ANY"), score("k3", "ANY")))

    def pairs(condition: str) -> str:
        return (
            f"SELECT t.customer, t.county, t.type, r.rule_id, r.price_level_name, {total} AS score "
            f"FROM triples t JOIN keyed r ON {condition}"
        )

    return [
        f"triples AS (SELECT DISTINCT customer, county, type, {line[0]} AS k1, {line[1]} AS k2, "
        f"{line[2]} AS k3 FROM billing)",
        f"keyed AS (SELECT rule_id, price_level_name, {rule[0]} AS k1, {rule[1]} AS k2, "
        f"{rule[2]} AS k3 FROM rules)",
        f"hits AS (SELECT * FROM ({pairs('r.k1 = t.k1')} UNION "
        f"{pairs(f'r.k1 = {chr(39)}{wild}{chr(39)}')}) WHERE score IS NOT NULL)",
        "best AS (SELECT customer, county, type, price_level_name AS level FROM hits "
        "QUALIFY row_number() OVER (PARTITION BY customer, county, type "
        "ORDER BY score DESC, rule_id) = 1)",
    ]


_SAME_TRIPLE = (
    "b.customer IS NOT DISTINCT FROM h.customer AND b.county IS NOT DISTINCT FROM h.county "
    "AND b.type IS NOT DISTINCT FROM h.type"
)


def _rated(normalise: bool, default: str = "'Base Price'", template: bool = False) -> list[str]:
    level = f"coalesce(h.level, {default})"
    if template:
        level = f"replace({level}, '{{Customer}}', b.customer)"
    return [
        *with_clause("billing", "rules"),
        *_rating(normalise),
        f"rated AS (SELECT b.*, {level} AS price_level, {_FLAG} AS ca_line "
        f"FROM billing b LEFT JOIN best h ON {_SAME_TRIPLE})",
    ]


def _rollup(normalise: bool = True, **kwargs) -> list[str]:
    return [
        *_rated(normalise, **kwargs),
        "rolled AS (SELECT customer, item, price_level, ca_line, coalesce(sum(units), 0) AS qty "
        "FROM rated WHERE customer IS NOT NULL AND item IS NOT NULL GROUP BY ALL)",
    ]


_TEMPLATE = dict(normalise=False, default="'{Customer} Flat Rate Rule'", template=True)


def _lookups(item_key=_item_key, dedupe: bool = True) -> list[str]:
    def once(key: str) -> str:
        return f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY seq) = 1" if dedupe else ""

    return [
        *[c for c in with_clause("customers_db", "items_db", "prices_db")],
        f"ids AS (SELECT {_match_key('customer_name')} AS ck, netsuite_id AS customer_id, seq "
        f"FROM customers_db {once('ck')})",
        f"its AS (SELECT {item_key('item_code')} AS ik, netsuite_internal_id AS item_id, line_order, "
        f"seq FROM items_db {once('ik')})",
        f"prs AS (SELECT {_match_key('customer_name')} AS ck, {item_key('item_code')} AS ik, "
        f"{_strip('price_level_name')} AS lk, price FROM prices_db)",
    ]


def _joins(item_key=_item_key) -> str:
    return (
        f"FROM rolled s LEFT JOIN ids ON ids.ck = {_match_key('s.customer')} "
        f"LEFT JOIN its ON its.ik = {item_key('s.item')} "
        f"LEFT JOIN prs ON prs.ck = {_match_key('s.customer')} AND prs.ik = {item_key('s.item')} "
        f"AND prs.lk = {_strip('s.price_level')}"
    )


def _with(ctes: list[str], select: str) -> str:
    unique = list(dict.fromkeys(ctes))
    return "WITH " + ",\n".join(unique) + "\n" + select


_KEYS = "s.customer, s.item, s.price_level, s.ca_line"
_PERIOD = f"'5/31/2026' AS invoice_date, 'Net 15' AS trade_credit, '6/15/2026' AS due_date"
_FILLED = (
    "coalesce(line_order, 1) AS line_order, coalesce(customer_id, 'NS-CUST-0000') AS customer_id, "
    "item_id, coalesce(price, 100.0::DOUBLE) AS price"
)


def _sheet(item_key=_item_key, dedupe: bool = True, tail: str = "", more: str = "") -> str:
    return _with(
        _rollup() + _lookups(item_key, dedupe),
        f"SELECT {_external_id('s.customer')} AS external_id, {_KEYS}, s.qty, {_PERIOD}, {_FILLED}, "
        f"s.qty * coalesce(price, 100.0::DOUBLE) AS total_value{more} {_joins(item_key)} {tail}",
    )


_BY_NUMBER = f"length({_item_key('s.item')}), {_item_key('s.item')}"

_LAST_ID = (
    "SELECT customer_name, netsuite_id FROM {table} WHERE customer_name IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY customer_name ORDER BY seq DESC) = 1"
)
_DEFAULT_ID = (
    "(SELECT netsuite_id FROM customers_db WHERE customer_name = 'DEFAULT' ORDER BY seq DESC LIMIT 1)"
)

_ALL_ITEMS = (
    "SELECT item FROM billing UNION SELECT item_code FROM items_db UNION "
    "SELECT item_code FROM prices_db"
)


def _inserted(existing: str, batch: str, keys: str, required: str) -> str:
    """Rows of ``batch`` that insert-or-ignore adds to ``existing``."""
    names = keys.split(", ")
    same = " AND ".join(f"e.{k} = b.{k}" for k in names)
    some_null = " OR ".join(f"{k} IS NULL" for k in names)
    present = " AND ".join(f"{c} IS NOT NULL" for c in required.split(", "))
    return (
        f"SELECT * FROM {batch} b WHERE {present} AND NOT EXISTS (SELECT 1 FROM {existing} e WHERE {same}) "
        f"QUALIFY {some_null} OR row_number() OVER (PARTITION BY {keys} ORDER BY seq) = 1"
    )


_INCOMING_SEEDS = (
    "seeds AS (SELECT * FROM customers_db UNION ALL "
    "SELECT seq + 1000000000000, customer_name, netsuite_id FROM incoming_customers)"
)
_NOTHING = "nothing AS (SELECT * FROM seeds WHERE false)"
_STORED_CUSTOMERS = "stored_customers AS (" + _inserted("nothing", "seeds", "customer_name", "netsuite_id") + ")"


def _orphans(child: str, column: str, parent: str, parent_column: str, name: str | None = None) -> str:
    return (
        f"SELECT '{name or child}' AS table_name, '{column}' AS column_name, {column} AS value, "
        f"count(*) AS n_rows FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {parent_column} FROM {parent} WHERE {parent_column} IS NOT NULL) GROUP BY {column}"
    )


def _null_counts(table: str, name: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM {table}"
        for c in columns.split(", ")
    )


# One pseudo-random draw after another, each from the one before.
def _draws() -> str:
    step = "SELECT *, (d{a} * 48271) % 2147483647 AS d{b} FROM ({inner})"
    sql = "SELECT (l_orderkey * 8 + l_linenumber) % 2147483646 + 1 AS d0 FROM lineitem"
    for i in range(10):
        sql = step.format(a=i, b=i + 1, inner=sql)
    return sql


def _pick(i: int, n: int) -> str:
    return f"CAST(floor(d{i + 2} * {n} / 2147483647) AS INTEGER)"


def _list_pick(i: int, values: list[str]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{_pick(i, len(values))} + 1]"


def _synthetic(customer: str) -> str:
    return (
        f"SELECT {customer} AS customer, "
        f"{_list_pick(2, ['1001', '1002', '1003', '1004', '1005'])} AS item, "
        f"{_list_pick(3, ['Practice 1', 'Practice 2', 'Practice 3'])} AS location, "
        f"{_list_pick(4, ['NY', 'CA', 'OK', 'TX'])} AS state, "
        f"{_list_pick(5, ['County X', 'County Y'])} AS county, {_list_pick(6, ['A', 'B'])} AS type, "
        f"CAST({_pick(7, 10)} + 1 AS DOUBLE) AS units, "
        f"DATE '2026-05-31' - {_pick(8, 26)} AS billing_date FROM ({_draws()})"
    )


def _build() -> dict[str, str]:
    billing = with_clause("billing")
    o: dict[str, str] = {}

    o["fn_match_key"] = _with(
        with_clause("billing", "rules", "customers_db"),
        f"SELECT name, {_match_key('name')} AS match_key FROM (SELECT customer AS name FROM billing "
        "UNION SELECT customer_name FROM rules UNION SELECT customer_name FROM customers_db)",
    )
    items = with_clause("billing", "items_db", "prices_db")
    o["fn_item_key"] = _with(items, f"SELECT item, {_item_key('item')} AS item_key FROM ({_ALL_ITEMS})")
    o["fn_item_key_text"] = _with(
        items, f"SELECT item, {_item_key_text('item')} AS item_key FROM ({_ALL_ITEMS})"
    )
    o["fn_level_key"] = _with(
        with_clause("rules", "prices_db"),
        f"SELECT level, {_strip('level')} AS level_key FROM (SELECT price_level_name AS level "
        "FROM rules UNION SELECT price_level_name FROM prices_db)",
    )
    o["fn_external_id"] = _with(
        billing,
        f"SELECT name, {_external_id('name')} AS external_id FROM (SELECT customer AS name "
        "FROM billing UNION SELECT p_name FROM part)",
    )
    o["fn_level_template"] = _with(
        with_clause("rules"),
        "SELECT rule_id, replace(price_level_name, '{Customer}', customer_name) AS level FROM rules",
    )
    o["fn_sql_registered"] = _with(
        billing,
        f"SELECT customer, item, {_match_key('customer')} AS match_key, {_item_key('item')} AS item_key, "
        f"{_item_key_text('item')} AS item_key_text, {_strip('county')} AS level_key, "
        f"{_external_id('customer')} AS external_id, "
        "replace('{Customer}: ' || type, '{Customer}', customer) AS level, count(*) AS n_lines "
        "FROM billing GROUP BY customer, item, county, type",
    )

    o["state_flag"] = _with(
        billing, f"SELECT state, {_FLAG} AS ca_line, count(*) AS n_lines FROM billing GROUP BY ALL"
    )
    o["invoice_terms"] = _with(
        billing,
        f"SELECT DISTINCT billing_date, {_day('billing_date')} AS invoice_date, "
        f"'Net 15' AS trade_credit, {_day('billing_date + 15')} AS due_date FROM billing",
    )
    o["drop_null_keys"] = _with(
        billing,
        "SELECT customer, count(*) AS n_lines, sum(units) AS units FROM billing "
        "WHERE customer IS NOT NULL AND item IS NOT NULL GROUP BY customer",
    )
    o["rule_scores"] = _with(
        with_clause("billing", "rules") + _rating(True),
        "SELECT customer, county, type, rule_id, price_level_name AS price_level, score FROM hits h "
        "JOIN keyed USING (rule_id, price_level_name) "
        "QUALIFY row_number() OVER (PARTITION BY customer, county, type, k1, k2, k3 ORDER BY rule_id) = 1",
    )
    sheet = _rollup() + _lookups()
    o["fallback_fill"] = _with(sheet, f"SELECT {_KEYS}, {_FILLED} {_joins()}")
    o["line_value"] = _with(
        sheet,
        f"SELECT {_KEYS}, s.qty, coalesce(price, 100.0::DOUBLE) AS price, "
        f"s.qty * coalesce(price, 100.0::DOUBLE) AS total_value {_joins()}",
    )
    o["customer_default_lookup"] = _with(
        with_clause("billing", "customers_db"),
        f"SELECT b.customer, coalesce(c.netsuite_id, {_DEFAULT_ID}) AS customer_id "
        "FROM (SELECT DISTINCT customer FROM billing) b "
        f"LEFT JOIN ({_LAST_ID.format(table='customers_db')}) c ON c.customer_name = b.customer",
    )

    columns = "customer, item, location, state, county, type, units, billing_date, price_level"
    o["rate_lines"] = o["rate_lines_probe"] = _with(_rated(True), f"SELECT {columns} FROM rated")
    o["join_customer"] = _with(
        sheet,
        f"SELECT {_KEYS}, s.qty, customer_id FROM rolled s "
        f"LEFT JOIN ids ON ids.ck = {_match_key('s.customer')}",
    )
    o["join_item"] = _with(
        sheet,
        f"SELECT {_KEYS}, s.qty, item_id, line_order FROM rolled s "
        f"LEFT JOIN its ON its.ik = {_item_key('s.item')}",
    )
    o["join_price"] = _with(
        sheet,
        f"SELECT {_KEYS}, s.qty, price FROM rolled s LEFT JOIN prs ON prs.ck = {_match_key('s.customer')} "
        f"AND prs.ik = {_item_key('s.item')} AND prs.lk = {_strip('s.price_level')}",
    )
    o["join_price_strict"] = _with(
        sheet,
        f"SELECT {_KEYS}, s.qty, price FROM rolled s LEFT JOIN prices_db p "
        "ON p.customer_name = s.customer AND p.item_code = s.item AND p.price_level_name = s.price_level",
    )
    o["join_fanout"] = _with(
        _rollup() + _lookups(_item_key_text, dedupe=False),
        f"SELECT {_KEYS}, s.qty, customer_id, item_id, line_order FROM rolled s "
        f"LEFT JOIN ids ON ids.ck = {_match_key('s.customer')} "
        f"LEFT JOIN its ON its.ik = {_item_key_text('s.item')}",
    )
    o["lookup_keep_last"] = _with(
        with_clause("billing", "incoming_customers"),
        "SELECT b.customer, c.netsuite_id AS customer_id FROM (SELECT DISTINCT customer FROM billing) b "
        f"LEFT JOIN ({_LAST_ID.format(table='incoming_customers')}) c ON c.customer_name = b.customer",
    )

    o["quantity_rollup"] = _with(_rollup(), "SELECT * FROM rolled")
    o["dedupe_first"] = _with(
        with_clause("incoming_customers"),
        f"SELECT {_match_key('customer_name')} AS customer_key, netsuite_id FROM incoming_customers "
        "QUALIFY row_number() OVER (PARTITION BY customer_key ORDER BY seq) = 1",
    )
    o["sheet_preview"] = _sheet(
        tail=f"ORDER BY s.customer, {_BY_NUMBER}, s.item, s.price_level, s.ca_line, price LIMIT 10"
    )

    o["sheet_order"] = _sheet(
        more=f", row_number() OVER (ORDER BY s.customer, {_BY_NUMBER}, s.item, s.price_level, s.ca_line, "
        "coalesce(price, 100.0::DOUBLE)) AS position"
    )
    o["billing_sheet"] = o["scan_reference"] = o["sheet_csv_roundtrip"] = _sheet()
    o["billing_sheet_text_keys"] = _sheet(_item_key_text, dedupe=False)
    o["billing_sheet_strict"] = _with(
        _rollup(normalise=False) + with_clause("customers_db", "items_db", "prices_db"),
        f"SELECT {_external_id('s.customer')} AS external_id, {_KEYS}, s.qty, {_PERIOD}, 1 AS line_order, "
        f"coalesce(c.netsuite_id, {_DEFAULT_ID}) AS customer_id, i.netsuite_internal_id AS item_id, "
        "coalesce(p.price, 100.0::DOUBLE) AS price, s.qty * coalesce(p.price, 100.0::DOUBLE) AS total_value "
        "FROM rolled s LEFT JOIN prices_db p ON p.customer_name = s.customer AND p.item_code = s.item "
        f"AND p.price_level_name = s.price_level LEFT JOIN ({_LAST_ID.format(table='customers_db')}) c "
        "ON c.customer_name = s.customer LEFT JOIN items_db i ON i.item_code = s.item",
    )
    o["upload_prototype"] = _with(
        _rollup(**_TEMPLATE),
        f"SELECT {_external_id('s.customer')} AS external_id, {_KEYS}, s.qty, {_PERIOD}, 1 AS line_order, "
        "'' AS customer_id, '' AS item_id FROM rolled s",
    )
    o["rated_lines"] = _with(_rated(**_TEMPLATE), f"SELECT {columns}, ca_line FROM rated")

    o["pk_violations"] = _with(
        with_clause("incoming_customers"),
        "SELECT customer_name AS key, count(*) AS n_rows, CASE WHEN customer_name IS NULL THEN 'null key' "
        "ELSE 'duplicate key' END AS problem FROM incoming_customers GROUP BY customer_name "
        "HAVING count(*) > 1 OR customer_name IS NULL",
    )
    o["pk_composite_violations"] = _with(
        with_clause("incoming_rules"),
        "SELECT customer_name, county, type, count(*) AS n_rows FROM incoming_rules "
        "WHERE customer_name IS NOT NULL AND county IS NOT NULL AND type IS NOT NULL "
        "GROUP BY ALL HAVING count(*) > 1",
    )
    o["price_key_duplicates"] = _with(
        _lookups(),
        "SELECT ck AS customer_key, ik AS item_key, lk AS level_key, count(*) AS n_rows FROM prs "
        "GROUP BY ALL HAVING count(*) > 1",
    )
    o["null_violations"] = _with(
        with_clause("incoming_customers", "items_db", "price_levels_db", "incoming_rules", "prices_db"),
        " UNION ALL ".join(
            (
                _null_counts("incoming_customers", "customers_db", "netsuite_id"),
                _null_counts("items_db", "items_db", "netsuite_internal_id, line_order"),
                _null_counts("price_levels_db", "price_levels_db", "netsuite_internal_id_pl"),
                _null_counts(
                    "incoming_rules", "price_level_rules", "customer_name, county, type, price_level_name"
                ),
                _null_counts("prices_db", "prices_db", "price"),
            )
        ),
    )
    o["fk_orphans"] = _with(
        with_clause("customers_db", "items_db", "price_levels_db", "rules", "prices_db"),
        " UNION ALL ".join(
            (
                _orphans("rules", "customer_name", "customers_db", "customer_name", "price_level_rules"),
                _orphans("prices_db", "customer_name", "customers_db", "customer_name"),
                _orphans("prices_db", "item_code", "items_db", "item_code"),
                _orphans("prices_db", "price_level_name", "price_levels_db", "price_level_name"),
            )
        ),
    )
    o["insert_or_ignore"] = _with(
        with_clause("customers_db", "incoming_customers"),
        "SELECT * FROM customers_db UNION ALL "
        + f"({_inserted('customers_db', 'incoming_customers', 'customer_name', 'netsuite_id')})",
    )
    o["assign_rule_ids"] = _with(
        with_clause("rules", "incoming_rules"),
        "SELECT (SELECT max(rule_id) FROM rules) + seq AS rule_id, customer_name, county, type, "
        "price_level_name FROM incoming_rules",
    )

    store = with_clause(
        "customers_db", "incoming_customers", "items_db", "price_levels_db", "rules", "prices_db",
        "incoming_rules",
    ) + [_INCOMING_SEEDS, _NOTHING, _STORED_CUSTOMERS]
    known = "customer_name IN (SELECT customer_name FROM stored_customers)"
    o["reference_tables"] = _with(
        store,
        "SELECT 'customers_db' AS table_name, seq AS position, customer_name AS text_1, "
        "netsuite_id AS text_2, CAST(NULL AS VARCHAR) AS text_3, CAST(NULL AS VARCHAR) AS text_4, "
        "CAST(NULL AS DOUBLE) AS number FROM stored_customers UNION ALL "
        "SELECT 'items_db', seq, item_code, netsuite_internal_id, NULL, NULL, line_order FROM items_db "
        "UNION ALL SELECT 'price_levels_db', seq, price_level_name, netsuite_internal_id_pl, NULL, NULL, "
        "NULL FROM price_levels_db UNION ALL "
        f"SELECT 'price_level_rules', rule_id, customer_name, county, type, price_level_name, NULL "
        f"FROM rules WHERE {known} UNION ALL "
        "SELECT 'prices_db', seq, customer_name, item_code, price_level_name, NULL, price FROM prices_db",
    )
    o["reference_tables_enforced"] = (
        f"{o['reference_tables']} WHERE {known} AND item_code IN (SELECT item_code FROM items_db) "
        "AND price_level_name IN (SELECT price_level_name FROM price_levels_db)"
    )
    o["load_rules"] = _with(
        store,
        f"SELECT rule_id, customer_name, county, type, price_level_name FROM rules WHERE {known} UNION ALL "
        f"SELECT (SELECT max(rule_id) FROM rules WHERE {known}) + seq, customer_name, county, type, "
        f"price_level_name FROM incoming_rules WHERE county IS NOT NULL AND {known}",
    )

    o["scan_billing"] = _with(
        billing,
        "SELECT customer, item, location, state, county, type, units, billing_date, count(*) AS n_lines "
        "FROM billing GROUP BY ALL",
    )
    o["scan_billing_rejects"] = _with(
        billing,
        "SELECT item, reject_reason, count(*) AS n_lines, "
        "sum(CASE WHEN reject_reason IS NULL THEN units END) AS units "
        "FROM (SELECT item, units, CASE right(item, 1) WHEN '5' THEN 'fields' WHEN '6' THEN 'fields' "
        "WHEN '7' THEN 'units' WHEN '8' THEN 'billing_date' END AS reject_reason FROM billing) "
        "GROUP BY ALL",
    )
    o["scan_rules"] = _with(
        with_clause("rules"),
        "SELECT row_number() OVER (ORDER BY rule_id) AS rule_id, customer_name, county, type, "
        "price_level_name FROM rules",
    )
    o["synth_billing"] = _synthetic(_list_pick(1, [f"Client {k}" for k in range(5)]))
    o["client_ids"] = (
        "SELECT 'CLI-' || CAST(99 + row_number() OVER (ORDER BY c_custkey) AS VARCHAR) "
        "AS internal_client_id, c_name AS client_name FROM customer"
    )
    o["synth_clients"] = _synthetic(
        f"(SELECT list(c_name ORDER BY c_custkey) FROM customer)[{_pick(1, '(SELECT count(*) FROM customer)')} + 1]"
    )
    return o


def oracle_sql() -> dict[str, str]:
    return _build()
