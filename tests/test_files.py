from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratemill import cli, schemas
from ratemill.operators import synth
from ratemill.sources import csvfiles

from .seeds import CUSTOMERS, ITEMS, LEVELS, PRICES, RULES, RULES_FILE, rows

HEADER = "Customer,Item,Location,State,County,Type,Units,billing_date\n"


def put(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def text_of(folder) -> list[str]:
    """The rows of all part files in name order, the header once."""
    lines: list[str] = []
    for part in sorted(Path(folder).glob("part-*")):
        found = part.read_text(encoding="utf-8").splitlines()
        lines += found if not lines else found[1:]
    return lines


def test_billing_from_csv(spark, tmp_path):
    path = put(
        tmp_path / "b.csv",
        HEADER
        + '"Acme, ""the"" Inc",01001,P1,CA,County X,A,3,2026-05-01\n'
        + "NA,1002,P1,,None,n/a,2.5,2026-05-02\n"
        + " Beta ,nan,P1,NY,X,A,,\n",
    )
    lines = csvfiles.read_billing(spark, path)
    assert lines.schema.simpleString() == schemas.BILLING.simpleString()
    assert rows(lines, *lines.columns) == sorted(
        [
            ('Acme, "the" Inc', "01001", "P1", "CA", "County X", "A", 3.0, date(2026, 5, 1)),
            (None, "1002", "P1", None, None, None, 2.5, date(2026, 5, 2)),
            (" Beta ", None, "P1", "NY", "X", "A", None, None),
        ],
        key=repr,
    )


def test_columns_are_found_by_name(spark, tmp_path):
    path = put(
        tmp_path / "b.csv",
        "billing_date,Extra,Units,Type,County,State,Location,Item,Customer\n"
        "2026-05-01,x,2,A,X,CA,P1,7,Acme\n",
    )
    row = csvfiles.read_billing(spark, path).first()
    assert (row.customer, row.item, row.units) == ("Acme", "7", 2.0)


def test_missing_column(spark, tmp_path):
    path = put(tmp_path / "b.csv", "Customer,Item\nAcme,1\n")
    try:
        csvfiles.read_billing(spark, path)
    except ValueError as error:
        assert "Location" in str(error)
    else:
        raise AssertionError("no error")


def test_unreadable_numbers_are_rejected_not_zero(spark, tmp_path):
    path = put(
        tmp_path / "b.csv",
        HEADER + "A,1,P,CA,X,A,zz,2026-05-01\nB,1,P,CA,X,A,1,soon\nC,1,P,CA,X,A,1,2026-05-01\n",
    )
    text = csvfiles.read_billing_text(spark, path)
    assert rows(csvfiles.rejected_billing(text), "customer", "units") == [("A", "zz"), ("B", "1")]
    kept = csvfiles.typed_billing(text)
    assert rows(kept.filter("units >= 0"), "customer") == [("C",)]


def _fails(run, *words):
    try:
        run()
    except Exception as error:
        assert all(word in str(error) for word in words), str(error)[:2000]
    else:
        raise AssertionError("no error")


GOOD = "C,1,P,CA,X,A,1,2026-05-01\n"


def test_short_and_long_lines_are_rejected(spark, tmp_path):
    path = put(
        tmp_path / "b.csv",
        HEADER + "S,1,P,CA\nL,1,P,CA,X,A,1,2026-05-01,more\nU,1,P,CA,X,A,zz,2026-05-01\n" + GOOD,
    )
    folder = str(tmp_path / "rejects")
    kept = csvfiles.read_billing(spark, path, rejects=folder)
    assert rows(kept, "customer", "units") == [("C", 1.0)]
    assert rows(csvfiles.read_rejects(spark, folder), "customer", "reject_reason", "raw_line") == [
        ("L", "fields", "L,1,P,CA,X,A,1,2026-05-01,more"),
        ("S", "fields", "S,1,P,CA"),
        ("U", "units", None),
    ]


def test_a_rejected_line_fails_a_read_without_rejects(spark, tmp_path):
    for n, line in enumerate(["S,1,P,CA\n", "L,1,P,CA,X,A,1,2026-05-01,more\n", "U,1,P,CA,X,A,z,\n"]):
        path = put(tmp_path / f"{n}.csv", HEADER + line + GOOD)
        lines = csvfiles.read_billing(spark, path)
        _fails(lambda: lines.select("customer").collect(), "billing line rejected")


def test_no_rejects_and_no_lines(spark, tmp_path):
    for n, lines in enumerate(["", GOOD]):
        path, folder = put(tmp_path / f"{n}.csv", HEADER + lines), str(tmp_path / f"r{n}")
        assert csvfiles.read_billing(spark, path, rejects=folder).count() == n


def test_files_with_other_column_order_are_read(spark, tmp_path):
    put(tmp_path / "b" / "1.csv", HEADER + GOOD)
    swapped = GOOD.split(",")
    swapped = ",".join([swapped[1], swapped[0], *swapped[2:]])
    put(tmp_path / "b" / "2.csv", HEADER.replace("Customer,Item", "Item,Customer") + swapped)
    one, two = csvfiles.read_billing(spark, str(tmp_path / "b")).collect()
    assert one == two


def test_rated_lines_keep_the_order_of_the_files(spark, tmp_path):
    """Several files and splits; rejected lines are counted in the numbers."""
    total = 0
    for name, size in (("a", 100), ("b", 900)):
        numbers = range(total, total + size)
        total += size
        lines = [f"C{n},{n},P,CA,X,A,{'oops' if n % 50 == 7 else 1},2026-05-01\n" for n in numbers]
        put(tmp_path / "b" / f"{name}.csv", HEADER + "".join(lines))
    rules = put(tmp_path / "r.csv", "Customer,County,Type,Price_Level_Name\nDEFAULT,ANY,ANY,L\n")
    good = [n for n in range(total) if n % 50 != 7]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        kept = csvfiles.read_billing(
            spark, str(tmp_path / "b"), rejects=str(tmp_path / "lost"), numbered=True
        )
        assert sorted((r.line_number, r.item) for r in kept.collect()) == [
            (n + 1, str(n)) for n in good
        ]
        argv = ["rated-lines", "--rules", rules, "--billing", tmp_path / "b", "--out", tmp_path / "o"]
        cli.main([str(a) for a in argv], spark)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [line.split(",")[1] for line in text_of(tmp_path / "o")[1:]] == [str(n) for n in good]


def test_rules_with_broken_lines_fail(spark, tmp_path):
    for n, line in enumerate(["C,ANY,ANY\n", "C,ANY,ANY,L,more\n"]):
        path = put(tmp_path / f"{n}.csv", "Customer,County,Type,Price_Level_Name\n" + line)
        _fails(lambda: csvfiles.read_rules(spark, path).collect(), "MALFORMED")


def test_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path / "b.csv", HEADER + '"A\nB",1,P,CA,X,A,1,2026-05-01\n')
    row = csvfiles.read_billing(spark, path, multi_line=True).first()
    assert row.customer == "A\nB"


def test_rules_are_numbered_in_file_order(spark, tmp_path):
    for part, start in (("a", 0), ("b", 40), ("c", 41)):
        stop = {"a": 40, "b": 41, "c": 300}[part]
        put(
            tmp_path / "rules" / f"{part}.csv",
            "Customer,County,Type,Price_Level_Name\n"
            + "".join(f"C{n},ANY,ANY,L{n}\n" for n in range(start, stop)),
        )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many splits per file
    try:
        found = csvfiles.read_rules(spark, str(tmp_path / "rules")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.rule_id, r.price_level_name) for r in found) == [
        (n + 1, f"L{n}") for n in range(300)
    ]


def test_numbers_as_text(spark):
    cases = [
        (1.0, "1.0"), (0.1, "0.1"), (12345678.0, "12345678.0"), (1234567890.125, "1234567890.125"),
        (-98765432.1, "-98765432.1"), (0.001, "0.001"), (0.0, "0.0"), (None, None),
        (123456789012345.6, "123456789012345.6"),
    ]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v double")
    found = df.select("i", csvfiles.number_text(F.col("v")).alias("t")).orderBy("i").collect()
    assert [r.t for r in found] == [t for _, t in cases]
    assert all(t is None or repr(v) == t for v, t in cases)


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame(
        [('Acme, "the" Inc', None, 12345678.0), (" pad ", "", 0.5)],
        "customer string, item string, qty double",
    )
    out = tmp_path / "out"
    header = {"customer": "Customer", "item": "Item", "qty": "Qty"}
    csvfiles.write_csv(df.orderBy("qty"), str(out), header)
    assert text_of(out) == ["Customer,Item,Qty", " pad ,,0.5", '"Acme, ""the"" Inc",,12345678.0']


def test_synthetic_lines_depend_on_the_id_only(spark):
    clients = ["Client 0", "Client 1", "Client 2"]
    ids = spark.range(3000)
    table = synth.made_up_clients(spark.range(3))
    one = synth.synthetic_billing(ids, table, date(2026, 5, 31))
    two = synth.synthetic_billing(ids.repartition(7), table, date(2026, 5, 31))
    assert rows(one, *one.columns) == rows(two, *two.columns)
    assert one.schema.simpleString() == schemas.BILLING.simpleString()
    for column, values in {"customer": clients, **synth.CHOICES}.items():
        counts = {r[0]: r[1] for r in one.groupBy(column).count().collect()}
        assert set(counts) == set(values)
        assert min(counts.values()) > 0.8 * 3000 / len(values), counts
    row = one.agg(F.min("units"), F.max("units"), F.min("billing_date"), F.max("billing_date")).first()
    assert tuple(row) == (1.0, 10.0, date(2026, 5, 6), date(2026, 5, 31))


def _csv(names, table):
    return "\n".join([names, *(",".join(f'"{v}"' for v in row) for row in table)]) + "\n"


def test_command_line(spark, tmp_path, capsys):
    run = lambda *argv: cli.main([str(a) for a in argv], spark)
    seeds, store = tmp_path / "seeds", tmp_path / "store"
    put(seeds / "customers_db.csv", _csv("customer_name,netsuite_id", CUSTOMERS))
    put(seeds / "items_db.csv", _csv("item_code,netsuite_internal_id,line_order", ITEMS))
    put(seeds / "price_levels_db.csv", _csv("price_level_name,netsuite_internal_id_pl", LEVELS))
    put(seeds / "price_level_rules.csv", _csv("customer_name,county,type,price_level_name", RULES))
    put(seeds / "prices_db.csv", _csv("customer_name,item_code,price_level_name,price", PRICES))
    rules = put(
        tmp_path / "rules.csv", _csv("Customer,County,Type,Price_Level_Name", RULES_FILE)
    )
    billing = put(
        tmp_path / "b.csv",
        HEADER + "Johnson-Clark,1001,P,CA,County X,A,4,2026-05-01\n"
        "Johnson-Clark,1001,P,CA,County Y,A,1,2026-05-01\n"
        "Johnson-Clark,1001,P,CA,County Y,A,oops,2026-05-01\n",
    )
    run("build-store", "--store", store, "--seeds", seeds)
    run("check", "--store", store)
    run("sheet", "--store", store, "--billing", billing, "--out", tmp_path / "sheet")
    assert "1 lines with unreadable" in capsys.readouterr().out
    lost = csvfiles.read_rejects(spark, f"{tmp_path}/sheet-rejects")
    assert rows(lost, "units", "reject_reason") == [("oops", "units")]
    assert text_of(tmp_path / "sheet") == [
        ",".join(schemas.SHEET_HEADER.values()),
        "0526-J,5/31/2026,Johnson-Clark,1001,1,YES,1.0,Base Price,NS-CUST-9902,NS-ITEM-101,"
        "Net 15,6/15/2026,100.0,100.0",
        "0526-J,5/31/2026,Johnson-Clark,1001,1,YES,4.0,JC-CX-TypeA,NS-CUST-9902,NS-ITEM-101,"
        "Net 15,6/15/2026,110.0,440.0",
    ]
    run("prototype", "--rules", rules, "--billing", billing, "--out", tmp_path / "proto")
    assert len(text_of(tmp_path / "proto")) == 3
    run("rated-lines", "--rules", rules, "--billing", billing, "--out", tmp_path / "rated")
    lines = text_of(tmp_path / "rated")
    assert lines[0] == ",".join(schemas.RATED_HEADER.values())
    assert lines[1].endswith(",JC-CX-TypeA,YES")
    run("load-rules", "--store", store, "--rules", rules)
    run("synth", "--rows", 20, "--out", tmp_path / "synth")
    again = csvfiles.read_billing(spark, str(tmp_path / "synth" / "raw_billing"))
    assert again.count() == 20
    clients = csvfiles.read_clients(spark, str(tmp_path / "synth" / "client_mappings"))
    assert clients.orderBy("seq").first().internal_client_id == "CLI-100"


def test_number_text_keeps_every_double(spark):
    """Doubles of all magnitudes, in positional notation, read back as the same bits."""
    import random
    import struct

    rnd = random.Random(4)
    values = [struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(2000)]
    values += [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 18) for _ in range(2000)]
    values += [0.0012345678901234567, 0.00012345678901234567, 1e7, 1.5e16, 123456789.125, -0.0, 0.0]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", csvfiles.number_text(F.col("v")).alias("t")).collect()
    for v, t in rows:
        assert struct.pack("<d", float(t)) == struct.pack("<d", v), (v, t)
        assert "E" not in t and "." in t
    nan = spark.range(1).select(csvfiles.number_text(F.lit(float("nan"))))
    assert nan.first()[0] is None


def test_doubles_without_exponent_are_not_taken_apart(spark):
    """Writing plain doubles costs little more than their own text."""
    import time

    def seconds(text):
        taken = []
        for _ in range(3):
            start = time.perf_counter()
            rows = spark.range(0, 400_000, 1, 4).select((F.col("id") * 0.37).alias("v"))
            rows.agg(F.sum(F.length(text(F.col("v"))))).collect()
            taken.append(time.perf_counter() - start)
        return min(taken)

    assert seconds(csvfiles.number_text) < 3 * seconds(lambda v: v.cast("string")) + 0.3


# --- files of different layouts, positions ----------------------------------


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_files_with_columns_in_another_order(spark, tmp_path):
    """Two orders, a further column, an empty file and one with the header only."""
    folder = tmp_path / "lines"
    _write(folder, "b c.csv", [
        "Units,Item,Customer,Location,State,County,Type,billing_date,Note",
        "3,01001,Acme,P,CA,X,A,2026-05-01,n", "4,1002,Acme,P,CA,X,A,2026-05-02",
    ])
    _write(folder, "a.csv", [
        "Customer,Item,Location,State,County,Type,Units,billing_date",
        "Beta,1001,P,NY,X,B,1,2026-05-01", "Beta,1002,P,NY,X,B,two,2026-05-01", "Beta,1003,P,NY,X,B,5,2026-05-01",
    ])
    _write(folder, "c.csv", ["Customer,Item,Location,State,County,Type,Units,billing_date"])
    (folder / "d.csv").write_text("")
    found = csvfiles.read_billing(spark, str(folder), rejects=str(tmp_path / "rejects"), numbered=True)
    lines = [(r["line_number"], r["customer"], r["item"], r["units"]) for r in found.orderBy("line_number").collect()]
    assert lines == [(1, "Beta", "1001", 1.0), (3, "Beta", "1003", 5.0), (4, "Acme", "01001", 3.0)]
    lost = {(r["item"], r["reject_reason"]) for r in csvfiles.read_rejects(spark, str(tmp_path / "rejects")).collect()}
    assert lost == {("1002", "units"), ("1002", "fields")}


def test_a_file_without_a_column_fails(spark, tmp_path):
    _write(tmp_path / "lines", "a.csv", ["Customer,Item,Location,State,County,Type,Units,billing_date", "B,1,P,NY,X,B,1,2026-05-01"])
    _write(tmp_path / "lines", "b.csv", ["Customer,Item", "B,1"])
    with pytest.raises(ValueError, match="no column"):
        csvfiles.read_billing(spark, str(tmp_path / "lines"))


def test_headers_of_compressed_files(spark, tmp_path):
    import gzip

    (tmp_path / "rules").mkdir()
    for name, text in (("a", "Customer,County,Type,Price_Level_Name\nA,ANY,ANY,L1\n"), ("b", "Type,County,Customer,Price_Level_Name\nT,C,B,L2\n")):
        (tmp_path / "rules" / f"{name}.csv.gz").write_bytes(gzip.compress(text.encode()))
    rows_ = [tuple(r) for r in csvfiles.read_rules(spark, str(tmp_path / "rules")).orderBy("rule_id").collect()]
    assert rows_ == [(1, "A", "ANY", "ANY", "L1"), (2, "B", "C", "T", "L2")]


def test_lines_from_parquet_keep_the_order_of_their_files(spark, tmp_path):
    path, out = str(tmp_path / "lines.parquet"), str(tmp_path / "out")
    lines = spark.range(1000).selectExpr(
        "'DEFAULT' AS customer", "CAST(id AS STRING) AS item", "'P' AS location", "'CA' AS state",
        "'X' AS county", "'A' AS type", "CAST(id AS DOUBLE) AS units", "DATE'2026-05-01' AS billing_date",
    )
    lines.repartition(7).write.parquet(path)
    import pyarrow.parquet as pq

    expected = [x for f in sorted((tmp_path / "lines.parquet").glob("*.parquet")) for x in pq.read_table(f)["item"].to_pylist()]
    found = csvfiles.read_billing_parquet(spark, path, numbered=True).orderBy("line_number").collect()
    assert [r["line_number"] for r in found] == list(range(1, 1001))
    assert [r["item"] for r in found] == expected
    _write(tmp_path, "rules.csv", ["Customer,County,Type,Price_Level_Name", "DEFAULT,ANY,ANY,L"])
    cli.main(["rated-lines", "--rules", str(tmp_path / "rules.csv"), "--billing", path, "--out", out], spark)
    written = [
        line.split(",")[1]
        for f in sorted((tmp_path / "out").glob("part-*.csv"))
        for line in f.read_text().splitlines()[1:]
    ]
    assert written == expected


def test_positions(spark):
    from pyspark.sql import functions as F

    from ratemill.operators.order import with_positions

    rows_ = spark.range(5000).select(F.pmod(F.col("id") * 7919, F.lit(5000)).alias("x"), F.lit("hot").alias("k"))
    found = with_positions(rows_, [F.col("k"), F.col("x")], "position")
    assert [r["x"] + 1 for r in found.collect()] == [r["position"] for r in found.collect()]
    assert found.columns == ["x", "k", "position"]
    assert with_positions(rows_.where("false"), [F.col("x")], "position").collect() == []
    # A value that all rows share is spread, as the next column tells them apart.
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = with_positions(rows_, [F.col("k"), F.col("x")], "position")
        sizes = [r["count"] for r in again.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
