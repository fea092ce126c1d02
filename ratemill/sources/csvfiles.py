"""CSV files in and out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BILLING, BILLING_HEADER, CLIENTS_HEADER, REJECTS_HEADER, RULES_HEADER
from ..session import checkpointed, shared_dir

# Texts that stand for a missing value in the files to be read
# (the documented defaults of the common CSV reader in Python).
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


#: The raw text of a line with more or fewer fields than the header, else NULL.
_LINE = "_line"

#: The position of a billing line over all files, from 1, rejected lines counted.
LINE_NUMBER = "line_number"


def _read_text(
    spark: SparkSession, path: str, header: dict[str, str], multi_line: bool, strict: bool = True
):
    """The named columns as text, found by header name and not by position.

    Nothing is inferred from the values: an item ``01001`` stays as it is
    whatever else is in the file. Missing-value texts become NULL. Files may have their columns
    in different orders, and further columns: files with the same header are read together.
    A file without one of the columns fails the job.
    A line with more or fewer fields than its header does too if ``strict``, and
    otherwise has its text in ``_line``.
    """
    groups = _files_by_header(spark, path)
    paths = [path] if len(groups) < 2 else groups.values()
    return reduce(
        DataFrame.unionByName,
        (_read_same_header(spark, p, header, multi_line, strict) for p in paths),
    )


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their first line; files without one are left out.

    Only first lines are read, some files at a time, as file names are listed on the driver too.
    """
    uris = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda uri: _first_line(spark, uri), uris))
    groups: dict[str, list[str]] = {}
    for name, line in sorted(lines):
        if line is not None:
            groups.setdefault(line, []).append(name)
    return groups


def _first_line(spark: SparkSession, uri: str) -> tuple[str, str | None]:
    """Name and first line of a file, which may be compressed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    name = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = name.getFileSystem(conf).open(name)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(name)
    try:
        text = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
        return name.toString(), reader.readLine()
    finally:
        stream.close()


def _read_same_header(
    spark: SparkSession, path: str | list[str], header: dict[str, str], multi_line: bool, strict: bool
):
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    names = reader.csv(path if isinstance(path, str) else path[0]).columns
    absent = [name for name in header if name not in names]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _LINE]])
    raw = (
        reader.schema(schema)
        .options(
            enforceSchema=False,
            # Fields can be counted only where all of them are parsed.
            columnPruning=False,
            mode="FAILFAST" if strict else "PERMISSIVE",
            columnNameOfCorruptRecord=_LINE,
        )
        .csv(path)
    )
    return raw.select(
        *(
            F.when(~F.col(f"`{outer}`").isin(MISSING_TEXTS), F.col(f"`{outer}`")).alias(inner)
            for outer, inner in header.items()
        ),
        _LINE,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )


def read_billing_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Billing lines as text, with ``reject_reason`` (NULL for good lines) and ``raw_line``.

    A line is rejected if its number of fields is not the header's, or if its
    units or date are there but cannot be read. ``raw_line`` is the text of the former.
    """
    return _billing_text(spark, path, multi_line).drop("_file", "_start")


def _billing_text(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    text = _read_text(spark, path, BILLING_HEADER, multi_line, strict=False)
    reason = F.when(F.col(_LINE).isNotNull(), "fields")
    for field in BILLING:
        if not isinstance(field.dataType, T.StringType):
            value = F.col(field.name)
            unreadable = value.isNotNull() & value.try_cast(field.dataType).isNull()
            reason = reason.when(unreadable, field.name)
    return text.select(
        *BILLING_HEADER.values(),
        reason.alias("reject_reason"),
        F.col(_LINE).alias("raw_line"),
        "_file",
        "_start",
    )


def typed_billing(text: DataFrame) -> DataFrame:
    """Billing lines in the layout of ``schemas.BILLING``; rejected lines left out."""
    return _typed(text.filter("reject_reason IS NULL"))


def _typed(text: DataFrame) -> DataFrame:
    number = [LINE_NUMBER] if LINE_NUMBER in text.columns else []
    return text.select(
        *number, *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in BILLING)
    )


def rejected_billing(text: DataFrame) -> DataFrame:
    """Rejected lines as text, with the reason; they are reported and never billed as 0."""
    return text.filter("reject_reason IS NOT NULL")


def read_billing(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    rejects: str | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Billing lines from CSV with a header.

    A line that cannot be read fails the job, unless ``rejects`` names a folder:
    then such lines are written there as CSV, with reason and raw text, and the others
    are returned. The files are parsed once, into the shared folder, for both.
    With ``numbered`` the lines have their ``line_number`` in file order.

    ``multi_line`` is needed only for quoted line breaks; such files cannot be
    split between tasks.
    """
    text = _billing_text(spark, path, multi_line)
    reason = F.col("reject_reason")
    if rejects is None:
        found = F.concat_ws(" ", F.lit("billing line rejected:"), reason, *BILLING_HEADER.values())
        failed = F.raise_error(F.concat_ws(" ", found, "raw_line")).cast("boolean")
        good = text.filter(F.when(reason.isNotNull(), failed).otherwise(True))
        return _typed(number_in_file_order(good, LINE_NUMBER) if numbered else good)
    routed = shared_dir(spark)
    rows = text.withColumns({"rejected": reason.isNotNull(), "_id": F.monotonically_increasing_id()})
    rows.write.partitionBy("rejected").parquet(routed)
    saved = spark.read.schema(rows.schema).parquet(routed)
    write_csv(rejected_billing(saved.filter("rejected")), rejects, REJECTS_HEADER)
    if numbered:
        saved = _numbered(saved, LINE_NUMBER)
    return _typed(saved.filter("NOT rejected"))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines that ``read_billing`` has written, as text."""
    header = {outer: inner for inner, outer in REJECTS_HEADER.items()}
    return _read_text(spark, path, header, False).select(*REJECTS_HEADER)


def read_billing_parquet(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Billing lines from parquet under the column names of ``schemas.BILLING``.

    With ``numbered`` the lines have their ``line_number`` by file name and place in the file. A parquet
    row knows its place, so nothing is saved or sorted; the rows before each file come from one count per file.
    """
    lines = spark.read.schema(BILLING).parquet(path)
    if not numbered:
        return lines
    places = lines.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.lit(0).alias("_start"),
        F.col("_metadata.row_index").alias("_id"),
    )
    return _numbered(places, LINE_NUMBER)


def read_rules(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Rules from CSV; ``rule_id`` is the position in the file, from 1."""
    text = _read_text(spark, path, RULES_HEADER, multi_line)
    return number_in_file_order(text, "rule_id").select("rule_id", *RULES_HEADER.values())


def read_clients(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Client map from CSV; ``seq`` is the position in the file, from 1."""
    text = _read_text(spark, path, CLIENTS_HEADER, multi_line)
    return number_in_file_order(text, "seq").select("seq", *CLIENTS_HEADER.values())


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows for a reference table from CSV under the table's column names, with ``seq``."""
    fields = [f for f in schema if f.name not in ("seq", "rule_id")]
    text = _read_text(spark, path, {f.name: f.name for f in fields}, False)
    return number_in_file_order(text, "seq").select(
        "seq", *(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields)
    )


def number_in_file_order(rows: DataFrame, as_name: str) -> DataFrame:
    """Number rows 1, 2, … by file name and position, without sorting them.

    Every task numbers the rows of its file splits; the rows before each split
    are counted from one summary row per split. Only that summary, whose
    length is the number of splits, goes through a window.

    Splits depend on the cores at hand, which may change between two reads,
    so the rows are saved with their split before they are counted.
    """
    return _numbered(
        checkpointed(rows.withColumn("_id", F.monotonically_increasing_id())), as_name
    )


def _numbered(numbered: DataFrame, as_name: str) -> DataFrame:
    """Positions from saved rows that have their split and the id they were given in it."""
    splits = numbered.groupBy("_file", "_start").agg(
        F.count("*").alias("_rows"), F.min("_id").alias("_first")
    )
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_file",
        "_start",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return (
        numbered.join(offsets, ["_file", "_start"])
        .withColumn(as_name, F.col("_id") + F.col("_shift"))
        .drop(_LINE, "_file", "_start", "_id", "_shift")
    )


def number_text(value: Column) -> Column:
    """A double in positional notation (``12345678.0``, not ``1.2345678E7``); NaN is missing.

    The digits are those of the double's own text, with the point moved, so it
    reads back as the same double. Most doubles have no exponent; only texts with one are taken apart,
    since that costs far more than all else that is done to a row.
    """
    text = value.cast("string")
    shape = r"^-?([0-9]+)\.([0-9]+)E(-?[0-9]+)$"
    whole, part = (F.regexp_extract(text, shape, n) for n in (1, 2))
    exponent = F.regexp_extract(text, shape, 3).try_cast("int")
    digits = F.when(part == "0", whole).otherwise(F.concat(whole, part))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    places = F.greatest(exponent + 1, F.length(digits))
    padded = F.rpad(digits, F.greatest(places, exponent + 2), F.lit("0"))
    large = F.concat(
        F.substring(padded, F.lit(1), exponent + 1),
        F.lit("."),
        F.substring(padded, exponent + 2, places),
    )
    moved = F.concat(
        F.when(text.startswith("-"), "-").otherwise(""),
        F.when(exponent < 0, small).otherwise(large),
    )
    return F.when(F.isnan(value), None).when(~F.contains(text, F.lit("E")), text).otherwise(moved)


def write_csv(
    df: DataFrame, path: str, header: dict[str, str], compression: str = "none"
) -> None:
    """Write the columns of ``header`` under their outer names, one file per task.

    The files' names are in row order, and each has the header. Missing values
    and empty texts are both written as nothing. ``compression`` is Spark's name of a codec, such as ``gzip``.
    """
    columns = []
    for inner, outer in header.items():
        column = F.col(inner)
        if isinstance(df.schema[inner].dataType, T.DoubleType):
            column = number_text(column)
        columns.append(column.alias(outer))
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("compression", compression)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_sheet(spark: SparkSession, path: str, header: dict[str, str]) -> DataFrame:
    """A written sheet under its inner column names, typed."""
    types = {"line_order": "int", "qty": "double", "price": "double", "total_value": "double"}
    text = _read_text(spark, path, {outer: inner for inner, outer in header.items()}, False)
    return text.select(*(F.col(c).cast(types.get(c, "string")).alias(c) for c in header))
