"""Reference tables at rest.

A reference store is a folder with data folders that are never changed once written, and
numbered commit files that say which of them make up each table of ``TABLES``:

    <store>/data/<id>/<table>/*.parquet
    <store>/commits/00000000000000000012.json

The commit with the highest number is the store. A change writes its data first and then its
commit, in one rename that fails if another commit has taken the number. So readers see a change whole or not
at all, a job that dies before its commit leaves the store as it was, and of two changes made at a time one
fails with ``ConcurrentChange``. A DataFrame that has been read keeps its files until ``remove_unused``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.lookups import stored_keys
from ..plans.sheet import ReferenceTables

TABLES = {
    "customers_db": schemas.CUSTOMERS,
    "items_db": schemas.ITEMS,
    "price_levels_db": schemas.PRICE_LEVELS,
    "price_level_rules": schemas.RULES,
    "prices_db": schemas.PRICES,
}


class ConcurrentChange(RuntimeError):
    """Another change was committed since the store was read."""


@dataclass(frozen=True)
class Commit:
    """What a store holds: data folders by table, the highest rule id ever given, and the loads that were made."""

    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    last_rule_id: int = 0
    loads: tuple[str, ...] = ()
    #: Number of buckets of the folders that are bucketed and sorted by normalised key.
    buckets: dict[str, int] = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _commit_path(location: str, number: int) -> str:
    return f"{location.rstrip('/')}/commits/{number:020d}.json"


def _commit_numbers(spark: SparkSession, location: str) -> list[int]:
    folder = f"{location.rstrip('/')}/commits"
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, location: str, number: int) -> Commit:
    path = _commit_path(location, number)
    stream = _files(spark, path).open(_path(spark, path))
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    saved = json.loads(text)
    return Commit(**saved | {"loads": tuple(saved["loads"])})


def current(spark: SparkSession, location: str) -> Commit:
    """The store as it is now; an empty one with number 0 where there is none."""
    numbers = _commit_numbers(spark, location)
    return _load(spark, location, numbers[-1]) if numbers else Commit()


def publish(spark: SparkSession, location: str, commit: Commit) -> Commit:
    """Make ``commit``, based on the commit with its number, the store's next one."""
    following = replace(commit, number=commit.number + 1)
    target = _commit_path(location, following.number)
    draft = f"{target}.{uuid.uuid4().hex}"
    files = _files(spark, draft)
    out = files.create(_path(spark, draft), False)
    try:
        out.write(json.dumps(asdict(following)).encode())
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    qualified = [files.makeQualified(_path(spark, p)) for p in (draft, target)]
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(*qualified, options)
    except Exception as error:
        files.delete(_path(spark, draft), False)
        if files.exists(_path(spark, target)):
            raise ConcurrentChange(f"{location} has a commit {following.number} already") from error
        raise
    return following


def new_folder(location: str) -> str:
    """A data folder that no commit names yet."""
    return f"{location.rstrip('/')}/data/{uuid.uuid4().hex}"


def _in_layout(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*(rows[f.name].cast(f.dataType) for f in TABLES[name]))


def write_table(rows: DataFrame, folder: str, name: str) -> str:
    """Write rows of a table in its layout below ``folder``; the path that a commit can name."""
    path = f"{folder}/{name}"
    _in_layout(rows, name).write.parquet(path)
    return path


def write_bucketed(rows: DataFrame, folder: str, name: str, buckets: int) -> str:
    """The same with the table's normalised keys as columns, bucketed and sorted by them.

    Joins and groupings by these keys then leave the stored side where it is. The catalog knows the
    table while it is written only; ``read_folders`` makes it known again from the commit.
    """
    path, keys = f"{folder}/{name}", stored_keys(name)
    keyed = _in_layout(rows, name).withColumns(keys)
    table = _catalog_name(path)
    # As many tasks as buckets, so that a bucket is one file.
    dealt = keyed.repartition(buckets, *keys)
    dealt.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    rows.sparkSession.sql(f"DROP TABLE {table}")
    return path


def _catalog_name(path: str) -> str:
    return f"ratemill_{md5(path.encode()).hexdigest()}"


def read_folders(
    spark: SparkSession, name: str, folders: list[str], buckets: dict[str, int] | None = None
) -> DataFrame:
    """The rows in these folders; a single bucketed one has its key columns besides and its buckets are used."""
    n = (buckets or {}).get(folders[0]) if len(folders) == 1 else None
    if not n:
        return spark.read.schema(TABLES[name]).parquet(*folders)
    table, keys = _catalog_name(folders[0]), ", ".join(stored_keys(name))
    columns = ", ".join([TABLES[name].toDDL(), *(f"{k} STRING" for k in stored_keys(name))])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {n} BUCKETS LOCATION '{folders[0]}'"
    )
    return spark.table(table)


def create_tables(spark: SparkSession, location: str) -> Commit:
    """Commit five empty tables; what was there before is no longer part of the store."""
    folder = new_folder(location)
    tables = {n: [write_table(spark.createDataFrame([], s), folder, n)] for n, s in TABLES.items()}
    return publish(spark, location, Commit(current(spark, location).number, tables))


def read_table(spark: SparkSession, location: str, name: str) -> DataFrame:
    commit = current(spark, location)
    if name not in commit.tables:
        raise FileNotFoundError(f"{location} is no reference store with a table {name}")
    return read_folders(spark, name, commit.tables[name], commit.buckets)


def append_rows(rows: DataFrame, location: str, name: str) -> Commit:
    """Add rows to a table, all or none of them."""
    spark = rows.sparkSession
    before = current(spark, location)
    return _changed(spark, location, before, name, [*before.tables[name], write_table(rows, new_folder(location), name)])


def replace_rows(rows: DataFrame, location: str, name: str) -> Commit:
    """Give a table other rows, which may be made from its present ones."""
    spark = rows.sparkSession
    before = current(spark, location)
    return _changed(spark, location, before, name, [write_table(rows, new_folder(location), name)])


def _changed(
    spark: SparkSession, location: str, before: Commit, name: str, folders: list[str], **others
) -> Commit:
    """Commit other folders of a table; rule ids that are there count as given."""
    if name == "price_level_rules":
        last = highest_rule_id(read_folders(spark, name, folders[-1:]))
        others["last_rule_id"] = max(before.last_rule_id, last)
    return publish(spark, location, replace(before, tables=before.tables | {name: folders}, **others))


def append_load(rows: DataFrame, location: str, before: Commit, load_id: str | None) -> Commit:
    """Add rules to the store as it was at ``before``, and remember the load."""
    spark, name = rows.sparkSession, "price_level_rules"
    folders = [*before.tables[name], write_table(rows, new_folder(location), name)]
    loads = before.loads if load_id is None else (*before.loads, load_id)
    return _changed(spark, location, before, name, folders, loads=loads)


def highest_rule_id(rules: DataFrame) -> int:
    return rules.agg(F.max("rule_id")).first()[0] or 0


def remove_unused(spark: SparkSession, location: str, keep: int = 1) -> list[str]:
    """Delete data folders that none of the last ``keep`` commits names, and the older commits; what was deleted.

    Results that were read from older commits fail afterwards, and so does a change that is being written.
    """
    numbers = _commit_numbers(spark, location)
    used = {
        folder.rstrip("/").split("/")[-2]
        for n in numbers[-keep:]
        for folders in _load(spark, location, n).tables.values()
        for folder in folders
    }
    gone = [_commit_path(location, n) for n in numbers[:-keep]]
    data = f"{location.rstrip('/')}/data"
    files = _files(spark, data)
    if files.exists(_path(spark, data)):
        found = [status.getPath().getName() for status in files.listStatus(_path(spark, data))]
        gone += [f"{data}/{name}" for name in sorted(found) if name not in used]
    for path in gone:
        files.delete(_path(spark, path), True)
    return gone


def register_tables(spark: SparkSession, location: str, database: str) -> None:
    """Make the tables, as they are now, known to the catalog as views, for SQL users."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, folders in current(spark, location).tables.items():
        columns = ", ".join(TABLES[name].names)
        parts = [f"SELECT {columns} FROM parquet.`{folder}`" for folder in folders]
        try:
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {' UNION ALL '.join(parts)}")
        except AnalysisException as error:
            raise RuntimeError(f"{database}.{name} is there and no view") from error


def read_reference(spark: SparkSession, location: str) -> ReferenceTables:
    """The four tables the sheet needs, from one commit of a reference store."""
    commit = current(spark, location)
    if not commit.tables:
        raise FileNotFoundError(f"{location} is no reference store")
    names = ("price_level_rules", "customers_db", "items_db", "prices_db")
    return ReferenceTables(
        *(read_folders(spark, name, commit.tables[name], commit.buckets) for name in names)
    )


def read_reference_catalog(spark: SparkSession, database: str) -> ReferenceTables:
    """The same from catalog tables."""
    return ReferenceTables(
        rules=spark.table(f"{database}.price_level_rules"),
        customers=spark.table(f"{database}.customers_db"),
        items=spark.table(f"{database}.items_db"),
        prices=spark.table(f"{database}.prices_db"),
    )
