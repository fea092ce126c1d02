"""Session settings and the place for intermediate files."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of the input's files for each partition a shuffle starts with, and most bytes of a shuffle partition
#: after coalescing and of a scan's. Shuffled bytes are compressed; in memory rows take many times as much.
SHUFFLED_BYTES = 4 << 20
ADVISORY_BYTES = 8 << 20
SCANNED_BYTES = 32 << 20

#: Least bytes of a shuffle partition that adaptive execution splits if it is five times as large as the median.
SKEWED_BYTES = 64 << 20


def build_session(app_name: str = "ratemill", **settings: str) -> SparkSession:
    """A session for this package; ``settings`` override or add configuration."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # HotSpot does not compile methods above 8000 bytes; without generated
        # code they are at least compiled operator by operator.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # A table bucketed by some of the join's keys stays where it is.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **settings,
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_partitions(spark: SparkSession, paths: list[str]) -> None:
    """Have the session's partitions grow in number with the files at ``paths``, not in size.

    Sorts and aggregates of a task hold its partition, and under adaptive execution partitions grow until they
    reach the advisory size or their first number. The first number follows the input, the advisory size and
    that of scans are lowered; settings that are finer already stay.
    """
    conf = spark.conf
    hadoop = spark._jsc.hadoopConfiguration()
    total = 0
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        files = path.getFileSystem(hadoop)
        total += files.getContentSummary(path).getLength() if files.exists(path) else 0
    first = max(int(conf.get("spark.sql.shuffle.partitions")), -(-total // SHUFFLED_BYTES))
    conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in (
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", ADVISORY_BYTES),
        ("spark.sql.files.maxPartitionBytes", SCANNED_BYTES),
    ):
        conf.set(key, str(min(as_bytes(conf.get(key)), most)))


def share_shuffles(spark: SparkSession) -> None:
    """Have steps of the session whose keys begin alike share one shuffle.

    A join by customer and item then takes rows that are shuffled by customer as they are. Should a customer's
    partition be very large, it is split all the same, and only then are its rows shuffled again.
    """
    conf = spark.conf
    conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    threshold = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    conf.set(threshold, str(min(as_bytes(conf.get(threshold)), SKEWED_BYTES)))


def free_shuffles(spark: SparkSession) -> None:
    """Have the session delete what a query has shuffled when it ends, not when the driver's memory is collected.

    Steps that are written to the shared folder then hold their rows only. A result that is read a second time
    through the same DataFrame is shuffled again.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def _shared_base(spark: SparkSession) -> str:
    """The folder the cluster shares between executors (``spark.checkpoint.dir``).

    It has to be set, by the cluster or with ``use_shared_folder``.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def use_shared_folder(spark: SparkSession) -> None:
    """Where ``spark.checkpoint.dir`` is unset, use a folder in the warehouse, which is shared too."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(f"{warehouse.rstrip('/')}/ratemill-shared")


def shared_dir(spark: SparkSession) -> str:
    """A fresh directory name in the shared folder."""
    return f"{_shared_base(spark).rstrip('/')}/ratemill-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as they are now, saved in the shared folder."""
    _shared_base(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows as they are now, as Parquet in the shared folder: several times smaller than ``checkpointed``."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, by way of the shared folder.

    Without it Python steps work only where the package is installed or on the path of the workers;
    ``spark-submit --py-files`` does the same.
    """
    context = spark.sparkContext
    if getattr(context, "_ratemill_shipped", False):
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(target.toString())
    context._ratemill_shipped = True


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder; results that read it fail afterwards."""
    base = spark._jvm.org.apache.hadoop.fs.Path(_shared_base(spark))
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(base):
        for status in files.listStatus(base):
            if status.getPath().getName().startswith(f"ratemill-{spark.sparkContext.applicationId}-"):
                files.delete(status.getPath(), True)
