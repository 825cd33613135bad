"""Session settings, and intermediate tables in a folder that all executors share."""

from __future__ import annotations

import pickle
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on the rows of a table that is broadcast or brought to the driver.
SMALL_ROWS = 100_000
# Bytes of a written table from which on the shuffles behind it are worth deleting at once.
LARGE_BYTES = 64_000_000


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on: timestamps are read and shown in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This session's folder for intermediate tables, removed when Spark ends.

    It lies in ``spark.checkpoint.dir``; where that is unset, beside the tables of the
    session's warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/stages-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return files.makeQualified(path).toString()


def stable(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and go on from there, partitioned by some columns if named.

    Needed where rows are read many times, or carry values that depend on how they
    were partitioned: a lost executor then reads the same rows again instead of
    making new ones.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    table.stage_path = path
    context = df.sparkSession.sparkContext
    written = context._jvm.org.apache.hadoop.fs.Path(path)
    if written.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(written).getLength() >= LARGE_BYTES:
        # Spark deletes the shuffle files of a job that is over once the driver collects its garbage, which a large heap puts off.
        context._jvm.System.gc()
    return table


def release(df: DataFrame | None) -> None:
    """Delete a table that :func:`stable` wrote, once nothing reads it any more."""
    if df is not None and (written := getattr(df, "stage_path", None)):
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def to_tasks(spark: SparkSession, value: object) -> Broadcast:
    """A value for tasks, read by :func:`in_task`. It brings its classes along, as executors need no copy of this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def in_task(held: Broadcast) -> object:
    return pickle.loads(held.value)


def small_table(spark: SparkSession, columns: dict[str, pa.Array | list]) -> DataFrame:
    """A driver-side table of a few rows as a local relation."""
    return spark.createDataFrame(pa.table(columns))


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast when the counted rows allow it; else the join shuffles on its key."""
    return F.broadcast(df) if df.count() <= rows else df
