"""Trajectory points as a folder of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from skyload.settings import Course

# Points of a bucket of a clustered table; a task reads one bucket.
BUCKET_ROWS = 2_000_000

POINT_COLUMNS = (
    "flight_id",
    "timestamp",
    "altitude",
    "groundspeed",
    "track",
    "vertical_rate",
    "u_component_of_wind",
    "v_component_of_wind",
    "temperature",
)


def read_trajectory(
    spark: SparkSession, *paths: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Points of all given files or folders; only ``columns`` are read if given."""
    points = spark.read.parquet(*paths)
    return points.select(*columns) if columns else points


def times_as_text(points: DataFrame) -> DataFrame:
    """Timestamp columns as ``yyyy-MM-dd HH:mm:ss`` text."""
    kinds = (TimestampType, TimestampNTZType)
    times = [f.name for f in points.schema if isinstance(f.dataType, kinds)]
    return points.withColumns(
        {c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss") for c in times}
    )


def cluster_points(points: DataFrame, table: str, path: str, course: Course = Course(), rows: int = BUCKET_ROWS) -> DataFrame:
    """Write points bucketed by flight and sorted along it, one file a bucket, as ``table`` of the session's catalog, and go on from there.

    Windows along flights, counts and features of such a table need neither a shuffle nor a sort, with the same ``course``: points are
    shuffled once, here, for all runs to come. A flight is in one bucket, whatever its length; one of more than
    ``course.long_rows`` points is cut into pieces later, as from any table. Without points there is one empty bucket.
    """
    spark, course = points.sparkSession, course.over(points.columns)
    buckets = max(1, -(-points.count() // rows))
    sorted_by = [course.key, *course.order]
    spread = points.repartition(buckets, course.key)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, course.key).sortBy(*sorted_by).format("parquet").saveAsTable(table)
    return clustered_points(spark, table)


def clustered_points(spark: SparkSession, table: str) -> DataFrame:
    """A table of :func:`cluster_points`. Its order is made known to the planner, which is right where each bucket is one file, as there."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(table)
