"""Flight tables as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyload.functions.times import add_duration
from skyload.operators.columns import scoring_set

FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("flight_id", T.LongType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("adep", T.StringType()),
        T.StructField("name_adep", T.StringType()),
        T.StructField("country_code_adep", T.StringType()),
        T.StructField("ades", T.StringType()),
        T.StructField("name_ades", T.StringType()),
        T.StructField("country_code_ades", T.StringType()),
        T.StructField("actual_offblock_time", T.TimestampType()),
        T.StructField("arrival_time", T.TimestampType()),
        T.StructField("aircraft_type", T.StringType()),
        T.StructField("wtc", T.StringType()),
        T.StructField("airline", T.StringType()),
        T.StructField("flown_distance", T.DoubleType()),
        T.StructField("tow", T.DoubleType()),
    ]
)


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files below a path, by their first line."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = lines.where(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return {r["header"]: r["files"] for r in first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()}


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """A flight table with a header. Columns are found by name, types are not inferred.

    Files of a folder may have their columns in different orders, and lack some; each is read by
    its own header. Columns that are no part of the known schema are read as text.
    """
    known = {f.name: f for f in FLIGHT_SCHEMA}
    table = None
    for header, files in sorted(_files_by_header(spark, path).items()):
        names = spark.read.option("header", True).csv(files[0]).columns
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in names])
        part = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(files)
        table = part if table is None else table.unionByName(part, allowMissingColumns=True)
    if table is None:
        raise ValueError(f"no lines below {path}")
    return table


def read_scoring_flights(spark: SparkSession, path: str) -> DataFrame:
    """Flights to predict; without the target, whether or not the file has one."""
    return scoring_set(read_flights(spark, path))


def read_flights_with_duration(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    return add_duration(read_flights(spark, path), exact=exact)
