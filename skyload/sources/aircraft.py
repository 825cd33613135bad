"""Aircraft reference data: a JSON object from type to its values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.session import small_table

# Names in the JSON, and the plain names used from there on.
FIELD_NAMES = {
    "MTOW(kg)": "mtow_kg",
    "passengers": "passengers",
    "ROC_Initial_Climb(ft/min)": "roc_initial_climb",
    "V2 (IAS)": "v2_ias",
}

# Type, MTOW in kg, passengers, initial rate of climb in ft/min, V2 in kt IAS.
AIRCRAFT_DATA = [
    ("B738", 70530, 162, 3000, 145),
    ("A333", 230000, 295, 2000, 145),
    ("B77W", 351500, 365, 2000, 149),
    ("B38M", 82600, 162, 2500, 145),
    ("A320", 73900, 150, 2500, 145),
    ("E190", 45995, 94, 3400, 138),
    ("CRJ9", 38330, 80, 2500, 140),
    ("A21N", 97000, 180, 2000, 145),
    ("A20N", 79000, 150, 2200, 145),
    ("B739", 79015, 177, 3000, 149),
    ("BCS3", 69900, 120, 3100, 165),
    ("E195", 52290, 100, 3000, 140),
    ("A321", 83000, 185, 2500, 145),
    ("A359", 268000, 314, 3000, 150),
    ("A319", 64000, 124, 2500, 135),
    ("A332", 230000, 253, 2000, 145),
    ("B788", 228000, 210, 2700, 165),
    ("B789", 253000, 406, 3000, 165),
    ("BCS1", 63100, 100, 3500, 140),
    ("B763", 186880, 269, 3000, 160),
    ("AT76", 23000, 78, 1350, 116),
    ("B772", 247210, 305, 3000, 170),
    ("B737", 66320, 128, 3000, 150),
    ("A343", 275000, 295, 1400, 145),
    ("B39M", 88300, 178, 2300, 150),
    ("B752", 115680, 200, 3500, 145),
    ("B773", 299370, 368, 3000, 168),
    ("E290", 45995, 94, 3400, 138),
]


def _map_type() -> str:
    fields = ", ".join(f"`{name}`: BIGINT" for name in FIELD_NAMES)
    return f"MAP<STRING, STRUCT<{fields}>>"


def aircraft_from_json(texts: DataFrame, json: str | Column = "value") -> DataFrame:
    """One row per type found in JSON objects of the form {type: {name: value}}."""
    column = F.col(json) if isinstance(json, str) else json
    entries = texts.select(F.explode(F.from_json(column, _map_type())).alias("aircraft_type", "data"))
    return entries.select(
        "aircraft_type",
        *[F.col("data").getField(name).alias(plain) for name, plain in FIELD_NAMES.items()],
    )


def read_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """The reference file, which is one JSON object."""
    return aircraft_from_json(spark.read.text(path, wholetext=True))


def aircraft_table(spark: SparkSession) -> DataFrame:
    """The built-in reference data."""
    names = ["aircraft_type", *FIELD_NAMES.values()]
    return small_table(spark, {n: [row[i] for row in AIRCRAFT_DATA] for i, n in enumerate(names)})
