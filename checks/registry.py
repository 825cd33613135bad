"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from checks.views import AIRCRAFT_SQL, FLIGHTS_SQL, TRAJECTORY_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PLACES = 6

_VIEWS = {
    "aircraft": AIRCRAFT_SQL,
    "flights": FLIGHTS_SQL,
    "trajectory": TRAJECTORY_SQL,
    "enriched": """
SELECT f.*, CAST(a.mtow_kg AS BIGINT) AS mtow_kg, CAST(a.passengers AS BIGINT) AS passengers,
       CAST(a.roc_initial_climb AS BIGINT) AS roc_initial_climb, CAST(a.v2_ias AS BIGINT) AS v2_ias
FROM flights f LEFT JOIN aircraft a ON a.aircraft_type = f.aircraft_type
""",
}
_NEEDS = {"flights": ["aircraft"], "enriched": ["aircraft", "flights"]}


def sql(select: str, *views: str, **more: str) -> str:
    """``select`` after a WITH clause of the named views and of ``more``."""
    names: list[str] = []
    for view in views:
        names += [v for v in (*_NEEDS.get(view, []), view) if v not in names]
    parts = {**{v: _VIEWS[v] for v in names}, **more}
    clause = ",\n".join(f"{name} AS ({text.strip()})" for name, text in parts.items())
    return f"WITH {clause}\n{select.strip()}" if parts else select.strip()


def rounded(*columns: str, places: dict[str, int] | None = None) -> str:
    """Select list of rounded columns; adding 0 turns a negative zero into zero."""
    places = places or {}
    return ", ".join(f'round("{c}", {places.get(c, PLACES)}) + 0.0 AS "{c}"' for c in columns)


def round_doubles(df: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    places = places or {}
    return df.select(
        *[
            F.round(f"`{f.name}`", places.get(f.name, PLACES)).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


def check(
    name: str, oracle: str | None = None, places: dict[str, int] | None = None
) -> Callable[[Query], Query]:
    """Register a query; its doubles are rounded as in the oracle, to six places by default."""

    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: round_doubles(query(spark, sf_dir), places)
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return register
