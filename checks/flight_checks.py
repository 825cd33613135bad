"""Scans, projections, filters, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import check, rounded, sql
from skyload.constants import KNOT_IN_FT_PER_S
from skyload.functions import atmosphere, motion
from skyload.functions.bins import distance_bin
from skyload.functions.times import add_duration, format_dates
from skyload.operators import columns, joins
from skyload.sources.aircraft import FIELD_NAMES, aircraft_from_json
from skyload.sources.trajectory import POINT_COLUMNS


def enriched(spark, sf):
    return joins.enrich(views.flights(spark, sf), views.aircraft(spark))


FLIGHT_COLUMNS = (
    "flight_id, date, callsign, adep, name_adep, country_code_adep, ades, name_ades, "
    "country_code_ades, actual_offblock_time, arrival_time, aircraft_type, wtc, airline"
)
NUMBERS = rounded("flown_distance", "tow")


@check("s1_flights_scan", sql(f"SELECT {FLIGHT_COLUMNS}, {NUMBERS} FROM flights", "flights"))
def s1(spark, sf):
    return views.flights(spark, sf)


@check(
    "s2_scoring_set",
    sql(f"SELECT {FLIGHT_COLUMNS}, {rounded('flown_distance')} FROM flights", "flights"),
)
def s2(spark, sf):
    return columns.scoring_set(views.flights(spark, sf))


_FORMAT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


@check(
    "s3_datetime_format",
    sql(
        "SELECT flight_id, "
        + ", ".join(_FORMAT.format(c) for c in ("date", "actual_offblock_time", "arrival_time"))
        + " FROM flights",
        "flights",
    ),
)
def s3(spark, sf):
    dates = views.flights(spark, sf).select("flight_id", "date", "actual_offblock_time", "arrival_time")
    return format_dates(dates)


_POINT_NUMBERS = [c for c in POINT_COLUMNS if c not in ("flight_id", "timestamp")]


@check(
    "s4_trajectory_scan",
    sql(f'SELECT flight_id, event_id, "timestamp", {rounded(*_POINT_NUMBERS)} FROM trajectory', "trajectory"),
)
def s4(spark, sf):
    return views.trajectory(spark, sf)


@check(
    "s5_aircraft",
    """
SELECT p_name || '/' || p_partkey AS aircraft_type, CAST(p_size AS BIGINT) * 1000 AS mtow_kg,
       p_partkey % 300 AS passengers, CAST(p_size AS BIGINT) * 50 AS roc_initial_climb,
       p_partkey % 170 AS v2_ias
FROM part
""",
)
def s5(spark, sf):
    """Parts as JSON objects of the reference file's form, read back as rows."""
    part = views.table(spark, sf, "part")
    size, key = F.col("p_size").cast("long"), F.col("p_partkey")
    values = (size * 1000, key % 300, size * 50, key % 170)
    data = F.struct(*[v.alias(n) for v, n in zip(values, FIELD_NAMES, strict=True)])
    name = F.concat("p_name", F.lit("/"), key.cast("string"))
    return aircraft_from_json(part.select(F.to_json(F.create_map(name, data)).alias("value")))


@check(
    "p1_drop_features",
    sql(
        f"SELECT flight_id, adep, country_code_adep, ades, country_code_ades, wtc, airline, {NUMBERS} "
        "FROM flights",
        "flights",
    ),
)
def p1(spark, sf):
    return columns.drop_features(views.flights(spark, sf), final_drop=True)


@check(
    "p2_drop_with_key",
    sql(
        "SELECT adep, country_code_adep, ades, country_code_ades, aircraft_type, wtc, airline, "
        f"{NUMBERS} FROM flights",
        "flights",
    ),
)
def p2(spark, sf):
    return columns.drop_features(views.flights(spark, sf), drop_key=True)


_AIRCRAFT = "mtow_kg, passengers, roc_initial_climb, v2_ias"


@check("p3_numeric_only", sql(f"SELECT {NUMBERS}, {_AIRCRAFT} FROM enriched", "enriched"))
def p3(spark, sf):
    return columns.numeric_only(enriched(spark, sf), exclude=["flight_id"])


_COMPLETE = " AND ".join(
    f"{c.strip()} IS NOT NULL"
    for c in f"{FLIGHT_COLUMNS}, flown_distance, tow, mtow_kg".split(",")
)


@check(
    "p4_dropna",
    sql(f"SELECT {FLIGHT_COLUMNS}, {NUMBERS}, {_AIRCRAFT} FROM enriched WHERE {_COMPLETE}", "enriched"),
)
def p4(spark, sf):
    return columns.complete_rows(enriched(spark, sf))


@check(
    "p5_altitude_range",
    sql(
        f'SELECT flight_id, event_id, "timestamp", {rounded(*_POINT_NUMBERS)} FROM trajectory '
        "WHERE altitude >= 0 AND altitude <= 47000",
        "trajectory",
    ),
)
def p5(spark, sf):
    return columns.valid_altitudes(views.trajectory(spark, sf))


@check(
    "p6_known_types",
    sql(
        f"SELECT {FLIGHT_COLUMNS}, {NUMBERS} FROM flights "
        "WHERE aircraft_type IN (SELECT aircraft_type FROM aircraft)",
        "flights",
    ),
)
def p6(spark, sf):
    return joins.known_types(views.flights(spark, sf), views.aircraft(spark))


@check(
    "p9_xy",
    sql(
        f"SELECT x.flight_id, {rounded('flown_distance')}, round(y.tow, 6) AS tow "
        "FROM (SELECT flight_id, flown_distance FROM flights) x "
        "JOIN (SELECT flight_id, tow FROM flights) y ON x.flight_id = y.flight_id",
        "flights",
    ),
)
def p9(spark, sf):
    flights = views.flights(spark, sf).select("flight_id", "flown_distance", "tow")
    features, target = columns.features_and_target(flights)
    return features.join(target, "flight_id")


@check("j1_enrich_left", sql(f"SELECT {FLIGHT_COLUMNS}, {NUMBERS}, {_AIRCRAFT} FROM enriched", "enriched"))
def j1(spark, sf):
    return enriched(spark, sf)


@check(
    "j3_semi_by_flight",
    sql("SELECT flight_id, round(tow, 6) AS tow FROM flights WHERE wtc = 'M'", "flights"),
)
def j3(spark, sf):
    flights = views.flights(spark, sf)
    return joins.targets_of(flights, flights.where(F.col("wtc") == "M"))


_MINUTES = "(epoch_us(arrival_time) - epoch_us(actual_offblock_time)) / 60e6"


@check(
    "h2_duration",
    sql(
        f"SELECT flight_id, CASE WHEN {_MINUTES} >= 0 THEN round({_MINUTES}, 2) END AS duration FROM flights",
        "flights",
    ),
)
def h2(spark, sf):
    return add_duration(views.flights(spark, sf)).select("flight_id", "duration")


@check("h2_duration_exact", sql(f"SELECT flight_id, round({_MINUTES}, 6) AS duration FROM flights", "flights"))
def h2_exact(spark, sf):
    return add_duration(views.flights(spark, sf), exact=True).select("flight_id", "duration")


_T = "CASE WHEN altitude <= 11000 THEN 288.15 - 0.0065 * altitude ELSE 216.65 END"
_P = """101325 * CASE WHEN altitude <= 11000
  THEN pow((288.15 - 0.0065 * altitude) / 288.15, 9.80665 / (0.0065 * 287.05287))
  ELSE pow(216.65 / 288.15, 9.80665 / (0.0065 * 287.05287))
       * exp(-9.80665 * (altitude - 11000) / (287.05287 * 216.65)) END"""


@check(
    "h3_isa",
    sql(
        f"""
SELECT event_id, round(t, 6) AS isa_temperature, round(p, 6) AS isa_pressure,
       round(p / (287.05287 * t), 6) AS isa_density
FROM (SELECT event_id,
             CASE WHEN altitude >= 0 AND altitude <= 47000 THEN CAST({_T} AS DOUBLE) END AS t,
             CASE WHEN altitude >= 0 AND altitude <= 47000 THEN {_P} END AS p
      FROM (SELECT event_id, CAST(altitude AS DOUBLE) AS altitude FROM trajectory)) x
""",
        "trajectory",
    ),
)
def h3(spark, sf):
    altitude = F.col("altitude")
    return views.trajectory(spark, sf).select(
        "event_id",
        atmosphere.isa_temperature(altitude).alias("isa_temperature"),
        atmosphere.isa_pressure(altitude).alias("isa_pressure"),
        atmosphere.isa_density(altitude).alias("isa_density"),
    )


def airspeed_sql(factor: float) -> str:
    ground = f"groundspeed * {KNOT_IN_FT_PER_S}"
    return (
        f"sqrt(pow({ground} * sin(radians(track)) - u_component_of_wind * {factor}, 2) "
        f"+ pow({ground} * cos(radians(track)) - v_component_of_wind * {factor}, 2))"
    )


def wind_sql(factor: float) -> str:
    return (
        "(u_component_of_wind * sin(radians(track)) + v_component_of_wind * cos(radians(track))) "
        f"* {factor}"
    )


def _airspeed(**options):
    names = ("groundspeed", "track", "u_component_of_wind", "v_component_of_wind")
    return motion.true_airspeed(*map(F.col, names), **options).alias("v")


def _wind(**options):
    names = ("track", "u_component_of_wind", "v_component_of_wind")
    return motion.wind_along_track(*map(F.col, names), **options).alias("w_long")


@check("h4_true_airspeed", sql(f"SELECT event_id, round({airspeed_sql(3.28084)}, 6) AS v FROM trajectory", "trajectory"))
def h4(spark, sf):
    return views.trajectory(spark, sf).select("event_id", _airspeed())


@check(
    "h4_true_airspeed_knots",
    sql(f"SELECT event_id, round({airspeed_sql(KNOT_IN_FT_PER_S)}, 6) AS v FROM trajectory", "trajectory"),
)
def h4_knots(spark, sf):
    return views.trajectory(spark, sf).select("event_id", _airspeed(wind_factor=KNOT_IN_FT_PER_S))


@check("h5_vertical_speed", sql("SELECT event_id, round(vertical_rate / 60, 6) AS dh_dt FROM trajectory", "trajectory"))
def h5(spark, sf):
    return views.trajectory(spark, sf).select(
        "event_id", motion.vertical_speed(F.col("vertical_rate")).alias("dh_dt")
    )


@check(
    "h6_temp_deviation",
    sql(
        "SELECT event_id, round(CASE WHEN altitude >= 0 AND altitude <= 47000 "
        f"THEN temperature - CAST({_T} AS DOUBLE) END, 6) AS delta_t FROM trajectory",
        "trajectory",
    ),
)
def h6(spark, sf):
    deviation = motion.temperature_deviation(F.col("temperature"), F.col("altitude"))
    return views.trajectory(spark, sf).select("event_id", deviation.alias("delta_t"))


@check("h7_wind_along", sql(f"SELECT event_id, round({wind_sql(3.28084)}, 6) + 0.0 AS w_long FROM trajectory", "trajectory"))
def h7(spark, sf):
    return views.trajectory(spark, sf).select("event_id", _wind())


@check(
    "h7_wind_along_knots",
    sql(f"SELECT event_id, round({wind_sql(KNOT_IN_FT_PER_S)}, 6) + 0.0 AS w_long FROM trajectory", "trajectory"),
)
def h7_knots(spark, sf):
    return views.trajectory(spark, sf).select("event_id", _wind(wind_factor=KNOT_IN_FT_PER_S))


@check(
    "h9_distance_bins",
    sql(
        "SELECT flight_id, CASE WHEN flown_distance >= 1000 THEN 'above_1000' "
        "WHEN flown_distance >= 500 THEN '500-1000' WHEN flown_distance >= 0 THEN '0-500' END AS bin "
        "FROM flights",
        "flights",
    ),
)
def h9(spark, sf):
    return views.flights(spark, sf).select("flight_id", distance_bin(F.col("flown_distance")).alias("bin"))


@check(
    "duration_by_type",
    sql(
        f"""
SELECT aircraft_type, mtow_kg, count(*) AS n_flights, count(d) AS n_durations, round(avg(d), 6) AS mean_duration
FROM (SELECT aircraft_type, mtow_kg, CASE WHEN {_MINUTES} >= 0 THEN round({_MINUTES}, 2) END AS d FROM enriched) x
GROUP BY aircraft_type, mtow_kg
""",
        "enriched",
    ),
)
def duration_by_type(spark, sf):
    return add_duration(enriched(spark, sf)).groupBy("aircraft_type", "mtow_kg").agg(
        F.count(F.lit(1)).alias("n_flights"),
        F.count("duration").alias("n_durations"),
        F.avg("duration").alias("mean_duration"),
    )
