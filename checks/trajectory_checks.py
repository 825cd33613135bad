"""Windows along flights, phases, thrust minus drag and features per flight."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import views
from checks.flight_checks import airspeed_sql, enriched, wind_sql
from checks.registry import ORACLES, check, rounded, sql
from skyload.operators import columns, joins
from skyload.operators import trajectory as t
from skyload.session import shared_folder
from skyload.sources.trajectory import cluster_points

_POINTS = """
SELECT s.*, row_number() OVER (PARTITION BY flight_id ORDER BY "timestamp", event_id) - 1 AS i,
       count(*) OVER (PARTITION BY flight_id) AS n, epoch_us("timestamp") AS us
FROM {source} s
"""
_ALONG = 'OVER (PARTITION BY flight_id ORDER BY "timestamp", event_id)'
_BY_ROW = "OVER (PARTITION BY flight_id ORDER BY i)"
_SMOOTH = """
SELECT p.flight_id, p.i, sum(q.altitude * (
         1 / (2 * m + 1)
         + x * y / (m * (m + 1) * (2 * m + 1) / 3)
         + (3 * x * x - m * (m + 1)) * (3 * y * y - m * (m + 1))
           / (m * (m + 1) * (2 * m + 1) * (4 * m * m + 4 * m - 3) / 5)
         + (5 * x * x * x - (3 * m * m + 3 * m - 1) * x) * (5 * y * y * y - (3 * m * m + 3 * m - 1) * y)
           / (m * (m + 1) * (2 * m + 1) * (4 * m * m + 4 * m - 3) * (m * m + m - 2) / 7)
       )) AS altitude_smooth
FROM (SELECT a.flight_id, a.i, b.altitude, a.m, a.i - a.st - a.m AS x, b.i - a.st - a.m AS y
      FROM (SELECT flight_id, i, w, greatest(0, least(i - w // 2, n - w)) AS st,
                   CAST(w // 2 AS DOUBLE) AS m
            FROM (SELECT *, least(21, n) - (least(21, n) + 1) % 2 AS w FROM pts) z
            WHERE w >= 5) a
      JOIN pts b ON b.flight_id = a.flight_id AND b.i BETWEEN a.st AND a.st + a.w - 1) q
JOIN (SELECT flight_id, i FROM pts) p ON p.flight_id = q.flight_id AND p.i = q.i
GROUP BY p.flight_id, p.i
"""
_CLIMB = """
SELECT *, CASE
  WHEN i = 0 THEN (f1 - f) / nullif(hd, 0)
  WHEN i = n - 1 THEN (f - f0) / nullif(hs, 0)
  ELSE (hs * hs * f1 + (hd * hd - hs * hs) * f - hd * hd * f0) / nullif(hs * hd * (hd + hs), 0) END AS roc
FROM (SELECT p.*, s.altitude_smooth AS f, lag(s.altitude_smooth) {along} AS f0,
             lead(s.altitude_smooth) {along} AS f1,
             (us - lag(us) {along}) / 1e6 AS hs, (lead(us) {along} - us) / 1e6 AS hd
      FROM (SELECT *, altitude - lag(altitude) {row} AS altitude_diff FROM pts) p
      LEFT JOIN smooth s USING (flight_id, i)) x
""".replace("{along}", "OVER (PARTITION BY p.flight_id ORDER BY i)").replace("{row}", _BY_ROW)
_LIMITS = {
    False: "SELECT flight_id, quantile_cont(altitude, 0.1) AS lo, max(altitude) * 0.95 AS hi, max(altitude) AS top "
    "FROM pts GROUP BY flight_id",
    True: "SELECT flight_id, 5000 AS lo, 15000 AS hi, max(altitude) AS top FROM pts GROUP BY flight_id",
}
_BOUNDS = """
SELECT p.flight_id, max(l.top) AS top, min(CASE WHEN altitude > lo THEN i END) AS te,
       min(CASE WHEN altitude > hi THEN i END) AS toc
FROM pts p JOIN limits l USING (flight_id) GROUP BY p.flight_id
"""
_PHASES = """
SELECT c.*, b.te, b.toc, b.top,
       b.te IS NOT NULL AND b.toc IS NOT NULL AND i <= te AS in_takeoff,
       b.te IS NOT NULL AND b.toc IS NOT NULL AND i >= te AND i <= toc AS in_climb,
       b.te IS NOT NULL AND b.toc IS NOT NULL AND i >= toc AS in_cruise
FROM climb c JOIN bounds b USING (flight_id)
"""
_REFINED = """
SELECT p.* EXCLUDE (in_takeoff, in_climb),
       in_takeoff AND coalesce(roc > q50, false) AS in_takeoff,
       in_climb AND coalesce(roc > q25 AND altitude < 0.8 * top, false) AS in_climb
FROM phases p JOIN (
  SELECT flight_id, quantile_cont(CASE WHEN in_takeoff THEN roc END, 0.5) AS q50,
         quantile_cont(CASE WHEN in_climb THEN roc END, 0.25) AS q25
  FROM phases GROUP BY flight_id) q USING (flight_id)
"""
_BALANCE = f"""
SELECT *, 32.17405 * dh_dt / nullif(v, 0) * (temperature / nullif(temperature - delta_t, 0))
          + dv_dt + dwi_dt AS t_minus_d
FROM (SELECT *, (v - lag(v) {_BY_ROW}) / nullif((us - lag(us) {_BY_ROW}) / 1e6, 0) AS dv_dt,
             (w_long - lag(w_long) {_BY_ROW}) / nullif((us - lag(us) {_BY_ROW}) / 1e6, 0) AS dwi_dt
      FROM (SELECT *, {airspeed_sql(3.28084)} AS v, vertical_rate / 60 AS dh_dt,
                   CASE WHEN altitude >= 0 AND altitude <= 47000 THEN temperature
                     - CASE WHEN altitude <= 11000 THEN 288.15 - 0.0065 * altitude ELSE 216.65 END END AS delta_t,
                   {wind_sql(3.28084)} AS w_long
            FROM {{phases}} WHERE in_takeoff OR in_climb) x) y
"""


def steps(upto: str, manual: bool = False, refine: bool = False, source: str = "trajectory") -> dict[str, str]:
    """CTEs of the trajectory chain up to the named one."""
    chain = {
        "pts": _POINTS.format(source=source),
        "smooth": _SMOOTH,
        "climb": _CLIMB,
        "limits": _LIMITS[manual],
        "bounds": _BOUNDS,
        "phases": _PHASES,
        "refined": _REFINED,
        "balance": _BALANCE.format(phases="refined" if refine else "phases"),
    }
    names = list(chain)
    return {n: chain[n] for n in names[: names.index(upto) + 1]}


VALID = "SELECT * FROM trajectory WHERE altitude >= 0 AND altitude <= 47000"
MEASURES = (
    "altitude", "groundspeed", "track", "vertical_rate", "u_component_of_wind",
    "v_component_of_wind", "temperature", "altitude_diff", "ROC", "V", "dh_dt", "delta_t",
    "W_long", "dV_dt", "dWi_dt", "T_minus_D",
)
FEATURES_SQL = (
    "SELECT flight_id, "
    + ", ".join(
        f'{f}("{c}") AS "{c}_{s}"'
        for c in MEASURES
        for s, f in (("mean", "avg"), ("max", "max"), ("std", "stddev_samp"))
    )
    + " FROM balance WHERE t_minus_d IS NOT NULL GROUP BY flight_id"
)
FEATURE_NAMES = [f"{c}_{s}" for c in MEASURES for s in ("mean", "max", "std")]
# Means of round numbers over few points end on a 5 at some place; none is rounded there.
PLACES = {
    **{f"{c}_mean": 7 for c in MEASURES},
    **{f"{c}_std": 4 for c in MEASURES},
    "delta_t_mean": 3,
}


@check(
    "w1_altitude_diff",
    sql(f"SELECT event_id, round(altitude - lag(altitude) {_ALONG}, 6) AS altitude_diff FROM trajectory", "trajectory"),
)
def w1(spark, sf):
    points = t.altitude_change(views.trajectory(spark, sf), views.COURSE)
    return points.select("event_id", "altitude_diff")


def _rate_sql(value: str, name: str, rate: str) -> str:
    return sql(
        f"""
SELECT event_id, round(x, 6) + 0.0 AS {name},
       round((x - lag(x) {_ALONG}) / nullif((us - lag(us) {_ALONG}) / 1e6, 0), 6) + 0.0 AS {rate}
FROM (SELECT *, {value} AS x, epoch_us("timestamp") AS us FROM trajectory) p
""",
        "trajectory",
    )


@check("w2_dv_dt", _rate_sql(airspeed_sql(3.28084), "V", "dV_dt"))
def w2(spark, sf):
    points = t.horizontal_acceleration(views.trajectory(spark, sf), views.COURSE)
    return points.select("event_id", "V", "dV_dt")


@check("w3_dwi_dt", _rate_sql(wind_sql(3.28084), "W_long", "dWi_dt"))
def w3(spark, sf):
    points = t.wind_acceleration(views.trajectory(spark, sf), views.COURSE)
    return points.select("event_id", "W_long", "dWi_dt")


@check(
    "w4_smoothed_altitude",
    sql(
        "SELECT event_id, round(altitude_smooth, 6) AS altitude_smooth "
        "FROM pts LEFT JOIN smooth USING (flight_id, i)",
        "trajectory",
        **steps("smooth"),
    ),
)
def w4(spark, sf):
    points = t.smoothed_altitude(views.trajectory(spark, sf), views.COURSE)
    return points.select("event_id", "altitude_smooth")


@check(
    "w5_rate_of_climb",
    sql('SELECT event_id, round(roc, 6) AS "ROC" FROM climb', "trajectory", **steps("climb")),
)
def w5(spark, sf):
    return t.rate_of_climb(views.trajectory(spark, sf), views.COURSE).select("event_id", "ROC")


def _bounds_sql(manual: bool) -> str:
    return sql(
        "SELECT flight_id, te AS takeoff_end, toc AS top_of_climb, round(top, 6) AS max_altitude FROM bounds",
        "trajectory",
        **{n: s for n, s in steps("bounds", manual).items() if n not in ("smooth", "climb")},
    )


def _bounds(spark, sf, manual):
    phases = t.flight_phases(views.trajectory(spark, sf), views.COURSE, manual=manual)
    return phases.groupBy("flight_id").agg(
        *[F.max(c).alias(c) for c in ("takeoff_end", "top_of_climb", "max_altitude")]
    )


@check("w6_phase_bounds", _bounds_sql(False))
def w6(spark, sf):
    return _bounds(spark, sf, manual=False)


@check("w6_phase_bounds_manual", _bounds_sql(True))
def w6_manual(spark, sf):
    return _bounds(spark, sf, manual=True)


def _flags(*names: str) -> str:
    return ", ".join(f"CASE WHEN {n} THEN 1 ELSE 0 END AS {n}" for n in names)


def _as_numbers(phases, *names):
    return phases.select("event_id", *[F.col(n).cast("int").alias(n) for n in names])


@check(
    "w7_phases",
    sql(
        f"SELECT event_id, {_flags('in_takeoff', 'in_climb', 'in_cruise')} FROM phases",
        "trajectory",
        **steps("phases"),
    ),
)
def w7(spark, sf):
    phases = t.flight_phases(views.trajectory(spark, sf), views.COURSE)
    return _as_numbers(phases, "in_takeoff", "in_climb", "in_cruise")


@check(
    "w7r_refined_phases",
    sql(
        f"SELECT event_id, {_flags('in_takeoff', 'in_climb')} FROM refined",
        "trajectory",
        **steps("refined"),
    ),
)
def w7r(spark, sf):
    phases = t.flight_phases(views.trajectory(spark, sf), views.COURSE, refine=True)
    return _as_numbers(phases, "in_takeoff", "in_climb")


def _balance_sql(refine: bool) -> str:
    return sql(
        f"SELECT flight_id, event_id, {rounded(*MEASURES)} FROM balance WHERE t_minus_d IS NOT NULL",
        "trajectory",
        **steps("balance", refine=refine),
    )


@check("w8_thrust_minus_drag", _balance_sql(False))
def w8(spark, sf):
    rows = t.thrust_minus_drag(views.trajectory(spark, sf), views.COURSE)
    return rows.select("flight_id", "event_id", *MEASURES)


@check("w8_thrust_minus_drag_refined", _balance_sql(True))
def w8_refined(spark, sf):
    rows = t.thrust_minus_drag(views.trajectory(spark, sf), views.COURSE, refine=True)
    return rows.select("flight_id", "event_id", *MEASURES)


@check(
    "u1_phase_union",
    sql(
        f"""
SELECT event_id, {_flags('in_takeoff', 'in_climb')} FROM phases WHERE in_takeoff
UNION SELECT event_id, {_flags('in_takeoff', 'in_climb')} FROM phases WHERE in_climb
""",
        "trajectory",
        **steps("phases"),
    ),
)
def u1(spark, sf):
    phases = t.flight_phases(views.trajectory(spark, sf), views.COURSE)
    parts = t.phase_rows(phases)
    both = parts["in_takeoff"].unionByName(parts["in_climb"].where(~F.col("in_takeoff")))
    return _as_numbers(both, "in_takeoff", "in_climb")


@check(
    "a1_flight_features",
    sql(
        f"SELECT flight_id, {rounded(*FEATURE_NAMES, places=PLACES)} FROM features",
        "trajectory",
        **steps("balance"),
        features=FEATURES_SQL,
    ),
    places=PLACES,
)
def a1(spark, sf):
    return t.trajectory_features(views.trajectory(spark, sf), views.COURSE)


@check("a1_clustered_features", ORACLES["a1_flight_features"], places=PLACES)
def a1_clustered(spark, sf):
    """The same from points that were written by flight and time before."""
    name = uuid.uuid4().hex
    return t.trajectory_features(cluster_points(views.trajectory(spark, sf), f"points_{name}", f"{shared_folder(spark)}/{name}", views.COURSE), views.COURSE)


@check(
    "j2_flights_with_features",
    sql(
        f"SELECT flight_id, aircraft_type, {rounded('tow', *FEATURE_NAMES, places=PLACES)} "
        "FROM enriched JOIN features USING (flight_id)",
        "enriched",
        "trajectory",
        valid=VALID,
        **steps("balance", refine=True, source="valid"),
        features=FEATURES_SQL,
    ),
    places=PLACES,
)
def j2(spark, sf):
    points = columns.valid_altitudes(views.trajectory(spark, sf))
    features = t.trajectory_features(points, views.COURSE, refine=True)
    flights = enriched(spark, sf).select("flight_id", "aircraft_type", "tow")
    return joins.with_flight_features(flights, features)
