"""Time-series operators per flight, and the features made from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.constants import (
    MANUAL_TAKEOFF_END_FT,
    MANUAL_TOP_OF_CLIMB_FT,
    METRE_IN_FT,
    REFINED_CLIMB_ALTITUDE_SHARE,
    REFINED_CLIMB_QUANTILE,
    REFINED_TAKEOFF_QUANTILE,
    SMOOTHING_MAX_WINDOW,
    SMOOTHING_MIN_WINDOW,
    TAKEOFF_END_QUANTILE,
    TOP_OF_CLIMB_SHARE,
)
from skyload.functions import motion, smoothing
from skyload.operators.columns import numeric_columns
from skyload.operators.course import LENGTH, ROW, FlightRows, along_flights
from skyload.settings import Course

_TIME, _ALTITUDE = "_micros", "_altitude"
_PHASES = ("in_takeoff", "in_climb", "in_cruise")


def _change(rows: FlightRows, value: Column) -> Column:
    return value - F.lag(value).over(rows.along())


def _prepared(points: DataFrame, course: Course) -> DataFrame:
    """Points with what windows look at as plain columns, which lets Spark join windows.

    A gap in the altitude must not shift the points after it, hence NaN there, not NULL.
    """
    return points.withColumns(
        {
            _TIME: motion.micros(F.col(course.time)),
            _ALTITUDE: F.coalesce(F.col("altitude").cast("double"), F.lit(float("nan"))),
        }
    )


def _over_flights(
    points: DataFrame, course: Course, reach: int, step: Callable[[FlightRows], FlightRows]
) -> DataFrame:
    return along_flights(_prepared(points, course), course, reach, step).drop(_TIME, _ALTITUDE)


def _airspeed(wind_factor: float) -> Column:
    return motion.true_airspeed(
        F.col("groundspeed"), F.col("track"),
        F.col("u_component_of_wind"), F.col("v_component_of_wind"), wind_factor,
    )


def _wind(wind_factor: float) -> Column:
    return motion.wind_along_track(
        F.col("track"), F.col("u_component_of_wind"), F.col("v_component_of_wind"), wind_factor
    )


def _with_altitude_change(rows: FlightRows) -> FlightRows:
    return rows.with_columns({"altitude_diff": _change(rows, F.col("altitude"))})


def _with_rates(rows: FlightRows, values: dict[str, Column], rates: dict[str, str]) -> FlightRows:
    """Add ``values``, and for each (rate, value) in ``rates`` its change per second."""
    rows = rows.with_columns(values)
    passed = _change(rows, F.col(_TIME))
    return rows.with_columns(
        {rate: motion.per_second(_change(rows, F.col(v)), passed) for rate, v in rates.items()}
    )


def _with_smoothed_altitude(rows: FlightRows, name: str = "altitude_smooth") -> FlightRows:
    """Cubic least-squares smoothing; NULL for flights of fewer than five points."""
    half = SMOOTHING_MAX_WINDOW // 2
    along, row, length = rows.along(), F.col(ROW), F.col(LENGTH)
    window = smoothing.window_length(length)
    # The first and last rows of a flight share one window each.
    rows = rows.with_flight_ends("_first", "_last", F.col(_ALTITUDE), SMOOTHING_MAX_WINDOW)
    rows = rows.with_columns(
        {
            "_centred": smoothing.centred_fit(lambda d: F.lag(_ALTITUDE, -d).over(along)),
            "_window": window,
            "_start": smoothing.window_start(row, length, window),
        }
    )
    rows = rows.with_columns({"_place": (row - F.col("_start")).cast("int")})
    weights = F.broadcast(smoothing.weights_table(rows.frame.sparkSession))
    rows = rows.mapped(lambda frame: frame.join(weights, ["_window", "_place"], "left"))
    at_start, zero = F.col("_start") == 0, F.lit(0).cast("long")
    at_edge = smoothing.edge_fit(
        F.when(at_start, F.col("_first")).otherwise(F.col("_last")),
        F.when(at_start, zero).otherwise(F.col("_start") - F.greatest(zero, length - SMOOTHING_MAX_WINDOW)),
        F.col("_window"),
        F.col("_weights"),
    )
    fitted = F.when((row >= half) & (row < length - half), F.col("_centred")).when(
        F.col("_window") >= SMOOTHING_MIN_WINDOW, at_edge
    )
    rows = rows.with_columns({name: F.nanvl(fitted, F.lit(None).cast("double"))})
    working = ("_first", "_last", "_centred", "_window", "_start", "_place", "_weights")
    return rows.mapped(lambda frame: frame.drop(*working))


def _with_rate_of_climb(rows: FlightRows, name: str = "ROC") -> FlightRows:
    """Gradient of the smoothed altitude over uneven time steps."""
    rows = _with_smoothed_altitude(rows)
    along = rows.along()
    rows = rows.with_columns(
        {
            "_before": F.lag("altitude_smooth").over(along),
            "_after": F.lead("altitude_smooth").over(along),
            "_step_in": (F.col(_TIME) - F.lag(_TIME).over(along)) / F.lit(1e6),
            "_step_out": (F.lead(_TIME).over(along) - F.col(_TIME)) / F.lit(1e6),
        }
    )
    here = F.col("altitude_smooth")
    step_in, step_out = F.col("_step_in"), F.col("_step_out")
    slope_in = F.try_divide(here - F.col("_before"), step_in)
    slope_out = F.try_divide(F.col("_after") - here, step_out)
    inner = F.try_divide(step_in * slope_out + step_out * slope_in, step_in + step_out)
    gradient = (
        F.when(F.col(ROW) == 0, slope_out)
        .when(F.col(ROW) == F.col(LENGTH) - 1, slope_in)
        .otherwise(inner)
    )
    rows = rows.with_columns({name: gradient})
    return rows.mapped(
        lambda frame: frame.drop("_before", "_after", "_step_in", "_step_out")
    ).settled()


def _with_phase_bounds(rows: FlightRows, manual: bool) -> FlightRows:
    """First rows above the two altitude limits, on every row of the flight."""
    altitude = F.col("altitude")
    rows = rows.with_flight_values({"max_altitude": F.max(altitude)})
    if manual:
        takeoff_limit, climb_limit = F.lit(MANUAL_TAKEOFF_END_FT), F.lit(MANUAL_TOP_OF_CLIMB_FT)
    else:
        rows = rows.with_flight_quantile("_takeoff_limit", altitude, TAKEOFF_END_QUANTILE)
        takeoff_limit = F.col("_takeoff_limit")
        climb_limit = F.col("max_altitude") * F.lit(TOP_OF_CLIMB_SHARE)
    return rows.with_flight_values(
        {
            "takeoff_end": F.min(F.when(altitude > takeoff_limit, F.col(ROW))),
            "top_of_climb": F.min(F.when(altitude > climb_limit, F.col(ROW))),
        }
    ).mapped(lambda frame: frame.drop("_takeoff_limit"))


def _with_phases(rows: FlightRows, manual: bool) -> FlightRows:
    """Phase flags; a phase holds both its end rows. No bound, no phase."""
    rows = _with_phase_bounds(rows, manual)
    row, end, top = F.col(ROW), F.col("takeoff_end"), F.col("top_of_climb")
    bounded = end.isNotNull() & top.isNotNull()
    return rows.with_columns(
        {
            "in_takeoff": bounded & F.coalesce(row <= end, F.lit(False)),
            "in_climb": bounded & F.coalesce((row >= end) & (row <= top), F.lit(False)),
            "in_cruise": bounded & F.coalesce(row >= top, F.lit(False)),
        }
    )


def _with_refined_phases(rows: FlightRows, manual: bool) -> FlightRows:
    """Take-off rows of above-median climb rate; climb rows that climb and are not yet high."""
    rows = _with_rate_of_climb(_with_phases(rows, manual))
    rate = F.col("ROC")
    rows = rows.with_flight_quantile(
        "_takeoff_rate", F.when(F.col("in_takeoff"), rate), REFINED_TAKEOFF_QUANTILE
    ).with_flight_quantile(
        "_climb_rate", F.when(F.col("in_climb"), rate), REFINED_CLIMB_QUANTILE
    )
    low_enough = F.col("altitude") < F.col("max_altitude") * F.lit(REFINED_CLIMB_ALTITUDE_SHARE)
    takeoff = F.col("in_takeoff") & (rate > F.col("_takeoff_rate"))
    climb = F.col("in_climb") & (rate > F.col("_climb_rate")) & low_enough
    return rows.with_columns(
        {
            "in_takeoff": F.coalesce(takeoff, F.lit(False)),
            "in_climb": F.coalesce(climb, F.lit(False)),
        }
    ).mapped(lambda frame: frame.drop("_takeoff_rate", "_climb_rate"))


def altitude_change(points: DataFrame, course: Course = Course()) -> DataFrame:
    """``altitude_diff``: difference to the previous point of the flight."""
    return _over_flights(points, course, 1, _with_altitude_change)


def horizontal_acceleration(
    points: DataFrame, course: Course = Course(), wind_factor: float = METRE_IN_FT
) -> DataFrame:
    """``V`` and ``dV_dt``: true airspeed and its change per second."""
    step = partial(_with_rates, values={"V": _airspeed(wind_factor)}, rates={"dV_dt": "V"})
    return _over_flights(points, course, 1, step)


def wind_acceleration(
    points: DataFrame, course: Course = Course(), wind_factor: float = METRE_IN_FT
) -> DataFrame:
    """``W_long`` and ``dWi_dt``: wind along the track and its change per second."""
    step = partial(_with_rates, values={"W_long": _wind(wind_factor)}, rates={"dWi_dt": "W_long"})
    return _over_flights(points, course, 1, step)


def smoothed_altitude(points: DataFrame, course: Course = Course()) -> DataFrame:
    """``altitude_smooth``: cubic least-squares smoothing over up to 21 points."""
    return _over_flights(points, course, smoothing.REACH, _with_smoothed_altitude)


def rate_of_climb(points: DataFrame, course: Course = Course()) -> DataFrame:
    """``altitude_smooth`` and ``ROC``, its gradient over time."""
    return _over_flights(points, course, smoothing.REACH + 1, _with_rate_of_climb)


def flight_phases(
    points: DataFrame, course: Course = Course(), manual: bool = False, refine: bool = False
) -> DataFrame:
    """``takeoff_end`` and ``top_of_climb`` row numbers, and a flag per phase.

    ``manual`` takes fixed altitudes as limits. ``refine`` narrows take-off and climb
    by rate of climb and altitude.
    """
    phases = _with_refined_phases if refine else _with_phases
    return _over_flights(points, course, smoothing.REACH + 1, partial(phases, manual=manual))


def phase_rows(phases: DataFrame, disjoint: bool = False) -> dict[str, DataFrame]:
    """Views of the phases; a boundary row is in both phases it bounds.

    If ``disjoint``, it is in the first of them alone.
    """
    views, earlier = {}, F.lit(False)
    for name in _PHASES:
        views[name] = phases.where(F.col(name) & ~earlier) if disjoint else phases.where(F.col(name))
        earlier = earlier | F.col(name)
    return views


def thrust_minus_drag(
    points: DataFrame,
    course: Course = Course(),
    refine: bool = False,
    manual: bool = False,
    wind_factor: float = METRE_IN_FT,
    altitude_factor: float = 1.0,
) -> DataFrame:
    """Take-off and climb points with speeds, accelerations and ``T_minus_D``.

    Changes are taken between points that are left after the choice of phases. Points
    whose result is NULL drop out, the first one of each flight among them.
    """

    def step(rows: FlightRows) -> FlightRows:
        rows = _with_altitude_change(rows)
        rows = _with_refined_phases(rows, manual) if refine else _with_rate_of_climb(
            _with_phases(rows, manual)
        )
        rows = rows.kept(F.col("in_takeoff") | F.col("in_climb"), reach=1)
        values = {
            "V": _airspeed(wind_factor),
            "dh_dt": motion.vertical_speed(F.col("vertical_rate")),
            "delta_t": motion.temperature_deviation(
                F.col("temperature"), F.col("altitude"), altitude_factor
            ),
            "W_long": _wind(wind_factor),
        }
        rows = _with_rates(rows, values, {"dV_dt": "V", "dWi_dt": "W_long"})
        balance = motion.thrust_minus_drag(
            F.col("dh_dt"), F.col("V"), F.col("temperature"), F.col("delta_t"),
            F.col("dV_dt"), F.col("dWi_dt"),
        )
        return rows.with_columns({"T_minus_D": balance})

    reach = smoothing.REACH + 1
    working = ("altitude_smooth", "max_altitude", "takeoff_end", "top_of_climb", *_PHASES)
    done = _over_flights(points, course, reach, step)
    return done.drop(*working).where(F.col("T_minus_D").isNotNull())


def flight_features(rows: DataFrame, course: Course = Course()) -> DataFrame:
    """Mean, maximum and sample deviation of every numeric column, one row per flight."""
    columns = numeric_columns(rows, exclude=(course.key, *course.ties))
    statistics = {"mean": F.avg, "max": F.max, "std": F.stddev_samp}
    return rows.groupBy(course.key).agg(
        *[f(F.col(c)).alias(f"{c}_{s}") for c in columns for s, f in statistics.items()]
    )


def trajectory_features(
    points: DataFrame, course: Course = Course(), refine: bool = False, manual: bool = False,
    wind_factor: float = METRE_IN_FT,
    altitude_factor: float = 1.0,
) -> DataFrame:
    """Points to one feature row per flight."""
    return flight_features(
        thrust_minus_drag(points, course, refine, manual, wind_factor, altitude_factor), course
    )
