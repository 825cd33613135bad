from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from points import by_flight, climb, flight, points

from skyload.operators import trajectory as t
from skyload.settings import Course

LENGTHS = (1, 2, 4, 5, 6, 20, 21, 22, 60)


def smooth(values):
    """Cubic least-squares fit over up to 21 points, window by window."""
    n = len(values)
    w = min(21, n)
    w -= 1 - w % 2
    if w < 5:
        return np.full(n, np.nan)
    result = []
    for i in range(n):
        start = min(max(i - w // 2, 0), n - w)
        x = np.arange(start, start + w) - i
        result.append(np.polyval(np.polyfit(x, values[start : start + w], 3), 0))
    return np.array(result)


@pytest.fixture(scope="module")
def lengths(spark):
    return points(spark, *[flight(n, climb(n, n), np.arange(n) * 1.5 + np.arange(n) % 2) for n in LENGTHS])


def test_smoothing_at_all_lengths(spark, lengths):
    for n, rows in by_flight(t.smoothed_altitude(lengths)).items():
        np.testing.assert_allclose(rows.altitude_smooth, smooth(rows.altitude.to_numpy()), rtol=1e-9)


def test_rate_of_climb_is_the_gradient(spark, lengths):
    for n, rows in by_flight(t.rate_of_climb(lengths)).items():
        if n < 5:
            assert rows.ROC.isna().all()
            continue
        seconds = (rows.timestamp - rows.timestamp[0]).dt.total_seconds().to_numpy()
        wanted = np.gradient(smooth(rows.altitude.to_numpy()), seconds)
        np.testing.assert_allclose(rows.ROC, wanted, rtol=1e-7, atol=1e-7)


def test_cubic_profile_is_left_unchanged(spark):
    x = np.arange(50)
    profile = 0.01 * x**3 - 0.5 * x**2 + 100 * x + 7
    rows = by_flight(t.smoothed_altitude(points(spark, flight(1, profile))))[1]
    np.testing.assert_allclose(rows.altitude_smooth, profile, rtol=1e-9)


def test_missing_altitude_spoils_only_its_window(spark):
    altitudes = climb(60)
    altitudes[30] = np.nan
    frame = flight(1, altitudes)
    df = spark.createDataFrame(frame).replace(float("nan"), None)
    rows = by_flight(t.smoothed_altitude(df))[1]
    missing = rows.altitude_smooth.isna()
    assert missing[20:41].all() and not missing[:20].any() and not missing[41:].any()


def test_no_time_step_gives_null(spark):
    seconds = [0, 1, 2, 2, 3, 4, 5, 6]
    df = points(spark, flight(1, climb(8), seconds))
    rows = by_flight(t.horizontal_acceleration(df))[1]
    assert rows.dV_dt.isna().tolist() == [True, False, False, True, False, False, False, False]
    assert t.thrust_minus_drag(df).count() > 0


def test_constant_altitude_has_no_phases(spark):
    df = points(spark, flight(1, [1000.0] * 30))
    rows = by_flight(t.flight_phases(df))[1]
    assert rows.takeoff_end.isna().all()
    assert not rows[["in_takeoff", "in_climb"]].to_numpy().any()
    assert t.thrust_minus_drag(df).count() == 0


def test_top_before_takeoff_end_keeps_rows_up_to_takeoff_end(spark):
    """A recording that starts in cruise: the first row is already over 95 % of the maximum."""
    altitudes = [9600.0] * 2 + [9900.0] * 20 + [10000.0] * 8
    rows = by_flight(t.flight_phases(points(spark, flight(1, altitudes))))[1]
    assert (rows.takeoff_end[0], rows.top_of_climb[0]) == (22, 0)
    assert rows.in_takeoff.sum() == 23
    assert not rows.in_climb.any()
    assert rows.in_cruise.all()


def pandas_thrust(rows, refine=False):
    """Rows of one flight by plain pandas."""
    k, c = 1.6878098571012, 3.28084
    rows = rows.sort_values("timestamp").reset_index(drop=True)
    rows["altitude_diff"] = rows.altitude.diff()
    seconds = (rows.timestamp - rows.timestamp[0]).dt.total_seconds()
    rows["ROC"] = np.gradient(smooth(rows.altitude.to_numpy()), seconds)
    high = rows.altitude.max()
    end = rows.index[rows.altitude > rows.altitude.quantile(0.1)][0]
    top = rows.index[rows.altitude > 0.95 * high][0]
    takeoff, climbing = rows.loc[:end], rows.loc[end:top]
    if refine:
        takeoff = takeoff[takeoff.ROC > takeoff.ROC.quantile(0.5)]
        climbing = climbing[(climbing.ROC > climbing.ROC.quantile(0.25)) & (climbing.altitude < 0.8 * high)]
    kept = rows.loc[sorted({*takeoff.index, *climbing.index})].copy()
    track = np.radians(kept.track)
    kept["V"] = np.hypot(
        kept.groundspeed * k * np.sin(track) - kept.u_component_of_wind * c,
        kept.groundspeed * k * np.cos(track) - kept.v_component_of_wind * c,
    )
    along = (kept.u_component_of_wind * np.sin(track) + kept.v_component_of_wind * np.cos(track)) * c
    passed = kept.timestamp.diff().dt.total_seconds()
    standard = np.where(kept.altitude <= 11000, 288.15 - 0.0065 * kept.altitude, 216.65)
    warm = kept.temperature / standard
    kept["T_minus_D"] = (
        32.17405 * kept.vertical_rate / 60 / kept.V * warm + kept.V.diff() / passed + along.diff() / passed
    )
    return kept.dropna(subset=["T_minus_D"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def flights():
    return [flight(i, climb(n, i), np.arange(n) * 2.0) for i, n in enumerate((40, 75, 90))]


@pytest.mark.parametrize("refine", [False, True])
def test_thrust_minus_drag(spark, flights, refine):
    found = by_flight(t.thrust_minus_drag(points(spark, *flights), refine=refine))
    for i, rows in enumerate(flights):
        wanted = pandas_thrust(rows, refine)
        assert len(found[i]) == len(wanted)
        for c in ("altitude_diff", "ROC", "V", "T_minus_D"):
            np.testing.assert_allclose(found[i][c], wanted[c], rtol=1e-7, atol=1e-7)


def test_flight_features(spark, flights):
    df = points(spark, *flights)
    rows = pd.concat(by_flight(t.thrust_minus_drag(df)).values())
    found = t.trajectory_features(df).toPandas().set_index("flight_id").sort_index()
    for c in ("altitude", "V", "T_minus_D"):
        for name, how in (("mean", "mean"), ("max", "max"), ("std", "std")):
            wanted = rows.groupby("flight_id")[c].agg(how)
            np.testing.assert_allclose(found[f"{c}_{name}"], wanted, rtol=1e-9)


@pytest.mark.parametrize("refine", [False, True])
def test_long_flights_in_pieces_give_the_same_rows(spark, flights, refine):
    """A limit of 50 rows cuts two of three flights into pieces."""
    df = points(spark, *flights)
    whole = by_flight(t.thrust_minus_drag(df, refine=refine))
    cut = by_flight(t.thrust_minus_drag(df, Course(long_rows=50), refine=refine))
    for key, rows in whole.items():
        pd.testing.assert_frame_equal(cut[key][rows.columns], rows)


def test_one_hot_flight_in_many_pieces(spark):
    """A flight with most of all points, in pieces as short as the smoothing reach."""
    df = points(spark, flight(0, climb(700, 3)), *[flight(i, climb(30, i)) for i in range(1, 6)])
    course = Course(long_rows=100)
    for operator in (t.altitude_change, t.smoothed_altitude, t.rate_of_climb, t.wind_acceleration):
        whole, cut = by_flight(operator(df)), by_flight(operator(df, replace(course, long_rows=22)))
        for key, rows in whole.items():
            pd.testing.assert_frame_equal(cut[key][rows.columns], rows)
    phases, cut = by_flight(t.flight_phases(df)), by_flight(t.flight_phases(df, course))
    for key, rows in phases.items():
        pd.testing.assert_frame_equal(cut[key][rows.columns], rows)


def test_manual_phases(spark):
    altitudes = np.arange(40) * 1000.0
    rows = by_flight(t.flight_phases(points(spark, flight(1, altitudes)), manual=True))[1]
    assert (rows.takeoff_end[0], rows.top_of_climb[0]) == (6, 16)


def test_wind_in_knots(spark):
    k = 1.6878098571012
    df = points(spark, flight(1, climb(30)))
    rows = by_flight(t.horizontal_acceleration(df, wind_factor=k))[1]
    track = np.radians(rows.track)
    wanted = k * np.hypot(
        rows.groundspeed * np.sin(track) - rows.u_component_of_wind,
        rows.groundspeed * np.cos(track) - rows.v_component_of_wind,
    )
    np.testing.assert_allclose(rows.V, wanted, rtol=1e-12)
