import math

import pytest
from pyspark.sql import functions as F

from skyload.functions import atmosphere
from skyload.functions.bins import distance_bin, is_narrow_body, wide_body_label
from skyload.functions.fdist import f_upper_tail
from skyload.functions.times import add_duration, format_dates


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def test_atmosphere_branches(spark):
    altitudes = [0.0, 11000.0, 11000.5, 46999.0, 47000.0, -1.0, 47001.0]
    x = F.col("x")
    rows = column(spark, altitudes).select(
        atmosphere.isa_temperature(x).alias("t"),
        atmosphere.isa_pressure(x).alias("p"),
        atmosphere.isa_density(x).alias("rho"),
    ).collect()
    assert rows[0].t == 288.15 and rows[0].p == pytest.approx(101325)
    assert rows[0].rho == pytest.approx(1.225, abs=1e-5)
    assert rows[1].t == pytest.approx(216.65) and rows[1].p == pytest.approx(22632.06, abs=0.1)
    assert rows[2].t == pytest.approx(216.65) and rows[2].p < rows[1].p
    assert rows[3].rho > rows[4].rho > 0
    assert rows[5].t is None and rows[6].p is None and rows[6].rho is None


def test_altitude_factor(spark):
    row = column(spark, [20000.0]).select(
        atmosphere.isa_temperature(F.col("x"), 0.3048).alias("t")
    ).first()
    assert row.t == pytest.approx(288.15 - 0.0065 * 6096)


def test_distance_bins(spark):
    rows = column(spark, [0.0, 499.99, 500.0, 1000.0, -1.0, None]).select(
        distance_bin(F.col("x")).alias("b")
    )
    assert [r.b for r in rows.collect()] == ["0-500", "0-500", "500-1000", "above_1000", None, None]


def test_body_predicates(spark):
    rows = column(spark, [115680, 115681, None], "bigint").select(is_narrow_body(F.col("x")).alias("n"))
    assert [r.n for r in rows.collect()] == [True, False, None]
    rows = column(spark, ["B77W", "A333", None], "string").select(wide_body_label(F.col("x")).alias("w"))
    assert [r.w for r in rows.collect()] == ["b77w", "non_b77w", "non_b77w"]


def test_durations(spark):
    rows = spark.createDataFrame(
        [
            ("2022-01-01 10:00:00", "2022-01-01 11:40:20.5"),
            ("2022-01-01 10:00:00", "2022-01-01 09:00:00"),
            ("no date", "2022-01-01 09:00:00"),
            ("2022-01-01 10:00:00", None),
        ],
        "actual_offblock_time string, arrival_time string",
    )
    assert [r.duration for r in add_duration(rows).collect()] == [100.33, None, None, None]
    exact = [r.duration for r in add_duration(rows, exact=True).collect()]
    assert exact[0] == pytest.approx(100 + 20.5 / 60) and exact[1:] == [-60.0, None, None]


def test_format_dates(spark):
    rows = spark.createDataFrame(
        [("2022-01-01 10:00:00.7", "x"), ("rubbish", "y")], "date string, other string"
    )
    found = format_dates(rows).collect()
    assert [r.date for r in found] == ["2022-01-01 10:00:00", None]
    assert [r.other for r in found] == ["x", "y"]


def test_f_upper_tail():
    # With 1 and n degrees of freedom, F is the square of a t value.
    for t in (0.1, 1.0, 2.5, 7.0):
        exact = 1 - 2 / math.pi * math.atan(t)
        assert f_upper_tail(t * t, 1, 1) == pytest.approx(exact, rel=1e-12)
        exact = 1 - t / math.sqrt(2 + t * t)
        assert f_upper_tail(t * t, 1, 2) == pytest.approx(exact, rel=1e-9)
    assert f_upper_tail(0.0, 1, 10) == 1.0
    assert f_upper_tail(3.841458820694124, 1, 1e7) == pytest.approx(0.05, rel=1e-4)
    assert f_upper_tail(math.inf, 1, 10) == 0.0
