import hashlib

import pytest
from pyspark.sql import functions as F

from skyload.operators import target_statistics
from skyload.operators.target_statistics import TargetStatistics, apply_statistics, fit_statistics, ordered_statistics

ROWS = [(i, "hot" if i % 3 else f"c{i % 7}", None if i % 11 == 0 else "x", float(i * i % 97) if i % 13 else None) for i in range(200)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "flight_id long, kind string, other string, tow double").repartition(5).persist()


def _plain(column: int, prior: float, weight: float) -> dict[int, float]:
    seen: dict[str | None, tuple[float, int]] = {}
    found = {}
    for row in sorted(ROWS, key=lambda r: hashlib.md5(f"{r[0]}order".encode()).hexdigest()):
        total, n = seen.get(row[column], (0.0, 0))
        found[row[0]] = (total + prior * weight) / (n + weight)
        if row[3] is not None:
            seen[row[column]] = (total + row[3], n + 1)
    return found


@pytest.mark.parametrize("stretch_rows", [1_000_000, 3])
def test_means_of_earlier_rows(df, stretch_rows):
    fitted = fit_statistics(df, ["kind", "other"], weight=2.0)
    known = [r[3] for r in ROWS if r[3] is not None]
    assert fitted.prior == pytest.approx(sum(known) / len(known))
    got = ordered_statistics(df, fitted, ["kind", "other"], stretch_rows=stretch_rows).collect()
    assert len(got) == len(ROWS)
    for place, column in ((1, "kind_statistic"), (2, "other_statistic")):
        assert {r.flight_id: r[column] for r in got} == pytest.approx(_plain(place, fitted.prior, 2.0))


def test_scored_rows_have_the_means_of_all_training_rows(spark, df, tmp_path):
    fit_statistics(df, ["kind", "other"]).save(str(tmp_path))
    fitted = TargetStatistics.load(spark, str(tmp_path))
    scored = spark.createDataFrame([(1, "hot", None), (2, "new", "x"), (3, None, "")], "flight_id long, kind string, other string")
    got = {r.flight_id: r for r in apply_statistics(scored, fitted, ["kind", "other"]).collect()}
    hot = [r[3] for r in ROWS if r[1] == "hot" and r[3] is not None]
    missing = [r[3] for r in ROWS if r[2] is None and r[3] is not None]
    assert got[1].kind_statistic == pytest.approx((sum(hot) + fitted.prior) / (len(hot) + 1))
    assert got[1].other_statistic == pytest.approx((sum(missing) + fitted.prior) / (len(missing) + 1))
    # New categories, NULL among rows that had none, and empty text: the prior.
    assert [got[2].kind_statistic, got[3].kind_statistic, got[3].other_statistic] == [fitted.prior] * 3


def test_no_rows_and_repeated_keys(spark, df):
    empty = fit_statistics(df.limit(0), ["kind"])
    assert empty.prior == 0.0 and ordered_statistics(df.limit(0), empty, ["kind"]).count() == 0
    assert {r.kind_statistic for r in apply_statistics(df, empty, ["kind"]).collect()} == {0.0}
    with pytest.raises(ValueError):
        fit_statistics(df, ["kind"], weight=0.0)
    twice = df.where(F.col("tow").isNotNull()).union(df.where(F.col("tow").isNotNull()))
    fitted = fit_statistics(twice, ["kind"])
    first, second = [sorted(tuple(r) for r in ordered_statistics(twice.repartition(n), fitted, ["kind"], stretch_rows=50).select("flight_id", "kind_statistic").collect()) for n in (1, 6)]
    assert first == second and len(first) == twice.count()


def test_rows_are_dealt_out_once_for_all_columns(spark, df, monkeypatch):
    """However many columns there are, rows with their features go through one shuffle, and what comes out is written."""
    plans, plain = [], target_statistics.stable
    monkeypatch.setattr(target_statistics, "stable", lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or plain(rows))
    columns = ["kind", "other"]
    found = ordered_statistics(df, fit_statistics(df, columns), columns, stretch_rows=50)
    wide = [line for line in plans[-1].splitlines() if "Exchange" in line and "REPARTITION_BY_COL" in line]
    assert len(wide) == 1 and "_stretch" in wide[0]
    assert all("/stages-" in f for f in found.inputFiles())
