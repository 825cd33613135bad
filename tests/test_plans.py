"""What the plans look like."""

import re
from dataclasses import replace

import pytest

from checks import views
from checks.flight_checks import enriched
from checks import plan_checks
from skyload.operators import trajectory as t
from skyload.operators.outliers import clean_trajectory
from skyload.operators.prepare import normalise
from skyload.plans import trajectory as plans
from skyload.sources.trajectory import cluster_points


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("refine", [False, True])
def test_points_to_features_shuffle_and_sort_once(spark, sf_dir, refine):
    text = plan(t.trajectory_features(views.trajectory(spark, sf_dir), views.COURSE, refine=refine))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert len(re.findall(r"BroadcastExchange", text)) == 1
    assert "Python" not in text and "Pandas" not in text


def test_clustered_points_need_no_shuffle_and_no_sort(spark, sf_dir, tmp_path):
    points = views.trajectory(spark, sf_dir)
    clustered = cluster_points(points, "clustered_points", str(tmp_path / "points"), views.COURSE, rows=3000)
    assert clustered.count() == points.count() and sorted(clustered.columns) == sorted(points.columns)
    found = t.trajectory_features(clustered, views.COURSE, refine=True)
    text = plan(found)
    assert "Exchange hashpartitioning" not in text and not re.search(r"\bSort \[", text)
    wanted = t.trajectory_features(points, views.COURSE, refine=True).select(*found.columns)
    assert sorted(found.collect()) == sorted(wanted.collect())
    # A long flight is cut into pieces as from any table.
    short = replace(views.COURSE, long_rows=40)
    assert sorted(t.trajectory_features(clustered, short).collect()) == sorted(t.trajectory_features(points, short).select(*found.columns).collect())
    spark.sql("DROP TABLE clustered_points")


def test_forests_run_only_for_flights_that_are_left(spark, sf_dir, monkeypatch):
    given = []

    def spy(points, *args):
        given.append(points)
        return clean_trajectory(points, *args)

    monkeypatch.setattr(plans, "clean_trajectory", spy)
    flights = views.flights(spark, sf_dir).where("flight_id % 3 = 0")
    found = plans.trajectory_flight_features(flights, views.aircraft(spark), views.trajectory(spark, sf_dir), course=views.COURSE)
    worked = {r.flight_id for r in given[0].select("flight_id").distinct().collect()}
    assert {r.flight_id for r in found.collect()} <= worked and all(key % 3 == 0 for key in worked)
    assert len(worked) < views.trajectory(spark, sf_dir).select("flight_id").distinct().count()


def test_only_needed_event_columns_are_read(spark, sf_dir):
    text = plan(t.trajectory_features(views.trajectory(spark, sf_dir), views.COURSE))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_aircraft_are_broadcast(spark, sf_dir):
    text = plan(enriched(spark, sf_dir))
    assert re.search(r"BroadcastHashJoin \[aircraft_type", text)


def test_normalising_is_a_projection(spark, sf_dir):
    df = views.table(spark, sf_dir, "supplier").select("s_acctbal")
    text = plan(normalise(df))
    assert "Exchange" not in text and "Join" not in text


def test_labelled_rows_are_joined_once(spark, sf_dir):
    """Rows that are fitted to, scaled and coded in many passes come from a written table, not from the joins of all given ones."""
    for part in (*plan_checks.rows_with_labels(spark, sf_dir), *plan_checks.training_and_scoring(spark, sf_dir)):
        assert all("/stages-" in f for f in part.inputFiles())


def test_searches_and_segments_run_with_all_trees_trials_and_depths(spark, sf_dir, monkeypatch):
    """Queries hand on no range, number of trials or learners below those of the source."""
    given = {}

    def spy(name):
        def run(*args, **kwargs):
            given[name] = (args[1:], kwargs)
            return {}, None

        return run

    monkeypatch.setattr(plan_checks, "prepared", lambda spark, sf: (None, None))
    monkeypatch.setattr(plan_checks, "segmented_features", lambda *args, **kwargs: None)
    for name in ("grid_search", "random_search", "adaptive_search"):
        monkeypatch.setattr(plan_checks.m, name, spy(name))
    monkeypatch.setattr(plan_checks, "train_segment_models", spy("segments"))
    for query in (plan_checks.m15, plan_checks.m16, plan_checks.m16_adaptive, plan_checks.l3):
        query(spark, sf_dir)
    assert given["grid_search"] == ((plan_checks.m.SECOND,), {})
    assert given["random_search"] == ((), {"trials": 50})
    assert given["adaptive_search"] == ((), {"trials": 50, "kind": "boosted_deep", "parallelism": 8})
    assert given["segments"] == ((), {})
