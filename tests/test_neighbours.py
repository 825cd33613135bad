import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.operators import models, neighbours
from skyload.operators.neighbours import _vector, index_rows
from skyload.sources.sinks import load_model, save_model

SCHEMA = "flight_id long, a double, b double, c double, tow double"


def _points(count, seed, whole=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(count, 3)) * [10, 3, 1]
    return np.round(x) if whole else x


def _frame(spark, x, y, first=0):
    rows = [(first + i, *map(float, p), float(t)) for i, (p, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def _plain(x, y, asked, k):
    out = []
    for q in asked:
        d = np.zeros(len(x))
        for f in range(x.shape[1]):
            d += (q[f] - x[:, f]) ** 2
        near = np.lexsort((np.arange(len(x)), d))[:k]
        out.append(y[near].mean())
    return out


@pytest.mark.parametrize("whole", [False, True])
def test_equal_to_brute_force(spark, whole):
    """Many small boxes and pieces; whole numbers have many equal distances."""
    x, asked = _points(900, 1, whole), _points(150, 2, whole)
    y = np.arange(900.0) ** 1.5
    model = index_rows(_frame(spark, x, y), ["a", "b", "c"], k=5, box_rows=40, piece_rows=15)
    assert len(model.boxes.number) > 10 and model.rows.select("_box", "_piece").distinct().count() > len(model.boxes.number)
    told = {r.flight_id: r.prediction for r in model.predict(_frame(spark, asked, np.zeros(150))).collect()}
    assert [told[i] for i in range(150)] == pytest.approx(_plain(x, y, asked, 5))


def test_only_boxes_within_the_bound_are_met(spark):
    x = _points(2000, 3)
    model = index_rows(_frame(spark, x, x[:, 0]), ["a", "b", "c"], k=3, box_rows=50)
    asked = _frame(spark, x[:200], np.zeros(200)).select(F.col("flight_id").alias("_q"), _vector(["a", "b", "c"]).alias("_x"))
    first = neighbours._visits(asked, model, True)
    bounds = neighbours.neighbours(model, asked).groupBy("_q").agg(F.max("_d").alias("_bound"))
    others = neighbours._visits(asked.join(bounds, "_q"), model, False)
    boxes = len(model.boxes.number)
    assert first.count() == 200 and 0 < others.count() < 0.3 * 200 * boxes
    assert first.join(others, ["_box", "_q"]).count() == 0


def test_a_heap_of_equal_rows(spark):
    """Equal rows are cut to the first keys before they are indexed, and give the same neighbours."""
    x = np.concatenate([np.zeros((500, 3)), _points(60, 4)])
    y = np.arange(560.0)
    df = _frame(spark, x, y).repartition(5)
    model = index_rows(df, ["a", "b", "c"], k=4, box_rows=20)
    assert model.rows.count() == 64
    told = {r.flight_id: r.prediction for r in model.predict(_frame(spark, x[480:], np.zeros(80))).collect()}
    assert [told[i] for i in range(80)] == pytest.approx(_plain(x, y, x[480:], 4))


def test_missing_values_few_rows_and_none(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 0.0, 0.0, 0.0, 10.0), (2, 1.0, 1.0, 1.0, 20.0), (3, None, 0.0, 0.0, 99.0), (4, 0.0, 0.0, float("nan"), 99.0), (5, 0.0, 0.0, 0.0, None)], SCHEMA
    )
    model = models.train(df, models.Learner("neighbours"))
    told = sorted((r.flight_id, r.prediction) for r in models.predict(model, df).collect())
    assert told == [(1, 15.0), (2, 15.0), (3, None), (4, None), (5, 15.0)]
    assert index_rows(df, ["a", "b", "c"], k=1).predict(df).where("prediction = 10").count() == 2
    none = index_rows(df.limit(0), ["a", "b", "c"]).predict(df)
    assert none.count() == 5 and none.where("prediction IS NULL").count() == 5
    assert model.predict(df.limit(0)).count() == 0
    save_model(model, str(tmp_path), "m")
    again = load_model(spark, str(tmp_path), "m")
    found = models.batch_predict({"a": model, "b": again}, df, ("flight_id", "tow"))
    assert found.columns == ["flight_id", "tow", "tow_a", "tow_b"] and found.where("tow_a <=> tow_b").count() == 5
    assert models.importances(model).count() == 3
    assert models.settings_table(spark, {"m": model}).first().value == "5"


def test_rough_distances_lose_no_neighbour():
    """Far from the origin products of pairs round badly; the nearest rows and their order are still those of full distances."""
    rng = np.random.default_rng(6)
    for far, whole in ((0.0, True), (1e7, False), (1e200, False)):
        x, points = (far + (np.round(p) if whole else p) for p in (rng.normal(size=(400, 3)) * 5, rng.normal(size=(50, 3)) * 5))
        d = sum(np.square(points[:, f, None] - x[:, f]) for f in range(3))
        plain = np.argsort(d, axis=1, kind="stable")[:, :5]
        own, at, found = neighbours._nearest(x, points, np.full(50, np.inf), 5)
        np.testing.assert_array_equal(at.reshape(50, 5), plain)
        own, at, _ = neighbours._nearest(x, points, found.reshape(50, 5)[:, -1], 5)
        np.testing.assert_array_equal(at.reshape(50, 5), plain)


def test_equal_rows_are_asked_for_once(spark, monkeypatch):
    x = np.repeat(_points(20, 5), 30, axis=0)
    model = index_rows(_frame(spark, x, x[:, 0]), ["a", "b", "c"], k=3)
    asked, plain = [], neighbours.neighbours
    monkeypatch.setattr(neighbours, "neighbours", lambda model, rows: asked.append(rows.count()) or plain(model, rows))
    told = {r.flight_id: r.prediction for r in model.predict(_frame(spark, x, x[:, 0])).collect()}
    assert asked == [20] and [told[i] for i in range(600)] == pytest.approx(x[:, 0].tolist())
