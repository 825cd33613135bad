import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.operators import metrics, models
from skyload.operators.prepare import train_test_split
from skyload.plans.segment_models import train_segment_models
from skyload.plans.tabular import run_tabular
from skyload.settings import Settings
from skyload.sources.sinks import load_model, save_model

GBT = models.Learner("gbt", depth=3, iterations=4, rate=0.3)
FOREST = models.Learner("forest", depth=3, iterations=4)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    y = 10 * x[:, 0] + 3 * x[:, 1] + rng.normal(0, 0.1, 400)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "flight_id long, a double, b double, c double, d double, tow double")
    return tuple(part.persist() for part in train_test_split(df))


def test_train_predict_and_save(spark, data, tmp_path):
    train, test = data
    model = models.train(train, GBT, test)
    found = models.predict(model, test)
    assert found.columns == ["flight_id", "prediction"] and found.count() == test.count()
    target = save_model(model, str(tmp_path), "gbt")
    assert target.endswith("/gbt")
    again = models.predict(load_model(spark, f"{tmp_path}/", "gbt"), test)
    assert sorted(again.collect()) == sorted(found.collect())


def test_predictions_are_null_for_incomplete_rows(data):
    train, test = data
    model = models.train(train, models.Learner("linear"))
    holed = test.withColumn("a", F.when(F.col("flight_id") % 2 == 0, F.col("a")))
    for found, name in ((models.predict(model, holed), "prediction"), (models.batch_predict({"m": model}, holed), "tow_m")):
        rows = {r.flight_id: r[name] for r in found.collect()}
        assert len(rows) == holed.count()
        assert all((value is None) == (key % 2 == 1) for key, value in rows.items())


def test_ensemble(data):
    train, test = data
    found = models.train_ensemble(train, test, {"boosted": GBT, "forest": FOREST})
    row = found.predictions.first()
    assert row.tow_ensemble == pytest.approx((row.tow_boosted + row.tow_forest) / 2)
    assert {r.model for r in found.metrics.collect()} == {"boosted", "forest", "ensemble"}
    top = found.top_features.collect()
    assert top[0].feature == "a"
    assert top[0].mean_importance == pytest.approx((top[0].boosted_importance + top[0].forest_importance) / 2)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 3.0), (3, 5.0, 4.0), (4, None, 4.0)], "flight_id long, tow double, prediction double")
    row = metrics.regression_metrics(df).first()
    assert (row.mse, row.rmse) == (pytest.approx(2 / 3), pytest.approx(math.sqrt(2 / 3)))
    assert row.r2 == pytest.approx(1 - 2 / 8)


def test_grid_search_covers_the_grid(data):
    model, trials = models.grid_search(data[0], GBT, {"maxIter": [1, 3], "maxDepth": [1, 2]}, parallelism=2)
    rows = trials.collect()
    assert len(rows) == 4 and all(r.mse > 0 for r in rows)
    best = min(rows, key=lambda r: r.mse)
    assert model.stages[-1].getMaxIter() == best.maxIter
    _, trials = models.grid_search(data[0], FOREST, {"maxIter": [1, 2], "maxDepth": [2], "stepSize": [0.1]})
    assert {r.numTrees for r in trials.collect()} == {1, 2}


def test_random_search(data):
    best, trials = models.random_search(data[0], trials=3, iterations=(1, 3), depth=(2, 3))
    rows = trials.collect()
    assert len(rows) == 3
    assert best["stepSize"] == pytest.approx(min(rows, key=lambda r: r.rmse).stepSize)
    cut = models.random_search(data[0], trials=4, timeout=0, iterations=(1, 2), depth=(2, 2), parallelism=1)[1].collect()
    assert [r.rmse is None for r in sorted(cut, key=lambda r: r.trial)] == [False, True, True, True]


def test_random_search_reads_equal_rows_once(data, monkeypatch):
    """Copies of all rows change no error: sums are weighted by their number, and their keys are of the same fold here."""
    df, read, plain = data[0], [], models.stable
    monkeypatch.setattr(models, "stable", lambda rows: read.append(rows.count()) or plain(rows))
    found = [
        {r.trial: r.rmse for r in models.random_search(rows, trials=3, kind="boosted_deep", iterations=(1, 3), depth=(2, 3))[1].collect()}
        for rows in (df, df.unionByName(df).unionByName(df))
    ]
    assert read[0] == read[1] == df.count() and found[1] == pytest.approx(found[0], rel=1e-6)


def test_recursive_elimination(data):
    left, ranks = models.recursive_elimination(data[0], keep=2)
    assert left == ["a", "b"]
    assert sorted(r["rank"] for r in ranks.collect()) == [1, 1, 2, 3]


def test_leaderboard(data):
    best, board = models.leaderboard(*data, {"linear": models.Learner("linear"), "forest": FOREST, "lasso": models.Learner("lasso")})
    assert [r.model for r in board.collect()][0] == "linear"
    assert best.features == ["a", "b", "c", "d"] and best.coefficients[:2] == pytest.approx([10, 3], abs=0.1)
    with pytest.raises(ValueError):
        models.estimator(models.Learner("unknown"))


def test_tabular_run(spark, data, tmp_path):
    """What is written can be read again."""
    train, test = data
    folder = str(tmp_path)
    run = run_tabular(train.unionByName(test), Settings(num_features=2), {"gbt": GBT, "forest": FOREST}, folder)
    assert run.selected == ["a", "b"]
    assert run.predictions.columns == ["flight_id", "tow_gbt", "tow_forest"]
    assert run.metrics.count() == 2
    assert spark.read.parquet(f"{folder}/features").count() == 400
    written = spark.read.option("header", True).csv(f"{folder}/predictions")
    assert written.columns == run.predictions.columns and written.count() == test.count()
    report = {r.model: r for r in spark.read.json(f"{folder}/metrics").collect()}
    assert report["gbt"].parameters.maxIter == "4" and report["forest"].parameters.numTrees == "4"
    assert report["gbt"].rmse == pytest.approx({r.model: r.rmse for r in run.metrics.collect()}["gbt"])
    assert spark.read.option("header", True).csv(f"{folder}/feature_scores").count() == 4
    assert load_model(spark, f"{folder}/models", "gbt").stages[-1].getMaxIter() == 4


def test_segment_models(spark, data, tmp_path):
    train, test = data
    split = train.unionByName(test).withColumn(
        "segment", F.when(F.col("flight_id") % 2 == 0, "low").otherwise("b77w")
    )
    trained, table = train_segment_models(split, {"boosted": GBT, "forest": FOREST}, k=2, model_path=str(tmp_path), folder=f"{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out/predictions").iterdir()) == ["b77w", "low"]
    assert spark.read.json(f"{tmp_path}/out/metrics/low").count() == 3
    assert set(trained) == {"low", "b77w"} and table.count() == 6
    assert (tmp_path / "low_boosted").is_dir() and (tmp_path / "b77w_forest").is_dir()


def test_rows_of_a_task_are_bounded(spark, data, monkeypatch):
    """Boosted trees and forests get as many partitions as the rows call for, whichever the reader had."""
    monkeypatch.setattr(models, "TASK_ROWS", 20)
    seen, whole = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: seen.append(rows.rdd.glom().map(len).collect()) or whole(self, rows))
    train, test = data
    models.train(train.coalesce(1), models.Learner("gbt", depth=2, iterations=1), test.coalesce(1))
    assert sum(seen[0]) == 400 and len(seen[0]) == 20 and max(seen[0]) <= 50


def test_settings_share_the_trees_of_the_longest(data, monkeypatch):
    """Settings that differ in the number of trees alone are one model, and have the errors that they have alone."""
    made, plain = [], models.boost_whole
    monkeypatch.setattr(models, "boost_whole", lambda jobs, *a, **k: made.append(len(jobs)) or plain(jobs, *a, **k))
    for learner in (models.SECOND, models.FIRST):
        grid = {"maxIter": [2, 5], "stepSize": [0.1], "maxDepth": [2, 3]}
        together = {(r.maxIter, r.maxDepth): r.mse for r in models.grid_search(data[0], learner, grid)[1].collect()}
        assert made.pop() == 2 * 3
        alone = models.grid_search(data[0], learner, {"maxIter": [2], "stepSize": [0.1], "maxDepth": [3]})[1].first().mse
        made.pop()
        assert together[2, 3] == pytest.approx(alone) and len(set(together.values())) == 4
        monkeypatch.setattr("skyload.operators.boosting_whole.BYTES_IN_TASK", 0)
        assert {(r.maxIter, r.maxDepth): r.mse for r in models.grid_search(data[0], learner, grid)[1].collect()} == pytest.approx(together)
        assert not made
        monkeypatch.undo()
        monkeypatch.setattr(models, "boost_whole", lambda jobs, *a, **k: made.append(len(jobs)) or plain(jobs, *a, **k))


def test_random_search_against_separate_models(data):
    """A trial's error is that of models trained apart on the rows without each fold."""
    rows = models._folds(data[0], 3)
    best, table = models.random_search(data[0], trials=2, kind="boosted_deep", iterations=(2, 4), depth=(2, 3), features=["a", "b"])
    for r in table.collect():
        learner = models.Learner("histogram", int(r.maxDepth), int(r.maxIter), r.stepSize, l2=0.0)
        errors = []
        for fold in range(3):
            model = models.train(rows.where(F.col("_fold") != fold), learner, features=["a", "b"])
            told = models.predict(model, rows.where(F.col("_fold") == fold), ("flight_id", "tow"))
            errors.append(math.sqrt(told.agg(F.avg((F.col("prediction") - F.col("tow")) ** 2)).first()[0]))
        assert r.rmse == pytest.approx(sum(errors) / 3, rel=1e-6)
    with pytest.raises(ValueError):
        models.random_search(data[0].limit(0), trials=1)
