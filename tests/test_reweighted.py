import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.operators import models, reweighted
from skyload.operators.reweighted import train_reweighted, weighted_median
from skyload.sources.sinks import load_model, save_model


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    flags = rng.integers(0, 2, size=(300, 3)).astype(float)
    y = 5 * flags[:, 0] + 3 * flags[:, 1] * flags[:, 0] - 2 * flags[:, 2] + rng.normal(0, 1, 300)
    rows = [(i, *map(float, f), float(t)) for i, (f, t) in enumerate(zip(flags, y, strict=True))]
    schema = "flight_id long, a double, `b.b` double, c double, tow double"
    return spark.createDataFrame([*rows, (-1, None, 1.0, 1.0, 9.0)], schema).repartition(4).persist(), flags, y


def _stump(flags, y, w):
    """The flag whose weighted means leave the least squared error, and those means."""
    means = [[np.average(y[flags[:, f] == v], weights=w[flags[:, f] == v]) for v in (0, 1)] for f in range(flags.shape[1])]
    left = [np.sum(w * (y - np.where(flags[:, f] == 1, m[1], m[0])) ** 2) for f, m in enumerate(means)]
    f = int(np.argmin(left))
    return np.where(flags[:, f] == 1, means[f][1], means[f][0])


def _plain(flags, y, iterations, rate, power):
    w, told, weights = np.ones(len(y)), [], []
    for _ in range(iterations):
        p = _stump(flags, y, w)
        loss = (np.abs(p - y) / np.abs(p - y).max()) ** power
        mean = np.average(loss, weights=w)
        if mean >= 0.5 and told:
            break
        told.append(p)
        weights.append(rate * math.log((1 - mean) / mean))
        w = w * (mean / (1 - mean)) ** (rate * (1 - loss))
        w /= w.mean()
    told, weights = np.array(told), np.array(weights)
    out = []
    for column in told.T:
        order = np.argsort(column, kind="stable")
        out.append(column[order][np.searchsorted(np.cumsum(weights[order]), weights.sum() / 2 * (1 - 1e-12))])
    return weights, np.array(out)


@pytest.mark.parametrize(("rate", "power"), [(1.0, 1), (0.5, 2)])
def test_weights_and_medians_against_a_plain_version(data, monkeypatch, rate, power):
    df, flags, y = data
    monkeypatch.setattr(reweighted, "TREES_A_STAGE", 3)
    model = train_reweighted(df.withColumnRenamed("b.b", "b"), ["a", "b", "c"], depth=1, iterations=7, rate=rate, power=power)
    weights, told = _plain(flags, y, 7, rate, power)
    assert model.weights == pytest.approx(weights.tolist())
    got = {r.flight_id: r.prediction for r in model.predict(df.withColumnRenamed("b.b", "b")).collect()}
    assert got.pop(-1) is None
    assert [got[i] for i in range(300)] == pytest.approx(told.tolist())


def test_weighted_median(spark):
    row = spark.range(1).select(
        weighted_median([F.lit(v) for v in (3.0, 1.0, 2.0)], [1.0, 1.0, 1.0]).alias("middle"),
        weighted_median([F.lit(v) for v in (3.0, 1.0, 2.0)], [5.0, 1.0, 1.0]).alias("heavy"),
        weighted_median([F.lit(v) for v in (2.0, 1.0)], [1.0, 1.0]).alias("lower"),
        weighted_median([F.lit(7.0)], [0.2]).alias("one"),
    ).first()
    assert (row.middle, row.heavy, row.lower, row.one) == (2.0, 3.0, 1.0, 7.0)


def test_ends_where_nothing_is_missed_or_too_much(spark):
    exact = spark.createDataFrame([(i, float(i % 2), 10.0 * (i % 2)) for i in range(20)], "flight_id long, a double, tow double")
    model = train_reweighted(exact, ["a"], iterations=5)
    assert model.weights == [1.0] and {r.prediction for r in model.predict(exact).collect()} == {0.0, 10.0}
    # Every row is equally far off, so the mean loss of the first tree is 1.
    even = spark.createDataFrame([(i, 1.0, float(i % 2)) for i in range(20)], "flight_id long, a double, tow double")
    assert train_reweighted(even, ["a"], iterations=5).weights == [1.0]
    with pytest.raises(ValueError):
        train_reweighted(exact.limit(0), ["a"])


def test_learner_saves_and_loads(spark, data, tmp_path):
    df = data[0].withColumnRenamed("b.b", "b")
    model = models.train(df, models.Learner("reweighted", depth=2, iterations=3, rate=1.0))
    save_model(model, str(tmp_path), "m")
    again = load_model(spark, str(tmp_path), "m")
    assert again.weights == model.weights and again.features == ["a", "b", "c"]
    both = models.batch_predict({"x": model, "y": again, "z": model}, df, ("flight_id", "tow"))
    assert both.columns == ["flight_id", "tow", "tow_x", "tow_y", "tow_z"]
    assert both.where("tow_x <=> tow_y AND tow_x <=> tow_z").count() == 301 and both.where("tow_x IS NULL").count() == 1
    shares = {r.feature: r.importance for r in models.importances(model).collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "a"
    assert models.settings_table(spark, {"m": model}).first().value == str(len(model.weights))


def test_equal_rows_are_one_with_their_number(spark, data, monkeypatch):
    """Every tree reads the different rows alone, and the model is that of all rows."""
    df = data[0].withColumnRenamed("b.b", "b")
    more = df.crossJoin(spark.range(4).select(F.col("id").alias("copy"))).where("flight_id % 3 = 0 OR copy = 0").drop("copy")
    read, plain = [], reweighted.stable
    monkeypatch.setattr(reweighted, "stable", lambda rows: read.append(rows.count()) or plain(rows))
    model = train_reweighted(more, ["a", "b", "c"], depth=1, iterations=3)
    _, flags, y = data
    number = np.where(np.arange(300) % 3 == 0, 4, 1)
    weights, told = _plain(np.repeat(flags, number, axis=0), np.repeat(y, number), 3, 1.0, 1)
    assert read == [300] and model.weights == pytest.approx(weights.tolist())
    got = {r.flight_id: r.prediction for r in model.predict(df.where("flight_id >= 0")).collect()}
    assert [got[i] for i in range(300)] == pytest.approx(told[np.cumsum(number) - 1].tolist())
