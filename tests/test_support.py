import numpy as np
import pytest

from skyload.operators import models, support
from skyload.operators.support import COSINES, loss, train_support
from skyload.sources.sinks import load_model, save_model

SCHEMA = "flight_id long, a double, b double, k double, tow double"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    x = np.c_[rng.normal(50, 10, 400), rng.normal(0, 0.1, 400), np.full(400, 0.1)]
    y = 1000 + 80 * np.sin((x[:, 0] - 50) / 8) + 300 * x[:, 1] + rng.normal(0, 3, 400)
    rows = [(i, *map(float, p), float(t)) for i, (p, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame([*rows, (-1, None, 1.0, 0.1, 9.0), (-2, 1.0, float("nan"), 0.1, None)], SCHEMA).repartition(4).persist()
    return df, x, y


def _plain(z, y, cost, tube, rounded, steps=20_000):
    """The least of the objective by steps along the gradient with momentum; all rows at once."""
    penalised = np.append(np.ones(z.shape[1] - 1), 0.0)
    rate = 1 / (cost * np.linalg.norm(z, 2) ** 2 / rounded + 1)
    at = ahead = np.zeros(z.shape[1])
    value = lambda w: cost * loss(y - z @ w, tube, rounded)[0].sum() + 0.5 * np.square(w) @ penalised
    least = value(at)
    for i in range(steps):
        slope = -cost * z.T @ loss(y - z @ ahead, tube, rounded)[1] + penalised * ahead
        new = ahead - rate * slope
        ahead = new + i / (i + 3) * (new - at)
        at = new
        least = min(least, value(at)) if i % 100 == 0 else least
    return least


def test_loss_and_its_slopes():
    left = np.array([-1.0, -0.12, 0.0, 0.05, 0.11, 0.2])
    value, one, two = loss(left, 0.1, 0.05)
    assert value == pytest.approx([0.875, 0.004, 0, 0, 0.001, 0.075])
    step = 1e-7
    assert one == pytest.approx((loss(left + step, 0.1, 0.05)[0] - loss(left - step, 0.1, 0.05)[0]) / (2 * step), abs=1e-5)
    assert two.tolist() == [0, 20, 0, 0, 20, 0]
    true = np.maximum(np.abs(left) - 0.1, 0)
    assert np.all(true - value <= 0.025 + 1e-12) and np.all(value <= true)


def test_objective_falls_to_that_of_a_plain_solver(data):
    df, x, y = data
    model, course = train_support(df, ["a", "b", "k"], cosines=40)
    assert all(later < earlier for earlier, later in zip(course, course[1:]))
    z = model.projection.of(x)
    assert course[-1] <= _plain(z, (y - y.mean()) / y.std(), 1.0, 0.1, 0.05) * (1 + 1e-4)
    told = {r.flight_id: r.prediction for r in model.predict(df).collect()}
    assert told.pop(-1) is None and told.pop(-2) is None
    assert [told[i] for i in range(400)] == pytest.approx((z @ model.coefficients * y.std() + y.mean()).tolist())


def test_learner_follows_a_curve_saves_and_loads(spark, data, tmp_path):
    df, x, y = data
    model = models.train(df, models.Learner("support"))
    told = {r.flight_id: r.prediction for r in models.predict(model, df).collect()}
    assert len(model.coefficients) == COSINES + 1
    assert np.sqrt(np.mean([(told[i] - y[i]) ** 2 for i in range(400)])) < 0.25 * y.std()
    save_model(model, str(tmp_path), "m")
    again = load_model(spark, str(tmp_path), "m")
    found = models.batch_predict({"x": model, "y": again}, df, ("flight_id", "tow"))
    assert found.columns == ["flight_id", "tow", "tow_x", "tow_y"] and found.where("tow_x <=> tow_y").count() == 402
    assert sum(r.importance for r in models.importances(model).collect()) == pytest.approx(1)
    assert models.settings_table(spark, {"m": model}).first().value == str(COSINES)


def test_no_rows_and_a_constant_target(spark, data):
    df, _, _ = data
    none, course = train_support(df.limit(0), ["a", "b"], cosines=8)
    assert course == [] and {r.prediction for r in none.predict(df.where("flight_id >= 0")).collect()} == {0.0}
    even = df.where("flight_id >= 0").selectExpr("flight_id", "a", "0.1D AS tow")
    model, _ = train_support(even, ["a"], cosines=8)
    assert {r.prediction for r in model.predict(even).collect()} == {0.1}


def test_equal_rows_are_one_with_their_number(spark, data, monkeypatch):
    """The steps read different rows alone; mean, deviation and objective are those of all."""
    df = data[0] if isinstance(data, tuple) else data
    read, plain = [], support.stable
    monkeypatch.setattr(support, "stable", lambda rows: read.append(rows.count()) or plain(rows))
    one, first = train_support(df, ["a", "b"], cosines=8)
    three, again = train_support(df.unionByName(df).unionByName(df), ["a", "b"], cosines=8, cost=1 / 3)
    assert read[0] == read[1] and again[0] == pytest.approx(first[0]) and again[-1] == pytest.approx(first[-1])
    assert (three.mean, three.deviation) == pytest.approx((one.mean, one.deviation))
