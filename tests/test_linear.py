import numpy as np
import pytest

from skyload.operators import models
from skyload.operators.linear import LinearModel, eliminate, lasso, least_squares, products
from skyload.sources.sinks import load_model, save_model

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(250, 5)) * [1, 10, 0.1, 1000, 1] + [0, 5, 1e6, -20, 3]
    x[:, 1] += 2 * x[:, 0]
    y = 4 * x[:, 0] - 0.5 * x[:, 1] + 30 * x[:, 2] + 0.002 * x[:, 3] + rng.normal(0, 1, 250)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    schema = "flight_id long, a double, b double, c double, d double, e double, tow double"
    df = spark.createDataFrame([*rows, (-1, None, 1.0, 1.0, 1.0, 1.0, 9.0)], schema).repartition(4).persist()
    return df, x, y


def _solved(x, y):
    return np.linalg.lstsq(np.c_[x - x.mean(0)], y - y.mean(), rcond=None)[0]


def test_least_squares(data):
    df, x, y = data
    of = products(df, FEATURES)
    assert of.n == 250 and of.sums == pytest.approx(np.cov(np.c_[x, y].T, bias=True) * 250, rel=1e-9, abs=1e-6)
    model = least_squares(of)
    assert model.coefficients == pytest.approx(_solved(x, y).tolist(), rel=1e-6)
    got = {r.flight_id: r.prediction for r in model.predict(df).collect()}
    assert got.pop(-1) is None
    told = (x - x.mean(0)) @ _solved(x, y) + y.mean()
    assert [got[i] for i in range(250)] == pytest.approx(told.tolist(), abs=1e-4)


def test_elimination_solves_again_without_reading_rows(data, monkeypatch):
    df, x, y = data
    left, order = list(range(5)), []
    while len(left) > 1:
        sizes = np.abs(_solved(x[:, left], y))
        order.insert(0, left.pop(int(np.argmin(sizes))))
    of = products(df, FEATURES)
    assert eliminate(of, 1) == ([FEATURES[left[0]]], [FEATURES[k] for k in order])
    kept, ranks = models.recursive_elimination(df, keep=2, features=FEATURES)
    assert sorted((r["rank"], r.feature) for r in ranks.collect() if r["rank"] > 1) == [(i + 2, FEATURES[k]) for i, k in enumerate(order[1:])]
    assert sorted(kept) == sorted([FEATURES[left[0]], FEATURES[order[0]]])


def test_constant_and_repeated_columns(spark):
    rows = [(i, 0.1, float(i % 7), float(i % 7) * 3, float(i % 5), float(2 * (i % 7) + i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "flight_id long, k double, a double, a3 double, b double, tow double")
    of = products(df, ["k", "a", "a3", "b"])
    assert least_squares(of).coefficients == pytest.approx([0.0, 2.0, 0.0, 1.0])
    # Once ``a`` is gone, its multiple takes its place.
    assert least_squares(of.of(["a3", "b"])).coefficients == pytest.approx([2 / 3, 1.0])
    assert eliminate(of, 2) == (["a", "b"], ["a3", "k"])
    none = products(df.limit(0), ["k", "a"])
    assert none.n == 0 and least_squares(none) == LinearModel(["k", "a"], [0.0, 0.0], 0.0)
    assert lasso(none).coefficients == [0.0, 0.0]


@pytest.mark.parametrize("penalty", [0.01, 1.0, 1e9])
def test_lasso_is_the_least_of_its_objective(data, penalty):
    df, x, y = data
    model = lasso(products(df, FEATURES), penalty)
    left = y - (x @ np.array(model.coefficients) + model.intercept)
    pull = (x - x.mean(0)).T @ left / len(y)
    for value, p, deviation in zip(model.coefficients, pull, x.std(0), strict=True):
        # The slope of the error is the penalty where a coefficient is not 0, and no more elsewhere.
        near = 1e-6 * deviation * y.std()
        assert abs(p - np.sign(value) * penalty) <= near if value else abs(p) <= penalty + near
    assert (penalty < 1e9) == any(model.coefficients)


def test_linear_learners_save_and_load(spark, data, tmp_path):
    df, _, _ = data
    for kind in ("linear", "lasso"):
        model = models.train(df, models.Learner(kind), features=FEATURES)
        save_model(model, str(tmp_path), kind)
        again = load_model(spark, str(tmp_path), kind)
        assert again == model and isinstance(again, LinearModel)
        found = models.batch_predict({"m": again}, df, ("flight_id", "tow"))
        assert found.columns == ["flight_id", "tow", "tow_m"] and found.where("tow_m IS NULL").count() == 1
    assert models.importances(model).count() == 5
