import subprocess
import sys
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.operators import boosting, boosting_whole
from skyload.operators.boosting import Boosting, HistogramModel, byte_table, column_edges, drawn, drawn_columns, stage_errors, train_histogram
from skyload.session import to_tasks

FEATURES = ["a", "b", "c"]


def _data(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=n), rng.integers(0, 5, n), rng.normal(size=n)]
    y = 100 + 10 * (x[:, 0] > 0) + 3 * x[:, 1] * (x[:, 2] > 0.5) + rng.normal(0, 0.5, n)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "flight_id long, a double, b double, c double, tow double").repartition(3).persist(), x, y


def _plain(bins, y, draws, settings):
    """The same boosting with plain loops, as nested tuples: (feature, bin, left, right) or a leaf's value."""
    told, trees = np.full(len(y), y.mean()), []

    def score(g, n):
        return g * g / (n + settings.l2)

    def build(rows, gradient, allowed, depth):
        g = gradient[rows].sum()
        best = None
        if depth < settings.depth:
            for f in allowed:
                for b in np.unique(bins[rows, f])[:-1]:
                    left = rows[bins[rows, f] <= b]
                    gl = gradient[left].sum()
                    gain = score(gl, len(left)) + score(g - gl, len(rows) - len(left)) - score(g, len(rows))
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, b)
        if best is None:
            return -settings.rate * g / (len(rows) + settings.l2)
        _, f, b = best
        go = bins[rows, f] <= b
        return (int(f), int(b), build(rows[go], gradient, allowed, depth + 1), build(rows[~go], gradient, allowed, depth + 1))

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for t in range(settings.iterations):
        rows = np.flatnonzero(drawn(draws, t, settings.subsample, settings.seed))
        trees.append(build(rows, told - y, np.flatnonzero(drawn_columns(bins.shape[1], t, settings)), 0))
        told = told + np.array([value(trees[-1], r) for r in bins])
    return trees, told


def _nested(tree, node=0):
    if tree.feature[node] < 0:
        return float(tree.value[node])
    return (int(tree.feature[node]), int(tree.bin[node]), _nested(tree, tree.left[node]), _nested(tree, tree.right[node]))


def _same(x, y):
    if isinstance(x, tuple):
        return x[:2] == y[:2] and _same(x[2], y[2]) and _same(x[3], y[3])
    return x == pytest.approx(y, abs=1e-6)


@pytest.mark.parametrize("settings", [Boosting(3, 4, 0.3, 1.0), Boosting(2, 4, 0.5, 5.0, subsample=0.6, column_share=0.5)])
def test_same_trees_as_plain_version(spark, monkeypatch, settings):
    monkeypatch.setattr(boosting, "TREES_A_STAGE", 3)
    df, x, y = _data(spark)
    model = train_histogram(df, settings, features=FEATURES)
    draws = np.array([r[0] for r in df.select(F.xxhash64("flight_id"), "flight_id").orderBy("flight_id").collect()])
    trees, told = _plain(model.bins(list(x.T)), y, draws, settings)
    assert len(model.trees) == 4 and all(_same(_nested(m), p) for m, p in zip(model.trees, trees, strict=True))
    got = {r["flight_id"]: r["prediction"] for r in model.predict(df).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(told.tolist(), abs=1e-6)


def _plain_levels(bins, y, settings):
    """Symmetric trees with plain loops: the splits and leaf values of each, and the predictions."""
    told, trees = np.full(len(y), y.mean()), []

    def score(g, n):
        return g * g / (n + settings.l2) if n else 0.0

    for _ in range(settings.iterations):
        gradient, at, splits = told - y, np.zeros(len(y), int), []
        while len(splits) < settings.depth:
            best = None
            for f in range(bins.shape[1]):
                for b in np.unique(bins[:, f]):
                    right = bins[:, f] > b
                    gain = 0.0
                    for node in np.unique(at):
                        here, there = gradient[(at == node) & ~right], gradient[(at == node) & right]
                        if len(here) and len(there):
                            gain += score(here.sum(), len(here)) + score(there.sum(), len(there)) - score(gradient[at == node].sum(), len(here) + len(there))
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, int(b))
            if best is None:
                break
            at = at + ((bins[:, best[1]] > best[2]).astype(int) << len(splits))
            splits.append(best[1:])
        value = [-settings.rate * gradient[at == n].sum() / ((at == n).sum() + settings.l2) if (at == n).any() else 0.0 for n in range(1 << len(splits))]
        trees.append((splits, value))
        told = told + np.array(value)[at]
    return trees, told


@pytest.mark.parametrize("settings", [Boosting(3, 4, 0.3, 1.0, symmetric=True), Boosting(4, 3, 0.9, 0.0, symmetric=True)])
def test_symmetric_trees_as_plain_version(spark, monkeypatch, tmp_path, settings):
    monkeypatch.setattr(boosting, "TREES_A_STAGE", 2)
    df, x, y = _data(spark)
    model = train_histogram(df, settings, features=FEATURES)
    trees, told = _plain_levels(model.bins(list(x.T)), y, settings)
    assert len(model.trees) == len(trees)
    for made, (splits, value) in zip(model.trees, trees, strict=True):
        assert list(zip(made.feature, made.bin, strict=True)) == splits
        assert made.value == pytest.approx(value, abs=1e-6)
    model.save(spark, str(tmp_path))
    got = {r["flight_id"]: r["prediction"] for r in HistogramModel.load(spark, str(tmp_path)).predict(df).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(told.tolist(), abs=1e-6)
    assert model.importances().orderBy(F.desc("importance")).first().feature == "a"


def test_symmetric_trees_for_any_partitioning_and_without_gain(spark):
    df, _, _ = _data(spark)
    first, second = [train_histogram(df.repartition(n), Boosting(3, 2, 0.3, symmetric=True), features=FEATURES) for n in (1, 7)]
    for a, b in zip(first.trees, second.trees, strict=True):
        assert a.feature.tolist() == b.feature.tolist() and a.bin.tolist() == b.bin.tolist() and a.value.tolist() == b.value.tolist()
    same = train_histogram(df.withColumn("tow", F.lit(5.0)), Boosting(3, 2, 0.3, symmetric=True), features=FEATURES)
    assert [t.value.tolist() for t in same.trees] == [[0.0], [0.0]] and {r.prediction for r in same.predict(df).collect()} == {5.0}


def test_same_trees_for_any_partitioning(spark):
    df, _, _ = _data(spark)
    first, second = [train_histogram(df.repartition(n), Boosting(3, 2, 0.3), features=FEATURES) for n in (1, 7)]
    assert [_nested(t) for t in first.trees] == [_nested(t) for t in second.trees]


def test_patience_keeps_the_stage_of_the_least_error(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TREES_A_STAGE", 4)
    df, _, _ = _data(spark, 60)
    test, x, y = _data(spark, 80, seed=5)
    settings = Boosting(3, 24, 0.9, 0.0, patience=5)
    whole = train_histogram(df, replace(settings, iterations=20), features=FEATURES)
    told = [((p - y) ** 2).sum() for p in whole.stages(whole.bins(list(x.T)))]
    cut = train_histogram(df, settings, test, features=FEATURES)
    # The first stages alone count that came before the patience was at an end.
    seen = next(i for i in range(len(told)) if i % 4 == 0 and i - int(np.argmin(told[: i + 1])) >= 5)
    assert len(cut.trees) == int(np.argmin(told[: seen + 1])) < 20


def test_errors_of_all_stages_in_one_pass(spark):
    df, x, y = _data(spark)
    model = train_histogram(df, Boosting(3, 5, 0.3), features=FEATURES)
    table = byte_table(df, model).withColumn("told", F.lit(model.base))
    found = stage_errors(table, model)
    assert [found[i] for i in range(6)] == pytest.approx([((p - y) ** 2).sum() for p in model.stages(model.bins(list(x.T)))])
    assert all(found[i + 1] < found[i] for i in range(5))


def test_edges_save_and_missing_features(spark, tmp_path):
    df, _, _ = _data(spark)
    edges = column_edges(df, FEATURES)
    assert edges[1].tolist() == [0.0, 1.0, 2.0, 3.0] and len(edges[0]) <= 254
    model = train_histogram(df, Boosting(2, 2, 0.3), features=FEATURES)
    model.save(spark, str(tmp_path))
    again = HistogramModel.load(spark, str(tmp_path))
    rows = df.limit(20).union(spark.createDataFrame([(999, None, 1.0, 1.0, 0.0)], df.schema))
    got = sorted(again.predict(rows).collect())
    assert got == sorted(model.predict(rows).collect()) and got[-1] == (999, None)
    shares = {r["feature"]: r["importance"] for r in again.importances().collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "a"


def test_no_complete_rows(spark):
    df, _, _ = _data(spark)
    model = train_histogram(df.withColumn("b", F.lit(None).cast("double")), Boosting(2, 2), features=FEATURES)
    assert model.trees == [] and model.base == 0.0


@pytest.mark.parametrize("symmetric", [True, False])
def test_models_grow_side_by_side(spark, monkeypatch, symmetric):
    """Models of several tables and settings are those made one by one, in as many jobs of levels as the largest takes."""
    monkeypatch.setattr(boosting, "TREES_A_STAGE", 1)
    tables = [boosting.bin_rows(_data(spark, n, n)[0], FEATURES) for n in (80, 120)]
    settings = [Boosting(2, 2, 0.3, 1.0, symmetric=symmetric), Boosting(1, 1, 0.5, 3.0, symmetric=symmetric)]
    jobs = [(t, s) for t in tables for s in settings]
    alone = [boosting.boost(*job) for job in jobs]
    levels, plain = [], boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda *a, **k: levels.append(1) or plain(*a, **k))
    together = boosting.boost_all(jobs)
    assert len(levels) == 6
    for a, b in zip(alone, together, strict=True):
        assert len(a.trees) == len(b.trees) and all((x.value == y.value).all() and (x.feature == y.feature).all() for x, y in zip(a.trees, b.trees, strict=True))
    monkeypatch.setattr(boosting, "CELLS_IN_TASK", 1)
    apart = boosting.boost_all(jobs[:2])
    assert all((x.value == y.value).all() for a, b in zip(alone, apart, strict=False) for x, y in zip(a.trees, b.trees, strict=True))


def test_models_reach_tasks_without_the_package(spark):
    model = HistogramModel(["a"], [np.array([0.0])], 1.0, [])
    held = to_tasks(spark, model)
    script = "import pickle, sys; m = pickle.loads(sys.stdin.buffer.read()); print(m.base); assert 'skyload' not in sys.modules"
    done = subprocess.run([sys.executable, "-I", "-c", script], input=held.value, capture_output=True, cwd="/")
    assert done.returncode == 0 and done.stdout.strip() == b"1.0", done.stderr


@pytest.mark.parametrize("settings", [Boosting(4, 5, 0.3), Boosting(8, 3, 0.5, 0.0, subsample=0.6, column_share=0.5), Boosting(5, 5, 0.3, 3.0, symmetric=True)])
@pytest.mark.parametrize("weight", [None, "times"])
def test_models_of_a_task_are_those_of_many_jobs(spark, monkeypatch, settings, weight):
    """To the bit, with equal rows as one too, and with cells counted in any number of pieces."""
    monkeypatch.setattr(boosting, "TREES_A_STAGE", 2)
    df, test = (_data(spark, n, n)[0].withColumn("times", (F.col("flight_id") % 3 + 1).cast("double")) for n in (250, 90))
    binned = boosting.bin_rows(df, FEATURES, weight=weight)
    held = binned.of(test)
    wanted = boosting.boost_all([(binned, settings)])[0]
    errors = stage_errors(held, wanted)
    sent = boosting_whole.send(binned, held)
    for cells in (1 << 18, 300):
        monkeypatch.setattr(boosting_whole, "CELLS_AT_ONCE", cells)
        [(found, course)] = boosting_whole.boost_whole([(sent, settings)], 2)
        assert len(found.trees) == len(wanted.trees) == settings.iterations and found.base == wanted.base
        for a, b in zip(found.trees, wanted.trees, strict=True):
            assert a.feature.tolist() == b.feature.tolist() and a.bin.tolist() == b.bin.tolist() and a.value.tolist() == b.value.tolist()
            assert a.gain == pytest.approx(b.gain)
        assert course == pytest.approx([errors[i] for i in range(len(course))])


def test_copies_of_rows_weigh_as_their_number(spark):
    """A row that stands for three grows the trees of three rows."""
    df, _, _ = _data(spark, 100)
    thrice = train_histogram(df.unionByName(df).unionByName(df), Boosting(3, 4, 0.3), features=FEATURES)
    binned = boosting.bin_rows(df.withColumn("times", F.lit(3.0)), FEATURES, weight="times")
    [(once, _)] = boosting_whole.boost_whole([(boosting_whole.send(binned), Boosting(3, 4, 0.3))], 10)
    assert binned.count == 300 and [_nested(t) for t in once.trees] == [_nested(t) for t in thrice.trees]


@pytest.mark.parametrize("symmetric", [True, False])
def test_few_rows_grow_in_a_task_and_many_in_jobs(spark, monkeypatch, symmetric):
    """The same model with the same patience, whichever way: a level is a job only where a task does not hold the rows."""
    (df, _, _), (test, _, _) = _data(spark, 60), _data(spark, 80, seed=5)
    settings, levels, plain = Boosting(3, 12, 0.9, 0.0, patience=4, symmetric=symmetric), [], boosting._histograms
    monkeypatch.setattr(boosting, "TREES_A_STAGE", 3)
    monkeypatch.setattr(boosting, "_histograms", lambda *a, **k: levels.append(1) or plain(*a, **k))
    whole = train_histogram(df, settings, test, features=FEATURES)
    assert not levels
    monkeypatch.setattr(boosting_whole, "BYTES_IN_TASK", 43 * 59)
    parts = train_histogram(df, settings, test, features=FEATURES)
    assert levels and len(whole.trees) == len(parts.trees)
    assert all(a.feature.tolist() == b.feature.tolist() and a.value.tolist() == b.value.tolist() for a, b in zip(whole.trees, parts.trees, strict=True))
