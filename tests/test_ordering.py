import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.operators.ordering import exact_quantiles, long_groups, split_by_length, with_row_index

PROBABILITIES = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q77": 0.77, "q100": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds most rows, and one value a third of them."""
    rng = np.random.default_rng(5)
    keys = np.where(rng.random(3000) < 0.7, 0, rng.integers(1, 5, 3000))
    values = np.where(rng.random(3000) < 0.33, 1.5, rng.normal(size=3000))
    rows = [(int(k), float(v), i) for i, (k, v) in enumerate(zip(keys, values, strict=True))]
    rows += [(9, None, 3000), (9, 4.0, 3001)]
    return spark.createDataFrame(rows, "k int, v double, i int").repartition(13)


@pytest.mark.parametrize("values_in_task", [10, 10**6])
def test_quantiles_equal_numpy(skewed, values_in_task):
    table = skewed.toPandas().dropna()
    found = exact_quantiles(skewed, "v", PROBABILITIES, values_in_task=values_in_task).first()
    for name, p in PROBABILITIES.items():
        assert found[name] == pytest.approx(np.quantile(table.v, p), abs=1e-12)
    by_key = exact_quantiles(skewed, "v", PROBABILITIES, ["k"], values_in_task).collect()
    assert len(by_key) == table.k.nunique()
    for row in by_key:
        for name, p in PROBABILITIES.items():
            assert row[name] == pytest.approx(np.quantile(table.v[table.k == row.k], p), abs=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, "v", {"q": 0.5}).first().q is None


def test_row_index(skewed):
    rows = skewed.where(F.col("v").isNotNull())
    found = with_row_index(rows, ["v", "i"], ["k"]).toPandas().sort_values(["k", "v", "i"])
    for _, group in found.groupby("k"):
        assert group.row_no.tolist() == list(range(len(group)))
        assert set(group.n_points) == {len(group)}
    found = with_row_index(rows, ["v", "i"]).toPandas().sort_values(["v", "i"])
    assert found.row_no.tolist() == list(range(rows.count()))


def test_long_groups(skewed):
    assert [r.k for r in long_groups(skewed, "k", 1000).collect()] == [0]
    assert long_groups(skewed, "k", 10**6) is None
    usual, long = split_by_length(skewed, "k", 1000)
    assert usual.where("k = 0").count() == 0
    assert usual.count() + long.count() == skewed.count()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_quantiles_have_the_bits_of_the_built_in(spark, keys):
    """Also on ties of numbers that no binary fraction holds, and for a NULL key."""
    rows = [(None if i % 3 == 0 else i % 3, [0.1, 0.7, 1 / 3, 2.3][i % 4] if i % 5 else i / 7) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v double")
    probabilities = {f"p{i}": i / 97 for i in range(98)}
    wanted = df.groupBy(*keys).agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probabilities.items()]).collect()
    for values_in_task in (10**6, 1):
        found = exact_quantiles(df, "v", probabilities, keys, values_in_task=values_in_task).collect()
        assert sorted(map(tuple, found), key=str) == sorted(map(tuple, wanted), key=str)


def test_null_is_a_long_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(45)] + [(1, i) for i in range(5)], "k int, v int")
    usual, long = split_by_length(df, "k", 10)
    assert (usual.count(), long.count()) == (5, 45)
