import numpy as np
import pandas as pd
import pytest
from points import climb, flight, points

from skyload.functions import isolation
from skyload.operators import outliers
from skyload.settings import Course


@pytest.fixture(scope="module")
def planted(spark):
    """1000 normal rows and 10 far ones, the latter with ids from 1000."""
    rng = np.random.default_rng(2)
    data = np.vstack([rng.normal(size=(1000, 3)), rng.normal(size=(10, 3)) + 9])
    rows = [(i, *map(float, x)) for i, x in enumerate(data)]
    return spark.createDataFrame(rows, "flight_id long, a double, b double, c double")


def kept(df):
    return {r.flight_id for r in df.collect()}


def test_forest_finds_planted_rows(planted):
    left = kept(outliers.clean(planted, 0.01, exclude=["flight_id"]))
    assert len(left) == 999
    assert len([i for i in left if i >= 1000]) <= 1


def test_forest_does_not_depend_on_partitioning(planted):
    first = outliers.anomaly_scores(planted).toPandas().set_index("flight_id").anomaly_score
    again = outliers.anomaly_scores(planted.repartition(5)).toPandas().set_index("flight_id").anomaly_score
    pd.testing.assert_series_equal(first.sort_index(), again.sort_index())


def test_copies_of_a_row_are_one_draw(spark, planted):
    """A row copied to a third of the table does not fill a tree's group."""
    copies = spark.range(500).selectExpr("0L AS flight_id", "0.5D AS a", "0.5D AS b", "0.5D AS c")
    points = planted.unionByName(copies).select("*", outliers._identity(planted.columns).alias("_identity"), outliers._point(["a", "b", "c"]).alias("_point"))
    candidates = outliers._candidates(points.withColumn("_distinct", outliers.F.lit(1011)))
    sizes = [r["count"] for r in candidates.groupBy("tree").count().collect()]
    assert len(sizes) == isolation.TREES and max(sizes) < 480 and min(sizes) > 290


def test_repeated_keys_lose_their_share(spark):
    """Keys say nothing about rows that share them; samples then still come from all rows."""
    rng = np.random.default_rng(0)
    rows = [(i % 2, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(3000, 2)))]
    df = spark.createDataFrame(rows, "flight_id long, a double, b double")
    assert outliers.clean(df, 0.01).count() == 2970


def test_draws_are_fair():
    """Each distinct row stands for each tree with the same chance, however it is batched."""
    identity = isolation.scatter(np.arange(20000, dtype=np.uint64))
    place, tree, order = isolation.candidates(identity, len(identity))
    assert abs(len(place) / isolation.TREES - isolation.CANDIDATE_ROWS) < 10
    assert np.bincount(tree, minlength=100).std() < 40 and len(set(zip(place.tolist(), tree.tolist()))) == len(place)
    parts = [isolation.candidates(identity[i : i + 5000], len(identity)) for i in range(0, 20000, 5000)]
    again = {(p + 5000 * i, t, o) for i, part in enumerate(parts) for p, t, o in zip(*part)}
    assert again == set(zip(place, tree, order))


def test_a_forest_lacking_trees_is_an_error():
    with pytest.raises(ValueError, match="99 trees"):
        isolation.forest([(np.zeros(1),) * 3] * 99)


def test_incomplete_rows_drop_out(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0), (4, 2.5)], "flight_id long, a double")
    assert kept(outliers.anomaly_scores(df)) == {1, 3, 4}
    assert outliers.clean(df.where("a > 5")).count() == 0


def test_paths_of_small_samples():
    assert isolation.average_path(np.array([1, 2])).tolist() == [0.0, 1.0]
    assert isolation.average_path(np.array([256]))[0] == pytest.approx(10.2448, abs=1e-3)
    same = np.ones((3, 8, 2))
    feature, _, path = isolation.grow(same, isolation.tree_seeds(0)[:3])
    assert (feature == -1).all() and path[0, 0] == pytest.approx(isolation.average_path(np.array([8]))[0])


def test_trees_split_every_row_apart():
    sample = np.random.default_rng(0).normal(size=(5, 8, 2))
    forest = isolation.grow(sample, isolation.tree_seeds(1)[:5])
    scores = isolation.scores(sample[0], forest, 8)
    assert ((scores > 0) & (scores <= 1)).all()


@pytest.fixture(scope="module")
def flights(spark):
    parts = [flight(i, climb(n, i)) for i, n in ((1, 1), (2, 100), (3, 400))]
    parts[2].loc[[50, 200, 350], ["groundspeed", "vertical_rate", "temperature"]] = [900.0, 90000.0, 900.0]
    return points(spark, *parts)


@pytest.mark.parametrize("long_rows", [10**6, 150])
def test_per_flight(flights, long_rows):
    """Flight 3 as one group, and sampled and scored in parts."""
    left = outliers.clean_trajectory(flights, 0.01, Course(long_rows=long_rows), exclude=["flight_id"])
    assert left.columns == flights.columns
    table = left.toPandas()
    sizes = table.groupby("flight_id").size().to_dict()
    assert sizes == {1: 1, 2: 99, 3: 396}
    assert (table.temperature == 900).sum() == 0


@pytest.mark.parametrize("share", [0.01, 0.1])
def test_same_points_whole_and_in_parts(spark, share):
    """Tied points, a NULL flight and flights of all lengths: ``long_rows`` changes nothing."""
    parts = [flight(i, climb(n, i)) for i, n in ((1, 2), (2, 149), (3, 151), (4, 700), (5, 1500))]
    df = points(spark, *parts, parts[3].iloc[:200])
    unknown = df.where("flight_id = 4").withColumn("flight_id", outliers.F.lit(None).cast("long"))
    df = df.unionByName(unknown)
    whole, cut = (sorted(map(str, outliers.clean_trajectory(df, share, Course(long_rows=n)).collect())) for n in (10**6, 150))
    assert whole == cut and len(whole) < df.count()


def test_per_flight_is_repeatable(flights):
    course = Course(long_rows=150)
    first, again = (
        {(r.flight_id, r.timestamp) for r in outliers.clean_trajectory(df, 0.05, course).collect()}
        for df in (flights, flights.repartition(3))
    )
    assert first == again


def test_altitudes_outside_the_range_drop_out(spark):
    df = points(spark, flight(1, [-1.0, 0.0, 47000.0, 47001.0]))
    assert sorted(r.altitude for r in outliers.clean_trajectory(df, 0.0).collect()) == [0.0, 47000.0]


@pytest.mark.parametrize("k", [1, 3])
def test_distance_cleaning(planted, k):
    left = kept(outliers.clean_by_distance(planted, 0.01, k))
    assert len(left) == 999
    if k == 1:
        assert not [i for i in left if i >= 1001]
    far = outliers.centre_distances(planted, k).toPandas()
    data = far[["a", "b", "c"]]
    if k == 1:
        z = (data - data.mean()) / data.std()
        np.testing.assert_allclose(far.distance, np.sqrt((z**2).sum(axis=1)))


def test_trajectory_distance_cleaning(flights):
    assert 480 < outliers.clean_trajectory_by_distance(flights).count() < 501


def test_clusters_read_written_rows(spark, monkeypatch):
    """Moments, clusters and distances are passes over complete rows that were made once."""
    read, found = [], outliers.centre_distances
    monkeypatch.setattr(outliers, "centre_distances", lambda df, *a, **k: read.append(df.inputFiles()) or found(df, *a, **k))
    rows = spark.range(200).selectExpr("id AS flight_id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b")
    assert outliers.clean_by_distance(rows, k=3).count() <= 200
    assert read[0] and all("/stages-" in f for f in read[0])


def test_forests_of_short_flights_grow_together():
    """Scores from where rows end in growing equal those looked up in each flight's own forest, to the bit."""
    rng = np.random.default_rng(8)
    flights = [rng.normal(size=(n, 4)) for n in (2, 3, 64, 65, 67, 256, 1)]
    flights[3][:, 1] = 1.0
    flights[4][:, 2:] = np.round(flights[4][:, 2:])
    flights[2][5, 0] = np.nan
    seeds = [isolation.tree_seeds(i) for i in range(len(flights))]
    found = isolation.shared_scores(np.concatenate(flights), np.array([len(f) for f in flights]), np.stack(seeds))
    own = [isolation.scores(f, isolation.grow(np.repeat(f[None], isolation.TREES, axis=0), s), len(f)) for f, s in zip(flights, seeds)]
    np.testing.assert_array_equal(found, np.concatenate(own))


def test_flights_are_joined_once_to_be_counted_and_cleaned(spark, sf_dir):
    from checks.registry import QUERIES

    import checks.model_checks  # noqa: F401

    found = QUERIES["m2_isolation_forest_counts"](spark, sf_dir)
    assert "lineitem" not in found._jdf.queryExecution().toString()
    assert {r.step for r in found.collect()} == {"before", "after"}
