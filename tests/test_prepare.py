import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.operators import columns, joins, prepare, scores, segments


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(3 * a + b), 7.0, int(i % 5)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    rows[3] = (3, None, 1.0, 7.0, 1)
    return spark.createDataFrame(rows, "flight_id long, x double, tow double, flat double, n int")


def test_normalised_columns_have_mean_0_and_std_1(numbers):
    table = prepare.normalise(numbers).toPandas()
    assert table.x.isna().sum() == 1
    for c in ("x", "n"):
        assert table[c].mean() == pytest.approx(0, abs=1e-12)
        assert table[c].std(ddof=0) == pytest.approx(1)
    assert (table.flat == 0).all()
    assert table.flight_id.tolist() == list(range(200))
    sample = prepare.normalise(numbers, ddof=1, only_double=True).toPandas()
    assert sample.x.std() == pytest.approx(1)
    assert sample.n.max() == 4


def test_normalise_keeps_distance_on_request(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, 9.0)], "flight_id long, flown_distance double, a double")
    table = prepare.normalise(df, keep_distance=True).toPandas()
    assert table.flown_distance.tolist() == [2.0, 4.0] and sorted(table.a) == [-1.0, 1.0]


def test_single_row_is_zero(spark):
    assert prepare.normalise(spark.createDataFrame([(1, 5.0)], "flight_id long, a double")).first().a == 0.0


@pytest.fixture(scope="module")
def categories(spark):
    rows = [(1, "b", "L"), (2, "a", "L"), (3, None, None), (4, "B", "L"), (5, "ä", "J"), (6, "b", "L")]
    return spark.createDataFrame(rows, "flight_id long, adep string, wtc string")


@pytest.mark.parametrize("rows", [100, 1])
def test_label_codes_follow_binary_order(categories, rows):
    """On the driver, and (with a limit of one value) by range partitions."""
    coded = prepare.label_encode(categories, ["adep", "wtc"], preserve=["adep"], rows=rows)
    assert set(coded.columns) == {"flight_id", "adep", "adep_encoded", "wtc_encoded"}
    found = {r.flight_id: (r.adep_encoded, r.wtc_encoded) for r in coded.collect()}
    assert found == {1: (2, 1), 2: (1, 1), 3: (None, None), 4: (0, 1), 5: (3, 0), 6: (2, 1)}


def test_label_codes_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "flight_id long, a string")
    assert [r.a_encoded for r in prepare.label_encode(df, ["a"]).collect()] == [None, None]


def test_one_hot_has_both_classes(categories):
    table = prepare.one_hot(categories).toPandas().set_index("flight_id")
    assert set(table.columns) == {"adep", "wtc_H", "wtc_J", "wtc_L", "wtc_M"}
    assert table.wtc_M.sum() == 0 and table.wtc_L.sum() == 4
    assert table.loc[3, ["wtc_H", "wtc_J", "wtc_L", "wtc_M"]].sum() == 0


def test_one_hot_drop_first(categories):
    assert set(prepare.one_hot(categories, always=(), drop_first=True).columns) == {"flight_id", "adep", "wtc_L"}


@pytest.mark.parametrize("exact", [False, True])
def test_split_is_disjoint_complete_and_stable(spark, exact):
    df = spark.range(2000).withColumnRenamed("id", "flight_id")
    ids = [{r.flight_id for r in part.collect()} for part in prepare.train_test_split(df, exact=exact)]
    again = prepare.train_test_split(df.repartition(7), exact=exact)
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 2000
    assert ids == [{r.flight_id for r in part.collect()} for part in again]
    assert len(ids[1]) == 400 if exact else 320 < len(ids[1]) < 480
    other = prepare.train_test_split(df, seed="7", exact=exact)[1]
    assert {r.flight_id for r in other.collect()} != ids[1]


def test_f_scores_and_selection(numbers):
    table = numbers.toPandas().dropna()
    found = {r.feature: r for r in scores.with_p_values(scores.f_scores(numbers)).collect()}
    r = np.corrcoef(table.x, table.tow)[0, 1]
    assert found["x"].score == pytest.approx(r * r / (1 - r * r) * (len(table) - 2))
    assert found["flat"].score is None and found["flat"].p_value is None
    assert found["x"].p_value < 1e-10 and 0 < found["n"].p_value <= 1
    train, test = prepare.train_test_split(numbers)
    train, test, chosen = scores.select_features(train, test, k=2)
    assert chosen == ["x", "n"] and train.columns == test.columns == ["flight_id", "x", "tow", "n"]
    assert scores.select_features(train, test, k=50)[2] == ["x", "n"]


def test_equal_scores_prefer_the_later_column(numbers):
    twice = numbers.select("flight_id", "x", F.col("x").alias("y"), "tow")
    assert scores.best_features(scores.f_scores(twice), 1) == ["y"]


def test_perfect_fit_has_an_infinite_score(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(4)], "flight_id long, a double, tow double")
    row = scores.with_p_values(scores.f_scores(df)).first()
    assert row.score > 1e12 and row.p_value < 1e-6


TYPES = [("A", 50000), ("B", 60000), ("C", 115680), ("D", 115681), ("B77W", 351500), (None, None)]


@pytest.fixture(scope="module")
def fleet(spark):
    rows = [
        (i, TYPES[i % 6][0], TYPES[i % 6][1], float(i * 20 - 20), 1000.0 + i, "MHL"[i % 3])
        for i in range(120)
    ]
    return spark.createDataFrame(
        rows, "flight_id long, aircraft_type string, mtow_kg long, flown_distance double, tow double, wtc string"
    )


def test_segments_cover_known_weights_once(fleet):
    split = segments.split_by_mtow(fleet)
    table = split.toPandas()
    assert len(table) == 100 and table.flight_id.is_unique
    labels = dict(table.groupby("aircraft_type").segment.unique().str[0])
    assert labels["D"] == "non_b77w" and labels["B77W"] == "b77w"
    # Edges 50000, 60000, 115680: equal weights stay together and no flight is "high".
    assert (labels["A"], labels["B"], labels["C"]) == ("very_low", "low", "medium")
    assert np.allclose(table.mtow_kg, 0)
    views = segments.segment_views(split)
    assert sum(features.count() for features, _ in views.values()) == 100
    features, target = views["b77w"]
    assert "tow" not in features.columns and target.columns == ["flight_id", "tow"]
    assert segments.split_by_mtow(fleet, is_test=True).columns.count("tow") == 0


def test_standardised_inside_segments(fleet):
    table = segments.split_by_distance(fleet).toPandas()
    grouped = table.groupby("segment").flown_distance
    assert np.allclose(grouped.mean(), 0) and np.allclose(grouped.std(ddof=0), 1)
    assert set(table.segment) == {"0-500", "500-1000", "above_1000", "non_b77w", "b77w"}


def test_ntile_cuts_equal_parts(fleet):
    narrow = fleet.where("mtow_kg <= 115680").toPandas().sort_values(["mtow_kg", "flight_id"])
    narrow = narrow.iloc[:58]
    df = fleet.where(F.col("flight_id").isin(narrow.flight_id.tolist()))
    table = segments.narrow_body_ntile(df).toPandas().sort_values(["mtow_kg", "flight_id"])
    assert table.flight_id.tolist() == narrow.flight_id.tolist()
    assert table.ntile.tolist() == [1] * 15 + [2] * 15 + [3] * 14 + [4] * 14
    labelled = segments.label_by_mtow(df, method="ntile").groupBy("segment").count().collect()
    assert {r.segment: r["count"] for r in labelled} == {"very_low": 15, "low": 15, "medium": 14, "high": 14}


def test_wake_classes(fleet):
    views = segments.split_by_wake_class(prepare.one_hot(fleet))
    for name, (features, target) in views.items():
        assert not {"wtc_M", "wtc_H", "tow"} & set(features.columns)
        ids = {r.flight_id for r in features.collect()}
        assert ids == {r.flight_id for r in target.collect()} and len(ids) == 40


def test_columns_and_joins(fleet, spark):
    assert columns.numeric_columns(fleet, ["flight_id"]) == ["mtow_kg", "flown_distance", "tow"]
    assert columns.numeric_columns(fleet, only_double=True) == ["flown_distance", "tow"]
    assert columns.complete_rows(fleet).count() == 100
    assert "aircraft_type" not in columns.drop_features(fleet, final_drop=True).columns
    assert "flight_id" not in columns.drop_features(fleet, drop_key=True).columns
    assert columns.scoring_set(columns.scoring_set(fleet)).columns == fleet.drop("tow").columns
    aircraft = spark.createDataFrame([("A", 1), ("Z", 2)], "aircraft_type string, passengers int")
    enriched = joins.enrich(fleet, aircraft)
    assert enriched.count() == 120 and enriched.where("passengers IS NULL").count() == 100
    assert joins.known_types(fleet, aircraft).count() == 20
    assert joins.with_flight_features(fleet, None, use_trajectory=False) is fleet
    both = joins.join_predictions(
        {m: fleet.select("flight_id", F.lit(v).alias("prediction")) for m, v in (("a", 1.0), ("b", 2.0))}
    )
    assert both.columns == ["flight_id", "tow_a", "tow_b"] and both.count() == 120
