import pytest

from skyload.operators.fitted import MOST_FLAGS, UNSEEN, Preparation, apply_preparation, fit_preparation

SCHEMA = "flight_id long, duration double, passengers double, airline string, adep string, wtc string"
LABELS = ("airline", "adep")


def _train(spark):
    rows = [(1, 10.0, 5.0, "b", "X", "M"), (2, 20.0, 5.0, "a", None, "H"), (3, 30.0, 5.0, "é", "Y", "L"), (3, None, 5.0, "a", "Y", None)]
    return spark.createDataFrame(rows, SCHEMA)


def _scored(spark, prepared, rows, **options):
    return {r["flight_id"]: r.asDict() for r in apply_preparation(spark.createDataFrame(rows, SCHEMA), prepared, **options).collect()}


@pytest.mark.parametrize("stored", [False, True])
def test_other_rows_get_what_training_found(spark, tmp_path, stored):
    prepared = fit_preparation(_train(spark), labels=LABELS, drop_first=True)
    if stored:
        prepared.save(str(tmp_path))
        prepared = Preparation.load(spark, str(tmp_path))
    got = _scored(spark, prepared, [(7, 20.0, 9.0, "é", "Z", "M"), (8, 30.0, None, None, "X", "J"), (9, None, 5.0, "a", None, None)])
    assert got[7] == {"flight_id": 7, "duration": 0.0, "passengers": 0.0, "adep_encoded": UNSEEN, "airline_encoded": 2, "wtc_L": 0, "wtc_M": 1}
    assert got[8]["duration"] == pytest.approx(1.5**0.5) and got[8]["passengers"] is None
    assert (got[8]["airline_encoded"], got[8]["adep_encoded"], got[8]["wtc_L"], got[8]["wtc_M"]) == (None, 0, 0, 0)
    assert got[9]["duration"] is None and got[9]["adep_encoded"] is None and got[9]["airline_encoded"] == 0


def test_one_row_is_scored_like_many(spark):
    """Scoring does not look at its own rows: each alone gives the same."""
    prepared = fit_preparation(_train(spark), labels=LABELS)
    rows = [(7, 20.0, 9.0, "é", "Z", "M"), (8, 30.0, None, "q", "X", "J")]
    together = _scored(spark, prepared, rows)
    assert {**_scored(spark, prepared, rows[:1]), **_scored(spark, prepared, rows[1:])} == together


def test_codes_beyond_the_limit_of_the_driver(spark):
    few, many = fit_preparation(_train(spark), labels=LABELS), fit_preparation(_train(spark), labels=LABELS, rows=1)
    assert sorted(few.codes.collect()) == sorted(many.codes.collect())


def test_preserved_missing_and_empty(spark):
    prepared = fit_preparation(_train(spark), labels=LABELS)
    got = apply_preparation(spark.createDataFrame([(7, 1.0, 1.0, "a", "X", "M")], SCHEMA), prepared, preserve=["airline"])
    assert "airline" in got.columns and "adep" not in got.columns and "wtc" not in got.columns
    with pytest.raises(ValueError, match="duration"):
        apply_preparation(_train(spark).drop("duration"), prepared)
    assert apply_preparation(_train(spark).limit(0), prepared).collect() == []
    nothing = fit_preparation(_train(spark).limit(0), labels=LABELS)
    row = apply_preparation(_train(spark).limit(1), nothing).first().asDict()
    assert row["duration"] == 0.0 and "wtc" not in row and nothing.codes.isEmpty()


def test_too_many_flags_are_an_error(spark):
    rows = spark.range(MOST_FLAGS + 1).selectExpr("id as flight_id", "1.0D as duration", "1.0D as passengers", "'a' as airline", "'x' as adep", "cast(id as string) as wtc")
    with pytest.raises(ValueError, match="wtc"):
        fit_preparation(rows, labels=LABELS)
