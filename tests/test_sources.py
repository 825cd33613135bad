import json

import pytest
from points import climb, flight, points
from pyspark.sql import functions as F

from skyload.operators import scores
from skyload.sources import aircraft, flights, sinks, trajectory

HEADER = (
    "flight_id,date,callsign,adep,name_adep,country_code_adep,ades,name_ades,country_code_ades,"
    "actual_offblock_time,arrival_time,aircraft_type,wtc,airline,flown_distance,tow"
)
LINE = (
    "7,2022-01-01,abc,EDDF,Frankfurt,DE,LFPG,Paris,FR,2022-01-01T10:00:00Z,2022-01-01T11:30:00Z,"
    "A320,M,xyz,250,65000.5"
)


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text(f"{HEADER}\n{LINE}\n")
    return str(path)


def test_read_flights(spark, csv):
    df = flights.read_flights(spark, csv)
    assert df.schema == flights.FLIGHT_SCHEMA
    row = df.first()
    assert (row.flight_id, row.adep, row.flown_distance, row.tow) == (7, "EDDF", 250.0, 65000.5)
    assert str(row.actual_offblock_time) == "2022-01-01 10:00:00"


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("tow,level_off,flight_id\n1.5,3,9\n")
    row = flights.read_flights(spark, str(path)).first()
    assert (row.tow, row.level_off, row.flight_id) == (1.5, "3", 9)


def test_scoring_set_and_duration(spark, csv):
    assert "tow" not in flights.read_scoring_flights(spark, csv).columns
    assert flights.read_flights_with_duration(spark, csv).first().duration == 90.0


def test_csv_round_trip(spark, csv, tmp_path):
    df = flights.read_flights(spark, csv)
    df.write.option("header", True).csv(str(tmp_path / "again"))
    assert flights.read_flights(spark, str(tmp_path / "again")).collect() == df.collect()


def test_read_trajectory_prunes_columns_and_pushes_the_range(spark, tmp_path):
    for day in (1, 2):
        points(spark, flight(day, climb(20))).write.parquet(str(tmp_path / f"day={day}"))
    df = trajectory.read_trajectory(spark, str(tmp_path), columns=["flight_id", "altitude"])
    plan = df.where(F.col("altitude").between(0, 47000))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(altitude,0" in plan and "ReadSchema: struct<flight_id:bigint,altitude:double>" in plan
    assert df.count() == 40
    some = trajectory.read_trajectory(spark, str(tmp_path / "day=1"), str(tmp_path / "day=2"))
    text = trajectory.times_as_text(some)
    assert dict(text.dtypes)["timestamp"] == "string" and text.first().timestamp.startswith("2024-01-01 06:00")


def test_read_aircraft(spark, tmp_path):
    entry = {"MTOW(kg)": 100, "passengers": 5, "ROC_Initial_Climb(ft/min)": 900, "V2 (IAS)": 120}
    path = tmp_path / "aircraft.json"
    path.write_text(json.dumps({"X1": entry, "X2": {**entry, "MTOW(kg)": 200}}, indent=2))
    rows = aircraft.read_aircraft(spark, str(path)).orderBy("aircraft_type").collect()
    assert [r.asDict() for r in rows] == [
        {"aircraft_type": t, "mtow_kg": m, "passengers": 5, "roc_initial_climb": 900, "v2_ias": 120}
        for t, m in (("X1", 100), ("X2", 200))
    ]


def test_built_in_aircraft(spark):
    table = aircraft.aircraft_table(spark)
    assert table.count() == 28 and table.distinct().count() == 28
    assert table.where("aircraft_type = 'B752'").first().mtow_kg == 115680


def test_sinks(spark, tmp_path):
    rows = [(i, float(i % 7), float(i % 3), float(i % 7 + i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "flight_id long, a double, b double, tow double")
    folder = str(tmp_path)
    assert sorted(sinks.write_stage(df, folder, "stage").collect()) == sorted(df.collect())
    sinks.write_predictions(df.select("flight_id", F.col("a").alias("tow_gbt")), f"{folder}/predictions")
    assert spark.read.option("header", True).csv(f"{folder}/predictions").columns == ["flight_id", "tow_gbt"]
    found = scores.f_scores(df)
    sinks.write_feature_reports(found, ["a"], folder)
    report = spark.read.option("header", True).csv(f"{folder}/feature_scores").collect()
    assert [r.Feature for r in report] == ["a", "b"] and float(report[0]["p-value"]) < 1e-9
    chosen = spark.read.option("header", True).csv(f"{folder}/selected_features").collect()
    assert [r["Selected Features"] for r in chosen] == ["a"]
    metrics = spark.createDataFrame([("gbt", 1.5)], "model string, rmse double")
    sinks.write_metrics(metrics, f"{folder}/metrics")
    assert spark.read.json(f"{folder}/metrics").first().rmse == 1.5


def test_flight_files_of_unlike_column_order(spark, tmp_path):
    folder = tmp_path / "flights"
    folder.mkdir()
    (folder / "a.csv").write_text("flight_id,tow,flown_distance,extra\n1,10.5,3.0,x\n")
    (folder / "b.csv").write_text("flown_distance,flight_id,tow\n4.0,2,20.5\n")
    found = sorted((r.flight_id, r.tow, r.flown_distance, r.extra) for r in flights.read_flights(spark, str(folder)).collect())
    assert found == [(1, 10.5, 3.0, "x"), (2, 20.5, 4.0, None)]
