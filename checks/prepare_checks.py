"""Moments, quantiles, standardising, encoding, scores, splits and segments."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views
from checks.flight_checks import enriched
from checks.registry import check, rounded, sql
from skyload.functions.times import add_duration
from skyload.operators import metrics, outliers, prepare, scores, segments
from skyload.operators.ordering import exact_quantiles

NUMBERS = ("flown_distance", "mtow_kg", "passengers", "roc_initial_climb", "v2_ias")
FEATURES = (*NUMBERS, "duration")
WITH_DURATION = (
    "SELECT *, (epoch_us(arrival_time) - epoch_us(actual_offblock_time)) / 60e6 AS duration FROM enriched"
)


def with_duration(spark, sf):
    return add_duration(enriched(spark, sf), exact=True)


@check(
    "a3_moments",
    sql(
        "SELECT count(*) AS n_rows, "
        + ", ".join(
            f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std" for c in NUMBERS
        )
        + " FROM enriched",
        "enriched",
    ),
)
def a3(spark, sf):
    return prepare.moments(enriched(spark, sf), NUMBERS)


_PROBABILITIES = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75}


@check(
    "a4_quantiles",
    sql(
        "SELECT "
        + ", ".join(
            f"round(quantile_cont(altitude, {p}), 6) AS {n}" for n, p in _PROBABILITIES.items()
        )
        + " FROM trajectory",
        "trajectory",
    ),
)
def a4(spark, sf):
    return exact_quantiles(views.trajectory(spark, sf), "altitude", _PROBABILITIES)


# Predictions, in tonnes, that stand for those of two models.
_PREDICTED = """
SELECT *, (tow_a + tow_b) / 2 AS tow_ensemble
FROM (SELECT flight_id, tow / 1000 AS tow, CAST(mtow_kg AS DOUBLE) / 1000 AS tow_a,
             flown_distance * 0.15 AS tow_b
      FROM enriched WHERE tow IS NOT NULL AND mtow_kg IS NOT NULL) x
"""


def predicted(spark, sf):
    known = enriched(spark, sf).where(F.col("tow").isNotNull() & F.col("mtow_kg").isNotNull())
    return metrics.ensemble_mean(
        known.select(
            "flight_id",
            (F.col("tow") / 1000).alias("tow"),
            (F.col("mtow_kg") / 1000).alias("tow_a"),
            (F.col("flown_distance") * 0.15).alias("tow_b"),
        ),
        ["a", "b"],
    )


def _errors_sql(column: str) -> str:
    return (
        f"round(avg(pow(tow - {column}, 2)), 6) AS mse, round(sqrt(avg(pow(tow - {column}, 2))), 6) AS rmse, "
        f"round(1 - sum(pow(tow - {column}, 2)) / sum(pow(tow - m, 2)), 6) AS r2"
    )


@check(
    "a6_regression_metrics",
    sql(
        f"SELECT {_errors_sql('tow_a')} FROM predicted, (SELECT avg(tow) AS m FROM predicted) z",
        "enriched",
        predicted=_PREDICTED,
    ),
)
def a6(spark, sf):
    return metrics.regression_metrics(predicted(spark, sf), "tow_a")


@check(
    "a7_correlations",
    sql(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS feature, count(CASE WHEN {c} IS NOT NULL AND tow IS NOT NULL "
            f"THEN 1 END) AS n, round(corr({c}, tow), 6) AS r FROM rows_"
            for i, c in enumerate(FEATURES)
        ),
        "enriched",
        rows_=WITH_DURATION,
    ),
)
def a7(spark, sf):
    return scores.correlations(with_duration(spark, sf), FEATURES)


def _score_sql(c: str, m: str, s: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN coalesce(({c} - {m}) / nullif({s}, 0), 0.0) END"
    )


def _normalised(names, deviation: str) -> str:
    listed = ", ".join(
        f"avg({c}) AS {c}_m, CASE WHEN min({c}) < max({c}) THEN {deviation}({c}) END AS {c}_s" for c in names
    )
    chosen = ", ".join(f"round({_score_sql(c, c + '_m', c + '_s')}, 6) AS {c}" for c in names)
    return sql(
        f"SELECT flight_id, {chosen} FROM rows_, (SELECT {listed} FROM rows_) z",
        "enriched",
        rows_=WITH_DURATION,
    )


@check("m1_normalize", _normalised(FEATURES, "stddev_pop"))
def m1(spark, sf):
    return prepare.normalise(with_duration(spark, sf)).select("flight_id", *FEATURES)


@check("m1_normalize_sample", _normalised(("flown_distance", "duration"), "stddev_samp"))
def m1_sample(spark, sf):
    rows = prepare.normalise(with_duration(spark, sf), ddof=1, only_double=True)
    return rows.select("flight_id", "flown_distance", "duration")


_FAR = ("flown_distance", "duration")


@check(
    "m4_distance_outliers",
    sql(
        f"""
SELECT flight_id, {rounded(*_FAR)} FROM placed
WHERE d <= (SELECT quantile_cont(d, 0.99) FROM placed)
""",
        "enriched",
        rows_=WITH_DURATION,
        complete="SELECT flight_id, flown_distance, duration FROM rows_ "
        "WHERE flown_distance IS NOT NULL AND duration IS NOT NULL",
        placed="SELECT *, sqrt("
        + " + ".join(f"pow({_score_sql(c, c + '_m', c + '_s')}, 2)" for c in _FAR)
        + ") AS d FROM complete, (SELECT "
        + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in _FAR)
        + " FROM complete) z",
    ),
)
def m4(spark, sf):
    return outliers.clean_by_distance(with_duration(spark, sf).select("flight_id", *_FAR))


@check("m4_cluster_outliers")
def m4_clusters(spark, sf):
    """Four centres."""
    return outliers.clean_by_distance(with_duration(spark, sf).select("flight_id", *_FAR), k=4)


@check("m2_isolation_forest")
def m2(spark, sf):
    return outliers.clean(with_duration(spark, sf).select("flight_id", *FEATURES))


@check("m3_isolation_per_flight")
def m3(spark, sf):
    return outliers.clean_trajectory(views.trajectory(spark, sf), course=views.COURSE)


_LABELS = prepare.LABEL_COLUMNS


def encoded_joins(table: str, columns=_LABELS) -> str:
    return "\n".join(
        f"LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
        f"(SELECT DISTINCT {c} AS v FROM {table} WHERE {c} IS NOT NULL) d) e{i} ON e{i}.v = r.{c}"
        for i, c in enumerate(columns)
    )


def encoded_columns(columns=_LABELS) -> str:
    return ", ".join(f"CAST(e{i}.code AS INT) AS {c}_encoded" for i, c in enumerate(columns))


@check(
    "m5_label_encode",
    sql(
        f"SELECT r.flight_id, r.aircraft_type, {encoded_columns()} FROM flights r {encoded_joins('flights')}",
        "flights",
    ),
)
def m5(spark, sf):
    flights = views.flights(spark, sf).select("flight_id", *_LABELS)
    return prepare.label_encode(flights, preserve=["aircraft_type"])


def _flag(value: str) -> str:
    return f'CASE WHEN wtc = \'{value}\' THEN 1 ELSE 0 END AS "wtc_{value}"'


@check("m6_one_hot", sql(f"SELECT flight_id, {_flag('H')}, {_flag('L')}, {_flag('M')} FROM flights", "flights"))
def m6(spark, sf):
    return prepare.one_hot(views.flights(spark, sf).select("flight_id", "wtc"))


@check("m6_one_hot_vector", sql(f"SELECT flight_id, {_flag('H')}, {_flag('L')}, {_flag('M')} FROM flights", "flights"))
def m6_vector(spark, sf):
    """Elements of the vector by order of the values."""
    rows = prepare.one_hot_vector(views.flights(spark, sf).select("flight_id", "wtc"))
    flags = vector_to_array(F.col("wtc_encoded"))
    return rows.select(
        "flight_id", *[flags[i].cast("int").alias(f"wtc_{v}") for i, v in enumerate("HLM")]
    )


@check("m6_one_hot_drop_first", sql(f"SELECT flight_id, {_flag('L')}, {_flag('M')} FROM flights", "flights"))
def m6_drop(spark, sf):
    return prepare.one_hot(views.flights(spark, sf).select("flight_id", "wtc"), always=(), drop_first=True)


_SCORES = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, n, r * r / nullif(1 - r * r, 0) * (n - 2) AS score FROM "
    f"(SELECT count(CASE WHEN {c} IS NOT NULL AND tow IS NOT NULL THEN 1 END) AS n, corr({c}, tow) AS r "
    "FROM {rows}) x"
    for i, c in enumerate(FEATURES)
)


@check(
    "m7_f_scores",
    sql(
        "SELECT position, feature, n, round(score, 6) AS score FROM scored",
        "enriched",
        rows_=WITH_DURATION,
        scored=_SCORES.format(rows="rows_"),
    ),
)
def m7(spark, sf):
    return scores.f_scores(with_duration(spark, sf), FEATURES)


_TEST = "substr(md5(CAST(flight_id AS VARCHAR)), 1, 4) < '3333'"


@check(
    "m8_select_k_best",
    sql(
        "SELECT flight_id, feature, round(value, 6) AS value FROM ("
        + " UNION ALL ".join(
            f"SELECT flight_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM rows_" for c in FEATURES
        )
        + ") v WHERE feature IN (SELECT feature FROM scored ORDER BY score DESC NULLS LAST, position DESC LIMIT 3)",
        "enriched",
        rows_=WITH_DURATION,
        train=f"SELECT * FROM rows_ WHERE NOT ({_TEST})",
        scored=_SCORES.format(rows="train"),
    ),
)
def m8(spark, sf):
    rows = with_duration(spark, sf).select("flight_id", "tow", *FEATURES)
    train, test, chosen = scores.select_features(*prepare.train_test_split(rows), k=3)
    values = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in chosen]
    )
    return train.unionByName(test).select("flight_id", F.inline(values))


@check(
    "m10_train_test_split",
    sql(f"SELECT flight_id, CASE WHEN {_TEST} THEN 'test' ELSE 'train' END AS part FROM flights", "flights"),
)
def m10(spark, sf):
    return _parts(prepare.train_test_split(views.flights(spark, sf).select("flight_id")))


def _parts(split: tuple[DataFrame, DataFrame]) -> DataFrame:
    train, test = split
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@check(
    "m10_train_test_split_exact",
    sql(
        """
SELECT flight_id, CASE WHEN place <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part
FROM (SELECT flight_id, count(*) OVER () AS n,
             row_number() OVER (ORDER BY md5(CAST(flight_id AS VARCHAR)), flight_id) AS place FROM flights) x
""",
        "flights",
    ),
)
def m10_exact(spark, sf):
    return _parts(prepare.train_test_split(views.flights(spark, sf).select("flight_id"), exact=True))


MTOW_LABEL = """
CASE WHEN mtow_kg <= 115680 THEN
       CASE WHEN mtow_kg <= q25 THEN 'very_low' WHEN mtow_kg <= q50 THEN 'low'
            WHEN mtow_kg <= q75 THEN 'medium' ELSE 'high' END
     WHEN mtow_kg > 115680 THEN CASE WHEN aircraft_type = 'B77W' THEN 'b77w' ELSE 'non_b77w' END END
"""


def mtow_labelled(table: str) -> str:
    return (
        f"SELECT r.*, {MTOW_LABEL} AS segment FROM {table} r, ("
        + "SELECT "
        + ", ".join(f"quantile_cont(mtow_kg, {p}) AS {n}" for n, p in segments._QUARTILES.items())
        + f" FROM {table} WHERE mtow_kg <= 115680) q"
    )


def in_segment(column: str) -> str:
    over = "OVER (PARTITION BY segment)"
    varied = f"min({column}) {over} < max({column}) {over}"
    score = f"({column} - avg({column}) {over}) / nullif(stddev_pop({column}) {over}, 0)"
    return f"coalesce(CASE WHEN {varied} THEN {score} END, 0.0)"


_KEPT = ("flight_id", "aircraft_type", "flown_distance", "mtow_kg", "tow")


@check(
    "m11_split_mtow",
    sql(
        f"SELECT segment, flight_id, aircraft_type, {rounded('flown_distance', 'tow')}, "
        f"round({in_segment('mtow_kg')}, 6) AS mtow_kg FROM labelled WHERE segment IS NOT NULL",
        "enriched",
        labelled=mtow_labelled("enriched"),
    ),
)
def m11(spark, sf):
    return segments.split_by_mtow(enriched(spark, sf).select(*_KEPT))


@check(
    "m11_split_mtow_ntile",
    sql(
        f"SELECT segment, flight_id, aircraft_type, {rounded('flown_distance', 'tow')}, "
        f"round({in_segment('mtow_kg')}, 6) AS mtow_kg FROM labelled WHERE segment IS NOT NULL",
        "enriched",
        labelled="""
SELECT r.*, CASE WHEN quarter = 1 THEN 'very_low' WHEN quarter = 2 THEN 'low' WHEN quarter = 3 THEN 'medium'
                 WHEN quarter = 4 THEN 'high' WHEN aircraft_type = 'B77W' THEN 'b77w'
                 WHEN mtow_kg > 115680 THEN 'non_b77w' END AS segment
FROM enriched r
LEFT JOIN (SELECT flight_id, ntile(4) OVER (ORDER BY mtow_kg, flight_id) AS quarter
           FROM enriched WHERE mtow_kg <= 115680) q USING (flight_id)
""",
    ),
)
def m11_ntile(spark, sf):
    return segments.split_by_mtow(enriched(spark, sf).select(*_KEPT), method="ntile")


@check(
    "w9_ntile",
    sql(
        "SELECT flight_id, mtow_kg, CAST(ntile(4) OVER (ORDER BY mtow_kg, flight_id) AS INT) AS ntile "
        "FROM enriched WHERE mtow_kg <= 115680",
        "enriched",
    ),
)
def w9(spark, sf):
    return segments.narrow_body_ntile(enriched(spark, sf).select("flight_id", "mtow_kg"))


@check(
    "m12_split_distance",
    sql(
        f"SELECT segment, flight_id, aircraft_type, {rounded('tow')}, "
        f"round({in_segment('flown_distance')}, 6) AS flown_distance, "
        f"round({in_segment('mtow_kg')}, 6) AS mtow_kg FROM labelled WHERE segment IS NOT NULL",
        "enriched",
        labelled="""
SELECT *, CASE WHEN mtow_kg <= 115680 THEN
                 CASE WHEN flown_distance >= 1000 THEN 'above_1000' WHEN flown_distance >= 500 THEN '500-1000'
                      WHEN flown_distance >= 0 THEN '0-500' END
               WHEN mtow_kg > 115680 THEN CASE WHEN aircraft_type = 'B77W' THEN 'b77w' ELSE 'non_b77w' END
          END AS segment
FROM enriched
""",
    ),
)
def m12(spark, sf):
    return segments.split_by_distance(enriched(spark, sf).select(*_KEPT))


@check(
    "m13_split_wtc",
    sql(
        f"SELECT 'wtc_' || wtc AS part, flight_id, {rounded('flown_distance', 'tow')} "
        "FROM flights WHERE wtc IN ('M', 'H')",
        "flights",
    ),
)
def m13(spark, sf):
    rows = prepare.one_hot(views.flights(spark, sf).select("flight_id", "wtc", "flown_distance", "tow"))
    parts = [
        features.join(target, "flight_id").select(
            F.lit(name).alias("part"), "flight_id", "flown_distance", "tow"
        )
        for name, (features, target) in segments.split_by_wake_class(rows).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@check(
    "m17_ensemble_mean",
    sql(
        f"SELECT flight_id, {rounded('tow', 'tow_a', 'tow_b', 'tow_ensemble')} FROM predicted",
        "enriched",
        predicted=_PREDICTED,
    ),
)
def m17(spark, sf):
    return predicted(spark, sf)


@check(
    "m19_evaluate",
    sql(
        " UNION ALL ".join(
            f"SELECT '{m}' AS model, {_errors_sql('tow_' + m)} FROM predicted, "
            "(SELECT avg(tow) AS m FROM predicted) z"
            for m in ("a", "b", "ensemble")
        ),
        "enriched",
        predicted=_PREDICTED,
    ),
)
def m19(spark, sf):
    return metrics.evaluate_models(predicted(spark, sf), ["a", "b", "ensemble"])


@check(
    "m22_segment_summary",
    sql(
        "SELECT segment, count(*) AS n_rows, "
        + ", ".join(
            f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std"
            for c in ("tow", "flown_distance")
        )
        + " FROM labelled WHERE segment IS NOT NULL GROUP BY segment",
        "enriched",
        labelled=mtow_labelled("enriched"),
    ),
)
def m22(spark, sf):
    split = segments.split_by_mtow(enriched(spark, sf).select(*_KEPT))
    return segments.segment_summary(split, ["tow", "flown_distance"])
