"""Whole feature runs, and models trained on them."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from checks import views
from checks.flight_checks import FLIGHT_COLUMNS
from checks.prepare_checks import (
    WITH_DURATION,
    encoded_columns,
    encoded_joins,
    in_segment,
    mtow_labelled,
)
from checks.registry import check, rounded, sql
from checks.trajectory_checks import FEATURE_NAMES, FEATURES_SQL, VALID, steps
from skyload.constants import LABEL_COLUMNS
from skyload.operators import models as m
from skyload.operators.columns import scoring_set
from skyload.operators.fitted import apply_preparation, fit_preparation
from skyload.operators.prepare import train_test_split
from skyload.operators.target_statistics import SUFFIX, apply_statistics, fit_statistics, ordered_statistics
from skyload.plans.segment_models import train_segment_models
from skyload.plans.tabular import run_tabular, score_flights, tabular_features, tabular_rows, train_for_scoring
from skyload.plans.trajectory import segmented_features
from skyload.session import shared_folder, stable
from skyload.settings import Settings

# Few trees, as two thousand take hours here: the queries' parameter. Rows, folds and settings are all used.
FEW_BOOSTED = 10
FEW_SYMMETRIC = 5
SMALL_GBT = m.Learner("gbt", depth=3, iterations=5, rate=0.1)
SMALL_FOREST = m.Learner("forest", depth=4, iterations=5)

_COMPLETE_FLIGHT = " AND ".join(
    f"{c.strip()} IS NOT NULL" for c in f"{FLIGHT_COLUMNS}, flown_distance, tow".split(",")
)
_COMPLETE = f"{_COMPLETE_FLIGHT} AND mtow_kg IS NOT NULL"


def _z(column: str, alias: str | None = None) -> str:
    score = f"(r.\"{column}\" - avg(r.\"{column}\") OVER ()) / nullif(stddev_pop(r.\"{column}\") OVER (), 0)"
    score = f"CASE WHEN min(r.\"{column}\") OVER () < max(r.\"{column}\") OVER () THEN {score} END"
    return f"CASE WHEN r.\"{column}\" IS NOT NULL THEN coalesce({score}, 0.0) END AS \"{alias or column}\""


def _rounded_z(*columns: str) -> str:
    return ", ".join(f"round({_z(c).rsplit(' AS ', 1)[0]}, 6) AS \"{c}\"" for c in columns)


def _flag(value: str) -> str:
    return f"CASE WHEN r.wtc = '{value}' THEN 1 ELSE 0 END AS \"wtc_{value}\""


_TABULAR = ("flown_distance", "duration", "mtow_kg", "passengers", "roc_initial_climb", "v2_ias")


@check(
    "l1_tabular_features",
    sql(
        f"SELECT r.flight_id, round(r.tow, 6) AS tow, {_rounded_z(*_TABULAR)}, {encoded_columns()}, "
        f"{_flag('L')}, {_flag('M')} FROM rows_ r {encoded_joins('rows_')}",
        "enriched",
        rows_=f"SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}",
    ),
)
def l1(spark, sf):
    return tabular_features(views.flights(spark, sf), views.aircraft(spark), isolation=False)


@check(
    "l1_tabular_trajectory_features",
    sql(
        f"SELECT r.flight_id, round(r.tow, 6) AS tow, {_rounded_z(*_TABULAR, *FEATURE_NAMES)}, "
        f"{encoded_columns()}, {_flag('L')}, {_flag('M')} FROM rows_ r {encoded_joins('rows_')}",
        "enriched",
        "trajectory",
        valid=VALID,
        **steps("balance", manual=True, source="valid"),
        features=FEATURES_SQL,
        rows_=f"SELECT * FROM (SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}) y JOIN features USING (flight_id)",
    ),
)
def l1_trajectory(spark, sf):
    """With trajectories, phases by fixed altitudes."""
    return tabular_features(
        views.flights(spark, sf), views.aircraft(spark),
        Settings(use_trajectory=True, manual_phases=True),
        views.trajectory(spark, sf), views.COURSE, isolation=False,
    )


_NORMALISED = ("duration", "passengers", "roc_initial_climb", "v2_ias", *FEATURE_NAMES)


@check(
    "l2_trajectory_features",
    sql(
        f"SELECT segment, flight_id, aircraft_type, {rounded('tow', 'flown_distance', *_NORMALISED)}, "
        + ", ".join(f"{c}_encoded" for c in LABEL_COLUMNS)
        + f', "wtc_H", "wtc_L", "wtc_M", round({in_segment("mtow_kg")}, 6) AS mtow_kg '
        "FROM labelled WHERE segment IS NOT NULL",
        "enriched",
        "trajectory",
        valid=VALID,
        **steps("balance", refine=True, source="valid"),
        features=FEATURES_SQL,
        rows_=f"SELECT * FROM (SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}) y JOIN features USING (flight_id)",
        prepared="SELECT r.flight_id, r.aircraft_type, r.tow, r.flown_distance, r.mtow_kg, "
        + ", ".join(_z(c) for c in _NORMALISED)
        + f", {encoded_columns()}, {_flag('H')}, {_flag('L')}, {_flag('M')} "
        f"FROM rows_ r {encoded_joins('rows_')}",
        labelled=mtow_labelled("prepared"),
    ),
)
def l2(spark, sf):
    return segmented_features(
        views.flights(spark, sf), views.aircraft(spark), views.trajectory(spark, sf),
        course=views.COURSE, isolation=False,
    )


def prepared(spark, sf):
    """Train and test rows of the tabular features."""
    return train_test_split(l1(spark, sf))


@check("m9_rfe")
def m9(spark, sf):
    train, _ = prepared(spark, sf)
    return m.recursive_elimination(train, keep=5)[1]


_CODED = (*(f"{c}_encoded" for c in LABEL_COLUMNS), "wtc_L", "wtc_M")
_ALL = (*_TABULAR, *_CODED)
_LAST = len(_ALL)
_SWEPT = (
    "list_transform(range({n}), lambda i: list_transform(range({n}), lambda j: CASE WHEN i = k AND j = k THEN -1 / m[k + 1][k + 1] "
    "WHEN i = k OR j = k THEN CASE WHEN step < {d} THEN 1 ELSE -1 END * m[i + 1][j + 1] / m[k + 1][k + 1] "
    "ELSE m[i + 1][j + 1] - m[i + 1][k + 1] * m[k + 1][j + 1] / m[k + 1][k + 1] END))"
).format(n=_LAST + 1, d=_LAST)
_SIZES = f"list_transform(remaining, lambda c: abs(m[c + 1][{_LAST + 1}]))"


@check(
    "m9_rfe_all",
    sql(
        f"SELECT list_element({list(_ALL)}, CAST(c AS INT) + 1) AS feature, CAST(rank AS INT) AS rank FROM ("
        f"SELECT unnest(remaining) AS c, 1 AS rank FROM steps WHERE len(remaining) = 1 "
        f"UNION ALL SELECT k AS c, len(remaining) AS rank FROM chosen WHERE step >= {_LAST}) x",
        "enriched",
        rows_=f"SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}",
        coded=f"SELECT r.flight_id, CAST(r.tow AS DOUBLE) AS tow, {', '.join(_z(c) for c in _TABULAR)}, {encoded_columns()}, {_flag('L')}, {_flag('M')} "
        f"FROM rows_ r {encoded_joins('rows_')}",
        cells=" UNION ALL ".join(f'SELECT flight_id, {i} AS i, CAST("{c}" AS DOUBLE) AS x FROM coded' for i, c in enumerate((*_ALL, "tow"))),
        pairs="SELECT a.i, b.i AS j, covar_pop(a.x, b.x) AS v FROM cells a JOIN cells b USING (flight_id) GROUP BY a.i, b.i",
        matrix="SELECT list(line ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS line FROM pairs GROUP BY i) x",
        steps=f"SELECT 0 AS step, m, range({_LAST}) AS remaining FROM matrix UNION ALL "
        f"SELECT step + 1, {_SWEPT}, CASE WHEN step < {_LAST} THEN remaining ELSE list_filter(remaining, lambda c: c <> k) END FROM ("
        f"SELECT *, CASE WHEN step < {_LAST} THEN step ELSE remaining[list_position({_SIZES}, list_min({_SIZES}))] END AS k FROM steps) x "
        f"WHERE step < {_LAST} OR len(remaining) > 1",
        chosen=f"SELECT *, remaining[list_position({_SIZES}, list_min({_SIZES}))] AS k FROM steps WHERE step >= {_LAST} AND len(remaining) > 1",
    ).replace("WITH", "WITH RECURSIVE", 1),
)
def m9_all(spark, sf):
    """Ranks of all features, eliminated one by one."""
    return m.recursive_elimination(l1(spark, sf), keep=1, features=list(_ALL))[1]


_ROWS = f"SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}"
_TEST_ROW = "substr(md5(CAST(flight_id AS VARCHAR)), 1, 4) < '3333'"
_EXACT_TOW = "CAST(tow AS DECIMAL(28, 6))"


def _ordered(column: str) -> str:
    line = f"OVER (PARTITION BY {column} ORDER BY md5(CAST(flight_id AS VARCHAR) || 'order'), flight_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"round((coalesce(CAST(sum({_EXACT_TOW}) {line} AS DOUBLE), 0) + prior) / (count(*) {line} + 1), 6) AS {column}{SUFFIX}"


def rows_with_labels(spark, sf):
    """Complete flights with their labels, to train on and to score; written, as they are read many times."""
    return train_test_split(stable(tabular_rows(views.flights(spark, sf), views.aircraft(spark), isolation=False)))


@check(
    "m14_ordered_statistics",
    sql(
        f"SELECT flight_id, {', '.join(_ordered(c) for c in LABEL_COLUMNS)} FROM trained CROSS JOIN prior_",
        "enriched",
        rows_=_ROWS,
        trained=f"SELECT * FROM rows_ WHERE NOT ({_TEST_ROW})",
        prior_=f"SELECT CAST(sum({_EXACT_TOW}) AS DOUBLE) / count(*) AS prior FROM trained",
    ),
)
def m14_ordered(spark, sf):
    """Mean target of earlier training rows of each label; the hottest labels are cut into stretches."""
    train, _ = rows_with_labels(spark, sf)
    found = ordered_statistics(train, fit_statistics(train), stretch_rows=500)
    return found.select("flight_id", *[f"{c}{SUFFIX}" for c in LABEL_COLUMNS])


@check(
    "m14_scored_statistics",
    sql(
        "SELECT flight_id, "
        + ", ".join(f"round((coalesce(t{i}.total, 0) + prior) / (coalesce(t{i}.n, 0) + 1), 6) AS {c}{SUFFIX}" for i, c in enumerate(LABEL_COLUMNS))
        + f" FROM (SELECT * FROM rows_ WHERE {_TEST_ROW}) r CROSS JOIN prior_ "
        + " ".join(
            f"LEFT JOIN (SELECT {c} AS v, count(*) AS n, CAST(sum({_EXACT_TOW}) AS DOUBLE) AS total FROM trained GROUP BY {c}) t{i} ON t{i}.v = r.{c}"
            for i, c in enumerate(LABEL_COLUMNS)
        ),
        "enriched",
        rows_=_ROWS,
        trained=f"SELECT * FROM rows_ WHERE NOT ({_TEST_ROW})",
        prior_=f"SELECT CAST(sum({_EXACT_TOW}) AS DOUBLE) / count(*) AS prior FROM trained",
    ),
)
def m14_scored(spark, sf):
    """Statistics of the training rows on flights that were not among them."""
    train, test = rows_with_labels(spark, sf)
    return apply_statistics(test, fit_statistics(train)).select("flight_id", *[f"{c}{SUFFIX}" for c in LABEL_COLUMNS])


@check(
    "m14_symmetric_levels",
    sql(
        "SELECT c.flight_id, round(base - 0.5 * t.g / (t.n + 1), 6) AS prediction FROM halves c JOIN second s ON TRUE "
        "JOIN cells x ON x.flight_id = c.flight_id AND x.f = s.f "
        "JOIN leaves t ON t.half = c.half AND t.beyond = (x.v > s.v) CROSS JOIN base_",
        "enriched",
        rows_=_ROWS,
        coded=f"SELECT r.flight_id, r.tow, {encoded_columns()}, {_flag('L')}, {_flag('M')} FROM rows_ r {encoded_joins('rows_')}",
        base_="SELECT avg(tow) AS base FROM coded",
        cells=" UNION ALL ".join(f'SELECT flight_id, tow - base AS r, {i} AS f, "{c}" AS v FROM coded CROSS JOIN base_' for i, c in enumerate(_CODED)),
        sums="SELECT f, v, sum(count(*)) OVER (PARTITION BY f ORDER BY v) AS n_left, -sum(sum(r)) OVER (PARTITION BY f ORDER BY v) AS g_left FROM cells GROUP BY f, v",
        total="SELECT count(*) AS n, -sum(r) AS g FROM cells WHERE f = 0",
        first_="SELECT s.f, s.v FROM sums s CROSS JOIN total WHERE n > n_left "
        "ORDER BY g_left * g_left / (n_left + 1) + (g - g_left) * (g - g_left) / (n - n_left + 1) DESC, s.f, s.v LIMIT 1",
        halves="SELECT x.flight_id, x.v > w.v AS half FROM cells x JOIN first_ w ON x.f = w.f",
        grid="SELECT d.f, d.v, h.half, coalesce(n, 0) AS n, coalesce(g, 0) AS g FROM (SELECT DISTINCT f, v FROM cells) d CROSS JOIN (SELECT DISTINCT half FROM halves) h "
        "LEFT JOIN (SELECT f, v, half, count(*) AS n, -sum(r) AS g FROM cells JOIN halves USING (flight_id) GROUP BY f, v, half) c ON c.f = d.f AND c.v = d.v AND c.half = h.half",
        upto="SELECT f, v, half, sum(n) OVER u AS n_left, sum(g) OVER u AS g_left, sum(n) OVER (PARTITION BY f, half) AS n, sum(g) OVER (PARTITION BY f, half) AS g "
        "FROM grid WINDOW u AS (PARTITION BY f, half ORDER BY v)",
        second="SELECT f, v FROM upto GROUP BY f, v ORDER BY sum(CASE WHEN n_left > 0 AND n > n_left "
        "THEN g_left * g_left / (n_left + 1) + (g - g_left) * (g - g_left) / (n - n_left + 1) - g * g / (n + 1) ELSE 0 END) DESC, f, v LIMIT 1",
        leaves="SELECT half, x.v > s.v AS beyond, count(*) AS n, -sum(x.r) AS g FROM cells x JOIN second s ON x.f = s.f JOIN halves USING (flight_id) GROUP BY ALL",
    ),
)
def m14_levels(spark, sf):
    """One symmetric tree of two levels: the second split gains most over both halves together."""
    rows = l1(spark, sf)
    return m.predict(m.train(rows, m.Learner("symmetric", depth=2, iterations=1, rate=0.5), features=list(_CODED)), rows)


@check("m14_symmetric_boosting")
def m14_symmetric(spark, sf):
    """The first learner on ordered statistics of the labels, at its own depth and cut at its best tree; fewer trees, see ``FEW_SYMMETRIC``."""
    train, test = rows_with_labels(spark, sf)
    fitted = fit_statistics(train)
    features = ["flown_distance", "duration", "mtow_kg", *[f"{c}{SUFFIX}" for c in LABEL_COLUMNS]]
    known, held = ordered_statistics(train, fitted), apply_statistics(test, fitted)
    return m.predict(m.train(known, replace(m.FIRST, iterations=FEW_SYMMETRIC), held, features=features), held)


@check("m14_gbt")
def m14(spark, sf):
    train, test = prepared(spark, sf)
    return m.predict(m.train(train, SMALL_GBT, test), test)


@check(
    "m14_histogram_stump",
    sql(
        "SELECT c.flight_id, round(t.base - 0.5 * CASE WHEN x.v <= w.v THEN w.g_left / (w.n_left + 1) ELSE (t.g - w.g_left) / (t.n - w.n_left + 1) END, 6) AS prediction "
        "FROM coded c CROSS JOIN total t CROSS JOIN best w JOIN cells x ON x.flight_id = c.flight_id AND x.f = w.f",
        "enriched",
        rows_=f"SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}",
        coded=f"SELECT r.flight_id, r.tow, {encoded_columns()}, {_flag('L')}, {_flag('M')} FROM rows_ r {encoded_joins('rows_')}",
        base_="SELECT avg(tow) AS base FROM coded",
        total="SELECT base, count(*) AS n, sum(base - tow) AS g FROM coded CROSS JOIN base_ GROUP BY base",
        cells=" UNION ALL ".join(f'SELECT flight_id, tow, {i} AS f, "{c}" AS v FROM coded' for i, c in enumerate(_CODED)),
        sums="SELECT f, v, sum(count(*)) OVER (PARTITION BY f ORDER BY v) AS n_left, sum(sum(base - tow)) OVER (PARTITION BY f ORDER BY v) AS g_left "
        "FROM cells CROSS JOIN base_ GROUP BY f, v",
        best="SELECT s.*, g_left * g_left / (n_left + 1) + (g - g_left) * (g - g_left) / (n - n_left + 1) AS gain FROM sums s CROSS JOIN total "
        "WHERE n > n_left ORDER BY gain DESC, f, v LIMIT 1",
    ),
)
def m14_stump(spark, sf):
    """One tree of one split: the best one of all coded columns, with penalised leaves."""
    rows = l1(spark, sf)
    learner = m.Learner("histogram", depth=1, iterations=1, rate=0.5)
    return m.predict(m.train(rows, learner, features=list(_CODED)), rows)


@check("m14_histogram_boosting")
def m14_histogram(spark, sf):
    """Boosting of the second learner's depth, cut at its best tree; fewer trees, see ``FEW_BOOSTED``."""
    train, test = prepared(spark, sf)
    return m.predict(m.train(train, replace(m.SECOND, iterations=FEW_BOOSTED), test), test)


@check("m15_grid_search")
def m15(spark, sf):
    """The whole grid of the second learner, node by node."""
    train, _ = prepared(spark, sf)
    return m.grid_search(train, m.SECOND)[1]


@check("m16_random_search")
def m16(spark, sf):
    """All trials over the whole ranges of the second learner."""
    train, _ = prepared(spark, sf)
    return m.random_search(train, trials=Settings().n_trials)[1]


@check("m16_adaptive_search")
def m16_adaptive(spark, sf):
    """The first learner with its leaf penalty, all trials over its own depths and trees; proposals from earlier trials."""
    train, _ = prepared(spark, sf)
    return m.adaptive_search(train, trials=Settings().n_trials, kind="boosted_deep", parallelism=8)[1]


def two_models(train, test):
    return {"boosted": m.train(train, SMALL_GBT, test), "forest": m.train(train, SMALL_FOREST)}


@check("m18_importances")
def m18(spark, sf):
    return m.mean_importances(two_models(*prepared(spark, sf)), top=10)


@check("m20_leaderboard")
def m20(spark, sf):
    learners = {
        "boosted": SMALL_GBT, "forest": SMALL_FOREST,
        "linear": m.Learner("linear"), "lasso": m.Learner("lasso"),
    }
    return m.leaderboard(*prepared(spark, sf), learners)[1]


@check("m20_leaderboard_all")
def m20_all(spark, sf):
    """Candidates that are not boosted by gradients, with their usual settings."""
    learners = {"reweighted": m.REWEIGHTED, "neighbours": m.Learner("neighbours"), "support": m.Learner("support")}
    return m.leaderboard(*prepared(spark, sf), learners)[1]


@check("m21_batch_predict")
def m21(spark, sf):
    train, test = prepared(spark, sf)
    return m.batch_predict(two_models(train, test), test)


@check("l1_tabular_run")
def l1_run(spark, sf):
    features = tabular_features(views.flights(spark, sf), views.aircraft(spark))
    return run_tabular(features, Settings(num_features=8), {"gbt": SMALL_GBT}).metrics


@check("l3_segment_models")
def l3(spark, sf):
    """Both learners of an ensemble for each segment, with their own depths, trees and rates."""
    split = segmented_features(
        views.flights(spark, sf), views.aircraft(spark), views.trajectory(spark, sf), course=views.COURSE
    )
    return train_segment_models(split)[1]


_IS_TEST = "substr(md5(CAST(flight_id AS VARCHAR)), 1, 4) < '3333'"
_SCALED = ("duration", "flown_distance", "mtow_kg", "passengers", "roc_initial_climb", "v2_ias")


def _of_training(column: str) -> str:
    score = f"CASE WHEN s.\"{column}_std\" > 0 THEN (r.\"{column}\" - s.\"{column}_mean\") / s.\"{column}_std\" ELSE 0.0 END"
    return f'round(CASE WHEN r."{column}" IS NOT NULL THEN {score} END, 6) + 0.0 AS "{column}"'


def training_and_scoring(spark, sf):
    """Complete flights to train on, and other ones to score."""
    return rows_with_labels(spark, sf)


@check(
    "s2_scoring_features",
    sql(
        f"SELECT r.flight_id, {', '.join(_of_training(c) for c in _SCALED)}, "
        + ", ".join(f"CASE WHEN r.{c} IS NOT NULL THEN CAST(coalesce(e{i}.code, -1) AS INT) END AS {c}_encoded" for i, c in enumerate(LABEL_COLUMNS))
        + f", {_flag('L')}, {_flag('M')} FROM scored r CROSS JOIN scales s {encoded_joins('trained')}",
        "enriched",
        rows_=f"SELECT * FROM ({WITH_DURATION}) x WHERE {_COMPLETE}",
        trained=f"SELECT * FROM rows_ WHERE NOT ({_IS_TEST})",
        scored=f"SELECT * FROM rows_ WHERE {_IS_TEST}",
        scales="SELECT "
        + ", ".join(f'avg({c}) AS "{c}_mean", CASE WHEN min({c}) < max({c}) THEN stddev_pop({c}) ELSE 0 END AS "{c}_std"' for c in _SCALED)
        + " FROM trained",
    ),
)
def s2_features(spark, sf):
    """Scales, codes and flags of training flights on flights that were not among them."""
    train, scored = training_and_scoring(spark, sf)
    prepared = fit_preparation(train, drop_first=True)
    return scoring_set(apply_preparation(scored, prepared))


@check(
    "s2_scored_flights",
    sql(
        "SELECT flight_id, arrival_time IS NOT NULL AND actual_offblock_time IS NOT NULL AND flown_distance IS NOT NULL AND mtow_kg IS NOT NULL "
        "AND adep IS NOT NULL AND country_code_adep IS NOT NULL AND ades IS NOT NULL AND country_code_ades IS NOT NULL "
        "AND aircraft_type IS NOT NULL AND airline IS NOT NULL AS is_scored FROM enriched",
        "enriched",
    ),
)
def s2_scored(spark, sf):
    """All flights scored by a model and a preparation that were written and read again."""
    folder = f"{shared_folder(spark)}/scoring-{uuid.uuid4().hex}"
    flights, aircraft = views.flights(spark, sf), views.aircraft(spark)
    settings = Settings(num_features=100)
    train_for_scoring(flights, aircraft, folder, settings, {"linear": m.Learner("linear")}, isolation=False)
    told = score_flights(flights, aircraft, folder, ["linear"], settings)
    return told.select("flight_id", F.col("tow_linear").isNotNull().alias("is_scored"))
