"""What is determined about learners and outlier filters, over all rows, beside their own results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views
from checks.flight_checks import enriched
from checks.plan_checks import prepared, two_models
from checks.prepare_checks import _TEST, FEATURES, WITH_DURATION, with_duration
from checks.registry import check, rounded, sql
from checks.trajectory_checks import VALID
from skyload.operators import joins, outliers
from skyload.operators import models as m
from skyload.operators.columns import complete_rows, valid_altitudes
from skyload.operators.prepare import train_test_split
from skyload.sources.flights import FLIGHT_SCHEMA
from skyload.session import stable
from skyload.sources.trajectory import read_trajectory, times_as_text

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ("flight_id", *FEATURES))
# Rows left of n when a hundredth goes, and no scores are tied at the limit.
_LEFT = "CAST(floor(0.99 * (count(*) - 1)) AS BIGINT) + 1"


def _before_and_after(before: DataFrame, after: DataFrame) -> DataFrame:
    steps = before.select(F.lit("before").alias("step")).unionByName(after.select(F.lit("after").alias("step")))
    return steps.groupBy("step").agg(F.count(F.lit(1)).alias("n"))


@check(
    "m2_isolation_forest_counts",
    sql(
        f"SELECT 'before' AS step, count(*) AS n FROM complete UNION ALL SELECT 'after', {_LEFT} FROM complete",
        "enriched",
        rows_=WITH_DURATION,
        complete=f"SELECT * FROM rows_ WHERE {_COMPLETE}",
    ),
)
def m2_counts(spark, sf):
    # Counted before and after: the flights are joined once.
    rows = stable(complete_rows(with_duration(spark, sf).select("flight_id", *FEATURES)))
    return _before_and_after(rows, outliers.clean(rows))


@check(
    "m3_isolation_counts",
    sql(f"SELECT flight_id, count(*) AS n_before, {_LEFT} AS n_after FROM valid GROUP BY flight_id", "trajectory", valid=VALID),
)
def m3_counts(spark, sf):
    points = views.trajectory(spark, sf)
    before = valid_altitudes(points).groupBy("flight_id").agg(F.count(F.lit(1)).alias("n_before"))
    after = outliers.clean_trajectory(points, course=views.COURSE).groupBy("flight_id").agg(F.count(F.lit(1)).alias("n_after"))
    return before.join(after, "flight_id", "left")


_PAIR = ("passengers", "v2_ias")


@check(
    "m9_rfe_pair",
    sql(
        """
SELECT 'passengers' AS feature, CASE WHEN abs(b1) >= abs(b2) THEN 1 ELSE 2 END AS rank FROM fit
UNION ALL SELECT 'v2_ias', CASE WHEN abs(b1) >= abs(b2) THEN 2 ELSE 1 END FROM fit
""",
        "enriched",
        pair="SELECT CAST(passengers AS DOUBLE) AS x1, CAST(v2_ias AS DOUBLE) AS x2, CAST(tow AS DOUBLE) AS y FROM enriched "
        "WHERE passengers IS NOT NULL AND v2_ias IS NOT NULL AND tow IS NOT NULL",
        fit="""
SELECT (covar_pop(x1, y) * var_pop(x2) - covar_pop(x2, y) * covar_pop(x1, x2)) / (var_pop(x1) * var_pop(x2) - pow(covar_pop(x1, x2), 2)) AS b1,
       (covar_pop(x2, y) * var_pop(x1) - covar_pop(x1, y) * covar_pop(x1, x2)) / (var_pop(x1) * var_pop(x2) - pow(covar_pop(x1, x2), 2)) AS b2
FROM pair
""",
    ),
)
def m9_pair(spark, sf):
    """Of two features the one of smaller coefficient goes."""
    return m.recursive_elimination(enriched(spark, sf).select("flight_id", "tow", *_PAIR), keep=1)[1]


@check(
    "m20_leaderboard_linear",
    sql(
        "SELECT 'linear' AS model, round(mse, 0) AS mse, round(sqrt(mse), 6) AS rmse, round(1 - mse / spread, 6) AS r2 "
        "FROM (SELECT avg(pow(y - (a + b * x), 2)) AS mse, var_pop(y) AS spread FROM test, fit) e",
        "enriched",
        pair="SELECT flight_id, CAST(passengers AS DOUBLE) AS x, CAST(tow AS DOUBLE) AS y FROM enriched WHERE passengers IS NOT NULL AND tow IS NOT NULL",
        test=f"SELECT * FROM pair WHERE {_TEST}",
        fit=f"SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM pair WHERE NOT ({_TEST})",
    ),
    places={"mse": 0},
)
def m20_linear(spark, sf):
    """One feature, so the errors follow from slope and intercept."""
    rows = enriched(spark, sf).select("flight_id", "passengers", "tow")
    train, test = train_test_split(rows)
    return m.leaderboard(train, test, {"linear": m.Learner("linear")})[1]


_ROUNDS = 3


def _reweighted_rounds() -> dict[str, str]:
    """Views of the rounds of adaptive boosting with one split at a flag: the mean of each side, errors, and the weights after."""
    rounds = {"w0": "SELECT flight_id, f, y, 1.0 AS w FROM flagged WHERE NOT in_test"}
    for i in range(1, _ROUNDS + 1):
        rounds[f"side{i}"] = f"SELECT f, sum(w * y) / sum(w) AS told FROM w{i - 1} GROUP BY f"
        rounds[f"e{i}"] = f"SELECT w.*, abs(told - y) / max(abs(told - y)) OVER () AS e FROM w{i - 1} w JOIN side{i} USING (f)"
        rounds[f"loss{i}"] = f"SELECT sum(w * e) / sum(w) AS loss, count(*) / sum(w) AS scale FROM e{i}"
        rounds[f"w{i}"] = f"SELECT flight_id, f, y, w * scale * pow(loss / (1 - loss), 1 - e) AS w FROM e{i} CROSS JOIN loss{i}"
    return rounds


_TREES = " UNION ALL ".join(f"SELECT f, told, ln((1 - loss) / loss) AS weight FROM side{i} CROSS JOIN loss{i}" for i in range(1, _ROUNDS + 1))
_FLAG_OF_LABEL = "CASE WHEN wtc = 'M' THEN 1.0 ELSE 0.0 END"


@check(
    "m20_reweighted_medians",
    sql(
        "SELECT t.flight_id, round(min(s.told), 4) + 0.0 AS prediction FROM flagged t JOIN summed s ON s.f = t.f "
        "WHERE in_test AND seen >= half * (1 - 1e-12) GROUP BY t.flight_id",
        "enriched",
        flagged=f"SELECT flight_id, {_FLAG_OF_LABEL} AS f, CAST(tow AS DOUBLE) AS y, {_TEST} AS in_test FROM enriched WHERE tow IS NOT NULL",
        **_reweighted_rounds(),
        trees=_TREES,
        summed="SELECT f, told, sum(weight) OVER (PARTITION BY f ORDER BY told) AS seen, sum(weight) OVER (PARTITION BY f) / 2 AS half FROM trees",
    ),
    places={"prediction": 4},
)
def m20_reweighted(spark, sf):
    """Three trees of one split: each is the weighted mean of its side, and a prediction their weighted median."""
    rows = enriched(spark, sf).select("flight_id", "tow", F.expr(_FLAG_OF_LABEL).cast("double").alias("f"))
    train, test = train_test_split(rows.where("tow IS NOT NULL"))
    return m.predict(m.train(train, m.Learner("reweighted", depth=1, iterations=_ROUNDS, rate=1.0)), test)


_NEAR = ("passengers", "v2_ias", "roc_initial_climb", "mtow_kg", "month")
_NEAR_COLUMNS = "passengers, v2_ias, roc_initial_climb, mtow_kg, month(date) AS month"


@check(
    "m20_neighbours",
    sql(
        "SELECT flight_id, round(avg(u.tow), 4) + 0.0 AS prediction FROM (SELECT flight_id, unnest(near) AS u FROM ("
        "SELECT q.flight_id, min({'d': d, 'key': r.flight_id, 'tow': r.tow}, 5) AS near FROM told q JOIN known r ON TRUE, "
        "LATERAL (SELECT " + " + ".join(f"(q.{c} - r.{c}) * (q.{c} - r.{c})" for c in _NEAR) + " AS d) x GROUP BY q.flight_id) y) z GROUP BY flight_id",
        "enriched",
        rows_=f"SELECT flight_id, CAST(tow AS DOUBLE) AS tow, {_NEAR_COLUMNS} FROM enriched",
        whole="SELECT * FROM rows_ WHERE tow IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in _NEAR),
        known=f"SELECT * FROM whole WHERE NOT ({_TEST})",
        told=f"SELECT * FROM whole WHERE {_TEST}",
    ),
    places={"prediction": 4},
)
def m20_neighbours(spark, sf):
    """Mean weight of the five nearest training flights of each test flight, the smaller keys of equally near ones."""
    rows = enriched(spark, sf).selectExpr("flight_id", "CAST(tow AS DOUBLE) AS tow", *_NEAR_COLUMNS.split(", ")).dropna("any")
    train, test = train_test_split(rows)
    return m.predict(m.train(train, m.Learner("neighbours")), test)


@check("m18_importances_sums", "SELECT 'boosted' AS model, 1.0 AS total UNION ALL SELECT 'forest', 1.0 UNION ALL SELECT 'mean', 1.0 FROM (SELECT count(*) AS n FROM orders) o WHERE n > 0")
def m18_sums(spark, sf):
    """Each model's importances sum up to one, and so do their means; a row for each feature."""
    table = m.mean_importances(two_models(*prepared(spark, sf)))
    names = {"boosted": "boosted_importance", "forest": "forest_importance", "mean": "mean_importance"}
    values = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("value")) for n, c in names.items()])
    return table.select(F.inline(values)).groupBy("model").agg(F.sum("value").alias("total"))


@check(
    "m21_batch_predict_rows",
    sql(
        f"""
SELECT flight_id, passengers IS NOT NULL AND v2_ias IS NOT NULL AS told,
       CASE WHEN passengers IS NOT NULL AND v2_ias IS NOT NULL THEN TRUE END AS in_range FROM enriched WHERE {_TEST}
""",
        "enriched",
    ),
)
def m21_rows(spark, sf):
    """Every test flight once; a prediction where it has both features, within the weights trained on."""
    train, test = train_test_split(enriched(spark, sf).select("flight_id", "tow", *_PAIR))
    low, high = train.agg(F.min("tow"), F.max("tow")).first()
    found = m.batch_predict({"forest": m.train(train, m.Learner("forest", depth=4, iterations=5))}, test)
    told = F.col("tow_forest")
    return found.select("flight_id", told.isNotNull().alias("told"), told.between(low, high).alias("in_range"))


@check(
    "m4_cluster_counts",
    sql(
        f"SELECT 'before' AS step, count(*) AS n FROM complete UNION ALL SELECT 'after', {_LEFT} FROM complete",
        "enriched",
        rows_=WITH_DURATION,
        complete="SELECT * FROM rows_ WHERE flown_distance IS NOT NULL AND duration IS NOT NULL",
    ),
)
def m4_counts(spark, sf):
    rows = with_duration(spark, sf).select("flight_id", "flown_distance", "duration")
    return _before_and_after(complete_rows(rows), outliers.clean_by_distance(rows, k=4))


_DOUBLES = ("altitude", "groundspeed", "track", "vertical_rate", "u_component_of_wind", "v_component_of_wind", "temperature")


@check(
    "m4_trajectory_distance",
    sql(
        "SELECT flight_id, event_id FROM placed WHERE d <= (SELECT quantile_cont(d, 0.99) FROM placed)",
        "trajectory",
        valid=VALID,
        placed="SELECT v.*, sqrt(" + " + ".join(f"pow((v.{c} - {c}_m) / {c}_s, 2)" for c in _DOUBLES) + ") AS d FROM valid v, (SELECT "
        + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in _DOUBLES) + " FROM valid) z",
    ),
)
def m4_trajectory(spark, sf):
    points = views.trajectory(spark, sf)
    return outliers.clean_trajectory_by_distance(points).select("flight_id", "event_id")


@check(
    "s1_flights_csv",
    sql(f"SELECT {', '.join(f.name for f in FLIGHT_SCHEMA if f.name not in ('flown_distance', 'tow'))}, {rounded('flown_distance', 'tow')} FROM flights", "flights"),
)
def s1_csv(spark, sf):
    """Flights as lines of CSV and back, by the schema that files are read with."""
    flights = views.flights(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in FLIGHT_SCHEMA])
    lines = flights.select(F.to_csv(F.struct(*flights.columns)).alias("line"))
    return lines.select(F.from_csv("line", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FLIGHT_SCHEMA)).alias("f")).select("f.*")


@check(
    "s4_trajectory_times",
    "SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events",
)
def s4_times(spark, sf):
    """Points read from files, two columns and the time, which becomes text."""
    return times_as_text(read_trajectory(spark, f"{sf}/events.parquet", columns=("user_id", "event_id", "ts")))


@check(
    "j5_join_predictions",
    sql(
        f"SELECT flight_id, {rounded('tow_a', 'tow_b')} FROM (SELECT flight_id, tow * 0.9 AS tow_a FROM flights) a "
        "JOIN (SELECT flight_id, tow + 100 AS tow_b FROM flights WHERE flight_id % 3 = 0) b USING (flight_id)",
        "flights",
    ),
)
def j5(spark, sf):
    flights = views.flights(spark, sf)
    return joins.join_predictions(
        {
            "a": flights.select("flight_id", (F.col("tow") * 0.9).alias("prediction")),
            "b": flights.where("flight_id % 3 = 0").select("flight_id", (F.col("tow") + 100).alias("prediction")),
        }
    )
