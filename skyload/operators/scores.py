"""Feature scores against the target, and the choice of features."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from skyload.constants import KEY, TARGET
from skyload.functions.fdist import f_upper_tail
from skyload.operators.columns import numeric_columns
from skyload.operators.prepare import spread


def correlations(df: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    """Rows (position, feature, n, r): Pearson correlation with the target, in one pass.

    NULL for a column without spread. Values go in long form, so that a few aggregates
    per feature are combined in each task, however many features there are.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("feature"),
                F.col(f"`{c}`").cast("double").alias("x"),
            )
            for i, c in enumerate(columns)
        ]
    )
    long = df.select(F.col(target).cast("double").alias("_y"), F.inline(pairs))
    both = F.col("x").isNotNull() & F.col("_y").isNotNull()
    x, y = F.when(both, F.col("x")), F.when(both, F.col("_y"))
    r = F.try_divide(F.covar_pop(x, y), spread(x) * spread(y))
    return long.groupBy("position", "feature").agg(F.count(x).alias("n"), r.alias("r"))


@F.pandas_udf(DoubleType())
def _upper_tail(score: pd.Series, within: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(s) else f_upper_tail(s, 1.0, w) for s, w in zip(score, within, strict=True)],
        dtype="float64",
    )


def f_scores(df: DataFrame, columns: Sequence[str] | None = None, target: str = TARGET) -> DataFrame:
    """Rows (position, feature, score): F statistic of a one-feature regression.

    A column without spread has no score.
    """
    columns = columns or numeric_columns(df, exclude=(KEY, target))
    rows = correlations(df, columns, target)
    r2 = F.col("r") * F.col("r")
    score = F.when(r2 >= 1, F.lit(float("inf"))).otherwise(
        F.try_divide(r2, F.lit(1.0) - r2) * (F.col("n") - 2)
    )
    return rows.select("position", "feature", "n", score.alias("score"))


def with_p_values(scores: DataFrame) -> DataFrame:
    """Report form (feature, score, p_value); one row per feature, so few rows."""
    within = (F.col("n") - 2).cast("double")
    return scores.select("position", "feature", "score", _upper_tail("score", within).alias("p_value"))


def best_features(scores: DataFrame, k: int = 15) -> list[str]:
    """The k best by score, in input order; of equal scores the later column wins."""
    ranked = scores.orderBy(F.desc_nulls_last("score"), F.desc("position")).limit(k)
    return [r.feature for r in ranked.orderBy("position").collect()]


def select_features(
    train: DataFrame,
    test: DataFrame,
    k: int = 15,
    target: str = TARGET,
    keep: Sequence[str] = (KEY, TARGET),
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sets with the k features that score best on the training set."""
    return keep_features(train, test, best_features(f_scores(train, target=target), k), keep)


def keep_features(
    train: DataFrame, test: DataFrame, chosen: Sequence[str], keep: Sequence[str] = (KEY, TARGET)
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sets with the features chosen."""

    def narrow(df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if c in chosen or c in keep])

    return narrow(train), narrow(test), list(chosen)
