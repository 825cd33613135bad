"""Errors of predictions, and ensembles of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET


def error_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """mse, rmse and r2 as aggregates over rows that have both values."""
    both = actual.isNotNull() & predicted.isNotNull()
    gap = actual - predicted
    mse = F.avg(gap * gap)
    spread = F.var_pop(F.when(both, actual))
    return {"mse": mse, "rmse": F.sqrt(mse), "r2": F.lit(1.0) - F.try_divide(mse, spread)}


def regression_metrics(
    df: DataFrame, predicted: str = "prediction", target: str = TARGET, by: Sequence[str] = ()
) -> DataFrame:
    """One row of errors, or one per group."""
    found = error_columns(F.col(target), F.col(predicted))
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in found.items()])


def stack_predictions(df: DataFrame, models: Sequence[str], target: str = TARGET) -> DataFrame:
    """Wide ``tow_<model>`` columns to (key, target, model, prediction) rows."""
    entries = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(f"tow_{m}").alias("prediction")) for m in models]
    )
    return df.select(KEY, target, F.inline(entries))


def evaluate_models(df: DataFrame, models: Sequence[str], target: str = TARGET) -> DataFrame:
    """Errors of several models on one table of predictions, in one pass."""
    return regression_metrics(stack_predictions(df, models, target), target=target, by=["model"])


def ensemble_mean(df: DataFrame, models: Sequence[str], name: str = "ensemble") -> DataFrame:
    """Add ``tow_<name>``, the mean of the models' predictions."""
    total = sum((F.col(f"tow_{m}") for m in models), F.lit(0.0))
    return df.withColumn(f"tow_{name}", total / F.lit(float(len(models))))
