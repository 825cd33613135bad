"""Writers for stage tables, predictions, reports, metrics and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.operators.boosting import HistogramModel
from skyload.operators.linear import LinearModel
from skyload.operators.neighbours import NeighbourModel
from skyload.operators.reweighted import ReweightedTrees
from skyload.operators.scores import with_p_values
from skyload.operators.support import SupportModel


def write_stage(df: DataFrame, folder: str, stage: str) -> DataFrame:
    """Write a stage's table as Parquet and go on from the written rows."""
    path = f"{folder.rstrip('/')}/{stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Id and one ``tow_<model>`` column per model, as CSV parts with a header."""
    predictions.write.mode("overwrite").option("header", True).csv(path)


def write_feature_reports(scores: DataFrame, chosen: list[str], folder: str) -> None:
    """``selected_features`` and ``feature_scores``; a row per feature, so one file each."""
    folder = folder.rstrip("/")
    picked = scores.where(scores["feature"].isin(chosen)).orderBy("position")
    picked.select(picked["feature"].alias("Selected Features")).coalesce(1).write.mode(
        "overwrite"
    ).option("header", True).csv(f"{folder}/selected_features")
    report = with_p_values(scores).orderBy("position")
    report.select(
        report["feature"].alias("Feature"),
        report["score"].alias("Score"),
        report["p_value"].alias("p-value"),
    ).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/feature_scores")


def write_metrics(metrics: DataFrame, path: str, settings: DataFrame | None = None) -> None:
    """One JSON object per model: its errors, and the ``parameters`` it was trained with where ``settings`` has them.

    ``settings`` has (model, parameter, value) rows; an ensemble has none.
    """
    if settings is not None:
        pairs = F.sort_array(F.collect_list(F.struct("parameter", "value")))
        metrics = metrics.join(settings.groupBy("model").agg(F.map_from_entries(pairs).alias("parameters")), "model", "left")
    metrics.coalesce(1).write.mode("overwrite").json(path)


# The table that tells a model's kind.
TABLES = {"nodes": HistogramModel, "coefficients": LinearModel, "neighbours": NeighbourModel, "tree_weights": ReweightedTrees, "cosines": SupportModel}
Model = PipelineModel | HistogramModel | LinearModel | NeighbourModel | ReweightedTrees | SupportModel


def save_model(model: Model, path: str, name: str) -> str:
    """Save under ``<path>/<name>`` on any file system Spark can write to."""
    target = f"{path.rstrip('/')}/{name}"
    if isinstance(model, tuple(TABLES.values())):
        model.save(SparkSession.active(), target)
    else:
        model.write().overwrite().save(target)
    return target


def load_model(spark: SparkSession, path: str, name: str) -> Model:
    target = f"{path.rstrip('/')}/{name}"
    for folder, kind in TABLES.items():
        written = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{folder}")
        if written.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(written):
            return kind.load(spark, target)
    return PipelineModel.load(target)
