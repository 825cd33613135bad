"""Adaptive boosting: each tree sees the rows again with more weight on those that the last one missed most.

A row's error counts relative to the largest one. A tree's own weight follows from the mean of these losses; a prediction is the
weighted median of the trees'. A tree is one Spark ML fit with row weights, and its losses are one aggregation. Rows equal in features
and target are missed alike in every tree, so they are one row that begins with their number as its weight.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET
from skyload.operators.columns import counted_rows
from skyload.session import release, stable

FEATURES, WEIGHT = "_vector", "_weight"
# Trees after which the rows are written with their weights.
TREES_A_STAGE = 10
# Share of the weights by which a sum may miss the half of them and still be it.
ROUNDING = 1e-12


@dataclass(frozen=True)
class ReweightedTrees:
    """A vector assembler and trees, each with a column of its own, and the trees' weights."""

    pipeline: PipelineModel
    weights: list[float]

    @property
    def features(self) -> list[str]:
        return self.pipeline.stages[0].getInputCols()

    def predict(self, df: DataFrame, name: str = "prediction", carry: Sequence[str] = (KEY,)) -> DataFrame:
        """``carry`` and the prediction of each row, NULL where a feature is missing."""
        lacking = F.lit(False)
        for feature in self.features:
            lacking = lacking | F.col(f"`{feature}`").isNull()
        given = {f"_c{i}": F.col(f"`{c}`") for i, c in enumerate(carry)}
        rows = df.select(*[c.alias(n) for n, c in given.items()], lacking.alias("_lacking"), *[F.col(f"`{f}`").cast("double").alias(f) for f in self.features])
        told = self.pipeline.transform(rows)
        median = weighted_median([F.col(tree.getPredictionCol()) for tree in self.pipeline.stages[1:]], self.weights)
        return told.select(*[F.col(n).alias(c) for n, c in zip(given, carry, strict=True)], F.when(~F.col("_lacking"), median).alias(name))

    def importances(self, name: str = "importance") -> DataFrame:
        """(feature, <name>): mean of the trees' importances by their weights."""
        total = sum(self.weights) or 1.0
        shares = [0.0] * len(self.features)
        for tree, weight in zip(self.pipeline.stages[1:], self.weights, strict=True):
            for i, share in enumerate(tree.featureImportances.toArray().tolist()):
                shares[i] += share * weight / total
        return SparkSession.active().createDataFrame(list(zip(self.features, shares, strict=True)), f"feature string, `{name}` double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the trees and a table of their weights below ``path``."""
        self.pipeline.write().overwrite().save(f"{path}/trees")
        rows = list(enumerate(self.weights))
        spark.createDataFrame(rows, "tree int, weight double").coalesce(1).write.mode("overwrite").parquet(f"{path}/tree_weights")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ReweightedTrees:
        rows = spark.read.parquet(f"{path}/tree_weights").orderBy("tree").collect()
        return ReweightedTrees(PipelineModel.load(f"{path}/trees"), [r.weight for r in rows])


def weighted_median(values: Sequence[Column], weights: Sequence[float]) -> Column:
    """The least value up to which the values have half of all weight."""
    half = sum(weights) / 2 * (1 - ROUNDING)
    pairs = F.array_sort(F.array(*[F.struct(v.cast("double").alias("told"), F.lit(float(w)).alias("weight")) for v, w in zip(values, weights, strict=True)]))

    def step(so_far: Column, pair: Column) -> Column:
        seen = so_far["seen"] + pair["weight"]
        return F.struct(seen.alias("seen"), F.when(so_far["seen"] < half, pair["told"]).otherwise(so_far["told"]).alias("told"))

    start = F.struct(F.lit(0.0).alias("seen"), F.lit(None).cast("double").alias("told"))
    return F.aggregate(pairs, start, step, lambda so_far: so_far["told"])


def train_reweighted(
    train: DataFrame, features: Sequence[str], target: str = TARGET, depth: int = 3, iterations: int = 50, rate: float = 1.0, power: int = 1, seed: int = 42
) -> ReweightedTrees:
    """Trees on the complete rows of ``train``; a loss is the ``power`` of the relative error, 1 or 2.

    It ends at a tree without errors, which alone decides then, and before one whose mean loss is half or more (the first stays
    anyway). Without complete rows there is nothing to split, which is a ValueError.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")
    complete = train.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features], F.col(f"`{target}`").cast("double").alias("_y")).dropna("any")
    rows = written = stable(assembler.transform(counted_rows(complete, WEIGHT)).select(FEATURES, "_y", WEIGHT))
    trees, weights = [], []
    try:
        count = rows.agg(F.sum(WEIGHT)).first()[0]
        if not count:
            raise ValueError("no complete rows to train on")
        for i in range(iterations):
            regressor = DecisionTreeRegressor(featuresCol=FEATURES, labelCol="_y", weightCol=WEIGHT, predictionCol=f"_tree_{i}", maxDepth=depth, seed=seed + i)
            tree = regressor.fit(rows)
            told = tree.transform(rows).withColumn("_error", F.abs(F.col(f"_tree_{i}") - F.col("_y")))
            largest, total, lost = told.agg(
                F.max("_error"), F.sum(WEIGHT), F.sum(F.col(WEIGHT) * F.pow("_error", F.lit(power)))
            ).first()
            if not largest:
                trees, weights = [tree], [1.0]
                break
            loss = lost / total / largest**power
            if loss >= 0.5 and trees:
                break
            trees.append(tree)
            weights.append(rate * math.log((1 - loss) / loss) if loss < 0.5 else 1.0)
            if loss >= 0.5:
                break
            kept = rate * (1 - F.pow(F.col("_error") / F.lit(largest), F.lit(power)))
            rows = told.select(FEATURES, "_y", (F.col(WEIGHT) * F.lit(count / total) * F.pow(F.lit(loss / (1 - loss)), kept)).alias(WEIGHT))
            if (i + 1) % TREES_A_STAGE == 0:
                old, rows = written, stable(rows)
                written = rows
                release(old)
    finally:
        release(written)
    return ReweightedTrees(PipelineModel([assembler, *trees]), weights)
