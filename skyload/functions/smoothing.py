"""Least-squares cubic smoothing over short windows, edges included."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.constants import SMOOTHING_MAX_WINDOW, SMOOTHING_MIN_WINDOW
from skyload.session import small_table

# Rows before and after a row that its smoothed value may depend on: at the ends
# of a flight the whole window lies on one side.
REACH = SMOOTHING_MAX_WINDOW - 1


def cubic_weights(window: int) -> np.ndarray:
    """Row p holds the weights that give the fitted cubic's value at point p."""
    x = np.linspace(-1.0, 1.0, window)
    basis, _ = np.linalg.qr(np.vander(x, 4, increasing=True))
    return basis @ basis.T


def weights_table(spark: SparkSession) -> DataFrame:
    """Weights by window length and place in it: 117 rows, whatever the data."""
    windows, places, weights = [], [], []
    for window in range(SMOOTHING_MIN_WINDOW, SMOOTHING_MAX_WINDOW + 1, 2):
        for place, row in enumerate(cubic_weights(window)):
            windows.append(window)
            places.append(place)
            weights.append(row.tolist())
    return small_table(
        spark, {"_window": windows, "_place": places, "_weights": weights}
    ).select(F.col("_window").cast("int"), F.col("_place").cast("int"), "_weights")


def window_length(n_points: Column) -> Column:
    """Largest odd length up to 21 that fits the flight."""
    fitting = F.least(F.lit(SMOOTHING_MAX_WINDOW).cast("long"), n_points)
    return (fitting - F.pmod(fitting + 1, F.lit(2))).cast("int")


def window_start(row_no: Column, n_points: Column, window: Column) -> Column:
    """First row of the window: centred, moved inwards at the ends of the flight."""
    centred = row_no - F.floor(window / 2)
    return F.greatest(F.lit(0).cast("long"), F.least(centred, n_points - window))


def centred_fit(neighbour: Callable[[int], Column]) -> Column:
    """Fit of a full window around a row; ``neighbour(d)`` is the value d rows on.

    The weights are the same for all such rows, nearly all of a flight, and symmetric.
    """
    half = SMOOTHING_MAX_WINDOW // 2
    weights = cubic_weights(SMOOTHING_MAX_WINDOW)[half, half:].tolist()
    total = F.lit(weights[0]) * neighbour(0)
    for d in range(1, half + 1):
        total = total + F.lit(weights[d]) * (neighbour(-d) + neighbour(d))
    return total


def edge_fit(values: Column, first: Column, window: Column, weights: Column) -> Column:
    """Sum of weights times the ``window`` values from position ``first`` on."""
    start = F.greatest(first + 1, F.lit(1)).cast("int")
    products = F.zip_with(F.slice(values, start, window), weights, lambda v, w: v * w)
    return F.aggregate(products, F.lit(0.0), lambda total, product: total + product)
