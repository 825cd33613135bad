"""Small trajectories for tests."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

START = datetime(2024, 1, 1, 6)


def flight(flight_id, altitudes, seconds=None, **columns):
    """Points of one flight; one per second unless ``seconds`` says otherwise."""
    n = len(altitudes)
    seconds = range(n) if seconds is None else seconds
    base = {
        "flight_id": [flight_id] * n,
        "timestamp": [START + timedelta(seconds=float(s)) for s in seconds],
        "altitude": [float(a) for a in altitudes],
        "groundspeed": 200.0 + np.arange(n) % 7,
        "track": (np.arange(n) * 11.0) % 360,
        "vertical_rate": 1000.0 + 10 * np.arange(n),
        "u_component_of_wind": np.arange(n) % 5 - 2.0,
        "v_component_of_wind": np.arange(n) % 3 - 1.0,
        "temperature": 250.0 + np.arange(n) % 4,
    }
    return pd.DataFrame({**base, **columns})


def climb(n, seed=0):
    """Altitudes of a noisy climb into a cruise."""
    rng = np.random.default_rng(seed)
    return np.minimum(300.0 * np.arange(n), 9000.0) + rng.normal(0, 50, n).round(1) + 500


def points(spark, *flights):
    return spark.createDataFrame(pd.concat(flights, ignore_index=True))


def by_flight(df):
    """Pandas rows by flight, in order."""
    table = df.toPandas().sort_values(["flight_id", "timestamp"])
    return {key: rows.reset_index(drop=True) for key, rows in table.groupby("flight_id")}
