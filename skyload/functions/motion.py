"""Speeds, winds and the thrust-minus-drag balance as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyload.constants import (
    GRAVITY_FT_PER_S2,
    KNOT_IN_FT_PER_S,
    METRE_IN_FT,
    SECONDS_PER_MINUTE,
)
from skyload.functions.atmosphere import isa_temperature


def true_airspeed(
    groundspeed: Column,
    track: Column,
    wind_east: Column,
    wind_north: Column,
    wind_factor: float = METRE_IN_FT,
) -> Column:
    """Airspeed in ft/s: ground velocity minus wind.

    ``wind_factor`` turns the stored wind into ft/s. Pass ``KNOT_IN_FT_PER_S``
    for wind stored in knots.
    """
    speed = groundspeed * F.lit(KNOT_IN_FT_PER_S)
    heading = F.radians(track)
    east = speed * F.sin(heading) - wind_east * F.lit(wind_factor)
    north = speed * F.cos(heading) - wind_north * F.lit(wind_factor)
    return F.sqrt(east * east + north * north)


def wind_along_track(
    track: Column, wind_east: Column, wind_north: Column, wind_factor: float = METRE_IN_FT
) -> Column:
    """Wind component along the track, in ft/s."""
    heading = F.radians(track)
    return (wind_east * F.sin(heading) + wind_north * F.cos(heading)) * F.lit(wind_factor)


def vertical_speed(rate_per_minute: Column) -> Column:
    """ft/min to ft/s."""
    return rate_per_minute / F.lit(SECONDS_PER_MINUTE)


def temperature_deviation(
    temperature: Column, altitude: Column, altitude_factor: float = 1.0
) -> Column:
    """Measured temperature minus the standard one at that altitude."""
    return temperature - isa_temperature(altitude, altitude_factor)


def micros(time: Column) -> Column:
    """Whole microseconds since the epoch; differences of it are exact."""
    return F.unix_micros(time.cast("timestamp"))


def per_second(change: Column, micros_passed: Column) -> Column:
    """Rate of change; NULL when no time has passed."""
    return F.try_divide(change, micros_passed / F.lit(1e6))


def thrust_minus_drag(
    climb: Column, airspeed: Column, temperature: Column, deviation: Column,
    acceleration: Column, wind_change: Column,
) -> Column:
    """Energy balance of the climb, per unit of mass; NULL on a zero divisor."""
    warm = F.try_divide(temperature, temperature - deviation)
    climbing = F.try_divide(F.lit(GRAVITY_FT_PER_S2) * climb, airspeed)
    return climbing * warm + acceleration + wind_change
