"""International standard atmosphere as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyload.constants import (
    ALTITUDE_MAX,
    ALTITUDE_MIN,
    ISA_GAS_CONSTANT,
    ISA_GRAVITY,
    ISA_LAPSE_PER_M,
    ISA_SEA_LEVEL_K,
    ISA_SEA_LEVEL_PA,
    ISA_TROPOPAUSE,
)

_TROPOPAUSE_K = ISA_SEA_LEVEL_K - ISA_LAPSE_PER_M * ISA_TROPOPAUSE
_EXPONENT = ISA_GRAVITY / (ISA_LAPSE_PER_M * ISA_GAS_CONSTANT)
_TROPOPAUSE_PA = ISA_SEA_LEVEL_PA * (_TROPOPAUSE_K / ISA_SEA_LEVEL_K) ** _EXPONENT


def _in_model(altitude: Column, value: Column) -> Column:
    return F.when(altitude.between(ALTITUDE_MIN, ALTITUDE_MAX), value)


def isa_temperature(altitude: Column, altitude_factor: float = 1.0) -> Column:
    """Temperature in K; constant above the tropopause, NULL outside [0, 47000].

    ``altitude_factor`` converts the altitude that enters the formula. The range
    is always checked on the altitude as stored.
    """
    h = altitude.cast("double") * F.lit(altitude_factor)
    below = F.lit(ISA_SEA_LEVEL_K) - F.lit(ISA_LAPSE_PER_M) * h
    return _in_model(altitude, F.when(h <= ISA_TROPOPAUSE, below).otherwise(F.lit(_TROPOPAUSE_K)))


def isa_pressure(altitude: Column, altitude_factor: float = 1.0) -> Column:
    """Pressure in Pa: a power law to the tropopause, an exponential above."""
    h = altitude.cast("double") * F.lit(altitude_factor)
    ratio = (F.lit(ISA_SEA_LEVEL_K) - F.lit(ISA_LAPSE_PER_M) * h) / F.lit(ISA_SEA_LEVEL_K)
    below = F.lit(ISA_SEA_LEVEL_PA) * F.pow(ratio, F.lit(_EXPONENT))
    decay = ISA_GRAVITY / (ISA_GAS_CONSTANT * _TROPOPAUSE_K)
    above = F.lit(_TROPOPAUSE_PA) * F.exp(F.lit(-decay) * (h - F.lit(ISA_TROPOPAUSE)))
    return _in_model(altitude, F.when(h <= ISA_TROPOPAUSE, below).otherwise(above))


def isa_density(altitude: Column, altitude_factor: float = 1.0) -> Column:
    """Density in kg/m3, by the gas law."""
    return isa_pressure(altitude, altitude_factor) / (
        F.lit(ISA_GAS_CONSTANT) * isa_temperature(altitude, altitude_factor)
    )
