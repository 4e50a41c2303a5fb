"""Derived measures as column expressions.

The formulas mix unit systems; they are what published tables contain and are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def heat_index(temperature: Column, humidity: Column) -> Column:
    # try_divide: NULL where the denominator is 0, whatever the ANSI setting
    exponent = F.try_divide(F.lit(17.27) * temperature, F.lit(237.7) + temperature)
    vapour = F.lit(6.11) * F.exp(exponent) - F.lit(10.0)
    return temperature + F.lit(0.5555) * vapour * (F.lit(1.0) - humidity / F.lit(100.0))


def wind_chill(temperature: Column, wind_speed: Column) -> Column:
    damped = F.pow(wind_speed, F.lit(0.16))
    return (
        F.lit(35.74)
        + F.lit(0.6215) * temperature
        - F.lit(35.75) * damped
        + F.lit(0.4275) * temperature * damped
    )


def potential_evapotranspiration(
    temperature: Column, lower: Column, upper: Column, water_vapour: Column
) -> Column:
    spread = F.sqrt(F.abs(upper - lower))
    return F.lit(0.0023) * (temperature + F.lit(17.8)) * spread * water_vapour


def day_flag(value: Column) -> Column:
    """1.0 is true; every other value, also NULL, is false."""
    return F.coalesce(value == F.lit(1.0), F.lit(False))
