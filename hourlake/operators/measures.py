"""Derived and rounded measures of an hourly frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.functions import weather
from hourlake.schema import DECIMALS, ROUNDED


def derive(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Add the derived measures and round the published ones.

    Derived measures use the values before rounding. One projection does it all.
    """
    temperature = F.col("temperature_2m")
    added = {
        "heat_index": weather.heat_index(temperature, F.col("relative_humidity_2m")),
        "wind_chill": weather.wind_chill(temperature, F.col("wind_speed_10m")),
        "potential_evapotranspiration": weather.potential_evapotranspiration(
            temperature,
            F.col("temperature_80m"),
            F.col("temperature_120m"),
            F.col("total_column_integrated_water_vapour"),
        ),
        "atmospheric_pressure_diff": F.col("pressure_msl") - F.col("surface_pressure"),
        "precipitation_rate": F.col("precipitation") + F.col("snowfall"),
    }
    rounded = {c: F.round(added.get(c, F.col(c)), decimals) for c in ROUNDED}
    return df.withColumns({**rounded, "is_day": weather.day_flag(F.col("is_day"))})
