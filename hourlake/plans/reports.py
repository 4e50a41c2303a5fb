"""Reports on the published tables as DataFrame functions.

``tables`` maps table names to DataFrames, from storage or from ``all_tables``. Filters
are on one table each and before the joins; hour keys are unique in a table, so joins on
them stay one-to-one and spread by hour even if one city holds most rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.operators.exact import Summary, summarise
from hourlake.schema import DAILY_TABLE

JOIN_KEYS = ["city", "date", "hour"]
LEVELS = ["2m", "80m", "120m"]
TEMPERATURES = [f"temperature_{level}" for level in LEVELS]


def day(text) -> F.Column:
    return F.lit(text).cast("date")


def _half(df: DataFrame, forecast: bool) -> DataFrame:
    return df.where(F.col("forecast_data") if forecast else ~F.col("forecast_data"))


def daily_extremes(tables: dict[str, DataFrame], date: str, forecast: bool = False) -> DataFrame:
    """Highest and lowest temperature of each city on one date."""
    rows = _half(tables[DAILY_TABLE], forecast).where(F.col("date") == day(date))
    return rows.select("city", "max_temperature_2m", "min_temperature_2m")


def city_averages(
    tables: dict[str, DataFrame],
    forecast: bool = False,
    fall_scale: int = 6,
    air_scale: int = 4,
) -> DataFrame:
    """Average snowfall, rain, surface pressure and wind speed of each city."""
    fall = _half(tables["hourly_precipitation_evaporation"], forecast)
    air = _half(tables["hourly_wind_atmospheric_conditions"], forecast)
    joined = fall.select(*JOIN_KEYS, "snowfall", "rain").join(
        air.select(*JOIN_KEYS, "surface_pressure", "wind_speed_10m"), JOIN_KEYS
    )
    scales = {"snowfall": fall_scale, "rain": fall_scale, "surface_pressure": air_scale, "wind_speed_10m": air_scale}
    return summarise(joined, ["city"], Summary(means={f"average_{c}": (c, s) for c, s in scales.items()}))


def temperatures(
    tables: dict[str, DataFrame], city: str, date: str, forecast: bool
) -> DataFrame:
    """Temperatures at three levels for one city, date and half."""
    rows = _half(tables["hourly_weather_conditions"], forecast)
    rows = rows.where((F.col("date") == day(date)) & (F.col("city") == city))
    return rows.select(*TEMPERATURES)


def day_over_day_city(
    tables: dict[str, DataFrame], city: str, first_date: str, second_date: str
) -> DataFrame:
    """Forecast of one date less observation of another, by hour, for one city."""
    weather = tables["hourly_weather_conditions"].where(F.col("city") == city)
    first = _half(weather, True).where(F.col("date") == day(first_date))
    second = _half(weather, False).where(F.col("date") == day(second_date))
    joined = first.alias("w1").join(second.alias("w2"), ["city", "hour"])
    return joined.select("hour", *_differences())


def day_over_day(tables: dict[str, DataFrame], lag_days: int = 1) -> DataFrame:
    """Forecast of each date less observation ``lag_days`` later, by city and hour."""
    weather = tables["hourly_weather_conditions"].select(
        "city", "date", "hour", "forecast_data", *TEMPERATURES
    )
    first = _half(weather, True).withColumn("later_date", F.date_add("date", lag_days))
    second = _half(weather, False).withColumnRenamed("date", "later_date")
    joined = first.alias("w1").join(second.alias("w2"), ["city", "later_date", "hour"])
    return joined.select("city", F.col("w1.date").alias("date"), "hour", *_differences())


def _differences():
    return [
        (F.col(f"w1.temperature_{level}") - F.col(f"w2.temperature_{level}")).alias(
            f"temperature_diff_{level}"
        )
        for level in LEVELS
    ]


# Measures of the wide report, by table.
WIDE_REPORT = {
    "hourly_weather_conditions": TEMPERATURES,
    "hourly_soil_conditions": [
        "soil_temperature_0cm",
        "soil_temperature_6cm",
        "soil_temperature_18cm",
    ],
    "hourly_wind_atmospheric_conditions": [f"wind_speed_{h}" for h in ("10m", "80m", "120m")],
    "meteorological_calculations": [
        "heat_index",
        "wind_chill",
        "precipitation_rate",
        "potential_evapotranspiration",
        "atmospheric_pressure_diff",
    ],
}


def wide_report(
    tables: dict[str, DataFrame],
    city: str | None = None,
    first_date: str | None = None,
    last_date: str | None = None,
    forecast: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Measures of four tables side by side, by city, date and hour."""

    def side(name: str) -> DataFrame:
        rows = _half(tables[name], forecast)
        if city is not None:
            rows = rows.where(F.col("city") == city)
        if first_date is not None:
            rows = rows.where(F.col("date") >= day(first_date))
        if last_date is not None:
            rows = rows.where(F.col("date") <= day(last_date))
        return rows.select(*JOIN_KEYS, *WIDE_REPORT[name])

    joined = reduce(lambda a, b: a.join(b, JOIN_KEYS), [side(name) for name in WIDE_REPORT])
    if ordered:
        joined = joined.orderBy(*[F.col(c).asc_nulls_last() for c in ("date", "hour")])
    return joined
