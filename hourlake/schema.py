"""Column lists, table layouts, labels and the city list."""

from __future__ import annotations

from pyspark.sql import types as T

# The measures of a landing document, in document order.
MEASURES = [
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation_probability",
    "precipitation",
    "rain",
    "snowfall",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover",
    "evapotranspiration",
    "wind_speed_10m",
    "wind_speed_80m",
    "wind_speed_120m",
    "temperature_2m",
    "temperature_80m",
    "temperature_120m",
    "soil_temperature_0cm",
    "soil_temperature_6cm",
    "soil_temperature_18cm",
    "soil_moisture_0_to_1cm",
    "soil_moisture_1_to_3cm",
    "soil_moisture_3_to_9cm",
    "uv_index_clear_sky",
    "is_day",
    "total_column_integrated_water_vapour",
]

# Columns published at a fixed number of decimals.
ROUNDED = [
    "dew_point_2m",
    "apparent_temperature",
    "pressure_msl",
    "wind_speed_80m",
    "wind_speed_10m",
    "wind_speed_120m",
    "temperature_2m",
    "temperature_80m",
    "temperature_120m",
    "soil_temperature_0cm",
    "soil_temperature_6cm",
    "soil_temperature_18cm",
    "soil_moisture_0_to_1cm",
    "soil_moisture_1_to_3cm",
    "soil_moisture_3_to_9cm",
    "total_column_integrated_water_vapour",
    "heat_index",
    "wind_chill",
    "potential_evapotranspiration",
    "atmospheric_pressure_diff",
    "precipitation_rate",
    "rain",
    "precipitation",
]
DECIMALS = 4

BATCH_KEYS = ["city", "date"]
HOUR_KEYS = ["city", "date", "hour", "forecast_data"]
DAY_KEYS = ["city", "date", "forecast_data"]

# Measures of the published hourly tables.
HOURLY_TABLES = {
    "meteorological_calculations": [
        "heat_index",
        "wind_chill",
        "precipitation_rate",
        "potential_evapotranspiration",
        "atmospheric_pressure_diff",
        "is_day",
    ],
    "hourly_precipitation_evaporation": [
        "precipitation",
        "rain",
        "snowfall",
        "evapotranspiration",
        "is_day",
    ],
    "hourly_soil_conditions": [
        "soil_temperature_0cm",
        "soil_temperature_6cm",
        "soil_temperature_18cm",
        "soil_moisture_0_to_1cm",
        "soil_moisture_1_to_3cm",
        "soil_moisture_3_to_9cm",
        "is_day",
    ],
    "hourly_weather_conditions": [
        "temperature_2m",
        "temperature_80m",
        "temperature_120m",
        "relative_humidity_2m",
        "dew_point_2m",
        "apparent_temperature",
        "cloud_cover",
        "uv_index_clear_sky",
        "is_day",
    ],
    "hourly_wind_atmospheric_conditions": [
        "pressure_msl",
        "surface_pressure",
        "wind_speed_10m",
        "wind_speed_80m",
        "wind_speed_120m",
        "is_day",
    ],
}
DAILY_TABLE = "daily_weather_summary"
DAILY_MEASURES = [
    "total_precipitation",
    "average_temperature_2m",
    "max_temperature_2m",
    "min_temperature_2m",
    "average_relative_humidity_2m",
]
TABLE_NAMES = [*HOURLY_TABLES, DAILY_TABLE]

# Labels shown to readers of a report. Units are as users know them,
# including the labels whose unit or bracket is off.
DISPLAY_NAMES = {
    "daily_extremes": {
        "city": "City",
        "max_temperature_2m": "Max Temperature (F)",
        "min_temperature_2m": "Min Temperature (F)",
    },
    "city_averages": {
        "city": "City",
        "average_snowfall": "Average Snowfall (m)",
        "average_rain": "Average Rain",
        "average_surface_pressure": "Average Surface Pressure (hPA)",
        "average_wind_speed_10m": "Average Wind speed (10mph)",
    },
    "temperatures": {
        "temperature_2m": "Temperature 2m Above",
        "temperature_80m": "Temperature 80m Above",
        "temperature_120m": "Temperature 120m Above",
    },
    "day_over_day": {
        "hour": "Hour",
        "temperature_diff_2m": "Temperature Difference (2m)",
        "temperature_diff_80m": "Temperature Difference (80m)",
        "temperature_diff_120m": "Temperature Difference (120m)",
    },
    "wide_report": {
        "city": "City",
        "date": "Date",
        "hour": "Hour",
        "temperature_2m": "Temperature at 2m (°F)",
        "temperature_80m": "Temperature at 80m (°F)",
        "temperature_120m": "Temperature at 120m (°F)",
        "soil_temperature_0cm": "Soil Temperature at 0cm (°F)",
        "soil_temperature_6cm": "Soil Temperature at 6cm (°F)",
        "soil_temperature_18cm": "Soil Temperature at 18cm (°F)",
        "wind_speed_10m": "Wind Speed at 10m (mph",
        "wind_speed_80m": "Wind Speed at 80m (mph)",
        "wind_speed_120m": "Wind Speed at 120m (mph)",
        "heat_index": "Heat Index (°F)",
        "wind_chill": "Wind Chill (°F)",
        "precipitation_rate": "Precipitation Rate (mm/h)",
        "potential_evapotranspiration": "Potential Evapotranspiration (mm)",
        "atmospheric_pressure_diff": "Atmospheric Pressure Difference (hPA)",
    },
}

# City, latitude, longitude.
CITIES = [
    ("Chicago", 41.878113, -87.629799),
    ("San Francisco", 37.774929, -122.419416),
    ("London", 51.507351, -0.127758),
    ("New Delhi", 28.613939, 77.209023),
    ("Tokyo", 35.689487, 139.691711),
    ("New York", 40.712776, -74.005974),
    ("Paris", 48.856613, 2.352222),
    ("Sydney", -33.868820, 151.209290),
    ("Moscow", 55.755825, 37.617298),
    ("Beijing", 39.904202, 116.407394),
    ("Cape Town", -33.924870, 18.424055),
    ("Berlin", 52.520008, 13.404954),
    ("Rio de Janeiro", -22.906847, -43.172897),
    ("Dubai", 25.276987, 55.296249),
    ("Singapore", 1.352083, 103.819836),
]


def landing_schema() -> T.StructType:
    """One hour of a landing document: ISO date text and the measures."""
    fields = [T.StructField("date", T.StringType())]
    fields += [T.StructField(name, T.DoubleType()) for name in MEASURES]
    return T.StructType(fields)


def line_schema() -> T.StructType:
    """One landing line: an hour, its place in the document and the document's size."""
    places = [T.StructField("pos", T.LongType()), T.StructField("doc_rows", T.LongType())]
    return T.StructType(places + landing_schema().fields)


def table_schema(name: str) -> T.StructType:
    """Schema of a published table."""
    types = {
        "city": T.StringType(),
        "date": T.DateType(),
        "hour": T.LongType(),
        "forecast_data": T.BooleanType(),
        "is_day": T.BooleanType(),
    }
    return T.StructType(
        [T.StructField(c, types.get(c, T.DoubleType())) for c in table_columns(name)]
    )


def table_columns(name: str) -> list[str]:
    if name == DAILY_TABLE:
        return DAY_KEYS + DAILY_MEASURES
    return HOUR_KEYS + HOURLY_TABLES[name]
