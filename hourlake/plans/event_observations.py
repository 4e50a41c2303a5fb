"""Hourly observations from an ``events`` table, for the checked queries.

A user plays the city, one ISO week of a user plays one batch, and ``(ts, event_id)`` is
the order in a batch. Landing files have one folder per city and day, so there the users
are spread over the known cities and a batch is a week of one of these. Measures are fixed expressions of ``event_id`` and ``value``; some
are NULL. Rows are numbered while they are narrow, and measures are computed afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.keys import object_key
from hourlake.operators.measures import derive
from hourlake.operators.numbering import POSITION, SIZE, label_batch, number_rows
from hourlake.schema import BATCH_KEYS, CITIES, MEASURES

ORDER = ["ts", "event_id"]
# hours in one document: one past day and one forecast day
DOCUMENT_HOURS = 48


def events(
    spark: SparkSession,
    folder: str,
    known_cities: bool = False,
    city: str | None = None,
    weeks: list[str] | None = None,
) -> DataFrame:
    """City, batch date and the columns the measures need.

    A choice of one city (a user) or of weeks (by their Mondays) is made on the stored columns, so
    that it reaches the scan; both are batch keys, so it leaves batches whole.
    """
    table = spark.read.parquet(f"{folder}/events.parquet")
    if city is not None:
        table = table.where(F.col("user_id") == int(city))
    if weeks is not None:
        starts = [F.lit(week).cast("date") for week in weeks]
        chosen = [(F.col("ts") >= d) & (F.col("ts") < F.date_add(d, 7)) for d in starts]
        table = table.where(reduce(Column.__or__, chosen))
    name = F.col("user_id").cast("string")
    if known_cities:
        names = F.array(*[F.lit(name) for name, _, _ in CITIES])
        name = F.get(names, F.col("user_id") % F.lit(len(CITIES)))
    return table.select(
        name.alias("city"),
        F.trunc(F.col("ts").cast("date"), "week").alias("date"),
        "event_id",
        "ts",
        "value",
    )


def measures() -> dict[str, Column]:
    """Fixed expressions of the observed measures."""
    i, value = F.col("event_id"), F.col("value")

    def cycle(n: int, scale: float) -> Column:
        return (i % n) / scale

    def every(n: int) -> Column:
        return i % n == 0

    daytime = F.hour("ts").between(6, 17)
    return {
        "relative_humidity_2m": (i % 101).cast("double"),
        "dew_point_2m": F.lit(10.0) + value / 7.0,
        "apparent_temperature": F.lit(19.0) + value / 5.0,
        "precipitation_probability": (i % 100).cast("double"),
        "precipitation": F.when(~every(17), cycle(40, 100.0)),
        "rain": cycle(31, 100.0),
        "snowfall": cycle(9, 100.0),
        "pressure_msl": F.lit(1015.0) + cycle(100, 7.0),
        "surface_pressure": F.lit(1000.0) + cycle(90, 11.0),
        "cloud_cover": (i % 97).cast("double"),
        "evapotranspiration": F.when(~every(19), cycle(13, 1000.0)),
        "wind_speed_10m": F.lit(1.0) + i % 30,
        "wind_speed_80m": F.lit(3.0) + i % 37,
        "wind_speed_120m": F.lit(5.0) + i % 41,
        "temperature_2m": F.lit(20.0) + value / 5.0,
        "temperature_80m": F.lit(18.5) + value / 5.0 - cycle(7, 10.0),
        "temperature_120m": F.lit(17.0) + value / 5.0,
        "soil_temperature_0cm": F.lit(25.0) + value / 6.0,
        "soil_temperature_6cm": F.lit(24.0) + value / 11.0,
        "soil_temperature_18cm": F.lit(23.0) + value / 9.0,
        "soil_moisture_0_to_1cm": cycle(50, 100.0),
        "soil_moisture_1_to_3cm": cycle(45, 100.0),
        "soil_moisture_3_to_9cm": cycle(43, 100.0),
        "uv_index_clear_sky": cycle(12, 1.0),
        "is_day": F.when(~every(23), F.when(daytime, F.lit(1.0)).otherwise(F.lit(0.0))),
        "total_column_integrated_water_vapour": F.lit(10.0) + i % 20,
    }


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Unlabelled observations."""
    return events(spark, folder).withColumns(measures())


def labelled(spark: SparkSession, folder: str, **chosen) -> DataFrame:
    """Observations with ``hour`` and ``forecast_data``; ``chosen`` as for ``events``."""
    return label_batch(events(spark, folder, **chosen), BATCH_KEYS, ORDER).withColumns(measures())


def derived(spark: SparkSession, folder: str, **chosen) -> DataFrame:
    """The hourly frame the tables are projections of."""
    return derive(labelled(spark, folder, **chosen))


def landing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as they come from a source, with place and size of their batch."""
    rows = events(spark, folder, known_cities=True)
    numbered = number_rows(rows, BATCH_KEYS, ORDER).withColumns(measures())
    return numbered.withColumns(
        {
            "run_date": F.col("date"),
            "date": F.concat(F.col("date").cast("string"), F.lit("T00:00:00.000Z")),
            "pos": F.col(POSITION),
            "doc_rows": F.col(SIZE),
        }
    ).drop(POSITION, SIZE)


def _documents(
    spark: SparkSession, folder: str, known_cities: bool, changed: dict[str, Column] | None = None
) -> DataFrame:
    """Events with the number of their document in the batch and their place in it."""
    numbered = number_rows(events(spark, folder, known_cities), BATCH_KEYS, ORDER)
    place = F.col(POSITION)
    return numbered.withColumns(
        {
            "document": F.floor(place / F.lit(DOCUMENT_HOURS)).cast("long"),
            "place": place % F.lit(DOCUMENT_HOURS),
        }
    ).withColumns({**measures(), **(changed or {})})


def payloads(spark: SparkSession, folder: str, variables: list[str]) -> DataFrame:
    """Column-array payloads of at most ``DOCUMENT_HOURS`` hours."""
    hours = F.sort_array(F.collect_list(F.struct("place", *variables)))
    grouped = (
        _documents(spark, folder, known_cities=False)
        .groupBy("city", F.col("date").alias("batch_date"), "document")
        .agg(hours.alias("hours"))
    )
    day_start = F.unix_date("batch_date").cast("long") * F.lit(86_400)
    return grouped.select(
        "city",
        "batch_date",
        "document",
        (day_start + F.col("document") * F.lit(DOCUMENT_HOURS * 3600)).alias("start_epoch"),
        *[F.col(f"hours.{v}").alias(v) for v in variables],
    )


def documents(
    spark: SparkSession, folder: str, with_first_event: bool = False, changed: dict[str, Column] | None = None
) -> DataFrame:
    """JSON array documents of at most ``DOCUMENT_HOURS`` hours; ``changed`` has other expressions of measures."""
    iso = F.concat(F.col("date").cast("string"), F.lit("T00:00:00.000Z"))
    hour = F.struct("place", iso.alias("date"), *MEASURES)
    grouped = (
        _documents(spark, folder, known_cities=True, changed=changed)
        .groupBy("city", F.col("date").alias("run_date"), "document")
        .agg(
            F.sort_array(F.collect_list(hour)).alias("hours"),
            F.min("event_id").alias("first_event"),
        )
    )
    first_event = ["first_event"] if with_first_event else []
    text = F.to_json(F.transform("hours", lambda h: h.dropFields("place")))
    return grouped.select(
        "city",
        "run_date",
        "document",
        F.concat_ws("#", object_key(F.col("city"), F.col("run_date")), "document").alias("file"),
        text.alias("text"),
        *first_event,
    )
