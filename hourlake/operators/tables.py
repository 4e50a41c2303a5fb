"""The published tables as projections and one aggregate of an hourly frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.operators.exact import Summary, summarise
from hourlake.schema import DAILY_TABLE, DAY_KEYS, DECIMALS, HOURLY_TABLES, table_columns


def split_tables(frame: DataFrame, further: list[str] | None = None) -> dict[str, DataFrame]:
    """The five hourly tables, with ``further`` columns of the frame."""
    return {n: frame.select(*table_columns(n), *(further or [])) for n in HOURLY_TABLES}


def day_summary(scale: int = DECIMALS) -> Summary:
    """What a daily row has: totals, averages and extremes."""
    return Summary(
        sums={"total_precipitation": ("precipitation", scale)},
        means={
            "average_temperature_2m": ("temperature_2m", scale),
            "average_relative_humidity_2m": ("relative_humidity_2m", scale),
        },
        greatest={"max_temperature_2m": "temperature_2m"},
        least={"min_temperature_2m": "temperature_2m"},
    )


def daily_summary(
    frame: DataFrame, further: list[str] | None = None, scale: int = DECIMALS
) -> DataFrame:
    """Totals, averages and extremes per city, date and half, and per ``further`` columns."""
    summary = summarise(frame, [*DAY_KEYS, *(further or [])], day_summary(scale))
    return summary.select(*table_columns(DAILY_TABLE), *(further or []))


def all_tables(frame: DataFrame, scale: int = DECIMALS) -> dict[str, DataFrame]:
    return {**split_tables(frame), DAILY_TABLE: daily_summary(frame, scale=scale)}


def union_batches(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)
