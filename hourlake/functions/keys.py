"""Dates, ISO texts and landing keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: name of the one file below city/year/month/day.
DOCUMENT_NAME = "weather_data.json"

# city/year/month/day/file, bare or with Hive-style "name=" prefixes
_KEY = r"(?:^|/)(?:city=)?([^/]+)/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/(?:day=)?(\d{1,2})/[^/]+$"


def utc_today() -> Column:
    """The run date of a load that starts now."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.now()) / 86_400).cast("int"))


def object_key(city: Column, day: Column) -> Column:
    """``city/year/month/day/file`` without leading zeros."""
    parts = [F.year(day), F.month(day), F.dayofmonth(day)]
    return F.concat_ws("/", city, *[p.cast("string") for p in parts], F.lit(DOCUMENT_NAME))


def city_of_path(path: Column) -> Column:
    """City part of a file path, with percent escapes undone; a plus sign stays one."""
    text = F.regexp_extract(path, _KEY, 1)
    return F.nullif(F.url_decode(F.regexp_replace(text, r"\+", "%2B")), F.lit(""))


def run_date_of_path(path: Column) -> Column:
    parts = [F.regexp_extract(path, _KEY, i) for i in (2, 3, 4)]
    return F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d")


def text_to_date(text: Column) -> Column:
    """Date part of an ISO text; NULL where the text is no date."""
    return F.try_to_date(text)


def hour_start(start_epoch: Column, position: Column, time_axis: str) -> Column:
    """UTC timestamp of a row: the start on every row, or one hour per position."""
    if time_axis == "start":
        return F.timestamp_seconds(start_epoch)
    if time_axis == "hourly":
        return F.timestamp_seconds(start_epoch + position * F.lit(3600))
    raise ValueError(f"time_axis must be 'start' or 'hourly', not {time_axis!r}")


def iso_text(timestamp: Column) -> Column:
    """``2025-01-02T00:00:00.000Z``, in UTC whatever the session zone is."""
    millis = F.unix_millis(timestamp)
    day = F.floor(millis / 86_400_000).cast("int")
    rest = F.pmod(millis, F.lit(86_400_000))
    second = F.floor(rest / 1000)
    clock = F.format_string(
        "T%02d:%02d:%02d.%03dZ",
        F.floor(second / 3600),
        F.floor(second / 60) % 60,
        second % 60,
        rest % 1000,
    )
    return F.concat(F.date_from_unix_date(day).cast("string"), clock)


def glob_text(name: str) -> str:
    """A pattern that matches the name and nothing else."""
    return "".join("\\" + ch if ch in "\\{}[]*?,^" else ch for ch in name)
