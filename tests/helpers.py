"""Small frames and comparisons for the tests."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from hourlake.schema import MEASURES

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows in a comparable order."""
    picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def measures_frame(spark, values):
    """One row per dict of measures; the others are NULL."""
    schema = ", ".join(f"{m} double" for m in MEASURES)
    data = [tuple(None if v.get(m) is None else float(v[m]) for m in MEASURES) for v in values]
    return spark.createDataFrame(data, schema)


def hours(start: int, count: int, date: str = "2025-01-02T00:00:00.000Z") -> list[dict]:
    """Records of a document."""
    return [
        {"date": date, **{m: round(start + i + j / 8, 4) for j, m in enumerate(MEASURES)}}
        for i in range(count)
    ]


def put_document(base, city, day, records, name="weather_data.json") -> str:
    """Write a document where the object store would hold it."""
    year, month, dom = (int(p) for p in day.split("-"))
    folder = f"{base}/{city}/{year}/{month}/{dom}"
    os.makedirs(folder, exist_ok=True)
    text = records if isinstance(records, str) else json.dumps(records)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write(text)
    return folder


def batches(spark, sizes: dict[tuple, int]):
    """Batches of given sizes, shuffled, with the true position in ``wanted``."""
    frames = []
    for (city, day), size in sizes.items():
        frames.append(
            spark.range(size).select(
                F.lit(city).cast("string").alias("city"),
                F.lit(day).cast("date").alias("date"),
                # several rows share a first key; the second one decides
                F.floor(F.col("id") / 3).cast("long").alias("first"),
                (F.col("id") % 3).alias("second"),
                F.col("id").alias("wanted"),
                F.lit(size).cast("long").alias("wanted_size"),
            )
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.orderBy(F.xxhash64("city", "date", "wanted"))
