"""The city dimension."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.schema import CITIES


def city_dim(spark: SparkSession) -> DataFrame:
    """The fixed list of cities: small by construction, so safe to broadcast."""
    names, latitudes, longitudes = zip(*CITIES)
    return spark.createDataFrame(
        pa.table(
            {
                "city_index": pa.array(range(len(CITIES)), pa.int64()),
                "city": pa.array(names, pa.string()),
                "latitude": pa.array(latitudes, pa.float64()),
                "longitude": pa.array(longitudes, pa.float64()),
            }
        )
    )


def expected_documents(
    spark: SparkSession, run_date: str, cities: list[str] | None = None
) -> DataFrame:
    """One row per city that should have a document for a run date."""
    names = city_dim(spark).select("city")
    if cities is not None:
        names = spark.createDataFrame(pa.table({"city": pa.array(cities, pa.string())}))
    return names.withColumn("run_date", F.lit(run_date).cast("date"))
