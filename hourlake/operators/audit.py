"""One audit row per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOADED = "loaded"
QUARANTINED = "quarantined"
EMPTY = "empty"
MISSING = "missing"

DOCUMENT = ["city", "run_date", "file"]


def load_audit(
    good: DataFrame,
    bad: DataFrame,
    expected: DataFrame | None = None,
    empty: DataFrame | None = None,
    report_missing: bool = True,
) -> DataFrame:
    """Status, row count and message of each document, and of each expected one not there.

    ``good`` has one row per hour, ``bad`` one per rejected document and ``empty`` one per document
    without hours, all with ``city``, ``run_date`` and ``file``; ``expected`` lists ``city`` and
    ``run_date``. Without such a list nothing can be missing, and the column ``expected`` is NULL.
    What is missing is known when all documents have been seen: parts of a load pass
    ``report_missing=False``.
    """
    loaded = (
        good.groupBy(*DOCUMENT)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(*DOCUMENT, F.lit(LOADED).alias("status"), "rows", _no_text().alias("message"))
    )
    rejected = bad.select(
        *DOCUMENT,
        F.lit(QUARANTINED).alias("status"),
        F.lit(0).cast("long").alias("rows"),
        F.col("reason").alias("message"),
    )
    seen = loaded.unionByName(rejected)
    if empty is not None:
        without = empty.select(
            *DOCUMENT,
            F.lit(EMPTY).alias("status"),
            F.lit(0).cast("long").alias("rows"),
            F.lit("no hours").alias("message"),
        )
        seen = seen.unionByName(without)
    found = mark_expected(seen, expected)
    if expected is None or not report_missing:
        return found
    return found.unionByName(missing_documents(seen, expected))


def mark_expected(seen: DataFrame, expected: DataFrame | None) -> DataFrame:
    """``seen`` with whether its city and run date were expected; NULL where there is no list."""
    if expected is None:
        return seen.withColumn("expected", F.lit(None).cast("boolean"))
    wanted = expected.select(
        F.col("city").alias("_city"), F.col("run_date").alias("_run_date")
    ).distinct()
    # A left and an anti join instead of a full outer one: AQE can split the documents
    # of one very large city in a left join, and in the other they are pre-aggregated.
    return seen.join(wanted, _same_document(seen, wanted), "left").select(
        *seen.columns, F.col("_run_date").isNotNull().alias("expected")
    )


def missing_documents(seen: DataFrame, expected: DataFrame) -> DataFrame:
    """Audit rows of the expected documents that are not among those seen."""
    wanted = expected.select(
        F.col("city").alias("_city"), F.col("run_date").alias("_run_date")
    ).distinct()
    known = seen.select("city", "run_date").distinct()
    return wanted.join(known, _same_document(known, wanted), "left_anti").select(
        F.col("_city").alias("city"),
        F.col("_run_date").alias("run_date"),
        _no_text().alias("file"),
        F.lit(MISSING).alias("status"),
        F.lit(0).cast("long").alias("rows"),
        F.lit("no document").alias("message"),
        F.lit(True).alias("expected"),
    )


def _same_document(seen: DataFrame, wanted: DataFrame):
    return seen["city"].eqNullSafe(wanted["_city"]) & seen["run_date"].eqNullSafe(
        wanted["_run_date"]
    )


def _no_text():
    return F.lit(None).cast("string")
