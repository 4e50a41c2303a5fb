"""Column-array payloads to hourly rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.functions.keys import hour_start
from hourlake.schema import MEASURES


def explode_payload(
    df: DataFrame, variables: list[str] = MEASURES, time_axis: str = "start"
) -> DataFrame:
    """One row per position of the arrays, with ``date``, ``pos`` and ``doc_rows``.

    ``df`` has ``start_epoch`` and one array per variable; its other columns are kept.
    A variable without a column, or with a NULL array, gives NULLs; one column there must be. ``time_axis`` is
    ``"start"`` (the start time on every row) or ``"hourly"`` (one hour per position).
    """
    present = [v for v in variables if v in df.columns]
    if not present:
        raise ValueError("the payloads have none of the variables, so their length is unknown")
    kept = [c for c in df.columns if c not in variables and c != "start_epoch"]
    # arrays_zip is NULL as soon as one array is, so a NULL array counts as empty
    arrays = [F.coalesce(F.col(v), F.array().cast("array<double>")).alias(v) for v in present]
    zipped = df.select(*kept, "start_epoch", F.arrays_zip(*arrays).alias("_hours"))
    rows = zipped.select(
        *kept, "start_epoch", F.size("_hours").alias("_n"), F.posexplode("_hours").alias("_p", "_h")
    )
    values = [
        F.col(f"_h.{v}").alias(v) if v in present else F.lit(None).cast("double").alias(v)
        for v in variables
    ]
    return rows.select(
        *kept,
        hour_start(F.col("start_epoch"), F.col("_p"), time_axis).alias("date"),
        F.col("_p").cast("long").alias("pos"),
        F.col("_n").cast("long").alias("doc_rows"),
        *values,
    )
