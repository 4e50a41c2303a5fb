"""Previews, display labels and chart series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.schema import DISPLAY_NAMES


def preview(df: DataFrame, rows: int, order: list[str], tail: bool = False) -> DataFrame:
    """First or last rows by ``order``, in ascending order, NULLs last."""
    ascending = [F.col(c).asc_nulls_last() for c in order]
    if not tail:
        return df.orderBy(*ascending).limit(rows)
    descending = [F.col(c).desc_nulls_first() for c in order]
    return df.orderBy(*descending).limit(rows).orderBy(*ascending)


def with_display_names(df: DataFrame, report: str) -> DataFrame:
    """Columns renamed to the labels readers see, in their order.

    The frame must have the report's columns, all and no others: anything else is another report.
    """
    labels = DISPLAY_NAMES[report]
    if missing := [c for c in labels if c not in df.columns]:
        raise ValueError(f"{report} lacks {missing}")
    if unknown := [c for c in df.columns if c not in labels]:
        raise ValueError(f"{report} has no label for {unknown}")
    return df.select(*[F.col(c).alias(label) for c, label in labels.items()])


def chart_series(df: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    """Long form of a chart: one row per id and series."""
    return df.select(*ids, *values).unpivot(ids, values, "series", "value")
