"""Position of each row in its batch, and the two halves of a batch.

A batch is normally one small document, so a window per batch is the cheapest plan: one
exchange. A batch may also hold a large share of all rows, and a window would put it in
one task. Then rows are numbered in slices: per batch and slice, and the slices' sizes,
which are pre-aggregated, give where each begins. Slices are named by the caller, as an
expression that rises with the order of a batch, such as the hour of a time; or they come
from the rows themselves (``spread``): borders of about equal ranges of batch and order,
out of a bounded sample by hash that is the same whenever it is taken. All of it is a plan
and nothing else: no job runs, and nothing is stored, before the result is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION = "batch_position"
SIZE = "batch_rows"
#: Rows of the sample, and slices of all batches together, where rows are spread by themselves.
SAMPLE_ROWS, SLICES = 20_000, 256


def number_rows(
    df: DataFrame,
    batch_cols: list[str],
    order_cols: list[str],
    slice_by: Column | None = None,
    spread: bool = False,
) -> DataFrame:
    """Add ``batch_position`` (from 0) and ``batch_rows``.

    ``order_cols`` must order the rows of a batch totally. With ``slice_by``, no task gets
    more than a slice; it must not fall as the order of a batch rises. The result is the
    same with any slices, or none. One slice per ten thousand rows or more is plenty: the
    slices of a batch are put in order in one task. With ``spread``, slices are found in the
    data: a batch with most of the rows is dealt to most of the slices.
    """
    if slice_by is not None:
        return _by_slice(df.withColumn("_slice", slice_by), batch_cols, order_cols)
    if spread:
        return _by_slice(_own_slices(df, [*batch_cols, *order_cols]), batch_cols, order_cols)
    return _by_window(df, batch_cols, order_cols)


def label_halves(
    df: DataFrame, position: str = POSITION, size: str = SIZE, first_half_flag: bool = True
) -> DataFrame:
    """Add ``forecast_data`` and ``hour`` from a known position and batch size.

    The first ``size div 2`` rows get ``first_half_flag``, the others its opposite, and
    ``hour`` starts at 0 in each half. No exchange is needed.
    """
    half = F.shiftright(size, 1)
    in_first = F.col(position) < half
    return df.withColumns(
        {
            "hour": F.when(in_first, F.col(position))
            .otherwise(F.col(position) - half)
            .cast("long"),
            "forecast_data": in_first if first_half_flag else ~in_first,
        }
    )


def label_batch(
    df: DataFrame,
    batch_cols: list[str],
    order_cols: list[str],
    first_half_flag: bool = True,
    slice_by: Column | None = None,
    spread: bool = False,
) -> DataFrame:
    """Number the rows of each batch and label its halves."""
    numbered = number_rows(df, batch_cols, order_cols, slice_by, spread)
    return label_halves(numbered, first_half_flag=first_half_flag).drop(POSITION, SIZE)


def _by_window(df: DataFrame, batch_cols: list[str], order_cols: list[str]) -> DataFrame:
    # the size uses the same order, so that one window operator computes both
    batch = Window.partitionBy(*batch_cols).orderBy(*order_cols)
    whole = batch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns(
        {
            POSITION: F.row_number().over(batch).cast("long") - F.lit(1),
            SIZE: F.count(F.lit(1)).over(whole),
        }
    )


def _own_slices(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_slice``: how many borders a row has passed, in the order of ``keys``.

    The sample is the rows of least hash, so that it does not depend on partitions; rows of equal
    hash are taken by their keys. Structs compare as their fields do, NULL first, as in a sort.
    """
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    sample = df.select(key.alias("key")).orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS)
    # the sample is bounded, so one task may order it
    all_ = Window.partitionBy(F.lit(0))
    place, total = F.row_number().over(all_.orderBy("key")), F.count(F.lit(1)).over(all_)
    step = F.greatest(F.lit(1), F.ceil(F.col("total") / SLICES))
    marks = sample.select("key", place.alias("place"), total.alias("total")).where(F.col("place") % step == 0)
    borders = marks.agg(F.sort_array(F.collect_set("key")).alias("borders"))
    # one row, computed once, and before the rows are read; a column first, as functions of
    # arrays take no subquery
    bordered = df.withColumn("_borders", borders.scalar())
    return bordered.withColumn("_slice", _passed(F.col("_borders"), key)).drop("_borders")


def _passed(borders: Column, key: Column) -> Column:
    """Number of sorted ``borders`` that are not greater than ``key``, by halving."""
    state = F.struct(F.lit(0).alias("low"), F.size(borders).alias("past"))
    middle = lambda a: F.shiftright(a["low"] + a["past"], 1)

    def halve(a: Column, _: Column) -> Column:
        beyond = F.get(borders, middle(a)) > key
        return F.when(a["low"] >= a["past"], a).otherwise(
            F.struct(
                F.when(beyond, a["low"]).otherwise(middle(a) + 1).alias("low"),
                F.when(beyond, middle(a)).otherwise(a["past"]).alias("past"),
            )
        )

    steps = F.sequence(F.lit(1), F.lit(SLICES.bit_length()))
    return F.aggregate(steps, state, halve, lambda a: a["low"])


def _by_slice(sliced: DataFrame, batch_cols: list[str], order_cols: list[str]) -> DataFrame:
    slice_ = Window.partitionBy(*batch_cols, "_slice").orderBy(*order_cols)
    numbered = sliced.withColumn("_in_slice", F.row_number().over(slice_).cast("long"))
    pieces = sliced.groupBy(*batch_cols, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per slice in these windows
    batch = Window.partitionBy(*batch_cols)
    earlier = batch.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(c).alias(f"_piece_{c}") for c in batch_cols],
        F.col("_slice").alias("_piece_slice"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(batch).alias(SIZE),
    )
    names = {**{c: f"_piece_{c}" for c in batch_cols}, "_slice": "_piece_slice"}
    matched = numbered.join(offsets, _same(numbered, offsets, names), "inner")
    columns = [c for c in sliced.columns if c != "_slice"]
    return matched.withColumn(POSITION, F.col("_before") + F.col("_in_slice") - 1).select(
        *columns, POSITION, SIZE
    )


def _same(left: DataFrame, right: DataFrame, names: dict[str, str]):
    """Equality of key columns that also matches NULL with NULL."""
    return reduce(
        lambda a, b: a & b, [left[mine].eqNullSafe(right[other]) for mine, other in names.items()]
    )
