"""Aggregates with exact sums and means (see ``functions.rounding``), by way of states that can be merged.

States are few rows a key: one with the sums of ordinary values, counts, marks and extremes, and one more for each
column and band of values from 10**15 on, if there are any. States of parts of the rows, united, are states
of all of them, so they may be stored and finished when they are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions import rounding as R

_FIRST = "coalesce(_place, 0) = 0"
_TYPES = {"sum": T.DecimalType(38, R.PLACES), "n": T.LongType(), "marks": T.IntegerType()}


@dataclass
class Summary:
    """What is computed: name of the result to column and decimals, or to column for extremes."""

    sums: dict[str, tuple[str, int]] = field(default_factory=dict)
    means: dict[str, tuple[str, int]] = field(default_factory=dict)
    greatest: dict[str, str] = field(default_factory=dict)
    least: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        """The columns that are added up; their places are the slots."""
        return list(dict.fromkeys(c for c, _ in [*self.sums.values(), *self.means.values()]))

    def state_fields(self) -> list[T.StructField]:
        """Columns of the states, besides the keys."""
        fields = [T.StructField(R.SLOT, T.IntegerType()), T.StructField(R.BAND, T.IntegerType())]
        fields.append(T.StructField(R.LARGE, T.DecimalType(38, 16)))
        fields += [T.StructField(f"{kind}_{c}", t) for c in self.columns for kind, t in _TYPES.items()]
        return fields + [T.StructField(name, T.DoubleType()) for name in [*self.greatest, *self.least]]


def summary_states(frame: DataFrame, keys: list[str], summary: Summary) -> DataFrame:
    """States of the rows by key."""
    needed = dict.fromkeys([*keys, *summary.columns, *summary.greatest.values(), *summary.least.values()])
    rows = frame.select(*needed, F.posexplode_outer(F.expr(R.large_values(summary.columns))).alias("_place", "_large"))
    sums = [
        F.expr(text(c, _FIRST)).cast(_TYPES[kind]).alias(f"{kind}_{c}")
        for c in summary.columns
        for kind, text in {"sum": R.ordinary_sum, "n": R.value_count, "marks": R.marks}.items()
    ]
    extremes = [F.max(c).alias(n) for n, c in summary.greatest.items()]
    extremes += [F.min(c).alias(n) for n, c in summary.least.items()]
    return rows.groupBy(
        *keys, F.col("_large.slot").alias(R.SLOT), F.expr("cast(_large.band AS int)").alias(R.BAND)
    ).agg(F.sum("_large.digits").cast("decimal(38,16)").alias(R.LARGE), *sums, *extremes)


def _merges(summary: Summary) -> list:
    merges = [F.sum(f"sum_{c}").cast(_TYPES["sum"]).alias(f"sum_{c}") for c in summary.columns]
    merges += [F.sum(f"n_{c}").alias(f"n_{c}") for c in summary.columns]
    merges += [F.bit_or(f"marks_{c}").alias(f"marks_{c}") for c in summary.columns]
    return merges + [F.max(n).alias(n) for n in summary.greatest] + [F.min(n).alias(n) for n in summary.least]


def merge_states(states: DataFrame, keys: list[str], summary: Summary) -> DataFrame:
    """States of several parts of the rows as states of all: one a key and band again."""
    large = F.sum(R.LARGE).cast("decimal(38,16)").alias(R.LARGE)
    return states.groupBy(*keys, R.SLOT, R.BAND).agg(large, *_merges(summary))


def finish_states(states: DataFrame, keys: list[str], summary: Summary) -> DataFrame:
    """Results by key, of states with at most one row a key and band.

    A column has at most 33 bands, so what is collected of a key is bounded.
    """
    band = F.struct(F.col(R.SLOT).alias("slot"), F.col(R.BAND).alias("band"), F.col(R.LARGE).alias("sum"))
    bands = F.collect_list(F.when(F.col(R.LARGE) != 0, band)).alias("_bands")
    slots = {c: i for i, c in enumerate(summary.columns)}

    def results(wanted: dict[str, tuple[str, int]], mean: bool) -> list:
        return [
            F.expr(R.result(slots[c], f"sum_{c}", f"n_{c}", f"marks_{c}", "_bands", scale, mean)).alias(name)
            for name, (c, scale) in wanted.items()
        ]

    merged = states.groupBy(*keys).agg(bands, *_merges(summary))
    found = [*results(summary.sums, False), *results(summary.means, True)]
    return merged.select(*keys, *found, *summary.greatest, *summary.least)


def summarise(frame: DataFrame, keys: list[str], summary: Summary) -> DataFrame:
    """Results by key. Two exchanges, of partial sums: by key and band, and by key."""
    return finish_states(summary_states(frame, keys, summary), keys, summary)
