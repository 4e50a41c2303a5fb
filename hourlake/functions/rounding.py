"""Sums and means of doubles that do not depend on the order of rows, as Spark SQL text.

A double is taken as the decimal it is written as. Below ``ORDINARY``, decimals of eleven places add up
exactly, in any order, and a tie of short decimals stays one. Larger values are rare, and no decimal holds
all of them; each is written as digits and a power of ten and added to the others of its *band*, nine powers
of ten wide, where decimals are exact too. A sum is that of the ordinary values and of the bands, from the
highest down, so cancelling values leave the others exact, and nothing overflows. NaN and infinities are kept
as marks and go through: a mean with a NaN is NaN, with infinities of one sign infinite, of both NaN.

The texts serve both DataFrames (``operators.exact``) and SQL (``plans.statements``). A column is summed in
two steps: states by key and band (``STATE`` columns), and results of states.
"""

from __future__ import annotations

PLACES = 11
#: Powers of ten from which a value is not ordinary, and in one band.
FIRST_POWER, POWERS = 15, 9
ORDINARY = f"1E{FIRST_POWER}D"
# 10**10 rows of such values fit in the sum
_VALUE = f"decimal(28,{PLACES})"
# of sums below 10**17, which all usual ones are, the quotient keeps 21 places
_USUAL, _COUNT = f"decimal(28,{PLACES})", "decimal(12,0)"
#: Digits of a large value, as a number below ten to the power of a band.
_DIGITS = "decimal(28,16)"

#: Marks of values that are no numbers.
PLUS, MINUS, NAN = 1, 2, 4

#: Columns of the states: the column and band that ``large`` is a sum of, or NULL.
SLOT, BAND, LARGE = "large_slot", "large_band", "large_sum"


def large_values(columns: list[str]) -> str:
    """The large values of a row: (slot, band, digits) of each, in an array that is mostly empty."""

    def value(slot: int, column: str) -> str:
        text = f"cast({column} AS string)"  # such as 1.25E300
        power = f"(cast(substring_index({text}, 'E', -1) AS int) - {FIRST_POWER})"
        digits = f"cast(concat(substring_index({text}, 'E', 1), 'E', {power} % {POWERS}) AS {_DIGITS})"
        large = f"abs({column}) >= {ORDINARY} AND abs({column}) < double('Infinity')"
        return f"CASE WHEN {large} THEN struct({slot} AS slot, {power} DIV {POWERS} AS band, {digits} AS digits) END"

    values = ", ".join(value(i, c) for i, c in enumerate(columns))
    return f"filter(array({values}), v -> v IS NOT NULL)"


def ordinary_sum(column: str, counted: str) -> str:
    """Sum of the ordinary values, in rows where ``counted`` holds."""
    return f"sum(CASE WHEN {counted} AND abs({column}) < {ORDINARY} THEN cast({column} AS {_VALUE}) END)"


def value_count(column: str, counted: str) -> str:
    return f"count(CASE WHEN {counted} THEN {column} END)"


def marks(column: str, counted: str) -> str:
    """Which values that are no numbers there are."""
    mark = (
        f"CASE WHEN isnan({column}) THEN {NAN} WHEN {column} = double('Infinity') THEN {PLUS} "
        f"WHEN {column} = double('-Infinity') THEN {MINUS} ELSE 0 END"
    )
    return f"bit_or(CASE WHEN {counted} THEN {mark} END)"


def result(slot: int, total: str, count: str, mark: str, bands: str, scale: int, mean: bool) -> str:
    """Sum or mean of a column, rounded once, half away from zero; NULL without values.

    ``bands`` is an array of (slot, band, sum) with sums that are not zero.
    """
    own = f"filter({bands}, b -> b.slot = {slot})"
    known = f"coalesce({total}, cast(0 AS {_VALUE}))"
    by = f" / cast({count} AS {_COUNT})" if mean else ""

    def exact(kind: str) -> str:
        return f"cast(round(try_cast({known} AS {kind}){by}, {scale}) AS double)"

    power = f"{FIRST_POWER} + {POWERS} * b.band"
    added = (
        f"aggregate(reverse(array_sort(transform({own}, b -> struct(b.band, b.sum)))), 0D, "
        f"(a, b) -> a + cast(concat(cast(b.sum AS string), 'E', {power}) AS double))"
    )
    large = f"round(({added} + cast({known} AS double)){' / ' + count if mean else ''}, {scale})"
    return f"""CASE WHEN {count} = 0 THEN NULL
        WHEN {mark} >= {NAN} OR {mark} = {PLUS | MINUS} THEN double('NaN')
        WHEN {mark} = {PLUS} THEN double('Infinity') WHEN {mark} = {MINUS} THEN double('-Infinity')
        WHEN size({own}) = 0 THEN coalesce({exact(_USUAL)}, {exact(f'decimal(38,{PLACES})')})
        ELSE {large} END"""
