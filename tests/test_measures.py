from __future__ import annotations

import datetime
import decimal
import math

import pytest
from pyspark.sql import functions as F

from hourlake.operators.exact import Summary, finish_states, merge_states, summarise, summary_states
from hourlake.operators.measures import derive
from hourlake.plans.reports import city_averages
from hourlake.plans.statements import STATEMENTS
from hourlake.schema import MEASURES, ROUNDED
from hourlake.sources.tables import register_views
from tests.helpers import measures_frame

KNOWN = {
    "temperature_2m": 50,
    "relative_humidity_2m": 80,
    "wind_speed_10m": 5,
    "temperature_80m": 47,
    "temperature_120m": 48,
    "total_column_integrated_water_vapour": 10,
}


def one(spark, **values):
    return derive(measures_frame(spark, [{**KNOWN, **values}])).first()


def test_known_vector(spark):
    row = one(spark)
    assert row["heat_index"] == 62.5425
    assert row["wind_chill"] == 48.218
    assert row["potential_evapotranspiration"] == 1.5594


@pytest.mark.parametrize("value,flag", [(1.0, True), (0.0, False), (None, False), (2.0, False)])
def test_day_flag(spark, value, flag):
    assert one(spark, is_day=value)["is_day"] is flag


def test_null_in_a_sum_stays_null(spark):
    row = one(spark, precipitation=None, snowfall=0.1)
    assert row["precipitation_rate"] is None
    assert row["snowfall"] == 0.1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_zero_denominator_is_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, temperature_2m=-237.7)["heat_index"] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_wind_domain(spark):
    assert one(spark, wind_speed_10m=0)["wind_chill"] == round(35.74 + 0.6215 * 50, 4)
    assert math.isnan(one(spark, wind_speed_10m=-1)["wind_chill"])


def test_rounding_is_half_away_from_zero(spark):
    assert one(spark, rain=0.00005)["rain"] == 0.0001
    assert one(spark, rain=-0.00005)["rain"] == -0.0001


def test_only_listed_columns_are_rounded(spark):
    row = derive(measures_frame(spark, [dict.fromkeys(MEASURES, 1.23456789)])).first()
    for name in set(MEASURES) - {"is_day"}:
        assert row[name] == (1.2346 if name in ROUNDED else 1.23456789), name


def test_derived_from_unrounded_values(spark):
    row = one(spark, pressure_msl=1000.00004, surface_pressure=999.99996)
    assert row["atmospheric_pressure_diff"] == 0.0001  # 1000.0 - 999.99996 would give 0.0


def both(scale, sum_scale=None):
    return Summary(
        sums={"total": ("x", scale if sum_scale is None else sum_scale)},
        means={"mean": ("x", scale)},
        greatest={"high": "x"},
        least={"low": "x"},
    )


@pytest.mark.parametrize("rows", [2_000_000])
def test_sums_and_means_do_not_depend_on_partitions(spark, rows):
    """Means of short decimals often lie on a tie; bits must not decide them."""
    values = F.round(F.lit(1004.0) + F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 7.0, 4)
    # and some values from 10**9 to 10**300, of both signs
    large = F.when(F.col("id") % 999 == 5, values * F.pow(F.lit(10.0), F.pmod(F.xxhash64("id"), F.lit(300))))
    sign = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    results = {
        repr(
            [
                *summarise(
                    spark.range(0, rows, 1, parts).select(
                        F.lit(1).alias("k"), (F.coalesce(large, values) * sign).alias("x")
                    ),
                    ["k"],
                    both(9),
                ).first(),
                *summarise(spark.range(0, rows, 1, parts).select(F.lit(1).alias("k"), values.alias("x")), ["k"], both(4)).first(),
            ]
        )
        for parts in (1, 8, 13)
    }
    assert len(results) == 1


def test_means_are_rounded_once_and_skip_nulls(spark):
    df = spark.createDataFrame([(0.125,), (0.126,), (None,), (0.0,), (0.003,)], "x double").withColumn("k", F.lit(1))
    got = summarise(df, ["k"], both(4, 2)).first()
    assert (got.mean, got.total, got.high, got.low) == (0.0635, 0.25, 0.126, 0.0)
    got = summarise(df.where("x is null"), ["k"], both(4)).first()
    assert (got.mean, got.total, got.high, got.low) == (None, None, None, None)


NAN, INF = math.nan, math.inf
CASES = {
    "usual": [1.5, 2.25, -7.125],
    "from 10**9": [2.5e9, 21.5, 20.0],
    "large and small": [1e300, 12.5, 3.0],
    "largest": [1.7976931348623157e308, 1.0],
    "beyond": [1.7976931348623157e308] * 3,
    "cancelling": [1e300, 0.1, -1e300, 0.2, 1e15, -1e15],
    "bands": [1e15, 9.999999999999999e14, 1.5e24, -1.5e24, 1e23, 12345678901234567.0],
    "digits": [1.2345678901234567e100, 1.2345678901234567e100, 9.876543210987654e107],
    "small": [5e-324, 1e-12, 4e-12, 4e-12, 4e-12],
    "nan": [NAN, 10.0],
    "nan and infinite": [NAN, INF, 1.0],
    "infinite": [INF, 1.0, None],
    "negative infinite": [-INF, 1e300],
    "both infinite": [INF, -INF, 1.0],
    "none": [None, None],
}


def wanted_sum(values):
    """The exact sum of the values as they are written, to eleven places, as the nearest double."""
    numbers = [v for v in values if v is not None]
    if any(math.isnan(v) for v in numbers) or {INF, -INF} <= set(numbers):
        return NAN
    for end in (INF, -INF):
        if end in numbers:
            return end
    with decimal.localcontext(prec=800):
        places = decimal.Decimal("1e-11")
        written = [decimal.Decimal(repr(v)) for v in numbers]
        return sum(v.quantize(places, decimal.ROUND_HALF_UP) for v in written)


def test_any_double_has_a_defined_sum_and_mean(spark):
    data = [(name, v) for name, values in CASES.items() for v in values]
    got = {r.k: r for r in summarise(spark.createDataFrame(data, "k string, x double").repartition(7), ["k"], both(4)).collect()}
    for name, values in CASES.items():
        numbers, row = [v for v in values if v is not None], got[name]
        if not numbers:
            assert (row.total, row.mean) == (None, None)
            continue
        total = wanted_sum(values)
        if isinstance(total, decimal.Decimal):
            with decimal.localcontext(prec=800):
                mean = total / len(numbers)
                places = decimal.Decimal("1e-4")
                total, mean = (float(v.quantize(places, decimal.ROUND_HALF_UP)) for v in (total, mean))
            # bands are added as doubles, from the highest down
            assert row.total == pytest.approx(total, rel=4e-16), name
            if abs(total) < math.inf:
                assert row.mean == pytest.approx(mean, rel=4e-16), name
        else:
            assert repr(row.total) == repr(total) == repr(row.mean), name


def test_states_of_parts_are_states_of_all(spark):
    data = [(name, i % 3, v) for name, values in CASES.items() for i, v in enumerate(values)]
    frame = spark.createDataFrame(data, "k string, part int, x double")
    whole = summarise(frame, ["k"], both(6)).collect()
    states = summary_states(frame, ["k", "part"], both(6)).drop("part")
    merged = merge_states(states, ["k"], both(6))
    assert sorted(map(repr, finish_states(merged, ["k"], both(6)).collect())) == sorted(map(repr, whole))


def test_the_statement_gives_the_same_means(spark):
    data = [(name, datetime.date(2025, 1, 1), i, False, v) for name, values in CASES.items() for i, v in enumerate(values)]
    keys = "city string, date date, hour long, forecast_data boolean"
    fall = spark.createDataFrame(data, f"{keys}, snowfall double").withColumn("rain", F.col("snowfall") / 3)
    air = spark.createDataFrame(data, f"{keys}, surface_pressure double").withColumn(
        "wind_speed_10m", -F.col("surface_pressure")
    )
    tables = {"hourly_precipitation_evaporation": fall, "hourly_wind_atmospheric_conditions": air}
    register_views(tables)
    by_statement = spark.sql(STATEMENTS["city_averages"])
    by_function = city_averages(tables)
    assert by_statement.columns == by_function.columns
    assert sorted(map(repr, by_statement.collect())) == sorted(map(repr, by_function.collect()))
