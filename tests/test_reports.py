"""SQL on views and DataFrame functions agree on published tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourlake.operators.tables import all_tables
from hourlake.plans import event_observations as source
from hourlake.plans import reports
from hourlake.plans.statements import STATEMENTS
from hourlake.schema import DAILY_TABLE, HOUR_KEYS
from hourlake.sinks.tables import write_tables
from hourlake.sources.tables import read_tables, register_views
from tests.helpers import SF_SMALL, rows

DATE, NEXT, LAST = "2024-01-08", "2024-01-15", "2024-01-22"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    write_tables(all_tables(source.derived(spark, SF_SMALL)), base)
    published = read_tables(spark, base)
    register_views(published)
    return published


@pytest.mark.parametrize(
    "name,args,function",
    [
        ("daily_extremes", {"date": DATE}, lambda t: reports.daily_extremes(t, DATE)),
        ("city_averages", {}, reports.city_averages),
        (
            "temperatures",
            {"city": "3", "date": DATE, "forecast": True},
            lambda t: reports.temperatures(t, "3", DATE, True),
        ),
        (
            "day_over_day_city",
            {"city": "3", "first_date": DATE, "second_date": NEXT},
            lambda t: reports.day_over_day_city(t, "3", DATE, NEXT),
        ),
        (
            "wide_report",
            {"city": "3", "first_date": DATE, "last_date": LAST},
            lambda t: reports.wide_report(t, "3", DATE, LAST),
        ),
    ],
)
def test_sql_equals_function(spark, tables, name, args, function):
    from_sql = spark.sql(STATEMENTS[name], args)
    from_function = function(tables)
    assert sorted(from_sql.columns) == sorted(from_function.columns)
    got = rows(from_function)
    assert got and got == rows(from_sql)


def test_preview_statement(spark, tables):
    got = spark.sql(STATEMENTS["preview_daily"]).collect()
    assert len(got) == 30
    keys = [(r.city, r.date, r.forecast_data) for r in got]
    assert keys == sorted(keys)


def test_all_tables_statement(spark, tables):
    df = spark.sql(STATEMENTS["all_tables"])
    assert rows(df, *HOUR_KEYS) == rows(tables["meteorological_calculations"], *HOUR_KEYS)


def test_wide_report_is_ordered(tables):
    got = [(r.date, r.hour) for r in reports.wide_report(tables, "3", DATE, LAST).collect()]
    assert got == sorted(got) and len({d for d, _ in got}) > 1


def test_day_over_day_covers_each_pair(tables):
    all_pairs = reports.day_over_day(tables, lag_days=7)
    one = all_pairs.where((F.col("city") == "3") & (F.col("date") == reports.day(DATE)))
    wanted = reports.day_over_day_city(tables, "3", DATE, NEXT)
    assert rows(one, *wanted.columns) == rows(wanted, *wanted.columns)
    assert reports.day_over_day(tables, lag_days=1).isEmpty()


def test_filters_reach_the_scans(tables):
    report = reports.wide_report(tables, "3", DATE, LAST, ordered=False)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(city,3)") >= 4
    assert plan.count("PartitionFilters: [isnotnull(date") >= 4
    extremes = reports.daily_extremes(tables, DATE)._jdf.queryExecution().executedPlan().toString()
    assert "average_temperature_2m" not in extremes


def test_reports_use_the_daily_table(tables):
    assert DAILY_TABLE in tables
