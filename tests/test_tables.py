from __future__ import annotations

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from hourlake.operators import presentation
from hourlake.operators.tables import (
    all_tables,
    daily_summary,
    duplicate_keys,
    split_tables,
    union_batches,
)
from hourlake.plans import event_observations as source
from hourlake.plans import reports
from hourlake.schema import (
    DAILY_TABLE,
    DAY_KEYS,
    HOUR_KEYS,
    HOURLY_TABLES,
    TABLE_NAMES,
    table_columns,
    table_schema,
)
from hourlake.sinks.tables import (
    APPEND,
    REPLACE,
    jdbc_options,
    jdbc_rows,
    write_bucketed,
    write_tables,
)
from hourlake.sources.tables import jdbc_predicates, read_table, read_tables
from tests.helpers import SF_SMALL, rows

SOIL = "hourly_soil_conditions"


@pytest.fixture(scope="module")
def frame(spark):
    return source.derived(spark, SF_SMALL).cache()


def test_tables_have_their_columns_and_rows(frame):
    tables = all_tables(frame)
    assert sorted(tables) == sorted(TABLE_NAMES)
    count = frame.count()
    for name, table in tables.items():
        assert table.columns == table_columns(name)
        types = [(f.name, f.dataType) for f in table.schema]
        assert types == [(f.name, f.dataType) for f in table_schema(name)], name
        if name != DAILY_TABLE:
            assert table.count() == count
    assert "precipitation_probability" not in {c for t in TABLE_NAMES for c in table_columns(t)}


def test_daily_totals_add_up(frame):
    daily = daily_summary(frame)
    total = daily.agg(F.sum("total_precipitation")).first()[0]
    assert total == pytest.approx(frame.agg(F.sum("precipitation")).first()[0])
    assert daily.count() == frame.select(*DAY_KEYS).distinct().count()


def test_daily_summary_skips_nulls(spark):
    schema = (
        "city string, date date, forecast_data boolean, precipitation double, "
        "temperature_2m double, relative_humidity_2m double"
    )
    day = datetime.date(2025, 1, 2)
    df = spark.createDataFrame(
        [
            ("A", day, True, 0.1, 1.00005, 10.0),
            ("A", day, True, None, 2.0, None),
            ("B", day, True, None, None, None),
        ],
        schema,
    )
    got = {r.city: tuple(r)[3:] for r in daily_summary(df).collect()}
    assert got["A"] == (0.1, 1.5, 2.0, 1.00005, 10.0)
    assert got["B"] == (None,) * 5


def test_union_and_duplicates(frame):
    keys = frame.select(*HOUR_KEYS)
    assert duplicate_keys(keys, HOUR_KEYS).isEmpty()
    one_city = keys.where("city = '3'")
    again = duplicate_keys(union_batches(keys, one_city), HOUR_KEYS)
    assert rows(again, *HOUR_KEYS) == rows(one_city, *HOUR_KEYS)
    assert {r.row_count for r in again.collect()} == {2}


def test_append_adds_and_replace_does_not(spark, frame, path):
    tables = all_tables(frame)
    write_tables(tables, path, APPEND)
    assert rows(read_table(spark, path, SOIL)) == rows(tables[SOIL])
    write_tables(tables, path, REPLACE)
    write_tables(tables, path, REPLACE)
    for name, table in read_tables(spark, path).items():
        assert rows(table) == rows(tables[name]), name
    write_tables({SOIL: tables[SOIL]}, path, APPEND)
    assert read_table(spark, path, SOIL).count() == 2 * tables[SOIL].count()


def test_replace_changes_only_the_batches_given(spark, frame, path):
    table = split_tables(frame)[SOIL].withColumn(
        # a batch without a date is a batch, too
        "date", F.when(F.col("city") != "5", F.col("date"))
    )
    write_tables({SOIL: table}, path, REPLACE)
    chosen = "(city = '3' and date = date'2024-01-08') or city = '5'"
    fewer = table.where(chosen).where("hour < 2").withColumn("soil_temperature_0cm", F.lit(-1.0))
    write_tables({SOIL: fewer}, path, REPLACE)
    kept = table.where(f"not coalesce({chosen}, false)")
    assert rows(read_table(spark, path, SOIL)) == rows(kept.unionByName(fewer))


def test_replace_by_half(spark, frame, path):
    table = split_tables(frame)[SOIL]
    write_tables({SOIL: table}, path, REPLACE)
    first = table.where("forecast_data").withColumn("soil_temperature_0cm", F.lit(-1.0))
    write_tables({SOIL: first}, path, REPLACE, batch_keys=DAY_KEYS)
    expected = table.where("not forecast_data").unionByName(first)
    assert rows(read_table(spark, path, SOIL)) == rows(expected)


def test_unknown_mode(frame, path):
    with pytest.raises(ValueError):
        write_tables(split_tables(frame), path, "merge")


def test_date_filter_reads_one_folder(spark, frame, path):
    write_tables({SOIL: split_tables(frame)[SOIL]}, path, APPEND)
    assert len(glob.glob(f"{path}/{SOIL}/date=*")) == 5
    one = read_table(spark, path, SOIL).where("date = date'2024-01-08'").select("city")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<city:string" in plan


def test_bucketed_tables_join_without_exchange(spark, frame):
    spark.sql("create database if not exists weather")
    write_bucketed(all_tables(frame), "weather", buckets=4)
    tables = {name: spark.table(f"weather.{name}") for name in TABLE_NAMES}
    report = reports.wide_report(tables, ordered=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        wanted = reports.wide_report(all_tables(frame), ordered=False)
        assert rows(report) == rows(wanted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop database weather cascade")


def test_jdbc_options():
    assert jdbc_options("jdbc:postgresql://h/d", SOIL, "u", "p", "org.postgresql.Driver") == {
        "url": "jdbc:postgresql://h/d",
        "dbtable": SOIL,
        "user": "u",
        "password": "p",
        "driver": "org.postgresql.Driver",
        "batchsize": "10000",
    }


def test_previews(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "k int")
    assert [r.k for r in presentation.preview(df, 2, ["k"]).collect()] == [1, 2]
    assert [r.k for r in presentation.preview(df, 9, ["k"]).collect()] == [1, 2, 3, None]
    assert [r.k for r in presentation.preview(df, 2, ["k"], tail=True).collect()] == [3, None]


def test_chart_series(spark):
    df = spark.createDataFrame([("A", 5.0, 1.0, 9)], "city string, hi double, lo double, n int")
    got = rows(presentation.chart_series(df, ["city"], ["hi", "lo"]), "city", "series", "value")
    assert got == [("A", "hi", 5.0), ("A", "lo", 1.0)]


def test_display_names(frame):
    shown = presentation.with_display_names(
        reports.daily_extremes(all_tables(frame), "2024-01-08"), "daily_extremes"
    )
    assert shown.columns == ["City", "Max Temperature (F)", "Min Temperature (F)"]
    wide = presentation.with_display_names(reports.wide_report(all_tables(frame)), "wide_report")
    assert "Wind Speed at 10m (mph" in wide.columns and len(wide.columns) == 17


def test_labels_of_another_report_are_refused(frame):
    report = reports.daily_extremes(all_tables(frame), "2024-01-08")
    with pytest.raises(ValueError, match="lacks"):
        presentation.with_display_names(report, "city_averages")
    with pytest.raises(ValueError, match="no label"):
        presentation.with_display_names(report.withColumn("more", F.lit(1)), "daily_extremes")


def test_jdbc_reads_whole_tables_and_parts():
    assert jdbc_predicates(None, 1) == ["1 = 1"]
    assert jdbc_predicates(None, 2) == ["mod(hour, 2) = 0", "mod(hour, 2) = 1"]
    assert jdbc_predicates(["2025-01-02"], 1) == ["date = DATE '2025-01-02'"]
    assert jdbc_predicates(["2025-01-02", "2025-01-03"], 2) == [
        "date = DATE '2025-01-02' AND mod(hour, 2) = 0",
        "date = DATE '2025-01-02' AND mod(hour, 2) = 1",
        "date = DATE '2025-01-03' AND mod(hour, 2) = 0",
        "date = DATE '2025-01-03' AND mod(hour, 2) = 1",
    ]


def test_jdbc_writes_from_its_own_tasks(frame):
    """The work before the write keeps its tasks: an exchange, not a coalesce."""
    table = jdbc_rows(split_tables(frame)[SOIL], 3)
    assert table.rdd.getNumPartitions() == 3
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Coalesce" not in plan


def test_every_table_of_the_report_is_covered(frame):
    assert set(reports.WIDE_REPORT) < set(HOURLY_TABLES)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_one_date_with_very_many_rows_is_split(spark, path, adaptive):
    name = SOIL
    schema = table_schema(name)
    values = [F.rand(i).alias(f.name) for i, f in enumerate(schema) if f.name not in HOUR_KEYS]
    df = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("city "), F.col("id") % 1000).alias("city"),
        F.when(F.col("id") >= 0, F.lit("2025-01-02")).cast("date").alias("date"),
        F.floor(F.col("id") / 1000).alias("hour"),
        (F.col("id") % 2 == 0).alias("forecast_data"),
        *[v.cast("double") for v in values],
    )
    df = df.select([F.col(f.name).cast(f.dataType) for f in schema])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        write_tables({name: df}, path, APPEND)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(glob.glob(f"{path}/{name}/date=2025-01-02/*.parquet")) >= 4
    assert read_table(spark, path, name).count() == 60_000
