"""Documents to published tables, in batch and incrementally, with their audit."""

from __future__ import annotations

import datetime
import glob
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hourlake.operators.audit import load_audit
from hourlake.plans import load
from hourlake.plans.load import load_run, read_audit
from hourlake.schema import HOUR_KEYS
from hourlake.session import application_folder
from hourlake.sinks.landing import write_landing
from hourlake.sinks.tables import APPEND, REPLACE
from hourlake.sources.cities import expected_documents
from hourlake.sources.payload import explode_payload
from hourlake.sources.tables import read_tables
from hourlake.streaming.incremental import incremental_load
from tests.helpers import hours, put_document, rows

DAY = datetime.date(2025, 1, 2)
CITIES = ["New York", "Dubai", "Cape Town"]


def put_day(base, day, cities=CITIES, count=6, shift=0):
    for i, city in enumerate(cities):
        records = hours(shift + 10 * i, count, f"{day}T00:00:00.000Z")
        put_document(base, city, day, records)


def contents(spark, base):
    return {name: rows(table) for name, table in read_tables(spark, base).items()}


def test_load_publishes_all_tables(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02")
    put_document(landing, "Broken", "2025-01-02", "[{")
    load_run(
        spark,
        landing,
        base,
        run_date="2025-01-02",
        expected=expected_documents(spark, "2025-01-02", [*CITIES, "Broken", "Tokyo"]),
    )
    tables = read_tables(spark, base)
    weather = tables["hourly_weather_conditions"]
    assert rows(weather, *HOUR_KEYS) == sorted(
        (city, DAY, hour, half) for city in CITIES for hour in range(3) for half in (True, False)
    )
    assert tables["daily_weather_summary"].count() == 6
    audit = read_audit(spark, base)
    columns = ["city", "run_date", "status", "rows", "expected", "message"]
    assert rows(audit, *columns) == sorted(
        [(c, DAY, "loaded", 6, True, None) for c in CITIES]
        + [("Broken", DAY, "quarantined", 0, True, "not a JSON document")]
        + [("Tokyo", DAY, "missing", 0, True, "no document")],
        key=repr,
    )


@pytest.mark.parametrize("mode,factor", [(APPEND, 2), (REPLACE, 1)])
def test_second_load(spark, tmp_path, mode, factor):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02")
    for _ in range(2):
        load_run(spark, landing, base, mode=mode)
    for name, table in read_tables(spark, base).items():
        per_table = len(CITIES) * (2 if name == "daily_weather_summary" else 6)
        assert table.count() == factor * per_table, name
    assert read_audit(spark, base).count() == factor * len(CITIES)


def test_loads_of_different_cities_keep_their_audit(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02")
    for city in ("Dubai", "New York", "Dubai"):
        load_run(spark, landing, base, run_date="2025-01-02", cities=[city], mode=REPLACE)
    assert rows(read_audit(spark, base), "city", "rows") == [("Dubai", 6), ("New York", 6)]


def test_load_turned_polarity(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02", ["A"], count=3)
    load_run(spark, landing, base, first_half_flag=False)
    got = read_tables(spark, base)["hourly_soil_conditions"]
    assert rows(got, "hour", "forecast_data") == [(0, False), (0, True), (1, True)]


def test_incremental_equals_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    base, progress = str(tmp_path / "tables"), str(tmp_path / "progress")
    put_day(landing, "2025-01-02")
    incremental_load(spark, landing, base, progress)
    put_day(landing, "2025-01-03", shift=100)
    put_document(landing, "Broken", "2025-01-03", "{")
    incremental_load(spark, landing, base, progress)
    incremental_load(spark, landing, base, progress)  # nothing new
    batch = str(tmp_path / "batch")
    load_run(spark, landing, batch)
    assert contents(spark, base) == contents(spark, batch)
    audit = read_audit(spark, base)
    batch_id = F.regexp_extract("load_id", r"^batch-\w+-(\d+)$", 1).alias("batch_id")
    assert rows(audit.groupBy(batch_id, "status").count(), "batch_id", "status", "count") == [
        ("0", "loaded", 3),
        ("1", "loaded", 3),
        ("1", "quarantined", 1),
    ]


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_documents_of_one_day_and_a_key_sent_again(spark, tmp_path, files_per_batch):
    landing = str(tmp_path / "landing")
    base, progress = str(tmp_path / "tables"), str(tmp_path / "progress")
    day = "2025-01-02"
    put_document(landing, "Dubai", day, hours(0, 6), "a.json")
    put_document(landing, "Dubai", day, hours(100, 4), "b.json")
    put_document(landing, "Tokyo", day, hours(200, 2))

    def load():
        incremental_load(spark, landing, base, progress, files_per_batch=files_per_batch)
        weather = read_tables(spark, base)["hourly_weather_conditions"]
        return [r[0] for r in rows(weather, "relative_humidity_2m")]

    assert load() == sorted([*range(6), *range(100, 104), 200, 201], key=repr)
    # the same key again, shorter: the other document of the day stays
    put_document(landing, "Dubai", day, hours(500, 3), "a.json")
    assert load() == sorted([500, 501, 502, *range(100, 104), 200, 201], key=repr)
    # an emptied document takes its rows along; a broken one does not
    put_document(landing, "Dubai", day, "[]", "b.json")
    put_document(landing, "Tokyo", day, "[{")
    assert load() == sorted([500, 501, 502, 200, 201], key=repr)
    assert load() == sorted([500, 501, 502, 200, 201], key=repr)


def test_an_old_file_that_arrives_late_is_loaded(spark, tmp_path):
    landing = str(tmp_path / "landing")
    base, progress = str(tmp_path / "tables"), str(tmp_path / "progress")
    put_day(landing, "2025-01-02")
    incremental_load(spark, landing, base, progress)
    folder = put_document(landing, "Old", "2024-11-30", hours(0, 5))
    long_ago = time.time() - 30 * 86_400
    os.utime(f"{folder}/weather_data.json", (long_ago, long_ago))
    incremental_load(spark, landing, base, progress)
    weather = read_tables(spark, base)["hourly_weather_conditions"]
    assert weather.where("city = 'Old'").count() == 5
    assert read_audit(spark, base).where("city = 'Old'").count() == 1


def test_missing_documents_are_reported_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    base, progress = str(tmp_path / "tables"), str(tmp_path / "progress")
    put_day(landing, "2025-01-02")
    expected = expected_documents(spark, "2025-01-02", [*CITIES, "Berlin"])
    for _ in range(2):
        incremental_load(spark, landing, base, progress, expected=expected, files_per_batch=1)
        audit = read_audit(spark, base)
        assert rows(audit, "city", "status", "expected") == sorted(
            [(c, "loaded", True) for c in CITIES] + [("Berlin", "missing", True)]
        )
    put_document(landing, "Berlin", "2025-01-02", hours(0, 2))
    incremental_load(spark, landing, base, progress, expected=expected)
    assert read_audit(spark, base).where("status = 'missing'").count() == 0


def test_a_load_without_manifest_is_not_seen(spark, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    base, progress = str(tmp_path / "tables"), str(tmp_path / "progress")
    put_day(landing, "2025-01-02")
    write = load._write_by_load

    def fail(table, base, name, load_id):
        if name == "load_manifest":
            raise RuntimeError("lost")
        write(table, base, name, load_id)

    monkeypatch.setattr(load, "_write_by_load", fail)
    with pytest.raises(RuntimeError):
        incremental_load(spark, landing, base, progress, mode=APPEND)
    monkeypatch.undo()
    incremental_load(spark, landing, base, progress, mode=APPEND)
    incremental_load(spark, landing, base, progress, mode=APPEND)
    weather = read_tables(spark, base)["hourly_weather_conditions"]
    assert weather.count() == 6 * len(CITIES)


def test_loads_of_two_cities_at_one_time(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02")
    load_run(spark, landing, base, mode=REPLACE)
    put_day(landing, "2025-01-02", ["Dubai", "New York"], count=4, shift=700)
    files = set(glob.glob(f"{base}/loads/*/load_id=*/date=*/*.parquet"))
    with ThreadPoolExecutor(2) as pool:
        for done in [
            pool.submit(load_run, spark, landing, base, cities=[c], mode=REPLACE)
            for c in ("Dubai", "New York")
        ]:
            done.result()
    weather = read_tables(spark, base)["hourly_weather_conditions"]
    got = rows(weather.groupBy("city").count(), "city", "count")
    assert got == [("Cape Town", 6), ("Dubai", 4), ("New York", 4)]
    # nothing that was published is rewritten
    assert files <= set(glob.glob(f"{base}/loads/*/load_id=*/date=*/*.parquet"))


def test_one_exchange_for_the_hourly_tables(spark, tmp_path, monkeypatch):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02")
    plans = {}
    write = load.write_load

    def keep(table, base, name, load_id):
        plans[name] = table._jdf.queryExecution().executedPlan().toString()
        write(table, base, name, load_id)

    monkeypatch.setattr(load, "write_load", keep)
    load_run(spark, landing, base)
    # the daily table is stored as states by document
    assert {n for n, plan in plans.items() if "Exchange" in plan} == {"daily_states"}


def test_what_is_no_document_is_set_aside_whole(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    good = json.dumps(hours(0, 2))
    cases = {
        "object": ('{"error": true, "reason": "limit"}', "quarantined", "not an array of objects"),
        "null": ("[null]", "quarantined", "not an array of objects"),
        "number": ("[1]", "quarantined", "not a JSON document"),
        "nulls": (good[:-1] + ", null]", "quarantined", "not an array of objects"),
        "two": (good + good, "quarantined", "not a JSON document"),
        "lines": (good + "\n" + good, "quarantined", "not a JSON document"),
        "listed": (good + "," + good, "quarantined", "not a JSON document"),
        "garbage": (good + " garbage", "quarantined", "not a JSON document"),
        "cut": (good[:-2], "quarantined", "not a JSON document"),
        "undated": ('[{"rain": 1.0}]', "quarantined", "hour without a date"),
        "misdated": ('[{"date": "soon", "rain": 1.0}]', "quarantined", "hour without a date"),
        "none": ("[]", "empty", "no hours"),
        "blank": (" \n", "empty", "no hours"),
        "zero": ("", "empty", "no hours"),
        "good": (" " + good + "\n", "loaded", None),
    }
    for city, (text, _, _) in cases.items():
        put_document(landing, city, "2025-01-02", text)
    put_document(landing, "Thirteen", "2025-13-02", good)
    with open(f"{landing}/stray.json", "w", encoding="utf-8") as out:
        out.write(good)
    with open(f"{put_document(landing, 'bytes', '2025-01-02', good)}/weather_data.json", "wb") as out:
        out.write(b'[{"date": "2025-01-02", "x": "\xff"}]')
    load_run(spark, landing, base)
    wanted = [(c, status, message) for c, (_, status, message) in cases.items()]
    wanted += [("Thirteen", "quarantined", "no city or run date in the path")]
    wanted += [(None, "quarantined", "no city or run date in the path")]
    wanted += [("bytes", "quarantined", "not UTF-8 text")]
    got = rows(read_audit(spark, base), "city", "status", "message")
    assert got == sorted(wanted, key=repr)
    for table in read_tables(spark, base).values():
        assert {r.city for r in table.select("city").collect()} == {"good"}


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_day(landing, "2025-01-02")
    mine = application_folder(spark)
    os.makedirs(mine, exist_ok=True)
    before = set(os.listdir(mine))
    load_run(spark, landing, base, expected=expected_documents(spark, "2025-01-02", CITIES))
    incremental_load(spark, landing, base, "feed")
    assert set(os.listdir(mine)) == before


def test_a_document_over_two_dates_is_replaced_whole(spark, tmp_path):
    """One document covers two dates; the next run adds the other half of the second."""
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    first = hours(0, 2, "2025-01-01T00:00:00.000Z") + hours(2, 2, "2025-01-02T00:00:00.000Z")
    second = hours(10, 2, "2025-01-02T00:00:00.000Z") + hours(12, 2, "2025-01-03T00:00:00.000Z")
    put_document(landing, "A", "2025-01-02", first)
    put_document(landing, "A", "2025-01-03", second)
    for day in ("2025-01-02", "2025-01-03", "2025-01-03"):
        load_run(spark, landing, base, run_date=day, mode=REPLACE)
    got = read_tables(spark, base)["hourly_soil_conditions"]
    assert rows(got.groupBy("date", "forecast_data").count(), "date", "forecast_data", "count") == [
        (datetime.date(2025, 1, 1), True, 2),
        (datetime.date(2025, 1, 2), False, 2),
        (datetime.date(2025, 1, 2), True, 2),
        (datetime.date(2025, 1, 3), False, 2),
    ]


def test_payload_to_tables(spark, tmp_path):
    """Payload, landing lines, tables: with a time per hour, the halves are two dates."""
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    start = 1735689600  # 2025-01-01
    temperatures = [float(i) for i in range(48)]
    payloads = spark.createDataFrame(
        [("San Francisco", start, temperatures), ("Dubai", start, temperatures[::-1])],
        "city string, start_epoch long, temperature_2m array<double>",
    ).withColumn("run_date", F.lit(DAY))
    write_landing(explode_payload(payloads, time_axis="hourly"), landing)
    load_run(spark, landing, base, layout="hive", run_date="2025-01-02")
    got = read_tables(spark, base)["hourly_weather_conditions"].where("city = 'San Francisco'")
    wanted = {
        (float(i), DAY - datetime.timedelta(days=1 - i // 24), i % 24, i < 24) for i in range(48)
    }
    assert set(rows(got, "temperature_2m", "date", "hour", "forecast_data")) == wanted
    daily = read_tables(spark, base)["daily_weather_summary"]
    assert rows(daily, "city", "forecast_data", "max_temperature_2m", "min_temperature_2m") == [
        ("Dubai", False, 23.0, 0.0),
        ("Dubai", True, 47.0, 24.0),
        ("San Francisco", False, 47.0, 24.0),
        ("San Francisco", True, 23.0, 0.0),
    ]


def test_audit_without_a_list_of_expected_documents(spark):
    good = spark.createDataFrame([("A", DAY, "f1")], "city string, run_date date, file string")
    bad = spark.createDataFrame([], "city string, run_date date, file string, reason string")
    got = rows(load_audit(good, bad), "city", "status", "rows", "expected")
    assert got == [("A", "loaded", 1, None)]


def test_audit_of_unexpected_and_unnamed_documents(spark):
    good = spark.createDataFrame(
        [("A", DAY, "f1")] * 3 + [("A", DAY, "f2"), (None, None, "f3")],
        "city string, run_date date, file string",
    )
    bad = spark.createDataFrame(
        [("B", DAY, "f4", "cut")], "city string, run_date date, file string, reason string"
    )
    expected = spark.createDataFrame([("A", DAY), ("C", DAY)], "city string, run_date date")
    got = rows(
        load_audit(good, bad, expected), "city", "file", "status", "rows", "expected", "message"
    )
    assert got == sorted(
        [
            ("A", "f1", "loaded", 3, True, None),
            ("A", "f2", "loaded", 1, True, None),
            (None, "f3", "loaded", 1, False, None),
            ("B", "f4", "quarantined", 0, False, "cut"),
            ("C", None, "missing", 0, True, "no document"),
        ],
        key=repr,
    )


def test_a_document_emptied_twice_loses_its_rows_twice(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    for count in (0, 3, 0, 0, 4, 0):
        put_document(landing, "Dubai", str(DAY), hours(0, count, f"{DAY}T00:00:00.000Z") if count else "")
        incremental_load(spark, landing, base, "feed")
        assert read_tables(spark, base)["hourly_weather_conditions"].count() == count
    # each time it was put is a version of its own, also without bytes
    assert rows(read_audit(spark, base), "status") == [("empty",)] * 4 + [("loaded",)] * 2
