"""The load store: versions, snapshots, quarantine, streams, and what a batch reads."""

from __future__ import annotations

import datetime
import json
import math
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hourlake.plans import load
from hourlake.plans.load import load_run, publish_rows, read_audit
from hourlake.plans.quarantine import read_quarantine, replay_quarantine
from hourlake.schema import DAY_KEYS
from hourlake.session import application_folder
from hourlake.sinks.compaction import compact, drop_unused, stored_files
from hourlake.sinks.tables import APPEND, REPLACE
from hourlake.sources.landing import binary_files, documents_in, listed_versions, only_files, parse_documents
from hourlake.sources.store import open_store
from hourlake.sources.tables import read_table, read_tables
from hourlake.streaming import incremental
from hourlake.streaming.incremental import incremental_load
from hourlake.streaming.landing_stream import stream_load
from tests.helpers import hours, put_document, rows

DAY = "2025-01-02"


def frame(spark, documents, modified="2025-01-02 12:00:00"):
    """Documents of texts by city, as a frame that needs no files."""
    data = [
        (city, datetime.date.fromisoformat(DAY), city, city, modified, len(text), text)
        for city, text in documents.items()
    ]
    schema = "city string, run_date date, file string, document string, modified string, size long, text string"
    return parse_documents(spark.createDataFrame(data, schema).withColumn("modified", F.col("modified").cast("timestamp")))


def text(first, count=2):
    return json.dumps(hours(first, count, f"{DAY}T00:00:00.000Z"))


def firsts(spark, base):
    """The first measure's lowest value by city."""
    weather = read_tables(spark, base)["hourly_weather_conditions"]
    return dict(rows(weather.groupBy("city").agg(F.min("relative_humidity_2m").alias("low")), "city", "low"))


def contents(spark, base, **how):
    return {name: rows(table) for name, table in read_tables(spark, base, **how).items()}


def aged(path, seconds):
    at = time.time() - seconds
    os.utime(path, (at, at))


def test_the_newest_version_wins_whoever_commits_last(spark, path):
    publish_rows(frame(spark, {"A": text(30), "B": text(30)}, "2025-01-03"), path, mode=REPLACE, load_id="third")
    publish_rows(frame(spark, {"A": text(20), "B": text(20), "C": text(20)}, "2025-01-02"), path, mode=REPLACE, load_id="second")
    assert firsts(spark, path) == {"A": 30, "B": 30, "C": 20}
    publish_rows(frame(spark, {"A": text(40)}, "2025-01-04"), path, mode=REPLACE, load_id="fourth")
    # the same version again, committed later
    publish_rows(frame(spark, {"B": text(31)}, "2025-01-03"), path, mode=REPLACE, load_id="again")
    assert firsts(spark, path) == {"A": 40, "B": 31, "C": 20}


def test_a_slow_load_does_not_undo_a_newer_one(spark, path, monkeypatch):
    """Two loads overlap: the one that read the older version writes and commits last."""
    write, nested = load._write_by_load, []

    def slow(table, base, name, load_id):
        if name == "load_manifest" and load_id.startswith("old") and not nested:
            nested.append(load_id)
            publish_rows(frame(spark, {"A": text(2)}, "2025-01-03"), base, mode=REPLACE, load_id="new")
        write(table, base, name, load_id)

    monkeypatch.setattr(load, "_write_by_load", slow)
    publish_rows(frame(spark, {"A": text(1), "B": text(1)}, "2025-01-02"), path, mode=REPLACE, load_id="old")
    assert nested and firsts(spark, path) == {"A": 2, "B": 1}


def test_a_file_put_back_in_an_older_version(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    file = put_document(landing, "A", DAY, hours(50, 2)) + "/weather_data.json"
    load_run(spark, landing, base, mode=REPLACE)
    put_document(landing, "A", DAY, hours(10, 2))
    aged(file, 3 * 86_400)
    load_run(spark, landing, base, mode=REPLACE)
    assert firsts(spark, base) == {"A": 50}


def published(spark, base):
    publish_rows(frame(spark, {"A": text(10), "B": text(10)}), base, mode=REPLACE, load_id="one")
    publish_rows(frame(spark, {"B": text(20), "C": text(20)}, "2025-01-03"), base, mode=REPLACE, load_id="two")
    publish_rows(frame(spark, {"C": text(30)}, "2025-01-03"), base, mode=APPEND, load_id="three")
    publish_rows(frame(spark, {"D": "[{"}), base, mode=REPLACE, load_id="four")


def test_a_snapshot_equals_its_loads_in_fewer_files(spark, path):
    published(spark, path)
    before, audit, files = contents(spark, path), rows(read_audit(spark, path)), stored_files(spark, path)
    merged = contents(spark, path, merge_days=True)
    early = read_tables(spark, path)["hourly_soil_conditions"]
    compact(spark, path)
    assert contents(spark, path) == before and rows(read_audit(spark, path)) == audit
    assert contents(spark, path, merge_days=True) == merged
    # a reader that opened the store before still has its files
    assert drop_unused(spark, path, older_than_hours=24) == 0
    assert rows(early) == before["hourly_soil_conditions"]
    assert drop_unused(spark, path, older_than_hours=0) > 0
    assert contents(spark, path) == before and rows(read_audit(spark, path)) == audit
    assert rows(read_quarantine(spark, path), "city", "open") == [("D", True)]
    assert stored_files(spark, path) < files
    # rows that are replaced are gone
    packed = spark.read.parquet(f"{path}/packed/*/hourly_soil_conditions")
    assert packed.count() == len(before["hourly_soil_conditions"])


def test_loads_after_a_snapshot_and_a_second_one(spark, path):
    published(spark, path)
    compact(spark, path)
    publish_rows(frame(spark, {"A": text(40)}, "2025-01-05"), path, mode=REPLACE, load_id="late")
    publish_rows(frame(spark, {"B": text(1)}, "2025-01-01"), path, mode=REPLACE, load_id="older")
    publish_rows(frame(spark, {"C": "[]"}, "2025-01-06"), path, mode=REPLACE, load_id="emptied")
    wanted = contents(spark, path)
    assert firsts(spark, path) == {"A": 40, "B": 20}
    compact(spark, path)
    drop_unused(spark, path, older_than_hours=0)
    assert contents(spark, path) == wanted
    assert len(os.listdir(f"{path}/packed")) == 1
    assert compact(spark, path + "/nothing") is None and drop_unused(spark, path + "/nothing") == 0


def test_loads_during_a_compaction_are_kept_and_a_failed_one_is_not_seen(spark, path, monkeypatch):
    from hourlake.sinks import compaction

    published(spark, path)
    wanted = contents(spark, path)
    monkeypatch.setattr(compaction, "states_schema", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        compact(spark, path)
    monkeypatch.undo()
    assert contents(spark, path) == wanted
    arranged = compaction._arranged

    def slow(packed):
        if not os.path.exists(f"{path}/seen"):
            os.mkdir(f"{path}/seen")
            publish_rows(frame(spark, {"A": text(60), "E": text(60)}, "2025-01-05"), path, mode=REPLACE, load_id="meanwhile")
        return arranged(packed)

    monkeypatch.setattr(compaction, "_arranged", slow)
    compact(spark, path)
    drop_unused(spark, path, older_than_hours=0)
    assert firsts(spark, path) == {"A": 60, "B": 20, "C": 20, "E": 60}


def test_incremental_load_goes_on_after_a_snapshot(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    put_document(landing, "A", DAY, hours(1, 2))
    incremental_load(spark, landing, base, "feed")
    compact(spark, base)
    drop_unused(spark, base, older_than_hours=0)
    incremental_load(spark, landing, base, "feed")
    assert read_audit(spark, base).count() == 1
    put_document(landing, "B", DAY, hours(5, 2))
    incremental_load(spark, landing, base, "feed")
    assert firsts(spark, base) == {"A": 1, "B": 5}
    assert sorted(r[0] for r in open_store(spark, base).manifest.select("batch").collect()) == [0, 1]


def test_daily_rows_of_several_documents_merge(spark, path):
    absurd = hours(0, 4, f"{DAY}T00:00:00.000Z")
    absurd[0]["temperature_2m"] = 1e300
    texts = {"a": text(10, 4), "b": text(100, 6), "c": json.dumps(absurd)}
    data = [("A", datetime.date.fromisoformat(DAY), name, t) for name, t in texts.items()]
    documents = spark.createDataFrame(data, "city string, run_date date, file string, text string")
    publish_rows(parse_documents(documents), path, mode=REPLACE)
    per_document = read_table(spark, path, "daily_weather_summary")
    merged = read_table(spark, path, "daily_weather_summary", merge_days=True)
    assert per_document.count() == 6
    assert merged.groupBy(*DAY_KEYS).count().where("count > 1").count() == 0 and merged.count() == 2
    weather = read_table(spark, path, "hourly_weather_conditions")
    for row in merged.collect():
        half = weather.where(F.col("forecast_data") == row.forecast_data)
        values = [r[0] for r in half.select("relative_humidity_2m").collect()]
        assert row.average_relative_humidity_2m == round(sum(values) / len(values), 4)
        assert (row.max_temperature_2m == 1e300) == row.forecast_data
        assert row.average_temperature_2m == 1e300 / 7 if row.forecast_data else row.average_temperature_2m < 200


@pytest.mark.parametrize("absurd", [2.5e9, 1e300, -1e300, math.nan, math.inf, -math.inf])
def test_one_absurd_value_stops_nothing(spark, tmp_path, absurd):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    odd = hours(0, 4)
    odd[1]["temperature_2m"] = absurd
    put_document(landing, "Odd", DAY, odd)  # json writes NaN and Infinity bare
    put_document(landing, "Usual", DAY, hours(50, 4))
    load_run(spark, landing, base)
    assert rows(read_audit(spark, base), "city", "status", "rows") == [("Odd", "loaded", 4), ("Usual", "loaded", 4)]
    daily = read_table(spark, base, "daily_weather_summary")
    means = {(r.city, r.forecast_data): r.average_temperature_2m for r in daily.collect()}
    usual = odd[0]["temperature_2m"]
    wanted = (usual + absurd) / 2 if math.isfinite(absurd) else absurd
    assert repr(means[("Odd", True)]) == repr(wanted)
    assert means[("Usual", True)] == 50 + 14 / 8 + 0.5


def test_rejected_documents_are_kept_and_replayed(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    cut = text(10, 4)[:-1]
    put_document(landing, "Cut", DAY, cut)
    put_document(landing, "Error", DAY, '{"error": true}')
    put_document(landing, "Good", DAY, hours(1, 2))
    incremental_load(spark, landing, base, "feed")
    kept = read_quarantine(spark, base)
    assert rows(kept, "city", "reason", "text", "open") == [
        ("Cut", "not a JSON document", cut, True),
        ("Error", "not an array of objects", '{"error": true}', True),
    ]

    def close(rejected):
        return rejected.withColumn("text", F.when(F.col("city") == "Cut", F.concat("text", F.lit("]"))).otherwise(F.col("text")))

    for _ in range(2):
        replay_quarantine(spark, base, close)
        assert rows(read_quarantine(spark, base), "city", "open") == [("Cut", False), ("Error", True)]
        assert firsts(spark, base) == {"Cut": 10, "Good": 1}
    audit = rows(read_audit(spark, base).where("city = 'Cut'"), "status", "rows", "message")
    assert audit == [("loaded", 4, None), ("quarantined", 0, "not a JSON document")]
    # a newer version of the file closes the other one, and is not undone by a replay
    put_document(landing, "Error", DAY, hours(70, 2))
    incremental_load(spark, landing, base, "feed")
    replay_quarantine(spark, base, lambda r: r.withColumn("text", F.lit(text(99))))
    assert firsts(spark, base) == {"Cut": 10, "Error": 70, "Good": 1}
    assert not read_quarantine(spark, base).where("open").count()
    assert read_quarantine(spark, base + "/nothing").count() == 0


def files_read(frame_):
    """Landing files that the scans of a frame offered to its tasks."""
    frame_.collect()
    plan = frame_._jdf.queryExecution().executedPlan()
    if "Adaptive" in plan.getClass().getName():
        plan = plan.finalPhysicalPlan()
    leaves = plan.collectLeaves()
    scans = [leaf for leaf in map(leaves.apply, range(leaves.size())) if "binaryFile" in leaf.toString()]
    return sum(scan.metrics().apply("numFiles").value() for scan in scans)


@pytest.mark.parametrize("files_per_batch", [1, 2, 4, None])
def test_a_batch_reads_its_own_files_and_no_others(spark, tmp_path, monkeypatch, files_per_batch):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    for i in range(9):
        put_document(landing, f"O'Ham \\ [{i}] 100%", DAY, hours(i, 2))
    opened = []
    parse = incremental.rows_of_files

    def count(files, root, empty):
        found = parse(files, root, empty)
        opened.append(files_read(found.select("text")))
        return found

    monkeypatch.setattr(incremental, "rows_of_files", count)
    incremental_load(spark, landing, base, "feed", files_per_batch=files_per_batch)
    size = files_per_batch or 9
    assert opened == [min(size, 9 - at) for at in range(0, 9, size)]
    # one old and two new files among those that are known
    opened.clear()
    old = put_document(landing, "Old", "2024-01-02", hours(20, 2)) + "/weather_data.json"
    aged(old, 90 * 86_400)
    for i in (3, 5):
        put_document(landing, f"O'Ham \\ [{i}] 100%", DAY, hours(100 + i, 2))
    incremental_load(spark, landing, base, "feed", files_per_batch=files_per_batch)
    assert sum(opened) == 3
    found = firsts(spark, base)
    assert found["Old"] == 20 and found["O'Ham \\ [3] 100%"] == 103 and len(found) == 10


def test_files_without_bytes_have_their_own_times(spark, tmp_path):
    landing = str(tmp_path / "landing")
    folder = put_document(landing, "New York", DAY, "")
    put_document(landing, "Full", DAY, "[]")
    aged(f"{folder}/weather_data.json", 1_000_000)
    files = binary_files(spark, landing, "*.json")
    found = {r.size: r.modified for r in listed_versions(files).collect()}
    assert set(found) == {0, 2}
    at = os.path.getmtime(f"{folder}/weather_data.json")
    assert abs(found[0].timestamp() - at) < 1
    assert only_files(files, []).count() == 0
    assert documents_in(files).count() == 1


def test_a_stream_equals_a_batch_and_a_batch_run_again_changes_nothing(spark, tmp_path):
    landing, base, checkpoint = (str(tmp_path / n) for n in ("landing", "tables", "checkpoint"))
    for i in range(5):
        put_document(landing, f"City {i}", DAY, hours(10 * i, 4))
    put_document(landing, "Broken", DAY, "[{")
    seen = []

    def lost(batch):
        seen.append(batch)
        if len(seen) == 2:
            raise RuntimeError("lost between the load and its commit")

    with pytest.raises(StreamingQueryException):
        stream_load(spark, landing, base, checkpoint, mode=APPEND, files_per_batch=2, published=lost)
    stream_load(spark, landing, base, checkpoint, mode=APPEND, files_per_batch=2, published=seen.append)
    assert seen == [0, 1, 1, 2]
    batch = str(tmp_path / "batch")
    load_run(spark, landing, batch)
    assert contents(spark, base) == contents(spark, batch)
    assert read_audit(spark, base).count() == 6
    put_document(landing, "Later", DAY, hours(500, 2))
    stream_load(spark, landing, base, checkpoint, mode=APPEND)
    assert read_audit(spark, base).count() == 7 and firsts(spark, base)["Later"] == 500


def test_a_failed_batch_of_a_stream_is_loaded_whole(spark, tmp_path, monkeypatch):
    landing, base, checkpoint = (str(tmp_path / n) for n in ("landing", "tables", "checkpoint"))
    put_document(landing, "A", DAY, hours(1, 4))
    write = load._write_by_load

    def fail(table, base, name, load_id):
        if name == "load_manifest":
            raise RuntimeError("lost")
        write(table, base, name, load_id)

    monkeypatch.setattr(load, "_write_by_load", fail)
    with pytest.raises(StreamingQueryException):
        stream_load(spark, landing, base, checkpoint, mode=APPEND)
    monkeypatch.undo()
    stream_load(spark, landing, base, checkpoint, mode=APPEND)
    assert read_tables(spark, base)["hourly_soil_conditions"].count() == 4


def test_loads_without_hours_write_no_tables(spark, path):
    mine = application_folder(spark)
    before = set(os.listdir(mine)) if os.path.exists(mine) else set()
    publish_rows(frame(spark, {"A": "[]", "B": "{"}), path, mode=REPLACE)
    assert rows(read_audit(spark, path), "city", "status", "message") == [
        ("A", "empty", "no hours"),
        ("B", "quarantined", "not a JSON document"),
    ]
    assert not os.path.exists(f"{path}/loads")
    assert all(t.count() == 0 for t in read_tables(spark, path).values())
    publish_rows(frame(spark, {"A": "[]"}).where("false"), path + "/none", mode=REPLACE)
    assert read_audit(spark, path + "/none").count() == 0
    assert set(os.listdir(mine)) == before


def test_jobs_of_a_load(spark, path):
    """Counts are taken while rows are stored: the audit and the manifest are one small write."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "one load")
    try:
        publish_rows(frame(spark, {c: text(1, 4) for c in "ABCD"}), path, mode=REPLACE)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert read_audit(spark, path).count() == 4
    names = os.listdir(path)
    assert "load_audit" not in names and {"load_manifest", "loads"} <= set(names)
    # besides the tables: two to store the rows with their exchange, three for the aggregate of versions
    assert len(tracker.getJobIdsForGroup("load")) <= 5
