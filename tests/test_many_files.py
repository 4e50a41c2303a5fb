"""What loads of very many small documents do once a file, once a batch, or not at all."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from hourlake.plans import load
from hourlake.plans.load import load_run, read_audit
from hourlake.plans.quarantine import read_quarantine
from hourlake.session import OPEN_COST, many_files_a_task
from hourlake.sinks.compaction import compact, drop_unused
from hourlake.sinks.landing import write_files
from hourlake.sources.landing import binary_files, file_paths, named_files, rows_of_files
from hourlake.sources.store import load_committed
from hourlake.streaming import incremental
from hourlake.streaming.landing_stream import short_name, stream_load
from tests.helpers import hours, put_document, rows

DAY = "2025-01-02"


def test_large_documents_are_chosen_without_their_names(spark, path):
    for i in range(12):
        put_document(path, f"City {i}", DAY, hours(i, 3))
    put_document(path, "Other", DAY, hours(0, 3), "notes.txt")
    found = rows_of_files(binary_files(spark, path, "*.json"), path, large_bytes=0)
    assert "City%20" not in found._jdf.queryExecution().toString()
    assert sorted(r[0] for r in rows(found, "city")) == sorted(f"City {i}" for i in range(12) for _ in range(3))


@pytest.mark.parametrize("partitions", [["city", "year"], []])
def test_files_are_those_that_spark_writes(spark, tmp_path, partitions):
    cases = [("New York", 2024, "a"), ("a/b:c=%d[é]", 2024, ""), (None, None, "two\nlines"), ("New York", 2024, "é")]
    frame = spark.createDataFrame(cases, "city string, year int, text string")
    named = frame.withColumn("name", F.concat_ws("-", F.lit("file"), F.xxhash64("text"))).repartition(3)
    mine, theirs = str(tmp_path / "mine"), str(tmp_path / "theirs")
    for _ in range(2):  # a second time, as a task that is run again does
        write_files(named, mine, partitions)
    spread = frame.select(*partitions, "text").repartition(3, "text")
    spread.write.option("maxRecordsPerFile", 1).partitionBy(*partitions).text(theirs)

    def written(folder):
        return sorted(
            (os.path.relpath(top, folder), open(f"{top}/{n}", "rb").read())
            for top, _, names in os.walk(folder)
            for n in names
            if not n.startswith((".", "_")) and os.path.getsize(f"{top}/{n}")
        )

    assert written(mine) == written(theirs) and len(written(mine)) == 4
    # no checksums beside them, nothing begun
    assert not [n for _, _, names in os.walk(mine) for n in names if n.startswith(".")]


def test_named_files_are_listed_alone(spark, path):
    for i in range(5):
        put_document(path, f"O'Ham \\ [{i}] 100%", DAY, hours(i, 2))
    documents = [r[0] for r in binary_files(spark, path, "*.json").select("_metadata.file_path").collect()]
    chosen = sorted(documents)[1:3]
    files = named_files(spark, file_paths(chosen), "*.json")
    assert len(files.inputFiles()) == 2
    assert sorted(r[0] for r in files.select("_metadata.file_path").collect()) == chosen


def test_batches_are_published_at_one_time(spark, tmp_path, monkeypatch):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    for i in range(4):
        put_document(landing, f"City {i}", DAY, hours(i, 2))
    put_document(landing, "Empty", DAY, "")
    put_document(landing, "Broken", DAY, "[{")
    publish, together = incremental.publish_rows, threading.Barrier(2)

    def meet(*arguments, **named):
        together.wait(60)
        publish(*arguments, **named)

    monkeypatch.setattr(incremental, "publish_rows", meet)
    incremental.incremental_load(spark, landing, base, "feed", files_per_batch=1)
    audit = read_audit(spark, base)
    assert rows(audit.groupBy("status").count(), "status", "count") == [("empty", 1), ("loaded", 4), ("quarantined", 1)]
    assert read_quarantine(spark, base).count() == 1


def test_a_batch_of_a_stream_is_found_by_its_own_manifest(spark, tmp_path):
    landing, base, checkpoint = (str(tmp_path / n) for n in ("landing", "tables", "checkpoint"))
    put_document(landing, "A", DAY, hours(1, 4))
    stream_load(spark, landing, base, checkpoint)
    feed = short_name("stream", checkpoint)
    for _ in range(2):
        known = [load_committed(spark, base, f"stream-{feed}-{batch}", feed, batch) for batch in (0, 1)]
        assert known == [True, False]
        # also where a snapshot has taken it in
        compact(spark, base)
        drop_unused(spark, base, older_than_hours=0)


@pytest.mark.parametrize("module", [load, incremental])
def test_a_task_reads_many_small_documents(spark, tmp_path, monkeypatch, module):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "tables")
    for i in range(200):
        put_document(landing, f"City {i}", DAY, hours(i, 1))
    publish, tasks = module.publish_rows, []

    def counted(read, *arguments, **named):
        tasks.append(read.rdd.getNumPartitions())
        publish(read, *arguments, **named)

    monkeypatch.setattr(module, "publish_rows", counted)
    if module is load:
        load_run(spark, landing, base)
    else:
        incremental.incremental_load(spark, landing, base, "feed")
    # a task a core of the four, and one for files without bytes; with 32 files a task there were seven
    assert len(tasks) == 1 and tasks[0] <= 5
    audit = read_audit(spark, base)
    assert sorted(r[0] for r in rows(audit, "city")) == sorted(f"City {i}" for i in range(200))
    assert rows(audit.select("status").distinct()) == [("loaded",)]


def test_a_chosen_cost_of_files_stays(spark):
    name = "spark.sql.files.openCostInBytes"
    with many_files_a_task(spark):
        assert spark.conf.get(name) == str(OPEN_COST)
    assert spark.conf.get(name, None) is None
    spark.conf.set(name, "1MB")
    try:
        with many_files_a_task(spark):
            assert spark.conf.get(name) == "1MB"
        assert spark.conf.get(name) == "1MB"
    finally:
        spark.conf.unset(name)
