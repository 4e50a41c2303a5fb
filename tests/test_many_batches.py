"""Many small batches share their jobs, and each is a load of its own all the same."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hourlake.plans import load
from hourlake.plans.load import load_run, read_audit
from hourlake.plans.quarantine import read_quarantine
from hourlake.sinks.tables import APPEND
from hourlake.sources.store import MANIFEST, open_store
from hourlake.sources.tables import read_tables
from hourlake.streaming import incremental
from hourlake.streaming.landing_stream import stream_load
from tests.helpers import hours, put_document, rows

DAY = "2025-01-02"


@pytest.fixture
def landing(tmp_path):
    folder = str(tmp_path / "landing")
    for i in range(8):
        put_document(folder, f"O'Ham [{i}] 100%", f"2025-01-0{1 + i % 3}", hours(10 * i, 4))
    put_document(folder, "Broken", DAY, "[{")
    return folder


@pytest.fixture
def staged(monkeypatch):
    """How often rows were parsed and stored."""
    found, store = [], load.write_aside

    def counted(frame, purpose):
        found.append(purpose)
        return store(frame, purpose)

    monkeypatch.setattr(load, "write_aside", counted)
    return found


def assert_same(spark, base, other):
    for name, table in read_tables(spark, other).items():
        assert rows(read_tables(spark, base)[name]) == rows(table), name
    columns = ["city", "run_date", "file", "status", "rows", "message"]
    assert rows(read_audit(spark, base), *columns) == rows(read_audit(spark, other), *columns)
    assert rows(read_quarantine(spark, base), "city", "text") == rows(read_quarantine(spark, other), "city", "text")


def loads(spark, base):
    """Number, name and documents of each load, and that its folders are its own."""
    manifest = open_store(spark, base).manifest.groupBy("batch", "load", "load_id").agg(F.count("*").alias("documents"))
    found = manifest.orderBy("batch").collect()
    assert sorted(f"load_id={r.load_id}" for r in found) == sorted(
        n for n in os.listdir(f"{base}/{MANIFEST}") if n.startswith("load_id=")
    )
    assert all(r.load_id.startswith(f"{r.load}-") and r.load.endswith(f"-{r.batch}") for r in found)
    return [(r.batch, r.documents) for r in found]


def test_batches_of_an_incremental_load_share_jobs(spark, tmp_path, landing, staged, monkeypatch):
    put_document(landing, "Empty", DAY, "")
    monkeypatch.setattr(incremental, "GROUPS", 1, raising=False)
    base, other = str(tmp_path / "tables"), str(tmp_path / "other")
    incremental.incremental_load(spark, landing, base, "feed", files_per_batch=3)
    assert staged == ["staged"]
    assert loads(spark, base) == [(0, 3), (1, 3), (2, 3), (3, 1)]
    load_run(spark, landing, other)
    assert_same(spark, base, other)
    # a version more of some, and none of the others
    for i in (2, 5, 7):
        put_document(landing, f"O'Ham [{i}] 100%", f"2025-01-0{1 + i % 3}", hours(500 + i, 2))
    incremental.incremental_load(spark, landing, base, "feed", files_per_batch=1)
    assert loads(spark, base)[4:] == [(4, 1), (5, 1), (6, 1)]
    soil = read_tables(spark, base)["hourly_soil_conditions"]
    assert rows(soil.groupBy("city").count(), "count") == [(2,)] * 3 + [(4,)] * 5


def test_batches_of_a_stream_share_jobs(spark, tmp_path, landing, staged):
    base, other, checkpoint = (str(tmp_path / n) for n in ("tables", "other", "checkpoint"))
    seen = []
    stream_load(spark, landing, base, checkpoint, mode=APPEND, files_per_batch=2, published=seen.append)
    # the first alone
    assert staged == ["staged"] * 2
    assert seen == [0, 1, 2, 3, 4]
    assert loads(spark, base) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 1)]
    load_run(spark, landing, other)
    assert_same(spark, base, other)
    put_document(landing, "Later", DAY, hours(900, 2))
    stream_load(spark, landing, base, checkpoint, mode=APPEND, files_per_batch=2, published=seen.append)
    assert seen == [0, 1, 2, 3, 4, 5] and loads(spark, base)[5:] == [(5, 1)]


def test_of_a_group_that_fails_the_batches_without_a_manifest_are_loaded_again(spark, tmp_path, landing, monkeypatch):
    base, other, checkpoint = (str(tmp_path / n) for n in ("tables", "other", "checkpoint"))
    write, seen = load._write_by_loads, []

    def fail(table, base, name):
        if name == MANIFEST:
            write(table.where("batch = 3"), base, name)
            raise RuntimeError("lost among the manifests")
        write(table, base, name)

    monkeypatch.setattr(load, "_write_by_loads", fail)
    with pytest.raises(StreamingQueryException):
        stream_load(spark, landing, base, checkpoint, mode=APPEND, files_per_batch=2, published=seen.append)
    assert seen == [0] and loads(spark, base) == [(0, 2), (3, 2)]
    monkeypatch.undo()
    stream_load(spark, landing, base, checkpoint, mode=APPEND, files_per_batch=2, published=seen.append)
    assert seen == [0, 3, 4, 5, 6] and loads(spark, base) == [(0, 2), (3, 2), (4, 2), (5, 2), (6, 1)]
    load_run(spark, landing, other)
    assert_same(spark, base, other)
