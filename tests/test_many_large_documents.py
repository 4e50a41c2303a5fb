"""Of many documents that are read in pieces, a plan holds no file, and there is one listing."""

from __future__ import annotations

import os

import pytest

from hourlake.plans.load import load_run, read_audit
from hourlake.session import application_folder
from hourlake.sources import landing
from hourlake.sources.landing import binary_files, rows_of_files
from hourlake.streaming import incremental
from tests.helpers import hours, put_document, rows

DAY = "2025-01-02"


@pytest.fixture
def path(tmp_path):
    folder = str(tmp_path / "landing")
    for i in range(6):
        put_document(folder, f"City {i}", DAY, hours(i, 3, f"{DAY}T00:00:00.000Z"))
    put_document(folder, "Broken", DAY, "[{]")
    put_document(folder, "Zero", DAY, "")
    put_document(folder, "Other", DAY, hours(0, 3), "notes.txt")
    return folder


def test_documents_in_pieces_are_scanned_once(spark, path, monkeypatch):
    from hourlake.sources import large_documents as large

    monkeypatch.setattr(large, "_pieces", None)  # what lists the files again
    found = rows_of_files(binary_files(spark, path, "*.json"), path, large_bytes=0, pattern="*.json")
    scans = [line for line in found._jdf.queryExecution().analyzed().toString().split("\n") if "text" in line.split("Relation")[-1] and "Relation" in line]
    assert not [line for line in scans if line.rstrip().endswith("text")]
    whole = rows_of_files(binary_files(spark, path, "*.json"), path)
    assert rows(found.drop("text")) == rows(whole.drop("text")) and found.count() == 19


@pytest.mark.parametrize("many", [False, True])
def test_loads_drop_the_pieces(spark, path, tmp_path, monkeypatch, many):
    monkeypatch.setattr(landing, "LARGE_BYTES", 0)
    mine = application_folder(spark)
    before = set(os.listdir(mine)) if os.path.exists(mine) else set()
    base = str(tmp_path / "tables")
    if many:
        monkeypatch.setattr(incremental, "GROUPS", 1)
        incremental.incremental_load(spark, path, base, "feed", files_per_batch=2)
    else:
        load_run(spark, path, base)
    counts = rows(read_audit(spark, base).groupBy("status", "rows").count(), "status", "rows", "count")
    assert counts == [("empty", 0, 1), ("loaded", 3, 6), ("quarantined", 0, 1)]
    assert set(os.listdir(mine)) == before
