"""Large documents are cut into records, and give the rows that small ones do."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from hourlake.plans.load import load_run, read_audit
from hourlake.plans.quarantine import read_quarantine
from hourlake.sources import landing
from hourlake.sources.tables import read_tables
from hourlake.streaming.incremental import incremental_load
from tests.helpers import hours, put_document, rows

DAY = "2025-01-02"
SMALL_BLOCKS = "2000"


@pytest.fixture
def blocks(spark, monkeypatch):
    """Every document is large, and a task reads two thousand bytes."""
    monkeypatch.setattr(landing, "LARGE_BYTES", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SMALL_BLOCKS)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def both(spark, path, monkeypatch):
    """Rows by pieces, and rows of whole documents."""
    by_pieces = landing.read_rows(spark, path)
    found = rows(by_pieces.drop("text")), by_pieces
    monkeypatch.setattr(landing, "LARGE_BYTES", 1 << 40)
    return found[0], rows(landing.read_rows(spark, path).drop("text"))


def nasty(seed, count):
    """Records with braces, quotes and backslashes in further fields, nested ones and odd blanks."""
    rng = random.Random(seed)
    strings = ["}", "{", '"', "\\", '\\"}', "{}{}", "a}b{c", "é}", "\\\\", "", "[", "]", ",", "}\n{"]
    records = []
    for record in hours(seed, count, f"{DAY}T00:00:00.000Z"):
        keys = list(record)
        rng.shuffle(keys)
        out = {k: record[k] for k in keys}
        for i in range(rng.randint(0, 4)):
            name, text = f"x{i}{rng.choice(strings)}", "".join(rng.choices(strings, k=rng.randint(0, 4)))
            out[name] = rng.choice([text, {"a": {"b": text}}, [text, {"c": text}], None, {}])
        records.append(out)
    return json.dumps(records, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)


def test_records_equal_those_of_whole_documents(spark, path, blocks, monkeypatch):
    for i in range(12):
        put_document(path, f"City {i}", DAY, nasty(i, 1 + 5 * i))
    by_pieces, whole = both(spark, path, monkeypatch)
    assert by_pieces == whole and len(whole) == sum(1 + 5 * i for i in range(12))


def test_verdicts_equal_those_of_whole_documents(spark, path, blocks, monkeypatch):
    good = json.dumps(hours(0, 40, f"{DAY}T00:00:00.000Z"))
    cases = {
        "good": good,
        "blanks": f" \n[ {good[1:-1]} \n] \n",
        "empty": " [ ] ",
        "blank": "  \n ",
        "cut": good[:-2],
        "half": good[: len(good) // 2],
        "unclosed": good[:-1],
        "garbage": good + " garbage",
        "two": good + good,
        "listed": good + "," + good,
        "comma": good[:-1] + ",]",
        "double comma": good.replace("}, {", "},, {", 1),
        "no comma": good.replace("}, {", "} {", 1),
        "undated": good[:-1] + ', {"rain": 1.0}]',
        "misdated": good[:-1] + ', {"date": "soon"}]',
        "null": good[:-1] + ", null]",
        "brace": "}",
        "braces": good + "}",
        "open": "[" + good,
        "letters": "abc",
        "quote": good[:-1] + ', {"date": "2025]',
    }
    for city, text in cases.items():
        put_document(path, city, DAY, text)
    put_document(path, "Thirteen", "2025-13-02", good)
    with open(f"{put_document(path, 'bytes', DAY, good)}/weather_data.json", "wb") as out:
        out.write(good.encode()[:-1] + b', {"date": "2025-01-02", "x": "\xff"}]')
    by_pieces, whole = both(spark, path, monkeypatch)
    # a null among objects is no object; cut at braces it is what stands before the end
    other = [r for r in by_pieces if r not in whole]
    assert [r[1:8] for r in whole if r not in by_pieces and "not an array of objects" not in r] == []
    assert all("not a JSON document" in r for r in other) and len(by_pieces) == len(whole)


def test_one_document_is_read_by_several_tasks(spark, path, blocks):
    count = 400
    put_document(path, "Large", DAY, hours(0, count, f"{DAY}T00:00:00.000Z"))
    put_document(path, "Other", DAY, hours(0, 5, f"{DAY}T00:00:00.000Z"))
    files = landing.binary_files(spark, path, "*.json")
    from hourlake.sources import large_documents as large

    named = [r[0] for r in files.select("_metadata.file_path").collect()]
    pieces = landing.only_files(large._pieces(spark, path), named)
    tasks = pieces.where(F.col("_metadata.file_path").contains("Large")).select(F.spark_partition_id()).distinct().count()
    assert tasks > 20
    found = landing.read_rows(spark, path).where("city = 'Large'")
    got = found.select("pos", "doc_rows", "relative_humidity_2m").orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(i, count, float(i)) for i in range(count)]


def test_loads_of_large_documents(spark, tmp_path, blocks, monkeypatch):
    path, base, other = (str(tmp_path / n) for n in ("landing", "tables", "other"))
    put_document(path, "A", DAY, hours(0, 50, f"{DAY}T00:00:00.000Z"))
    put_document(path, "B", DAY, hours(100, 7, f"{DAY}T00:00:00.000Z"))
    put_document(path, "C", DAY, "[{]")
    put_document(path, "Zero", DAY, "")
    incremental_load(spark, path, base, "feed", files_per_batch=2)
    assert rows(read_quarantine(spark, base), "city", "reason") == [("C", "not a JSON document")]
    monkeypatch.setattr(landing, "LARGE_BYTES", 1 << 40)
    load_run(spark, path, other)
    for name, table in read_tables(spark, other).items():
        assert rows(read_tables(spark, base)[name]) == rows(table), name
    columns = ["city", "status", "rows", "message"]
    assert rows(read_audit(spark, base), *columns) == rows(read_audit(spark, other), *columns)
