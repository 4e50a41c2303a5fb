from __future__ import annotations

import datetime
import glob
import json

import pytest
from pyspark.sql import functions as F

from hourlake.functions.keys import (
    city_of_path,
    iso_text,
    object_key,
    run_date_of_path,
    text_to_date,
    utc_today,
)
from hourlake.operators.numbering import label_halves
from hourlake.schema import CITIES, MEASURES
from hourlake.sinks import landing as landing_sink
from hourlake.sinks.landing import write_landing
from hourlake.sources.cities import city_dim, expected_documents
from hourlake.sources.landing import parse_documents, read_landing, read_rows, split_rejected
from hourlake.sources.payload import explode_payload
from tests.helpers import hours, put_document, rows

DAY = datetime.date(2025, 1, 2)


def payload(spark):
    return spark.createDataFrame(
        [
            ("A", 1735776000, [1.0, None, 3.0], [10.0, 20.0, 30.0]),
            ("B", 1735776000, None, [5.0]),
        ],
        "city string, start_epoch long, rain array<double>, snowfall array<double>",
    )


def test_payload_rows(spark):
    df = explode_payload(payload(spark), ["rain", "snowfall", "cloud_cover"])
    assert rows(df, "city", "pos", "doc_rows", "rain", "snowfall", "cloud_cover") == [
        ("A", 0, 3, 1.0, 10.0, None),
        ("A", 1, 3, None, 20.0, None),
        ("A", 2, 3, 3.0, 30.0, None),
        ("B", 0, 1, None, 5.0, None),
    ]
    assert df.schema["cloud_cover"].dataType.simpleString() == "double"


def test_payload_time_axes(spark):
    start = explode_payload(payload(spark), ["rain", "snowfall"]).select(
        "city", "pos", iso_text(F.col("date")).alias("t")
    )
    assert {r.t for r in start.collect()} == {"2025-01-02T00:00:00.000Z"}
    hourly = explode_payload(payload(spark), ["rain", "snowfall"], "hourly").select(
        "city", "pos", iso_text(F.col("date")).alias("t")
    )
    assert rows(hourly.where("city = 'A'"), "pos", "t") == [
        (0, "2025-01-02T00:00:00.000Z"),
        (1, "2025-01-02T01:00:00.000Z"),
        (2, "2025-01-02T02:00:00.000Z"),
    ]
    with pytest.raises(ValueError):
        explode_payload(payload(spark), ["rain"], "daily")


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Kolkata"])
def test_iso_text_is_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1735786800123,), (-1,)], "ms long")
        texts = [r[0] for r in df.select(iso_text(F.timestamp_millis("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert texts == ["2025-01-02T03:00:00.123Z", "1969-12-31T23:59:59.999Z"]


def test_text_to_date(spark):
    df = spark.createDataFrame([("2025-01-02T23:00:00.000Z",), ("no date",), (None,)], "t string")
    assert [r[0] for r in df.select(text_to_date(F.col("t"))).collect()] == [DAY, None, None]


@pytest.mark.parametrize(
    "path,city",
    [
        ("file:/x/San%20Francisco/2025/1/2/weather_data.json", "San Francisco"),
        ("s3a://bucket/A+B/2025/1/2/weather_data.json", "A+B"),
        ("hdfs:/x/city=Rio%20de%20Janeiro/year=2025/month=1/day=2/part-0.json", "Rio de Janeiro"),
        ("Tokyo/2025/1/2/weather_data.json", "Tokyo"),
    ],
)
def test_path_fields(spark, path, city):
    df = spark.createDataFrame([(path,)], "p string")
    row = df.select(city_of_path(F.col("p")), run_date_of_path(F.col("p"))).first()
    assert tuple(row) == (city, DAY)


def test_path_without_fields(spark):
    df = spark.createDataFrame([("file:/x/readme.txt",), ("file:/A/2025/13/2/f",)], "p string")
    got = [tuple(r) for r in df.select(city_of_path("p"), run_date_of_path("p")).collect()]
    assert got == [(None, None), ("A", None)]


def test_object_key_has_no_leading_zeros(spark):
    df = spark.createDataFrame([("New York", DAY)], "c string, d date")
    key = df.select(object_key(F.col("c"), F.col("d"))).first()[0]
    assert key == "New York/2025/1/2/weather_data.json"


def test_documents(spark, path):
    records = hours(1, 5)
    records[2]["rain"] = None
    del records[3]["snowfall"]
    records[4]["extra"] = "dropped"
    put_document(path, "New York", "2025-01-02", records)
    put_document(path, "A+B", "2025-01-02", hours(7, 1))
    put_document(path, "Broken", "2025-01-02", '[{"date": "2025-01-02", "rain"')
    put_document(path, "Empty list", "2025-01-02", "[]")
    good, bad = read_landing(spark, path)
    assert rows(good, "city", "run_date", "pos", "doc_rows", "rain", "snowfall") == sorted(
        [
            ("New York", DAY, i, 5, r.get("rain"), r.get("snowfall"))
            for i, r in enumerate(records)
        ]
        + [("A+B", DAY, 0, 1, hours(7, 1)[0]["rain"], hours(7, 1)[0]["snowfall"])],
        key=repr,
    )
    assert [(r.city, r.run_date, r.reason) for r in bad.collect()] == [
        ("Broken", DAY, "not a JSON document")
    ]
    assert bad.first().text.startswith("[{")
    # the one-scan form gives the same
    good_2, bad_2 = split_rejected(read_rows(spark, path))
    assert rows(good_2) == rows(good)
    assert rows(bad_2) == rows(bad)


def test_pretty_printed_document_and_wrong_type(spark, path):
    put_document(
        path, "A", "2025-01-02", '[\n {"date": "2025-01-02",\n "rain": "much",\n "snowfall": 2}\n]'
    )
    good, bad = read_landing(spark, path)
    assert rows(good, "rain", "snowfall") == [(None, 2.0)]
    assert bad.count() == 0


def test_document_order_is_kept(spark, path):
    for i in range(20):
        put_document(path, f"c{i}", "2025-01-02", hours(100 * i, 48))
    good, _ = read_landing(spark, path)
    wrong = good.where(
        F.col("relative_humidity_2m")
        != F.substring("city", 2, 2).cast("int") * 100 + F.col("pos")
    )
    assert good.count() == 20 * 48 and wrong.count() == 0


def test_selected_documents(spark, path):
    for city in ("New York", "A{b},c", "London"):
        for day in ("2025-01-02", "2025-01-03"):
            put_document(path, city, day, hours(1, 2))
    good, _ = read_landing(spark, path, run_date="2025-01-03")
    assert {(r.city, str(r.run_date)) for r in good.collect()} == {
        ("New York", "2025-01-03"),
        ("A{b},c", "2025-01-03"),
        ("London", "2025-01-03"),
    }
    good, _ = read_landing(spark, path, run_date=DAY, cities=["A{b},c", "Nowhere"])
    assert {(r.city, r.run_date) for r in good.collect()} == {("A{b},c", DAY)}
    good, bad = read_landing(spark, path, cities=["Nowhere"])
    assert good.count() == 0 and bad.count() == 0


def test_unknown_layout(spark, path):
    with pytest.raises(ValueError):
        read_rows(spark, path, layout="zip")


def landing_frame(spark, cities, days=("2025-01-02",), count=6, shift=0):
    documents = [
        (
            city,
            datetime.date.fromisoformat(day),
            f"{city}-{day}",
            json.dumps(hours(shift + i, count, f"{day}T00:00:00.000Z")),
        )
        for i, city in enumerate(cities)
        for day in days
    ]
    docs = spark.createDataFrame(documents, "city string, run_date date, file string, text string")
    return split_rejected(parse_documents(docs))[0]


def test_lines_round_trip_and_replace(spark, path):
    columns = ["city", "run_date", "pos", "doc_rows", "date", *MEASURES]
    first = landing_frame(spark, ["San Francisco", "7", "A:b"], ["2025-01-02", "2025-01-13"])
    write_landing(first, path)
    good, bad = read_landing(spark, path, layout="hive")
    assert rows(good, *columns) == rows(first, *columns)
    assert bad.count() == 0
    # writing one key again replaces that key only
    again = landing_frame(spark, ["7"], ["2025-01-13"], count=4, shift=50)
    write_landing(again, path)
    good, _ = read_landing(spark, path, layout="hive")
    kept = first.where("not (city = '7' and run_date = date'2025-01-13')")
    assert rows(good, *columns) == rows(kept.unionByName(again), *columns)
    # and one key can be read alone
    good, _ = read_landing(spark, path, layout="hive", run_date="2025-01-13", cities=["7"])
    assert rows(good, *columns) == rows(again, *columns)


def test_large_folder_is_cut_in_files(spark, path, monkeypatch):
    monkeypatch.setattr(landing_sink, "LINES_PER_FILE", 10)
    frame = landing_frame(spark, ["A", "B"], count=100)
    write_landing(frame, path)
    assert len(glob.glob(f"{path}/city=A/**/*.json", recursive=True)) > 1
    good, _ = read_landing(spark, path, layout="hive")
    labelled = label_halves(good, "pos", "doc_rows")
    assert rows(labelled, "city", "pos", "hour", "forecast_data") == rows(
        label_halves(frame, "pos", "doc_rows"), "city", "pos", "hour", "forecast_data"
    )


def test_bad_lines_are_rejected(spark, path):
    write_landing(landing_frame(spark, ["A"]), path)
    folder = f"{path}/city=A/year=2025/month=1/day=2"
    with open(f"{folder}/part-extra.json", "w", encoding="utf-8") as out:
        out.write('{"pos": 1, "doc_rows"\n{"rain": 1.0}\n')
    good, bad = read_landing(spark, path, layout="hive")
    assert good.count() == 6
    assert rows(bad, "city", "reason") == [
        ("A", "line without a place in its document"),
        ("A", "not a JSON document"),
    ]


def test_timestamps_land_as_iso_text(spark, path):
    df = explode_payload(payload(spark), ["rain", "snowfall"], "hourly").withColumn(
        "run_date", F.lit(DAY)
    )
    write_landing(df, path)
    good, _ = read_landing(spark, path, layout="hive")
    assert rows(good.where("city = 'A'"), "pos", "date", "rain") == [
        (0, "2025-01-02T00:00:00.000Z", 1.0),
        (1, "2025-01-02T01:00:00.000Z", None),
        (2, "2025-01-02T02:00:00.000Z", 3.0),
    ]


def test_landing_needs_places(spark, path):
    with pytest.raises(ValueError, match="doc_rows"):
        write_landing(spark.createDataFrame([("A", DAY)], "city string, run_date date"), path)


def test_utc_today(spark):
    before = datetime.datetime.now(datetime.timezone.utc).date()
    today = spark.range(1).select(utc_today()).first()[0]
    assert before <= today <= datetime.datetime.now(datetime.timezone.utc).date()


def test_cities(spark):
    dim = city_dim(spark)
    assert [tuple(r)[1:] for r in dim.orderBy("city_index").collect()] == CITIES
    assert expected_documents(spark, "2025-01-02").count() == 15
    assert rows(expected_documents(spark, "2025-01-02", ["X"])) == [("X", DAY)]
