"""The checked queries, each over the whole ``events`` table of a folder."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.keys import city_of_path, iso_text, object_key, run_date_of_path
from hourlake.operators import audit, presentation, tables
from hourlake.operators.numbering import POSITION, SIZE, label_halves, number_rows
from hourlake.plans import event_observations as source
from hourlake.plans import reports
from hourlake.plans.load import load_run, publish_rows, read_audit
from hourlake.plans.quarantine import replay_quarantine
from hourlake.plans.statements import STATEMENTS
from hourlake.schema import CITIES, DAILY_TABLE, DAY_KEYS, HOUR_KEYS, MEASURES
from hourlake.session import application_folder, folder_exists, fresh_folder, write_aside
from hourlake.sinks.compaction import compact, drop_unused
from hourlake.sinks.landing import PARTITIONS, put_document, write_files, write_landing
from hourlake.sinks.tables import APPEND, REPLACE, write_tables
from hourlake.sources.cities import city_dim
from hourlake.sources.landing import (
    DOCUMENT_KEYS,
    UNPARSEABLE,
    VERSION,
    binary_files,
    parse_documents,
    read_landing,
    rows_of_files,
    split_rejected,
)
from hourlake.sources.payload import explode_payload
from hourlake.sources.tables import read_table, read_tables, register_views
from hourlake.streaming.incremental import incremental_load
from hourlake.streaming.landing_stream import stream_load

CITY = "3"
DATE, NEXT_DATE = "2024-01-08", "2024-01-15"
FIRST_WEEK, THIRD_WEEK = "2024-01-01", "2024-01-15"
SELECTED_CITIES = ["New York", "Tokyo", "Nowhere"]

Query = Callable[[SparkSession, str], DataFrame]


def hourly_obs(spark: SparkSession, folder: str) -> DataFrame:
    return source.observations(spark, folder).select("city", "date", "event_id", *MEASURES)


def label_batch(spark: SparkSession, folder: str) -> DataFrame:
    frame = source.labelled(spark, folder)
    return frame.select("city", "date", "event_id", "hour", "forecast_data")


def derive(spark: SparkSession, folder: str) -> DataFrame:
    added = [
        "heat_index",
        "wind_chill",
        "potential_evapotranspiration",
        "atmospheric_pressure_diff",
        "precipitation_rate",
    ]
    return source.derived(spark, folder).select(*HOUR_KEYS, *added, *MEASURES)


def hourly_table(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return tables.split_tables(source.derived(spark, folder))[name]

    return query


def all_tables(spark: SparkSession, folder: str, **chosen) -> dict[str, DataFrame]:
    """The tables derived from all events, or from those of one city or of some weeks."""
    return tables.all_tables(source.derived(spark, folder, **chosen))


def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return all_tables(spark, folder)[DAILY_TABLE]


def daily_extremes_on_date(spark: SparkSession, folder: str) -> DataFrame:
    return reports.daily_extremes(all_tables(spark, folder, weeks=[DATE]), DATE)


def city_averages(spark: SparkSession, folder: str) -> DataFrame:
    return reports.city_averages(all_tables(spark, folder))


def temps_forecast_true(spark: SparkSession, folder: str) -> DataFrame:
    chosen = all_tables(spark, folder, city=CITY, weeks=[DATE])
    return reports.temperatures(chosen, CITY, DATE, True)


def temps_forecast_false(spark: SparkSession, folder: str) -> DataFrame:
    chosen = all_tables(spark, folder, city=CITY, weeks=[NEXT_DATE])
    return reports.temperatures(chosen, CITY, NEXT_DATE, False)


def day_over_day_city(spark: SparkSession, folder: str) -> DataFrame:
    chosen = all_tables(spark, folder, city=CITY, weeks=[DATE, NEXT_DATE])
    return reports.day_over_day_city(chosen, CITY, DATE, NEXT_DATE)


def day_over_day_all(spark: SparkSession, folder: str) -> DataFrame:
    return reports.day_over_day(all_tables(spark, folder), lag_days=7)


def wide_report(spark: SparkSession, folder: str) -> DataFrame:
    chosen = all_tables(spark, folder, city=CITY, weeks=[FIRST_WEEK, DATE, THIRD_WEEK])
    return reports.wide_report(chosen, CITY, FIRST_WEEK, THIRD_WEEK)


def wide_report_all(spark: SparkSession, folder: str) -> DataFrame:
    """Four tables of all events: numbered once and stored, as published tables are."""
    frame, _ = write_aside(source.derived(spark, folder), "derived")
    return reports.wide_report(tables.all_tables(frame), ordered=False)


def labelled_report(report: str, query: Query) -> Query:
    """The report with the labels its readers see."""

    def labelled(spark: SparkSession, folder: str) -> DataFrame:
        return presentation.with_display_names(query(spark, folder), report)

    return labelled


def by_statement(name: str, **arguments) -> Query:
    """The report as SQL text on registered views."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        register_views(all_tables(spark, folder))
        return spark.sql(STATEMENTS[name], arguments)

    return query


def preview_daily(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.preview(daily_summary(spark, folder), 30, DAY_KEYS)


def preview_tail(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.preview(daily_summary(spark, folder), 5, DAY_KEYS, tail=True)


def union_batches(spark: SparkSession, folder: str) -> DataFrame:
    frame = source.labelled(spark, folder).select(
        "city", "date", "event_id", "hour", "forecast_data", "temperature_2m"
    )
    return tables.union_batches(frame.where("forecast_data"), frame.where("not forecast_data"))


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A date published twice by a rerun shows up as duplicates."""
    frame = source.derived(spark, folder).select(*HOUR_KEYS)
    rerun = frame.where(F.col("date") == reports.day(DATE))
    return tables.duplicate_keys(tables.union_batches(frame, rerun), HOUR_KEYS)


def chart_series_extremes(spark: SparkSession, folder: str) -> DataFrame:
    bars = daily_extremes_on_date(spark, folder)
    return presentation.chart_series(bars, ["city"], ["max_temperature_2m", "min_temperature_2m"])


def chart_series_levels(spark: SparkSession, folder: str) -> DataFrame:
    lines = day_over_day_all(spark, folder)
    levels = [f"temperature_diff_{level}" for level in reports.LEVELS]
    return presentation.chart_series(lines, ["city", "date", "hour"], levels)


# cloud_cover is in no payload: an absent variable becomes NULL
PAYLOAD_VARIABLES = [m for m in MEASURES if m != "cloud_cover"]


def payload_explode(time_axis: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        payloads = source.payloads(spark, folder, PAYLOAD_VARIABLES)
        rows = explode_payload(payloads, MEASURES, time_axis)
        return rows.withColumn("date_iso", iso_text(F.col("date"))).drop("date")

    return query


def path_fields(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    named = F.concat(F.lit("City "), F.col("user_id").cast("string"))
    keyed = events.select(
        "event_id", object_key(named, F.col("ts").cast("date")).alias("object_key")
    )
    # file systems report a blank as %20
    path = F.concat(F.lit("file:/landing/"), F.replace("object_key", F.lit(" "), F.lit("%20")))
    return keyed.select(
        "event_id",
        "object_key",
        city_of_path(path).alias("city"),
        run_date_of_path(path).alias("run_date"),
    )


def city_dim_join(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    indexed = events.select(
        "event_id", "value", (F.col("user_id") % len(CITIES)).alias("city_index")
    )
    joined = indexed.join(F.broadcast(city_dim(spark)), "city_index")
    return joined.select("event_id", "city", "latitude", "longitude", "value")


def landing_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "landing")
    write_landing(source.landing_rows(spark, folder), path)
    good, _ = read_landing(spark, path, layout="hive")
    labelled = label_halves(good, "pos", "doc_rows")
    return labelled.select(
        "city", "run_date", "date", "pos", "doc_rows", "hour", "forecast_data", *MEASURES
    )


def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Some documents are cut off; each city seen in a week is expected in the next."""
    documents = source.documents(spark, folder, with_first_event=True)
    cut = F.expr("substr(text, 1, length(text) - 2)")
    path = fresh_folder(spark, "documents")
    documents.withColumn(
        "text", F.when(F.col("first_event") % 10 == 0, cut).otherwise(F.col("text"))
    ).drop("document", "first_event").write.parquet(path)
    landed = spark.read.parquet(path)
    expected = landed.select("city", F.date_add("run_date", 7).alias("run_date"))
    # the measures are not needed, so little is stored between the two uses
    rows, _ = write_aside(
        parse_documents(landed).select(*DOCUMENT_KEYS, *VERSION, "status", "text", "reason"), "rows"
    )
    return audit.load_audit(*split_rejected(rows), expected)


def publish_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_folder(spark, "tables")
    frame = source.derived(spark, folder).persist()  # six tables read it
    try:
        write_tables(tables.all_tables(frame), base, APPEND)
    finally:
        frame.unpersist()
    register_views(read_tables(spark, base))
    return spark.sql(STATEMENTS["all_tables"])


def replace_batch(spark: SparkSession, folder: str) -> DataFrame:
    """One date is loaded again with other snowfall: its batches change, no row is added."""
    name = "hourly_precipitation_evaporation"
    base = fresh_folder(spark, "tables")
    table = tables.split_tables(source.derived(spark, folder))[name].persist()
    again = table.where(F.col("date") == reports.day(DATE)).withColumn(
        "snowfall", F.col("snowfall") + F.lit(1.0)
    )
    try:
        write_tables({name: table}, base, REPLACE)
        write_tables({name: again}, base, REPLACE)
    finally:
        table.unpersist()
    return read_table(spark, base, name)


def write_documents(documents: DataFrame, landing: str) -> None:
    """One file per document, below city, year, month and day."""
    keyed = documents.select(
        "city",
        F.year("run_date").alias("year"),
        F.month("run_date").alias("month"),
        F.dayofmonth("run_date").alias("day"),
        F.format_string("document-%d.txt", "document").alias("name"),
        "text",
    )
    write_files(keyed, landing, PARTITIONS)


FILES = "*.{txt,json}"


# files of all documents, and tables they have been loaded to, by application and folder: queries
# that only read them share them
_LANDED: dict[tuple[str, str], str] = {}
_LOADED: dict[tuple[str, str], str] = {}


def landed_documents(spark: SparkSession, folder: str) -> str:
    """Files of all documents; once in an application."""
    mine = (application_folder(spark), folder)
    if mine not in _LANDED or not folder_exists(spark, _LANDED[mine]):
        landing = fresh_folder(spark, "documents")
        write_documents(source.documents(spark, folder), landing)
        _LANDED[mine] = landing
    return _LANDED[mine]


def loaded_base(spark: SparkSession, folder: str) -> str:
    """The tables of one load of all documents; once in an application."""
    mine = (application_folder(spark), folder)
    if mine not in _LOADED or not folder_exists(spark, _LOADED[mine]):
        base = fresh_folder(spark, "tables")
        load_run(spark, landed_documents(spark, folder), base, mode=REPLACE, file_pattern=FILES)
        _LOADED[mine] = base
    return _LOADED[mine]


def loaded_table(name: str, merge_days: bool = False) -> Query:
    """One published table with all its columns."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return read_table(spark, loaded_base(spark, folder), name, merge_days=merge_days)

    return query


def load_run_all(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of one load; files have names that no statement can know."""
    audit = read_audit(spark, loaded_base(spark, folder))
    return audit.select("city", "run_date", "status", "rows", "expected", "message")


def load_run_selected(spark: SparkSession, folder: str) -> DataFrame:
    """A load of one date and some cities."""
    landing, base = landed_documents(spark, folder), fresh_folder(spark, "tables")
    load_run(spark, landing, base, mode=REPLACE, file_pattern=FILES, run_date=DATE, cities=SELECTED_CITIES)
    return read_table(spark, base, "hourly_soil_conditions")


def finite_or_kind(column: str) -> list:
    """The value where it is finite, and what it is where it is not."""
    value = F.col(column)
    kind = (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .otherwise("finite")
    )
    return [F.when(kind == "finite", value).alias(column), kind.alias(f"{column}_kind")]


#: Temperatures of some events that no thermometer shows, by number of the event modulo 1000.
EXTREMES = {1: 2.5e9, 2: 1e300, 3: float("nan"), 4: float("inf"), 5: float("-inf"), 999: -3.25e10}


def daily_extreme_values(spark: SparkSession, folder: str) -> DataFrame:
    """Daily rows of documents with absurd hours: nothing stops, and every mean is defined."""
    temperature = F.col("value") / 5.0 + F.lit(20.0)
    for rest, absurd in EXTREMES.items():
        temperature = F.when(F.col("event_id") % 1000 == rest, F.lit(absurd)).otherwise(temperature)
    base = fresh_folder(spark, "tables")
    documents = source.documents(spark, folder, changed={"temperature_2m": temperature})
    publish_rows(parse_documents(documents.drop("document")), base, mode=REPLACE)
    daily = read_table(spark, base, DAILY_TABLE)
    measured = [f"{kind}_temperature_2m" for kind in ("average", "max", "min")]
    shown = [c for m in measured for c in finite_or_kind(m)]
    return daily.select(*DAY_KEYS, "total_precipitation", *shown)


def _versions(spark: SparkSession, folder: str, modified: str, snowfall: float) -> DataFrame:
    """All documents, as versions of a time, with some inches more or less of snow."""
    more = {"snowfall": (F.col("event_id") % 9) / 100.0 + F.lit(snowfall)}
    documents = source.documents(spark, folder, with_first_event=True, changed=more)
    return documents.withColumns({"document": F.col("file"), "modified": F.lit(modified).cast("timestamp")})


def replace_out_of_order(spark: SparkSession, folder: str) -> DataFrame:
    """The second version of all documents is published before the first, and a third of some last."""
    base = fresh_folder(spark, "tables")
    for modified, snowfall in (("2024-06-02", 0.0), ("2024-06-01", -5.0), ("2024-06-03", 1.0)):
        documents = _versions(spark, folder, modified, snowfall)
        if snowfall > 0:
            documents = documents.where("first_event % 2 = 0")
        publish_rows(parse_documents(documents.drop("first_event")), base, mode=REPLACE, load_id=modified)
    return read_table(spark, base, "hourly_precipitation_evaporation")


def compacted_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Loads, a snapshot of them, a newer version of some documents, and a snapshot of all; older files go."""
    base = fresh_folder(spark, "tables")
    documents = _versions(spark, folder, "2024-06-01", 0.0)
    for rest in (0, 1):
        part = documents.where(F.col("first_event") % 2 == rest).drop("first_event")
        publish_rows(parse_documents(part), base, mode=REPLACE, load_id=f"part-{rest}")
    compact(spark, base)
    newer = _versions(spark, folder, "2024-06-02", 1.0).where("first_event % 3 = 0").drop("first_event")
    publish_rows(parse_documents(newer), base, mode=REPLACE, load_id="newer")
    compact(spark, base)
    drop_unused(spark, base, older_than_hours=0)
    return read_table(spark, base, "hourly_precipitation_evaporation")


def quarantine_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Some documents are cut off, some are errors; the first are mended and loaded. The audit has both."""
    base = fresh_folder(spark, "tables")
    documents = source.documents(spark, folder, with_first_event=True).drop("document")
    kind = F.col("first_event") % 4
    spoiled = (
        F.when(kind == 0, F.expr("substr(text, 1, length(text) - 2)"))
        .when(kind == 1, F.lit('{"error": true}'))
        .otherwise(F.col("text"))
    )
    publish_rows(parse_documents(documents.withColumn("text", spoiled).drop("first_event")), base, mode=REPLACE)

    def closed(rejected: DataFrame) -> DataFrame:
        cut = rejected.where(F.col("reason") == UNPARSEABLE)
        return cut.withColumn("text", F.concat("text", F.lit("}]")))

    replay_quarantine(spark, base, closed)
    audit = read_audit(spark, base)
    hours = read_table(spark, base, "hourly_soil_conditions").agg(F.count("*").alias("hours"))
    # one row, beside every row of the audit
    return audit.select("city", "run_date", "status", "rows", "message").join(F.broadcast(hours))


def streamed(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that ends after its first load, before that is noted, and is started again."""
    landing, base = landed_documents(spark, folder), fresh_folder(spark, "tables")
    checkpoint = fresh_folder(spark, "stream")

    def lost(batch: int) -> None:
        raise RuntimeError("lost after the load")

    try:
        stream_load(spark, landing, base, checkpoint, files_per_batch=500, file_pattern=FILES, published=lost)
    except StreamingQueryException:
        pass
    stream_load(spark, landing, base, checkpoint, files_per_batch=500, file_pattern=FILES)
    return read_table(spark, base, "hourly_weather_conditions")


def quarantine_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Files that are no documents, in every way that the load tells apart, and their audit."""
    landing, base = fresh_folder(spark, "documents"), fresh_folder(spark, "tables")
    documents = source.documents(spark, folder, with_first_event=True)
    kind = F.col("first_event") % 12
    spoiled = (
        F.when(kind == 0, F.expr("substr(text, 1, length(text) - 2)"))
        .when(kind == 1, F.lit('{"error": true, "reason": "limit"}'))
        .when(kind == 2, F.lit("[null]"))
        .when(kind == 3, F.concat("text", F.lit(" garbage")))
        .when(kind == 4, F.concat("text", "text"))
        .when(kind == 5, F.concat("text", F.lit("\n"), "text"))
        .when(kind == 6, F.lit("[]"))
        .when(kind == 7, F.lit(""))
        .when(kind == 8, F.replace("text", F.lit('"date":"2'), F.lit('"date":"no 2')))
        .otherwise(F.col("text"))
    )
    documents = documents.withColumn("text", spoiled)
    stray = kind == 9
    write_documents(documents.where(~stray), f"{landing}/good")
    named = F.concat_ws("-", "city", "run_date", "document", F.lit("stray.txt"))
    write_files(documents.where(stray).select(named.alias("name"), "text"), f"{landing}/stray")
    load_run(spark, landing, base, mode=REPLACE, file_pattern=FILES)
    audit = read_audit(spark, base)
    return audit.select("city", "run_date", "status", "rows", "message")


def _one_document(spark: SparkSession, folder: str):
    """The document with the first event, whose file the queries below name themselves."""
    documents = source.documents(spark, folder, with_first_event=True)
    key = F.min(F.struct("first_event", "city", "run_date"))
    first, city, run_date = documents.agg(key.alias("key")).first()["key"]
    # its keys reach the scan, so no other text is made
    batch = F.col("city").eqNullSafe(F.lit(city)) & F.col("run_date").eqNullSafe(F.lit(run_date))
    one = documents.where((F.col("first_event") == first) & batch)
    return documents.where(F.col("first_event") != first), one.first()


def incremental(files_per_batch: int | None = None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        landing, base = landed_documents(spark, folder), fresh_folder(spark, "tables")
        incremental_load(
            spark, landing, base, "feed", files_per_batch=files_per_batch, file_pattern=FILES
        )
        return read_table(spark, base, "hourly_weather_conditions")

    return query


def incremental_resent_key(spark: SparkSession, folder: str) -> DataFrame:
    """One document is put again under its key, without its last hour."""
    landing, base = fresh_folder(spark, "documents"), fresh_folder(spark, "tables")
    others, one = _one_document(spark, folder)
    write_documents(others, landing)
    put_document(spark, landing, one.city, one.run_date, one.text)
    incremental_load(spark, landing, base, "feed", file_pattern=FILES)
    shorter = json.dumps(json.loads(one.text)[:-1])
    put_document(spark, landing, one.city, one.run_date, shorter)
    incremental_load(spark, landing, base, "feed", file_pattern=FILES)
    return read_table(spark, base, "hourly_weather_conditions")


def incremental_old_file(spark: SparkSession, folder: str) -> DataFrame:
    """One document arrives late, with a time long before the first load."""
    landing, base = fresh_folder(spark, "documents"), fresh_folder(spark, "tables")
    others, one = _one_document(spark, folder)
    write_documents(others, landing)
    incremental_load(spark, landing, base, "feed", file_pattern=FILES)
    before = datetime.datetime.now(datetime.timezone.utc) - datetime.timedelta(days=30)
    put_document(spark, landing, one.city, one.run_date, one.text, before)
    incremental_load(spark, landing, base, "feed", file_pattern=FILES)
    return read_table(spark, base, "hourly_weather_conditions")


def numbered_spread(spark: SparkSession, folder: str) -> DataFrame:
    """All events as one batch, which spreads over all tasks without a word from the caller."""
    rows = source.events(spark, folder).withColumn("batch", F.lit("all"))
    numbered = number_rows(rows, ["batch"], source.ORDER, spread=True)
    return numbered.select("event_id", F.col(POSITION).alias("position"), F.col(SIZE).alias("size"))


def documents_in_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All documents read as large ones are: cut where records end, by tasks that know a part of the file."""
    path = landed_documents(spark, folder)
    rows = rows_of_files(binary_files(spark, path, FILES), path, large_bytes=0, pattern=FILES)
    return rows.select("city", "run_date", "status", "pos", "doc_rows", "date", *MEASURES)


QUERIES: dict[str, Query] = {
    "hourly_obs": hourly_obs,
    "label_batch": label_batch,
    "derive": derive,
    "tbl_meteorological": hourly_table("meteorological_calculations"),
    "tbl_precip_evap": hourly_table("hourly_precipitation_evaporation"),
    "tbl_soil": hourly_table("hourly_soil_conditions"),
    "tbl_weather": hourly_table("hourly_weather_conditions"),
    "tbl_wind": hourly_table("hourly_wind_atmospheric_conditions"),
    "daily_summary": daily_summary,
    "daily_extremes_on_date": daily_extremes_on_date,
    "city_averages": city_averages,
    "temps_forecast_true": temps_forecast_true,
    "temps_forecast_false": temps_forecast_false,
    "day_over_day_city": day_over_day_city,
    "day_over_day_all": day_over_day_all,
    "wide_report": wide_report,
    "wide_report_all": wide_report_all,
    "preview_daily": preview_daily,
    "preview_tail": preview_tail,
    "union_batches": union_batches,
    "duplicate_keys": duplicate_keys,
    "chart_series_extremes": chart_series_extremes,
    "chart_series_levels": chart_series_levels,
    "payload_explode_start": payload_explode("start"),
    "payload_explode_hourly": payload_explode("hourly"),
    "path_fields": path_fields,
    "city_dim_join": city_dim_join,
    "landing_roundtrip": landing_roundtrip,
    "load_audit": load_audit,
    "publish_roundtrip": publish_roundtrip,
    "replace_batch": replace_batch,
    "incremental_load": incremental(),
    "incremental_in_parts": incremental(files_per_batch=500),
    "incremental_resent_key": incremental_resent_key,
    "incremental_old_file": incremental_old_file,
    "quarantine_documents": quarantine_documents,
    "load_run_all": load_run_all,
    "load_run_selected": load_run_selected,
    "loaded_meteorological": loaded_table("meteorological_calculations"),
    "loaded_precip_evap": loaded_table("hourly_precipitation_evaporation"),
    "loaded_soil": loaded_table("hourly_soil_conditions"),
    "loaded_weather": loaded_table("hourly_weather_conditions"),
    "loaded_wind": loaded_table("hourly_wind_atmospheric_conditions"),
    "loaded_daily": loaded_table(DAILY_TABLE),
    "daily_merged": loaded_table(DAILY_TABLE, merge_days=True),
    "daily_extreme_values": daily_extreme_values,
    "replace_out_of_order": replace_out_of_order,
    "compacted_tables": compacted_tables,
    "quarantine_replay": quarantine_replay,
    "stream_load": streamed,
    "numbered_spread": numbered_spread,
    "documents_in_pieces": documents_in_pieces,
    "sql_preview_daily": by_statement("preview_daily"),
    "sql_daily_extremes": by_statement("daily_extremes", date=DATE),
    "sql_city_averages": by_statement("city_averages"),
    "sql_temperatures": by_statement("temperatures", city=CITY, date=DATE, forecast=True),
    "sql_day_over_day_city": by_statement(
        "day_over_day_city", city=CITY, first_date=DATE, second_date=NEXT_DATE
    ),
    "sql_wide_report": by_statement(
        "wide_report", city=CITY, first_date=FIRST_WEEK, last_date=THIRD_WEEK
    ),
    "labels_daily_extremes": labelled_report("daily_extremes", daily_extremes_on_date),
    "labels_city_averages": labelled_report("city_averages", city_averages),
    "labels_temperatures": labelled_report("temperatures", temps_forecast_true),
    "labels_day_over_day": labelled_report("day_over_day", day_over_day_city),
    "labels_wide_report": labelled_report("wide_report", wide_report),
}
