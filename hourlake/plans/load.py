"""One load: landing documents to published tables and audit.

A load writes its rows in folders of its own, beside those of other loads, and commits by writing
its manifest: one row for each version of a document it has read, with its status, rows and message, which
is also the audit. Readers keep the rows that the manifests call current (see ``sources.store``): those of a
document's newest replacing version and of what was appended after it. So a document is replaced by what it
is, whatever dates its hours have; an emptied one takes its rows along; a load that stops half-way is not
seen; and loads of other documents do not meet. Rejected documents are kept, with their text.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.keys import text_to_date
from hourlake.operators.audit import mark_expected, missing_documents
from hourlake.operators.exact import summary_states
from hourlake.operators.measures import derive
from hourlake.operators.numbering import label_halves
from hourlake.operators.tables import day_summary, split_tables
from hourlake.schema import DAY_KEYS
from hourlake.session import drop_folder, kept_in_here, many_files_a_task, write_aside
from hourlake.sinks.tables import APPEND, MODES, REPLACE, arrange, write_load, write_loads
from hourlake.sources.landing import DOCUMENT_KEYS, LOADED, QUARANTINED, VERSION, read_rows
from hourlake.sources.store import MANIFEST, QUARANTINE, Store, existing, open_store, store_path
from hourlake.sources.tables import DAILY_STATES

#: Reports of expected documents that no load has seen.
MISSING_TABLE = "load_missing"
AUDIT_COLUMNS = ["city", "run_date", "file", "status", "rows", "expected", "message"]


def hourly_frame(rows: DataFrame, first_half_flag: bool = True) -> DataFrame:
    """Derived, dated and labelled rows; every row carries its place, so no exchange."""
    dated = derive(rows).withColumn("date", text_to_date(F.col("date")))
    return label_halves(dated, "pos", "doc_rows", first_half_flag)


def publish_rows(
    rows: DataFrame,
    base: str,
    expected: DataFrame | None = None,
    mode: str = APPEND,
    load_id: str = "0",
    first_half_flag: bool = True,
    feed: str = "",
    batch: int = 0,
    report_missing: bool = True,
) -> None:
    """Publish landing rows and then their manifest, which is their audit too.

    The documents are parsed once and their rows arranged once, with one exchange; the tables are
    projections of the arranged rows, written at one time. Rows are counted as they are stored, and tables
    without rows are not written. The audit of a load published again under the same ``load_id`` is that of
    the last time. Of the daily table, states are stored that can be merged.
    """
    own = f"{load_id}-{uuid.uuid4().hex[:8]}"
    missing = load_id if report_missing else None
    _publish(rows, base, expected, mode, first_half_flag, feed, F.lit(batch), F.lit(load_id), own, missing)


def publish_batches(
    rows: DataFrame,
    base: str,
    expected: DataFrame | None,
    mode: str,
    load_id: str,
    first_half_flag: bool,
    feed: str,
    batch: int,
    firsts: list[str],
) -> None:
    """Publish several batches at one time, each as a load of its own.

    ``firsts`` has the first document of each batch, in the order of their names; ``batch`` is the number of the first
    batch, and a load is ``load_id`` and its number. Every load gets the folders and the manifest that ``publish_rows``
    gives it, and commits by its own manifest, but the documents of all are parsed, arranged and written by the
    same jobs, as a job's fixed costs are far larger than a small load's. Nothing is reported as missing.
    """
    place = reduce(Column.__add__, [(F.col("document") >= first).cast("int") for first in firsts[1:]], F.lit(1))
    # out of an array, as other numbers in the code of a stage would have it compiled again for each group
    numbered = rows.withColumn("batch", F.element_at(F.array(*[F.lit(batch + i) for i in range(len(firsts))]), place))
    load = F.concat(F.lit(f"{load_id}-"), F.col("batch").cast("string"))
    _publish(numbered, base, expected, mode, first_half_flag, feed, F.col("batch"), load, None, None)


def _publish(
    rows: DataFrame,
    base: str,
    expected: DataFrame | None,
    mode: str,
    first_half_flag: bool,
    feed: str,
    batch: Column,
    load: Column,
    own: str | None,
    missing: str | None,
) -> None:
    """One load, in folders named ``own``, or a load for each ``batch`` of the rows, each in folders of its own.

    ``missing`` is what the report of missing documents is written as, if there is to be one.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    by_load = []
    if own is None:
        by_load = ["batch", "load_id"]
        rows = rows.withColumn("load_id", F.concat(load, F.lit(f"-{uuid.uuid4().hex[:8]}")))
    spark = rows.sparkSession
    counts = Observation()
    counted = arrange(hourly_frame(rows, first_half_flag), by_load[1:]).observe(
        counts,
        F.count_if(F.col("status") == LOADED).alias("hours"),
        F.count_if(F.col("status") == QUARANTINED).alias("rejected"),
    )
    staged, folder = write_aside(counted, "staged")
    try:
        found = counts.get
        # versions are few: they are aggregated once, for the manifest and for what is missing
        keys = [*VERSION, *DOCUMENT_KEYS, "status", F.col("reason").alias("message"), *by_load]
        versions = staged.groupBy(*keys).agg(F.count_if(F.col("status") == LOADED).alias("rows"))
        no_hours = F.when(F.col("status") == "empty", F.lit("no hours"))
        versions = versions.withColumn("message", F.coalesce("message", no_hours))
        writes = []
        if found["hours"]:
            good = staged.where(F.col("status") == LOADED)
            tables = split_tables(good, ["document", *by_load[1:]])
            tables[DAILY_STATES] = summary_states(good, [*DAY_KEYS, "document", *by_load[1:]], day_summary())
            for name, table in tables.items():
                writes.append((write_loads, table, base, name) if by_load else (write_load, table, base, name, own))
        if found["rejected"]:
            rejected = staged.where(F.col("status") == QUARANTINED)
            kept = rejected.select(*VERSION, *DOCUMENT_KEYS, "reason", "text", F.now().alias("published"), *by_load[1:])
            writes.append((_write_by_loads, kept, base, QUARANTINE) if by_load else (_write_by_load, kept, base, QUARANTINE, own))
        if expected is not None and missing is not None:
            writes.append((_write_by_load, _missing(versions, expected), base, MISSING_TABLE, missing))
        _at_one_time(writes)
        manifest = mark_expected(versions, expected).withColumns(
            {
                "feed": F.lit(feed),
                "batch": batch,
                "replaces": F.lit(mode == REPLACE),
                "load": load,
                "published": F.now(),
            }
        )
        if by_load:
            _write_by_loads(manifest, base, MANIFEST)
        else:
            _write_by_load(manifest, base, MANIFEST, own)
    finally:
        drop_folder(spark, folder)


def _at_one_time(writes: list[tuple]) -> None:
    """Runs the writes in threads: each is a small job next to a cluster."""
    if not writes:
        return
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(write, *arguments) for write, *arguments in writes]:
            done.result()


def _missing(seen: DataFrame, expected: DataFrame) -> DataFrame:
    return missing_documents(seen.select("city", "run_date"), expected).select(*AUDIT_COLUMNS)


def _write_by_load(table: DataFrame, base: str, name: str, load_id: str) -> None:
    folder = store_path(base, name, f"load_id={load_id}")
    table.hint("rebalance").write.mode("overwrite").parquet(folder)


def _write_by_loads(table: DataFrame, base: str, name: str) -> None:
    """The rows of each load, which ``load_id`` names, in its own folder, which appears whole."""
    writer = table.hint("rebalance", "load_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load_id").parquet(store_path(base, name))


def report_missing_documents(spark: SparkSession, base: str, expected: DataFrame, load_id: str) -> None:
    """One audit row for each expected document of which no load has seen any version."""
    store = open_store(spark, base)
    _write_by_load(_missing(store.manifest, expected), base, MISSING_TABLE, load_id)


def short_name(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:12]


def load_run(
    spark: SparkSession,
    landing: str,
    base: str,
    layout: str = "object_key",
    run_date: str | None = None,
    cities: list[str] | None = None,
    expected: DataFrame | None = None,
    mode: str = APPEND,
    first_half_flag: bool = True,
    file_pattern: str = "*.json",
) -> None:
    """Load the documents of one run date, or of all, in one pass over all cities."""
    load_id = f"run-{run_date or 'all'}-{short_name(layout, landing, *sorted(cities or []))}"
    if mode == APPEND:
        load_id += f"-{uuid.uuid4().hex[:8]}"  # an appended load is always a new one
    with many_files_a_task(spark), kept_in_here(spark):
        rows = read_rows(spark, landing, layout, run_date, cities, file_pattern)
        publish_rows(rows, base, expected, mode, load_id, first_half_flag)


def read_audit(spark: SparkSession, base: str) -> DataFrame:
    """One row for each document that a load has read, and for each expected one that is missing."""
    store = open_store(spark, base)
    schema = "city string, run_date date, file string, status string, rows long, expected boolean, message string, load_id string"
    missing = existing(spark, store_path(base, MISSING_TABLE), schema)
    seen = spark.createDataFrame([], schema) if store is None else _last_times(store)
    return seen if missing is None else seen.unionByName(missing)


def _last_times(store: Store) -> DataFrame:
    """The manifests' rows of each load's last time."""
    times = store.manifest.groupBy("load").agg(F.max_by("load_id", F.struct("published", "load_id")).alias("load_id"))
    rows = store.manifest.join(times, ["load", "load_id"], "left_semi")
    return rows.select(*AUDIT_COLUMNS, F.col("load").alias("load_id"))
