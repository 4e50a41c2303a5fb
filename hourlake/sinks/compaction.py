"""Upkeep of the load store: many loads packed into one snapshot, and files dropped that nothing names.

Packing reads the rows that count and writes them again, sorted and in few files, with the load that each
row came from; so later loads replace documents in a snapshot as they do elsewhere. A row that is replaced
once never counts again, so snapshots need not keep it. The snapshot is committed by its pointer, written
last; a reader has one snapshot or the other, and a compaction that fails is not seen. Loads that commit in
the meantime are not in the snapshot and stay what they are.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.schema import HOUR_KEYS, HOURLY_TABLES, table_schema
from hourlake.sources.store import LOADS, MANIFEST, PACKED, QUARANTINE, SNAPSHOTS, open_store, store_path
from hourlake.sources.tables import DAILY_STATES, states_schema


def compact(spark: SparkSession, base: str) -> str | None:
    """Packs the loads below ``base`` into a new snapshot and returns its name; None without loads.

    Rows stay until a document is replaced; of the manifest and of the quarantine everything stays, in fewer
    files. Two compactions at one time do no harm: readers take the last, and ``drop_unused`` the other.
    """
    store = open_store(spark, base)
    if store is None:
        return None
    snapshot = f"{store.seq + 1:08d}-{uuid.uuid4().hex[:8]}"
    schemas: dict[str, T.StructType] = {name: table_schema(name) for name in HOURLY_TABLES}
    schemas[DAILY_STATES] = states_schema()
    packed = {name: _arranged(store.rows(name, schema)).write.partitionBy("date") for name, schema in schemas.items()}
    packed |= {name: rows.hint("rebalance").write for name, rows in {MANIFEST: store.manifest, QUARANTINE: store.quarantine()}.items()}
    # at one time, as loads write them: the end of one write leaves cores to the next
    with ThreadPoolExecutor(len(packed)) as pool:
        writes = [pool.submit(w.parquet, store_path(base, PACKED, snapshot, name)) for name, w in packed.items()]
    for done in writes:
        done.result()
    # one row a load since files were last dropped
    loads = store.manifest.select("load_id").distinct()
    pointer = loads.select(F.lit(store.seq + 1).cast("long").alias("seq"), "load_id", F.now().alias("taken"))
    pointer.coalesce(1).write.parquet(store_path(base, SNAPSHOTS, f"snapshot={snapshot}"))
    return snapshot


def _arranged(rows: DataFrame) -> DataFrame:
    order = ["date", *[c for c in HOUR_KEYS if c in rows.columns and c != "date"]]
    return rows.hint("rebalance", "date").sortWithinPartitions(*order)


def drop_unused(spark: SparkSession, base: str, older_than_hours: float = 24.0) -> int:
    """Deletes the folders of loads that the last snapshot has taken in, and of other snapshots.

    Readers that opened the store before the snapshot still use them: nothing is dropped before the snapshot
    is ``older_than_hours`` old. Folders of loads that have not committed are left alone. Returns the number of
    folders dropped.
    """
    store = open_store(spark, base)
    if store is None or store.snapshot is None:
        return 0
    pointer = spark.read.parquet(store_path(base, SNAPSHOTS, f"snapshot={store.snapshot}"))
    age = pointer.agg((F.unix_micros(F.now()) - F.unix_micros(F.max("taken"))) / 3.6e9).first()[0]
    if age < older_than_hours:
        return 0
    tables = [f"{LOADS}/{name}" for name in [*HOURLY_TABLES, DAILY_STATES]] + [MANIFEST, QUARANTINE]
    named = [store_path(base, t, f"load_id={load}") for load in store.taken_in for t in tables]
    for folder, prefix in ((PACKED, ""), (SNAPSHOTS, "snapshot=")):
        named += [p for p in _folders(spark, store_path(base, folder)) if not p.endswith(f"/{prefix}{store.snapshot}")]
    return sum(_delete(spark, path) for path in named)


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list[str]:
    target, system = _system(spark, path)
    return [s.getPath().toString() for s in system.listStatus(target) if s.isDirectory()]


def _delete(spark: SparkSession, path: str) -> int:
    target, system = _system(spark, path)
    return int(system.delete(target, True))


def stored_files(spark: SparkSession, base: str) -> int:
    """Files that the tables of the store are read from."""
    store = open_store(spark, base)
    schemas = {**{name: table_schema(name) for name in HOURLY_TABLES}, DAILY_STATES: states_schema()}
    frames = [f for name, schema in schemas.items() for f in store._parts(f"{LOADS}/{name}", name, schema.add("load_id", "string"))]
    paths = [f.select(F.col("_metadata.file_path").alias("path")).distinct() for f in frames]
    return reduce(DataFrame.unionByName, paths).count()
