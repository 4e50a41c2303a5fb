"""The load store: what loads have written, and which of it counts.

A load writes rows in folders of its own and commits with a manifest of the versions of documents that it has
read. A snapshot (``sinks.compaction``) holds the rows of many loads in few files, and names the loads it has
taken in. A reader takes the last snapshot and the loads that it does not name, all resolved once, when the store
is opened; what commits later is not seen.

Versions of a document are ordered by what they are (time of the file, then size) and only then by when they
were committed, so a slow load of an old version does not take the place of a newer one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.keys import glob_text
from hourlake.session import folder_exists

LOADS, MANIFEST, QUARANTINE = "loads", "load_manifest", "load_quarantine"
SNAPSHOTS, PACKED = "load_snapshots", "packed"

MANIFEST_SCHEMA = (
    "document string, modified timestamp, size long, city string, run_date date, file string, status string, "
    "message string, rows long, expected boolean, feed string, batch int, replaces boolean, load string, "
    "published timestamp, load_id string"
)
QUARANTINE_SCHEMA = (
    "document string, modified timestamp, size long, city string, run_date date, file string, reason string, "
    "text string, published timestamp, load_id string"
)
_POINTER = "seq long, load_id string, taken timestamp, snapshot string"


def store_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """Parquet files of a known schema; None where there is no such folder."""
    return spark.read.schema(schema).parquet(path) if folder_exists(spark, path) else None


@dataclass
class Store:
    """The store as it was when it was opened."""

    spark: SparkSession
    base: str
    seq: int
    snapshot: str | None
    #: Loads that the snapshot has taken in and whose own folders may still be there.
    taken_in: list[str]
    manifest: DataFrame

    def _parts(self, own: str, packed: str, schema) -> list[DataFrame]:
        found = []
        live = existing(self.spark, store_path(self.base, own), schema)
        if live is not None:
            # a condition on the folders' names: those of other loads are not listed as files to read
            found.append(live.where(~F.col("load_id").isin(self.taken_in)) if self.taken_in else live)
        if self.snapshot is not None:
            old = existing(self.spark, store_path(self.base, PACKED, self.snapshot, packed), schema)
            found += [old] if old is not None else []
        return found

    def all_rows(self, own: str, packed: str, schema) -> DataFrame:
        parts = self._parts(own, packed, schema)
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    @cached_property
    def current(self) -> DataFrame:
        return current_versions(self.manifest)

    def rows(self, name: str, schema: T.StructType) -> DataFrame:
        """The rows of a table that count, with ``document`` and ``load_id``."""
        schema = T.StructType([*schema.fields, T.StructField("document", T.StringType()), T.StructField("load_id", T.StringType())])
        written = self.all_rows(f"{LOADS}/{name}", name, schema)
        # a manifest row per document and load; small next to the hours, and Spark sees how small
        return written.join(self.current, ["document", "load_id"], "left_semi").select(*schema.names)

    def quarantine(self) -> DataFrame:
        return self.all_rows(QUARANTINE, QUARANTINE, QUARANTINE_SCHEMA)


def open_store(spark: SparkSession, base: str) -> Store | None:
    """The store below ``base``, or None before the first load."""
    pointers = existing(spark, store_path(base, SNAPSHOTS), _POINTER)
    last = None if pointers is None else pointers.agg(F.max(F.struct("seq", "snapshot")).alias("last")).first()["last"]
    seq, snapshot, taken_in = 0, None, []
    if last is not None:
        seq, snapshot = last["seq"], last["snapshot"]
        # loads since files were last dropped
        named = pointers.where((F.col("snapshot") == snapshot) & F.col("load_id").isNotNull())
        taken_in = [r["load_id"] for r in named.select("load_id").collect()]
    store = Store(spark, base, seq, snapshot, taken_in, None)
    parts = store._parts(MANIFEST, MANIFEST, MANIFEST_SCHEMA)
    if not parts:
        return None
    store.manifest = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return store


def load_committed(spark: SparkSession, base: str, load: str, feed: str, batch: int) -> bool:
    """Whether a batch of a feed has its manifest; of other loads since the last snapshot, none is opened."""
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{glob_text(store_path(base, MANIFEST))}/load_id={glob_text(load)}-*/part-*")
    if len(own.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(own) or []):
        return True
    if not folder_exists(spark, store_path(base, SNAPSHOTS)):
        return False
    store = open_store(spark, base)
    return store is not None and not store.manifest.where((F.col("feed") == feed) & (F.col("batch") == batch)).isEmpty()


def version_order() -> Column:
    """What orders the versions of a document: what they are, then when they were committed."""
    return F.struct("modified", "size", "published", "load_id")


def current_versions(manifest: DataFrame) -> DataFrame:
    """(document, load_id) whose rows count: of a document's newest replacing version, and appended after it.

    A quarantined version replaces nothing: what was published stays. A document in several files has
    the version of its newest file.
    """
    known = manifest.where("status <> 'quarantined'").groupBy("document", "load_id").agg(
        F.max(version_order()).alias("order"), F.bool_or("replaces").alias("replaces")
    )
    last = known.groupBy("document").agg(
        F.max(F.when(F.col("replaces"), F.col("order"))).alias("since")
    )
    return (
        known.join(last, "document")
        .where(F.col("since").isNull() | (F.col("order") >= F.col("since")))
        .select("document", "load_id")
    )
