"""Documents as a stream: new files are taken some thousands at a time, each batch of them as a load of its own."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.plans.load import publish_batches, publish_rows, short_name
from hourlake.session import drop_folder, listed_by_few_tasks, many_files_a_task, write_aside
from hourlake.sinks.tables import REPLACE
from hourlake.sources.landing import documents_in, file_paths, named_files, parse_documents, read_versions
from hourlake.sources.store import open_store

_FILES = "path string, modificationTime timestamp, length long, content binary"
#: Files whose batches are published by the same jobs; of these groups, a micro-batch has some, that run at one time.
FILES_TOGETHER, GROUPS, GROUPS_AT_ONCE = 5_000, 8, 4


def stream_load(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    mode: str = REPLACE,
    files_per_batch: int = 1_000,
    file_pattern: str = "*.json",
    first_half_flag: bool = True,
    published: Callable[[int], None] | None = None,
) -> None:
    """Publish the documents that have arrived below ``landing`` since the checkpoint, and stop.

    A batch is at most ``files_per_batch`` documents and a load of its own, with its own manifest. A micro-batch has
    many batches: those that have ``FILES_TOGETHER`` files together share their jobs (``publish_batches``); the first
    batch of a call goes alone. Batches are numbered on from those that the manifests of this stream have.

    A micro-batch that is run again, because the query ended before it was noted, finds the documents that
    manifests have and loads the others only, so nothing is loaded twice; a batch that failed half-way has no
    manifest and is loaded whole. ``published`` is called after each batch with its number, in their order; the last
    one that it returned from is noted beside the checkpoint.

    The source takes a path once: here a new version of a document is a new file. Where a key is written
    again, or documents without bytes mean something, use ``incremental_load``, which compares versions.
    """
    feed = short_name("stream", checkpoint)
    notes = _Notes(spark, f"{checkpoint.rstrip('/')}/published")
    number, earlier, folder = _loaded_before(spark, base, feed)
    alone, together = True, files_per_batch * max(1, FILES_TOGETHER // files_per_batch)

    def load(documents: list[str], batch: int) -> None:
        rows = parse_documents(documents_in(named_files(spark, file_paths(documents), file_pattern)))
        firsts = documents[::files_per_batch]
        if len(firsts) > 1:
            publish_batches(rows, base, None, mode, f"stream-{feed}", first_half_flag, feed, batch, firsts)
        else:
            publish_rows(rows, base, None, mode, f"stream-{feed}-{batch}", first_half_flag, feed, batch)

    def note(batch: int) -> None:
        if published is not None and batch > notes.last:
            published(batch)
            notes.write(batch)

    def done(group: Future, batches: range) -> None:
        group.result()
        for batch in batches:
            note(batch)

    def publish(versions: DataFrame, _: int) -> None:
        nonlocal number, alone
        # in the order of their paths, so that a batch has few dates to write
        documents = sorted(r["document"] for r in versions.select("document").collect())
        if earlier is not None:
            taken = spark.createDataFrame([(d,) for d in documents], "document string")
            known = {r["document"]: r["batch"] for r in earlier.join(taken, "document", "left_semi").collect()}
            for batch in sorted(set(known.values())):
                note(batch)
            documents = [d for d in documents if d not in known]
        groups = [documents[:files_per_batch]] if alone else []
        rest = documents[files_per_batch:] if alone else documents
        groups += [rest[i : i + together] for i in range(0, len(rest), together)]
        with ThreadPoolExecutor(GROUPS_AT_ONCE) as pool:
            running = []
            for own in filter(None, groups):
                batches = range(number, number + -(-len(own) // files_per_batch))
                running.append((pool.submit(load, own, number), batches))
                number = batches.stop
                if alone or len(running) == GROUPS_AT_ONCE:
                    done(*running.pop(0))
                alone = False
            for group in running:
                done(*group)

    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_pattern)
        .option("maxFilesPerTrigger", GROUPS * together)
        .option("maxCachedFiles", 2 * GROUPS * together)
        .load(landing)
    )
    # without their content, which the loads read
    writer = (
        read_versions(files)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    try:
        # each micro-batch lists its files by name
        with listed_by_few_tasks(spark), many_files_a_task(spark):
            writer.start().awaitTermination()
    finally:
        if folder is not None:
            drop_folder(spark, folder)


def _loaded_before(spark: SparkSession, base: str, feed: str) -> tuple[int, DataFrame | None, str | None]:
    """The number of the next batch, the documents and batches that manifests have, and the folder these are in."""
    store = open_store(spark, base)
    if store is None:
        return 0, None, None
    own = store.manifest.where(F.col("feed") == feed).select("document", "batch")
    earlier, folder = write_aside(own.hint("rebalance"), "earlier")
    last = earlier.agg(F.max("batch")).first()[0]
    if last is None:
        drop_folder(spark, folder)
        return 0, None, None
    return last + 1, earlier, folder


class _Notes:
    """A number that is kept as the name of a file."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(folder)
        self._system = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found = self._system.listStatus(self._folder) if self._system.exists(self._folder) else []
        self.last = max((int(s.getPath().getName()) for s in found), default=-1)

    def write(self, number: int) -> None:
        self._system.create(self._path(self._folder, str(number)), True).close()
        if self.last >= 0:
            self._system.delete(self._path(self._folder, str(self.last)), False)
        self.last = number
