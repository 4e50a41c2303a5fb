"""Load the documents that arrived since the last load."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hourlake.plans.load import publish_batches, publish_rows, report_missing_documents, short_name
from hourlake.session import drop_folder, kept_in_here, listed_by_few_tasks, many_files_a_task, write_aside
from hourlake.sinks.tables import REPLACE
from hourlake.sources.landing import (
    VERSION,
    binary_files,
    empty_documents,
    empty_versions,
    file_paths,
    named_files,
    read_versions,
    rows_of_files,
)
from hourlake.sources.store import open_store

#: Files that are named to the scan at a time, where not all that are there have arrived.
FILES_AT_ONCE = 5_000
#: What is published at one time, batches or groups of them: each is small next to a cluster, and none meets another.
LOADS_AT_ONCE = 4
#: Where batches are many, so many groups at least are made of them; a group is published by the same jobs.
GROUPS = 16


def incremental_load(
    spark: SparkSession,
    landing: str,
    base: str,
    progress: str,
    mode: str = REPLACE,
    expected: DataFrame | None = None,
    files_per_batch: int | None = None,
    file_pattern: str = "*.json",
    first_half_flag: bool = True,
) -> None:
    """Publish new documents below ``landing`` and stop when none is left.

    A version of a document is its path, time and size: the listing is joined to the versions
    that the manifests of this feed (``progress`` names it) have, so a document that is put again
    is read again, and no age matters. A load that fails has no manifest, is not seen and is done again;
    nothing is published twice. ``files_per_batch`` is how many documents a load reads and has no
    influence on the result; a scan lists and opens the files of its batches and no others. Where batches are
    many, each is still a load of its own, but as many as have ``FILES_AT_ONCE`` files together share their jobs
    (``publish_batches``). Up to ``LOADS_AT_ONCE`` of these groups are published at one time. What is missing of
    ``expected`` is reported once, after all documents have been seen.
    """
    feed = short_name(progress)
    store = open_store(spark, base)
    files = binary_files(spark, landing, file_pattern)
    if files is not None:
        with many_files_a_task(spark):
            batch = 0
            # one pass over the files; the versions without bytes are what it has not seen
            read, folder = write_aside(read_versions(files).hint("rebalance"), "listed")
            folders = [folder]
            try:
                empty = empty_versions(files, read)
                arrivals = read if empty is None else read.unionByName(empty)
                if store is not None:
                    own = store.manifest.where(F.col("feed") == feed)
                    batch = own.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]
                    new = arrivals.join(own.select(*VERSION).distinct(), VERSION, "left_anti")
                    arrivals, folder = write_aside(new.hint("rebalance"), "arrivals")
                    folders.append(folder)
                groups = _groups(arrivals, store is None, files_per_batch)

                def rows(group: list[Row] | None) -> DataFrame:
                    return rows_of_files(*_files(files, landing, arrivals, group, file_pattern))

                def publish(group: list[Row], batch: int) -> None:
                    firsts = [r["document"] for r in group[::files_per_batch]]
                    load_id = f"batch-{feed}"
                    with kept_in_here(spark):
                        publish_batches(rows(group), base, expected, mode, load_id, first_half_flag, feed, batch, firsts)

                # for all files that are named in here
                with listed_by_few_tasks(spark), kept_in_here(spark), ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
                    running = []
                    for group, count in groups:
                        if count > 1:
                            running.append(pool.submit(publish, group, batch))
                        else:
                            arguments = base, expected, mode, f"batch-{feed}-{batch}", first_half_flag, feed, batch
                            running.append(pool.submit(publish_rows, rows(group), *arguments, report_missing=False))
                        batch += count
                        if len(running) == LOADS_AT_ONCE:
                            running.pop(0).result()
                    for load in running:
                        load.result()
            finally:
                for folder in folders:
                    drop_folder(spark, folder)
    if expected is not None and open_store(spark, base) is not None:
        report_missing_documents(spark, base, expected, f"missing-{feed}")


def _groups(arrivals: DataFrame, all_files: bool, files_per_batch: int | None) -> Iterator[tuple[list[Row] | None, int]]:
    """Versions of the batches that are published together, and the number of these; no versions are all at once."""
    count = arrivals.count()
    if not count:
        return
    if all_files and files_per_batch is None:
        yield None, 1
        return
    size = files_per_batch or FILES_AT_ONCE
    together = max(1, min(FILES_AT_ONCE // size, -(-count // size) // GROUPS))
    # in the order of their paths, so that a batch has few dates to write; a part of the names comes at a time
    ordered = arrivals.orderBy("document").toLocalIterator()
    while group := list(islice(ordered, size * together)):
        yield group, -(-len(group) // size)


def _files(
    files: DataFrame, landing: str, arrivals: DataFrame, group: list[Row] | None, pattern: str
) -> tuple[DataFrame, str | list[str], DataFrame]:
    """Files of a group, where they are, and documents without bytes: of all at once, or those that are named."""
    if group is None:
        return files, landing, empty_documents(arrivals)
    paths = file_paths([r["document"] for r in group if r["size"]])
    blank = [r["document"] for r in group if not r["size"]]
    own = named_files(files.sparkSession, paths, pattern) if paths else files.where("false")
    empty = arrivals.where(F.col("document").isin(blank)) if blank else arrivals.where("false")
    return own, paths or landing, empty_documents(empty)
