"""Rejected documents: what they were, why they were rejected, and their replay once they are mended."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.plans.load import publish_rows
from hourlake.session import drop_folder, write_aside
from hourlake.sinks.tables import REPLACE
from hourlake.sources.landing import VERSION, parse_documents
from hourlake.sources.store import QUARANTINE_SCHEMA, open_store

QUARANTINE_COLUMNS = ["city", "run_date", "file", *VERSION, "reason", "text"]


def read_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """Rejected documents (or lines) with their text and reason, and whether they are ``open``.

    A rejected version is no longer open when it, or a newer version of its document, has been loaded since. A
    version that was rejected several times is there once, with the last reason.
    """
    store = open_store(spark, base)
    if store is None:
        empty = spark.createDataFrame([], QUARANTINE_SCHEMA)
        return empty.select(*QUARANTINE_COLUMNS, F.lit(False).alias("open"))
    rejected = store.quarantine()
    # uncommitted loads have no manifest
    times = store.manifest.where("status = 'quarantined'").groupBy(*VERSION).agg(
        F.max_by(F.struct("load_id", "published"), F.struct("published", "load_id")).alias("last")
    )
    last = times.select(
        *[F.col(c).alias(f"_{c}") for c in VERSION], F.col("last.load_id").alias("_load_id"), F.col("last.published").alias("rejected")
    )
    known = store.manifest.where("status <> 'quarantined'").groupBy(F.col("document").alias("_known")).agg(
        F.max(F.struct("modified", "size", "published")).alias("_accepted")
    )
    # documents that came without files have no time
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*VERSION, "load_id"]])
    rows = rejected.drop("published").join(last, same)
    rows = rows.join(known, F.col("document") == F.col("_known"), "left")
    accepted = F.col("_accepted") > F.struct("modified", "size", F.col("rejected").alias("published"))
    return rows.select(*QUARANTINE_COLUMNS, (~F.coalesce(accepted, F.lit(False))).alias("open"))


def replay_quarantine(
    spark: SparkSession, base: str, mend: Callable[[DataFrame], DataFrame] | None = None,
    first_half_flag: bool = True,
) -> None:
    """Loads the open documents of the quarantine again, with the texts that ``mend`` gives them.

    ``mend`` gets the open rows and returns those that should be tried, with ``city``, ``run_date``,
    ``file`` and the version as they are; without it, documents are tried as they are, which helps after the
    reader has learned something. What is loaded supersedes the rejected version, as the same version of the
    document committed later; what is rejected again stays in quarantine. Lines are not replayed: a line
    that is landed again comes with its document.
    """
    rows = read_quarantine(spark, base)
    open_ = rows.where(F.col("open") & (F.col("document") == F.col("file"))).drop("open")
    tried, folder = write_aside(mend(open_) if mend else open_, "replay")
    try:
        if not tried.isEmpty():
            documents = parse_documents(tried.drop("reason"))
            load_id = f"replay-{uuid.uuid4().hex[:12]}"
            publish_rows(documents, base, mode=REPLACE, load_id=load_id, first_half_flag=first_half_flag)
    finally:
        drop_folder(spark, folder)
