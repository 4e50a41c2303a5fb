"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a daily load writes few dates; let AQE split the ones that are too large
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # no Python call site per column expression: it costs more than small queries do
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoints go when nothing uses them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: What opening a document counts as, in bytes: some hundreds of small ones make a task.
OPEN_COST = 256 << 10


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session
    without it is refused, because other machines could not read a local folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context.getCheckpointDir() is not None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="hourlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def listed_by_few_tasks(spark: SparkSession):
    """Lists of files, of a reader or a stream that runs in here, are made by a task a core, not by one a file."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(min(before, max(2, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


@contextmanager
def many_files_a_task(spark: SparkSession):
    """Scans that run in here give a task many small files.

    By default opening a file counts as 4 MB, so a task gets 32 files however small they are: tasks, and the
    blocks of an exchange after them, grow with the number of files. Cores are kept busy all the same, and a
    value that the session has been given stays.
    """
    name = "spark.sql.files.openCostInBytes"
    given = spark.conf.get(name, None) is not None
    if not given:
        spark.conf.set(name, str(OPEN_COST))
    try:
        yield
    finally:
        if not given:
            spark.conf.unset(name)


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps what it stores between its steps."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the application's folder."""
    return f"{application_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def write_aside(frame: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``frame`` stored in the shared folder and read again, and the folder to drop afterwards."""
    path = fresh_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


_KEPT: ContextVar[list[str] | None] = ContextVar("kept", default=None)


def write_to_keep(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` stored and read again, for what is made of it: kept up to the end of ``kept_in_here``.

    Outside of that it is kept until the application's folder is dropped.
    """
    stored, folder = write_aside(frame, purpose)
    kept = _KEPT.get()
    if kept is not None:
        kept.append(folder)
    return stored


@contextmanager
def kept_in_here(spark: SparkSession):
    """What this thread stores to keep is dropped at the end."""
    kept: list[str] = []
    token = _KEPT.set(kept)
    try:
        yield
    finally:
        _KEPT.reset(token)
        for folder in kept:
            drop_folder(spark, folder)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh_folder`` named, wherever it is stored.

    ``application_folder`` may be dropped when no result of this application is needed any more.
    """
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
