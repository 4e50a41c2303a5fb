"""Hourly rows as JSON lines below city, year, month and day; single documents under their key."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.keys import DOCUMENT_NAME, iso_text
from hourlake.schema import line_schema
from hourlake.session import shuffle_partitions

PARTITIONS = ["city", "year", "month", "day"]
LINES_PER_FILE = 100_000


def write_landing(df: DataFrame, path: str) -> None:
    """Write rows with ``city``, ``run_date``, ``pos`` and ``doc_rows``.

    A second write replaces the folders it has rows for and leaves the others alone.
    """
    missing = {"city", "run_date", "pos", "doc_rows"} - set(df.columns)
    if missing:
        raise ValueError(f"landing rows lack {sorted(missing)}")
    fields = {
        f.name: F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)
        for f in line_schema().fields
    }
    if isinstance(df.schema["date"].dataType, T.TimestampType):
        fields["date"] = iso_text(F.col("date"))
    lines = df.select(
        "city",
        F.year("run_date").alias("year"),
        F.month("run_date").alias("month"),
        F.dayofmonth("run_date").alias("day"),
        *[value.alias(name) for name, value in fields.items()],
    )
    # One task and file per folder, but a folder with very many lines is cut by place, so
    # that no task gets all of it. The number of tasks is fixed, as it does not change the
    # number of files, and opening many small files takes longer than writing them.
    piece = F.floor(F.col("pos") / LINES_PER_FILE)
    (
        lines.repartition(shuffle_partitions(df.sparkSession), *PARTITIONS, piece)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .json(path)
    )


def write_files(texts: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Write each ``text`` and a line end as the file ``name``, below ``path`` and folders of ``partitions``.

    Names must be unique in a folder and stay the same when a task is run again. Below a mounted path tasks
    write the files themselves, and a file gets its name when it is whole: for each file that Hadoop makes there it
    starts processes that set permissions, and the driver renames all of them, one by one. On other file
    systems Spark writes a file a row.
    """
    partitions = partitions or []
    spark = texts.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() == "file":
        system.mkdirs(target)
        texts.select(*partitions, "name", "text").foreachPartition(_file_writer(target.toUri().getPath(), partitions))
        return
    # a fixed number of tasks; see write_landing
    spread = texts.select(*partitions, "text").repartition(
        shuffle_partitions(spark), *partitions, F.xxhash64("text")
    )
    spread.write.option("maxRecordsPerFile", 1).mode("append").partitionBy(*partitions).text(path)


def _file_writer(root: str, partitions: list[str]):
    """What writes the rows of a task; as a closure it needs no module of this package."""

    def write(rows) -> None:
        import os
        import re
        import uuid

        def folder_part(name: str, value) -> str:
            # as Spark names folders
            text = "" if value is None else str(value)
            text = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", text)
            return f"{name}={text or '__HIVE_DEFAULT_PARTITION__'}"

        made = set()
        for row in rows:
            folder = "/".join([root, *(folder_part(p, row[p]) for p in partitions)])
            if folder not in made:
                os.makedirs(folder, exist_ok=True)
                made.add(folder)
            begun = f"{folder}/.{uuid.uuid4().hex}.tmp"
            with open(begun, "wb") as out:
                out.write((row["text"] + "\n").encode())
            os.replace(begun, f"{folder}/{row['name']}")

    return write


def put_document(
    spark: SparkSession,
    path: str,
    city: str,
    run_date: datetime.date,
    text: str,
    modified: datetime.datetime | None = None,
) -> str:
    """Write one document under its key, in place of an earlier version; returns its path.

    ``modified`` sets the time of the file, as a copy that keeps times does.
    """
    key = f"{city}/{run_date.year}/{run_date.month}/{run_date.day}/{DOCUMENT_NAME}"
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{key}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if modified is not None:
        system.setTimes(target, int(modified.timestamp() * 1000), -1)
    return target.toString()
