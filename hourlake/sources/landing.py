"""Landing documents and lines.

Layout ``object_key``: one JSON array per file below ``city/year/month/day/``.
Layout ``hive``: JSON lines below ``city=/year=/month=/day=/``, where every line carries
its place in the document, so files may be split freely.

Both are parsed with the fixed schema, once. A row of an array gets its place from the array
itself, so numbering a document needs no exchange. One task reads a document whole, up to
``LARGE_BYTES``; larger ones are cut where their records end (see ``large_documents``).

Every document gives at least one row, with its ``status``: ``loaded`` rows are hours, and an
``empty`` or ``quarantined`` document has one row without an hour. Quarantined is what is not an
array of objects and nothing else, what has no city or run date, and what has an hour without a
date; such a document gives no hour at all, and its text is kept with the reason.
"""

from __future__ import annotations

import datetime
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.keys import city_of_path, glob_text, run_date_of_path, text_to_date
from hourlake.schema import landing_schema, line_schema
from hourlake.session import listed_by_few_tasks

DOCUMENT_KEYS = ["city", "run_date", "file"]
#: What tells a document, and one version of it, from others.
VERSION = ["document", "modified", "size"]

#: Documents of more bytes are read by several tasks.
LARGE_BYTES = 64 << 20

LOADED = "loaded"
EMPTY = "empty"
QUARANTINED = "quarantined"

UNPARSEABLE = "not a JSON document"
NOT_OBJECTS = "not an array of objects"
NOT_UTF8 = "not UTF-8 text"
NO_KEY = "no city or run date in the path"
NO_DATE = "hour without a date"
NO_PLACE = "line without a place in its document"

_DOCUMENT_ROW = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("file", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)


def read_landing(
    spark: SparkSession,
    path: str,
    layout: str = "object_key",
    run_date: datetime.date | str | None = None,
    cities: list[str] | None = None,
    file_pattern: str = "*.json",
) -> tuple[DataFrame, DataFrame]:
    """Hourly rows of good documents, and the rejected documents."""
    return split_rejected(read_rows(spark, path, layout, run_date, cities, file_pattern))


def read_rows(
    spark: SparkSession,
    path: str,
    layout: str = "object_key",
    run_date: datetime.date | str | None = None,
    cities: list[str] | None = None,
    file_pattern: str = "*.json",
) -> DataFrame:
    """Good and rejected rows in one frame, so that one scan serves both."""
    run_date = _as_date(run_date)
    if layout == "object_key":
        return _document_rows(spark, path, run_date, cities, file_pattern)
    if layout == "hive":
        return _parse_lines(_lines(spark, path, run_date, cities))
    raise ValueError(f"layout must be 'object_key' or 'hive', not {layout!r}")


def split_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows of one frame, which should be stored or cheap to read twice."""
    good = rows.where(F.col("status") == LOADED).drop("text", "reason", "status", *VERSION)
    bad = rows.where(F.col("status") == QUARANTINED)
    return good, bad.select("city", "run_date", "file", "text", "reason")


def parse_documents(documents: DataFrame) -> DataFrame:
    """Rows of documents given as ``city, run_date, file, text``, and their status.

    A value that is NULL, absent or of another type is NULL; the other values stay. Without the
    columns ``document``, ``modified`` and ``size`` a document is known by its file.
    """
    given = documents.columns
    versions = {
        "document": F.col("document") if "document" in given else F.col("file"),
        "modified": F.col("modified") if "modified" in given else F.lit(None).cast("timestamp"),
        "size": F.col("size") if "size" in given else F.octet_length("text").cast("long"),
    }
    # in an array of its own, anything after the document's array shows
    wrapped = F.concat(F.lit("["), F.col("text"), F.lit("]"))
    arrays = F.from_json(wrapped, T.ArrayType(T.ArrayType(landing_schema())))
    parsed = documents.withColumns(versions).withColumn("_arrays", arrays)
    hours = F.get("_arrays", F.lit(0))
    blank = ~F.col("text").rlike(r"\S")
    no_hour = F.lit(None).cast(T.ArrayType(landing_schema()))
    parsed = parsed.withColumn(
        "_hours", F.when(blank, F.array().cast(T.ArrayType(landing_schema()))).when(F.size("_arrays") == 1, hours).otherwise(no_hour)
    )
    opens = F.col("text").rlike(r"^\s*\[")
    reason = (
        F.when(F.col("text").isNull(), F.lit(NOT_UTF8))
        .when(F.col("city").isNull() | F.col("run_date").isNull(), F.lit(NO_KEY))
        .when(F.col("_hours").isNull() & ~opens & F.try_parse_json("text").isNotNull(), F.lit(NOT_OBJECTS))
        .when(F.col("_hours").isNull(), F.lit(UNPARSEABLE))
        .when(F.exists("_hours", lambda h: h.isNull()), F.lit(NOT_OBJECTS))
        .when(F.exists("_hours", lambda h: text_to_date(h["date"]).isNull()), F.lit(NO_DATE))
    )
    judged = parsed.withColumn("reason", reason)
    bad, size = F.col("reason").isNotNull(), F.size("_hours").cast("long")
    status = F.when(bad, F.lit(QUARANTINED)).when(size == 0, F.lit(EMPTY)).otherwise(F.lit(LOADED))
    sized = judged.withColumn("status", status).withColumn("_loaded", F.col("status") == LOADED)
    rows = sized.select(
        *DOCUMENT_KEYS,
        *VERSION,
        "status",
        F.when(bad, F.col("text")).alias("text"),
        "reason",
        F.when(F.col("_loaded"), size).alias("doc_rows"),
        "_loaded",
        # a document without hours keeps one row
        F.posexplode(
            F.when(F.col("_loaded"), F.col("_hours")).otherwise(F.array(F.lit(None).cast(landing_schema())))
        ).alias("_pos", "_hour"),
    )
    return rows.select(
        *DOCUMENT_KEYS,
        *VERSION,
        "status",
        "text",
        "reason",
        F.when(F.col("_loaded"), F.col("_pos").cast("long")).alias("pos"),
        "doc_rows",
        "_hour.*",
    )


def document_columns(path: Column) -> list[Column]:
    return [
        city_of_path(path).alias("city"),
        run_date_of_path(path).alias("run_date"),
        path.alias("file"),
        path.alias("document"),
    ]


def listed_versions(files: DataFrame) -> DataFrame:
    """(document, modified, size) of all files of a frame of binary files, those without bytes included."""
    read = read_versions(files)
    empty = empty_versions(files, read)
    return read if empty is None else read.unionByName(empty)


def read_versions(files: DataFrame) -> DataFrame:
    """(document, modified, size) of the files that have bytes."""
    return files.select(
        F.col("_metadata.file_path").alias("document"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )


def empty_versions(files: DataFrame, read: DataFrame) -> DataFrame | None:
    """Versions of the files without bytes, which Spark lists but does not read; None if there is none.

    The listing stays in the JVM, where Spark's index has it; Python sees the paths of empty files only, and
    asks the file system for their times.
    """
    spark = files.sparkSession
    listed = files._jdf.inputFiles()  # a reference to the JVM's array
    if len(listed) == read.count():
        return None
    strings = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(listed)
    paths = DataFrame(
        spark._jsparkSession.createDataset(strings, spark._jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark
    )
    # an empty authority is written in one of two ways; rows of files have the shorter one
    named = paths.select(F.regexp_replace("value", r"^([A-Za-z0-9.+-]+):///", "$1:/").alias("document"))
    found = []
    for row in named.join(read, "document", "left_anti").collect():
        status = _file_status(spark, row["document"])
        if status is not None and status.getLen() == 0:
            found.append((row["document"], status.getModificationTime()))
    if not found:
        return None
    versions = spark.createDataFrame(found, "document string, millis long")
    return versions.select("document", F.timestamp_millis("millis").alias("modified"), F.lit(0).cast("long").alias("size"))


def _file_status(spark: SparkSession, document: str):
    """What the file system says of a file; None if it is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(document))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        return system.getFileStatus(path)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.io.FileNotFoundException":
            raise
        return None


def only_files(files: DataFrame, documents: list[str]) -> DataFrame:
    """The rows of the named files; the condition reaches the index, so no other file is read."""
    quoted = ("'" + d.replace("\\", "\\\\").replace("'", "\\'") + "'" for d in documents)
    # as text: a column per name takes far longer to make
    return files.where(f"_metadata.file_path IN ({', '.join(quoted)})") if documents else files.where("false")


def empty_documents(versions: DataFrame) -> DataFrame:
    """The documents among ``versions`` that have no bytes."""
    return versions.where("size = 0").select(
        *document_columns(F.col("document")), "modified", "size", F.lit("").alias("text")
    )


def documents_in(files: DataFrame) -> DataFrame:
    """Documents of a frame of binary files; a file that is no UTF-8 has no text."""
    return files.select(
        *document_columns(F.col("_metadata.file_path")),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("text"),
    )


def file_paths(documents: list[str]) -> list[str]:
    """Paths that a reader takes for the named files and no others."""
    return [glob_text(unquote(d)) for d in documents]


def binary_files(spark: SparkSession, root: str, pattern: str) -> DataFrame | None:
    """The files below ``root``; None where there is no such folder."""
    try:
        return _binary_reader(spark, pattern).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def named_files(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """The files of ``file_paths``, which must be there: no other is listed or opened."""
    with listed_by_few_tasks(spark):
        return _binary_reader(spark, pattern).load(paths)


def _binary_reader(spark: SparkSession, pattern: str):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern)


def _document_rows(spark, path, run_date, cities, pattern) -> DataFrame:
    # a pattern only as far as a choice needs one; below it, listing is distributed
    root = path.rstrip("/")
    if cities or run_date:
        root += "/" + _either("city", cities) if cities else "/*"
    if run_date:
        day = {"year": run_date.year, "month": run_date.month, "day": run_date.day}
        root += "".join("/" + _either(name, [str(value)]) for name, value in day.items())
    files = binary_files(spark, root, pattern)
    if files is None:
        return parse_documents(spark.createDataFrame([], _DOCUMENT_ROW))
    empty = empty_versions(files, files.select(F.col("_metadata.file_path").alias("document")))
    return rows_of_files(files, root, None if empty is None else empty_documents(empty), pattern=pattern)


def rows_of_files(
    files: DataFrame,
    root: str | list[str],
    empty: DataFrame | None = None,
    large_bytes: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Rows of the documents of a frame of binary files below ``root``, and of ``empty`` documents.

    ``root`` is a folder or pattern, or the files of the frame, as ``file_paths`` has them.
    """
    from hourlake.sources.large_documents import read_large_documents

    most = LARGE_BYTES if large_bytes is None else large_bytes
    # a condition on the listing: files are chosen before any is opened, and none is named
    size = F.col("_metadata.file_size")
    large = files.where(size > most)
    some = not large.select("length").isEmpty()
    small = documents_in(files.where(size <= most) if some else files)
    rows = parse_documents(small if empty is None else small.unionByName(empty))
    return rows.unionByName(read_large_documents(large, root, most, pattern)) if some else rows


def _lines(spark, path, run_date, cities) -> DataFrame:
    schema = "value string, city string, year int, month int, day int"
    lines = spark.read.schema(schema).text(path)
    # conditions on partition columns: other folders are not read
    if run_date:
        lines = lines.where(
            (F.col("year") == run_date.year)
            & (F.col("month") == run_date.month)
            & (F.col("day") == run_date.day)
        )
    if cities:
        lines = lines.where(F.col("city").isin(*cities))
    return lines.select(
        "city",
        F.try_to_date(F.concat_ws("-", "year", "month", "day"), "yyyy-M-d").alias("run_date"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("text"),
    )


def _parse_lines(lines: DataFrame) -> DataFrame:
    corrupt = T.StructField("_corrupt", T.StringType())
    schema = T.StructType(line_schema().fields + [corrupt])
    hour = F.from_json("text", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.withColumn("_hour", hour)
    reason = (
        F.when(F.col("city").isNull() | F.col("run_date").isNull(), F.lit(NO_KEY))
        .when(F.col("_hour._corrupt").isNotNull() | F.col("_hour").isNull(), F.lit(UNPARSEABLE))
        .when(F.col("_hour.pos").isNull() | F.col("_hour.doc_rows").isNull(), F.lit(NO_PLACE))
        .when(text_to_date(F.col("_hour.date")).isNull(), F.lit(NO_DATE))
    )
    judged = parsed.withColumn("reason", reason)
    # the lines of a document may be in several files
    document = F.concat_ws("/", "city", F.col("run_date").cast("string"))
    return judged.select(
        "city",
        "run_date",
        "file",
        document.alias("document"),
        "modified",
        "size",
        F.when(F.col("reason").isNull(), F.lit(LOADED)).otherwise(F.lit(QUARANTINED)).alias("status"),
        F.when(F.col("reason").isNotNull(), F.col("text")).alias("text"),
        "reason",
        *[F.col(f"_hour.{f.name}").alias(f.name) for f in line_schema().fields],
    )


def _as_date(run_date: datetime.date | str | None) -> datetime.date | None:
    return datetime.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date


def _either(name: str, values: list[str]) -> str:
    """A pattern for folders called as one of the values, with or without ``name=``."""
    texts = [glob_text(v) for v in values]
    return "{" + ",".join([*texts, *(f"{name}={t}" for t in texts)]) + "}"
