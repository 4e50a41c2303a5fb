"""Large landing documents, each read by many tasks.

A document is one JSON array of objects. Its file is read as text that is cut after every ``}``, which any
task can do from anywhere in the file. Most pieces are one record; where braces are in strings or in nested
values, a record is several. What a piece needs to know of those before it are sums: quotes, for whether it
begins in a string; braces, for how deep; and records, for its place. Each sum is taken within a block of
the file, and the blocks' totals, which are few, give where it begins. So no task has more than a block of
text, or a record.

The pieces are stored when the files have been read, and so are the records that they make: there may be as many
files as a listing can hold, and a scan of them takes as much of the driver's memory again, each time it is in a plan.

The rows, their places and their verdicts are those of ``landing.parse_documents``, but for the text of a
rejected document: it is that of the first part that is wrong, and not of the whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.keys import text_to_date
from hourlake.schema import landing_schema
from hourlake.session import drop_folder, many_files_a_task, write_aside, write_to_keep
from hourlake.sources import landing

_BLOCK = ["file", "block"]


def read_large_documents(files: DataFrame, root: str | list[str], more_than: int, pattern: str | None = None) -> DataFrame:
    """Rows of the documents of ``files``, which are those below ``root`` of more than so many bytes.

    Files are chosen by size and ``pattern``, which need the listing only; what else there may be drops out when
    records meet ``files``. No list of names is made, so there may be any number.
    """
    spark = files.sparkSession
    with many_files_a_task(spark):
        listed = files.select(
            *landing.document_columns(F.col("_metadata.file_path")),
            F.col("modificationTime").alias("modified"),
            F.col("length").alias("size"),
        )
        listed = write_to_keep(listed, "listed")
        pieces = _pieces_of(files)
        if pieces is None:
            pieces = _pieces(spark, root, pattern)
        pieces = pieces.where(F.col("_metadata.file_size") > more_than).select(*_columns())
        pieces, folder = write_aside(pieces, "pieces")
    try:
        records = write_to_keep(_records(_numbered(pieces)), "records")
    finally:
        drop_folder(spark, folder)
    return _parsed(records, listed)


def _pieces_of(files: DataFrame) -> DataFrame | None:
    """The pieces of the files that a frame has listed, out of that listing; None if it is no frame of one listing."""
    spark = files.sparkSession
    leaves = files._jdf.queryExecution().analyzed().collectLeaves()
    classes = spark._jvm.org.apache.spark.sql.execution.datasources
    leaf = leaves.head()
    if leaves.size() > 1 or leaf.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = leaf.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    options = spark._jvm.org.apache.spark.api.python.PythonUtils.toScalaMap({"lineSep": "}"})
    text = T.StructType([T.StructField("value", T.StringType())]).json()
    text = spark._jsparkSession.parseDataType(text)
    pieces = classes.HadoopFsRelation(
        relation.location(),
        relation.partitionSchema(),
        text,
        relation.bucketSpec(),
        classes.text.TextFileFormat(),
        options,
        spark._jsparkSession,
    )
    return DataFrame(spark._jsparkSession.baseRelationToDataFrame(pieces), spark)


def _pieces(spark: SparkSession, root: str | list[str], pattern: str | None = None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "}")
    return (reader if pattern is None else reader.option("pathGlobFilter", pattern)).text(root)


def _columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # only the order within a block counts
        F.monotonically_increasing_id().alias("order"),
        F.col("value").alias("piece"),
    ]


def _before(frame: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the pieces of the file that come before."""
    within = Window.partitionBy(*_BLOCK).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # a row a block
    blocks = frame.groupBy(*_BLOCK).agg(F.sum(value).alias("_total"))
    blocks = blocks.select(*_BLOCK, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    own = F.coalesce(F.sum(value).over(within), F.lit(0))
    return frame.withColumn(name, own).join(blocks, _BLOCK).withColumn(name, F.col(name) + F.col("_offset")).drop("_offset")


def _numbered(pieces: DataFrame) -> DataFrame:
    """Pieces with the number of their record, and whether they end it."""
    # characters that are escaped are no quotes; no escape goes over a brace that ends a piece
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    counted = pieces.withColumn("_bare", bare).withColumn("_quotes", _count(F.col("_bare"), '"'))
    known = _before(counted, "_quotes", "_quotes_before")
    begins_inside = F.col("_quotes_before") % 2 == 1
    ends_inside = (F.col("_quotes_before") + F.col("_quotes")) % 2 == 1
    outside = F.when(begins_inside, F.regexp_replace("_bare", r'(?s)^[^"]*("|$)', "")).otherwise(F.col("_bare"))
    outside = F.regexp_replace(outside, r'(?s)"[^"]*("|$)', "")
    deeper = _count(outside, "{") - F.when(ends_inside, F.lit(0)).otherwise(F.lit(1))
    known = known.withColumn("_closes", ~ends_inside).withColumn("_deeper", deeper).drop("_bare")
    known = _before(known, "_deeper", "_depth_before")
    # a brace at no depth ends a record, also one that has never begun
    ends = F.col("_closes") & (F.col("_depth_before") + F.col("_deeper") <= 0)
    known = known.withColumn("ends", ends).withColumn("_ended", F.col("ends").cast("int"))
    return _before(known, "_ended", "record").select("file", "record", "block", "order", "piece", "ends")


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character)))


def _records(pieces: DataFrame) -> DataFrame:
    """One row a record, and one for what comes after the last: its text, and whether it was ended."""
    joined = pieces.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "order", "piece"))).alias("parts"),
        F.bool_or("ends").alias("ended"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["piece"]), "}")
    return joined.select("file", "record", text.alias("piece"), "ended")


def _parsed(records: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows as ``landing.parse_documents`` gives them."""
    size = F.sum(F.octet_length("piece") + F.lit(1)).alias("_bytes")
    last = records.groupBy("file").agg(F.max("record").alias("_last"), size)
    known = records.join(last, "file").withColumn("_after", F.col("record") == F.col("_last"))
    opening = F.when(F.col("record") == 0, F.lit(r"^\s*\[\s*")).otherwise(F.lit(r"^\s*,\s*"))
    body = F.concat(F.regexp_replace("piece", opening, ""), F.lit("}"))
    opened = F.col("piece").rlike(r"^\s*\[\s*\{") & (F.col("record") == 0)
    opened = opened | (F.col("piece").rlike(r"^\s*,\s*\{") & (F.col("record") > 0))
    closing = F.when(F.col("record") == 0, F.lit(r"^\s*(\[\s*\]\s*)?$")).otherwise(F.lit(r"^\s*\]\s*$"))
    hour = F.get(F.from_json(F.concat(F.lit("["), body, F.lit("]")), f"array<{landing_schema().simpleString()}>"), F.lit(0))
    parsed = known.withColumn("_hour", F.when(~F.col("_after"), hour))
    reason = (
        F.when(F.try_validate_utf8(F.col("piece").cast("binary").cast("string")).isNull(), F.lit(landing.NOT_UTF8))
        .when(F.col("_after") & F.regexp_like("piece", closing), F.lit(None))
        .when(F.col("_after") | ~opened, F.lit(landing.UNPARSEABLE))
        .when(F.col("_hour").isNull(), F.lit(landing.UNPARSEABLE))
        .when(text_to_date(F.col("_hour.date")).isNull(), F.lit(landing.NO_DATE))
    )
    judged = parsed.withColumn("_reason", reason)
    wrong = F.when(F.col("_reason").isNotNull(), F.struct("record", "_reason", "piece"))
    verdicts = judged.groupBy(F.col("file").alias("_file")).agg(
        F.min(wrong).alias("_wrong"), F.max("record").alias("_rows"), F.max("_bytes").alias("_bytes")
    )
    keyless = F.col("city").isNull() | F.col("run_date").isNull()
    # with a brace for every part, the file ends with one: its last record is where the array's end should be
    unended = F.when(F.col("_bytes") == F.col("size"), F.lit(landing.UNPARSEABLE))
    documents = listed.join(verdicts, F.col("file") == F.col("_file")).withColumn(
        "reason", F.when(keyless, F.lit(landing.NO_KEY)).otherwise(F.coalesce("_wrong._reason", unended))
    )
    status = (
        F.when(F.col("reason").isNotNull(), F.lit(landing.QUARANTINED))
        .when(F.col("_rows") == 0, F.lit(landing.EMPTY))
        .otherwise(F.lit(landing.LOADED))
    )
    documents = documents.withColumn("status", status)
    whole = [*landing.DOCUMENT_KEYS, *landing.VERSION, "status"]
    loaded = documents.where(F.col("status") == landing.LOADED).select(*whole, "_file", "_rows")
    hours = judged.where(~F.col("_after")).select(F.col("file").alias("_of"), "record", "_hour")
    rows = hours.join(loaded, F.col("_of") == F.col("_file")).select(
        *whole,
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("reason"),
        F.col("record").cast("long").alias("pos"),
        F.col("_rows").cast("long").alias("doc_rows"),
        "_hour.*",
    )
    nothing = [F.lit(None).cast("long").alias("pos"), F.lit(None).cast("long").alias("doc_rows")]
    nothing += [F.lit(None).cast(f.dataType).alias(f.name) for f in landing_schema().fields]
    others = documents.where(F.col("status") != landing.LOADED).select(
        *whole, F.when(F.col("reason").isNotNull(), F.col("_wrong.piece")).alias("text"), "reason", *nothing
    )
    return rows.unionByName(others)
