"""Published tables: Parquet folders, bucketed catalog tables, JDBC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.schema import BATCH_KEYS, DAILY_TABLE, HOUR_KEYS
from hourlake.sources.store import LOADS, store_path
from hourlake.sources.tables import read_unloaded, table_exists, table_path

APPEND = "append"
REPLACE = "replace_batch"
MODES = (APPEND, REPLACE)


def write_tables(
    tables: dict[str, DataFrame],
    base: str,
    mode: str = APPEND,
    batch_keys: list[str] = BATCH_KEYS,
) -> None:
    """Write tables as Parquet below ``base``, partitioned by date, outside of any load.

    Documents are published by ``plans.load``, which never rewrites; this is for frames that have
    no documents. ``append`` adds rows. ``replace_batch`` first drops the published rows of every batch
    (city and date) that the new rows contain, so that a second load changes nothing; only
    the dates concerned are rewritten. Where one document covers two dates, one per half, a
    batch is city, date and forecast_data: pass those as ``batch_keys``. The daily table
    goes last. Whole dates are rewritten, so no two replacements may run at a time.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be {APPEND!r} or {REPLACE!r}, not {mode!r}")
    for name in sorted(tables, key=lambda n: n == DAILY_TABLE):
        table = tables[name]
        if mode == REPLACE and table_exists(table.sparkSession, base, name):
            _replace(table, base, name, batch_keys)
        else:
            writer = arrange(table).write.mode("append").partitionBy("date")
            writer.parquet(table_path(base, name))


def write_load(table: DataFrame, base: str, name: str, load_id: str) -> None:
    """Rows of a load that are arranged already, in its own folder: no exchange, only a projection."""
    folder = store_path(base, LOADS, name, f"load_id={load_id}")
    table.write.partitionBy("date").parquet(folder)


def write_loads(table: DataFrame, base: str, name: str) -> None:
    """Rows of several loads, which ``load_id`` names, in the folders that ``write_load`` gives each of them.

    Files are made in a folder of this write's own and then moved, so writes at one time do not meet.
    """
    writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load_id", "date").parquet(store_path(base, LOADS, name))


def arrange(df: DataFrame, further: list[str] | None = None) -> DataFrame:
    """Rows grouped by date, after ``further`` columns, and sorted, for few and well-sorted files per date.

    One exchange; AQE splits a date with very many rows and joins small ones. It does so
    in the plan of a write, not in a plan kept with ``persist``. Without AQE, ranges of the
    whole key do the same from a sample.
    """
    first = [*(further or []), "date"]
    order = [*first, *[c for c in HOUR_KEYS if c in df.columns and c != "date"]]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        grouped = df.hint("rebalance", *first)
    else:
        grouped = df.repartitionByRange(*order)
    return grouped.sortWithinPartitions(*order)


def _replace(incoming: DataFrame, base: str, name: str, batch_keys: list[str]) -> None:
    published = read_unloaded(incoming.sparkSession, base, name)
    # one row per day: bounded by the calendar, and it makes the read prune partitions
    dates = [r["date"] for r in incoming.select("date").distinct().collect()]
    concerned = F.col("date").isin([d for d in dates if d is not None])
    if None in dates:
        concerned = concerned | F.col("date").isNull()
    batches = incoming.select(*[F.col(c).alias(f"_new_{c}") for c in batch_keys]).distinct()
    same = reduce(
        lambda a, b: a & b, [published[c].eqNullSafe(batches[f"_new_{c}"]) for c in batch_keys]
    )
    kept = published.where(concerned).join(batches, same, "left_anti")
    (
        arrange(kept.unionByName(incoming))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(table_path(base, name))
    )


def write_bucketed(tables: dict[str, DataFrame], database: str, buckets: int) -> None:
    """Append hourly tables to the catalog, bucketed by the join keys.

    Joins of these tables on city, date and hour then need no exchange. The hour is in
    the bucket key, so one city or day with very many rows still spreads.
    """
    keys = ["city", "date", "hour"]
    for name, table in tables.items():
        if name == DAILY_TABLE:
            table.write.mode("append").saveAsTable(f"{database}.{name}")
            continue
        # one task per bucket, so that a load adds one file per bucket
        (
            table.repartition(buckets, *keys)
            .write.mode("append")
            .bucketBy(buckets, *keys)
            .sortBy(*keys)
            .saveAsTable(f"{database}.{name}")
        )


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, batch_rows: int = 10_000
) -> dict[str, str]:
    """Options of the JDBC writer for one table."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_rows),
    }


def write_tables_jdbc(
    tables: dict[str, DataFrame],
    url: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    connections: int = 16,
) -> None:
    """Append tables over JDBC, from ``connections`` tasks.

    An exchange stands between the work that makes a table and the few tasks that write it: with
    ``numPartitions`` alone, Spark would do all of that work in those tasks. Pass published tables
    (``read_tables``), or the documents are parsed once per table.
    """
    for name, table in tables.items():
        options = jdbc_options(url, name, user, password, driver)
        jdbc_rows(table, connections).write.format("jdbc").options(**options).mode("append").save()


def jdbc_rows(table: DataFrame, connections: int) -> DataFrame:
    return table.repartition(connections)
