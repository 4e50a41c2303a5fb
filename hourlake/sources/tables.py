"""Published tables as DataFrames and SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourlake.operators.exact import finish_states, merge_states
from hourlake.operators.tables import day_summary
from hourlake.schema import DAILY_TABLE, DAY_KEYS, TABLE_NAMES, table_columns, table_schema
from hourlake.sources.store import Store, existing, open_store

#: What loads store of the daily table: states by document, which are finished when they are read.
DAILY_STATES = "daily_states"


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def states_schema() -> T.StructType:
    keys = [f for f in table_schema(DAILY_TABLE).fields if f.name in DAY_KEYS]
    return T.StructType([*keys, *day_summary().state_fields()])


def read_table(
    spark: SparkSession, base: str, name: str, store: Store | None = None, merge_days: bool = False
) -> DataFrame:
    """One table; the schema is fixed, so no file is opened to find it.

    Rows that loads have written count as far as the manifests call them current; rows that were
    written without a load (``write_tables``) always do. A daily row summarises a half of one document, or
    with ``merge_days`` a half of a day over all its documents, so that its keys are unique.
    """
    store = store or open_store(spark, base)
    if store is None:
        return read_unloaded(spark, base, name)
    loaded = _daily(store, merge_days) if name == DAILY_TABLE else store.rows(name, table_schema(name))
    table = loaded.select(*table_columns(name))
    if table_exists(spark, base, name):
        table = table.unionByName(read_unloaded(spark, base, name))
    return table


def _daily(store: Store, merge_days: bool) -> DataFrame:
    """Daily rows from the states of documents: finished as they are, or merged first."""
    states, summary = store.rows(DAILY_STATES, states_schema()), day_summary()
    if not merge_days:
        return finish_states(states, [*DAY_KEYS, "document", "load_id"], summary)
    return finish_states(merge_states(states, DAY_KEYS, summary), DAY_KEYS, summary)


def read_unloaded(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The rows that were written without a load."""
    table = spark.read.schema(table_schema(name)).parquet(table_path(base, name))
    return table.select(*table_columns(name))


def read_tables(spark: SparkSession, base: str, merge_days: bool = False) -> dict[str, DataFrame]:
    """All tables, as one opening of the store has them."""
    store = open_store(spark, base)
    return {name: read_table(spark, base, name, store, merge_days) for name in TABLE_NAMES}


def table_exists(spark: SparkSession, base: str, name: str) -> bool:
    """Whether rows were written without a load."""
    return existing(spark, table_path(base, name), table_schema(name)) is not None


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables known to ``spark.sql`` under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def jdbc_predicates(dates: list[str] | None, parts: int) -> list[str]:
    """Conditions of the reading tasks: by date if there are dates, and each in ``parts`` by hour."""
    hours = [f"mod(hour, {parts}) = {i}" for i in range(parts)] if parts > 1 else [""]
    days = [f"date = DATE '{d}'" for d in dates] if dates is not None else [""]
    conditions = [" AND ".join(c for c in (day, hour) if c) for day in days for hour in hours]
    return [c or "1 = 1" for c in conditions]


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    user: str,
    password: str,
    dates: list[str] | None = None,
    parts: int = 1,
    driver: str = "org.postgresql.Driver",
) -> DataFrame:
    """One table over JDBC: the whole of it, or the days ``dates`` (``yyyy-MM-dd``).

    Each day, or the whole table, is read by ``parts`` tasks, which share its hours; the daily
    table has no hours and is read with one.
    """
    properties = {"user": user, "password": password, "driver": driver}
    predicates = jdbc_predicates(dates, 1 if name == DAILY_TABLE else parts)
    return spark.read.jdbc(url, name, predicates=predicates, properties=properties)
