"""Catalog tables and views."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadevents.session import children, remove
from roadevents.sinks.files import full_refresh


def create_table_if_absent(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    defaults: dict[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Declares a Parquet table; ``defaults`` maps columns to default expressions."""
    defaults = defaults or {}
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
        for f in schema
    )
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def insert_by_name(df: DataFrame, name: str) -> None:
    """Adds the rows to a table; columns that ``df`` lacks take their declared defaults."""
    spark = df.sparkSession
    view = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    try:
        spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _folder_of_versions(spark: SparkSession, name: str) -> str:
    """Beside the catalog's own tables, so that it lives as long as they do."""
    *schema, table = name.split(".")
    database = spark.catalog.getDatabase(schema[0] if schema else spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{table}-versions"


def _point(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Makes the table's name stand for the files at ``path``, in one step of the catalog.

    A name whose columns stay the same, or get more, never stands for nothing.
    """
    if spark.catalog.tableExists(name):
        old = {f.name: f.dataType for f in spark.table(name).schema}
        new = {f.name: f.dataType for f in schema}
        added = [f for f in schema if f.name not in old]
        # More columns can be added behind the others; any other change is a new table.
        if list(new)[: len(old)] == list(old) and all(new[c] == old[c] for c in old):
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    create_table_if_absent(spark, name, schema, location=path)


def publish(
    df: DataFrame,
    name: str,
    *,
    keep: int = 2,
    write: Callable[[DataFrame, str], None] = lambda df, path: df.write.parquet(path),
) -> DataFrame:
    """Publishes ``df``, which may read the table itself, as the table's next version.

    A version is a folder of its own. When its files are complete, the catalog's entry is
    pointed at them: a reader finds the old rows or the new ones, never none. One that has
    begun goes on reading the old version's files, of which the last ``keep`` versions stay.
    A build that fails, or whose ``write`` raises, leaves the table as it was. One writer
    publishes a table at a time.
    """
    spark = df.sparkSession
    base = _folder_of_versions(spark, name)
    moment = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    version = f"{base}/{moment}-{uuid.uuid4().hex[:8]}"
    try:
        write(df, version)
    except Exception:
        remove(spark, version)
        raise
    _point(spark, name, df.schema, version)
    for old in children(spark, base)[:-keep]:
        remove(spark, f"{base}/{old}")
    return spark.table(name)


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "view",
    *,
    path: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Publishes a model as a ``"view"`` or ``"table"`` and returns the published form.

    A view is the session's own; ``create_view`` makes lasting ones. A table is a version
    as ``publish`` makes them, in the given ``schema``; with ``path`` its files replace
    those in that folder instead. A model that fails leaves the old table.
    """
    spark = df.sparkSession
    if kind == "view":
        if schema:
            raise ValueError("a session's view has no schema")
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    if schema:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        name = f"{schema}.{name}"
    if path is None:
        return publish(df, name)
    full_refresh(df, path)
    _point(spark, name, df.schema, path)
    return spark.table(name)


def create_view(
    spark: SparkSession, name: str, query: str, schema: str | None = None
) -> DataFrame:
    """A view that the catalog keeps: its query runs over its tables at each reading."""
    if schema:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        name = f"{schema}.{name}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns: what a temporary copy of a table's shape is for."""
    return df.sparkSession.createDataFrame([], df.schema)


def drop(spark: SparkSession, name: str) -> None:
    """Removes a table with its published versions, or a view, if there is one."""
    if spark.catalog.dropTempView(name) or not spark.catalog.tableExists(name):
        return
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"DROP {kind} {name}")
    if kind == "TABLE":
        remove(spark, _folder_of_versions(spark, name))
