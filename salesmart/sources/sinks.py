"""Table writers: create, overwrite, append, typed create-if-missing, copy.

Tables are Parquet (no versioned table format is installed here;
row changes are plain log frames, see ``operators.changelog``).
Every writer runs one distributed write job: tasks write their own files and
the driver only commits the file list, so a lost executor re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesmart.session import own_path


def create_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """``saveAsTable`` in the default mode: fail if the table exists."""
    w = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """``mode("overwrite").saveAsTable(name)``."""
    w = df.write.format("parquet").mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def overwrite_path(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``mode("overwrite").save(path)``; with ``partition_by`` and dynamic
    partition overwrite only the partitions present in ``df`` are replaced,
    so a re-run of one batch replaces that batch instead of appending it twice."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def append_path(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``INSERT INTO``: add rows (new files) to a table folder."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_by_name(target: DataFrame, rows: DataFrame, allow_missing: bool = True) -> DataFrame:
    """``INSERT INTO t (cols) ..``: match columns by name; absent ones become NULL."""
    return target.unionByName(rows, allowMissingColumns=allow_missing)


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE``, keeping NOT NULL."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )


def create_if_not_exists(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS name (...) USING parquet``."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet{location}")


def copy_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS SELECT ..``: write to a new folder in the
    shared folder and return the copy as read back from it.

    Each call has a folder of its own, so a copy that is still to be read is
    never overwritten by the next one.
    """
    path = own_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
