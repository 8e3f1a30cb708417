"""Landed tables: Parquet scans, named table sets and catalog views.

A scan is left lazy so that Catalyst can prune columns and push filters into
the Parquet reader (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Star-schema tables of the driver data set.
SALES_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
ALL_TABLES = SALES_TABLES + (
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_location(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one landed Parquet table."""
    return spark.read.parquet(table_location(root, name))


def read_tables(spark: SparkSession, root: str, names=SALES_TABLES) -> dict[str, DataFrame]:
    """Load a named set of tables (the workbook-with-sheets case) as a dict."""
    return {name: read_table(spark, root, name) for name in names}


def register_views(
    spark: SparkSession, root: str, names=SALES_TABLES, prefix: str = "salesmart_"
) -> dict[str, str]:
    """Expose tables by name so ``spark.read.table(name)`` and SQL can address
    them; returns table -> view name (prefixed, so a caller's own views of the
    same table names are left alone)."""
    views = {}
    for name, df in read_tables(spark, root, names).items():
        views[name] = f"{prefix}{name}"
        df.createOrReplaceTempView(views[name])
    return views


def table_set_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table of a set: one aggregate per table, one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def scan_limit(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows by a key; planned as TakeOrderedAndProject (a per-task
    top-n merged once), so no full sort and no shuffle of the table."""
    return df.orderBy(*order_by).limit(n)
