"""Storage layout for repeated joins: bucketed, sorted tables.

Tables that are joined again and again on the same key (``lineitem`` and
``orders`` on the order key) can be landed once bucketed by that key with the
same bucket count.  Later joins then read co-partitioned, pre-sorted buckets
and plan a sort-merge join with no shuffle on either side.  The bucket count
is fixed at landing time; pick it so one bucket file stays near the scan split
size (for example total bytes / 256 MB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesmart.session import table_path


def land_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a catalog table bucketed and sorted by ``key``; return it."""
    spark = df.sparkSession
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path or table_path(spark, name))
        .saveAsTable(name)
    )
    return spark.table(name)
