"""Split a key list into comma-joined batches of bounded size.

The distinct keys are range-partitioned in key order and numbered from 0: each
partition numbers its own keys and adds the number of keys in the partitions
before it.  A batch is a run of ``size`` consecutive numbers, so the batches are
the same for any number of partitions, only the last batch can be short, and
no task handles more than one range of keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.session import own_path


def numbered_keys(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``(k, n)``: the distinct non-null keys with their position in key order.

    The ranges are landed first: they come from a sample, and a second
    evaluation could draw other bounds.
    """
    spark = df.sparkSession
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull()).distinct()
    path = own_path(spark, "key_ranges")
    keys.repartitionByRange(width, "k").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    # One row per range: the window over them holds as many rows as partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    starts = sizes.select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("k")) - 1
    return ranged.withColumn("own", own).join(starts, "part").select("k", (F.col("start") + F.col("own")).alias("n"))


def key_batches(df: DataFrame, key: str, size: int = 50, partitions: int | None = None) -> DataFrame:
    """Rows ``(batch, n_keys, keys)`` with ``keys`` the comma-joined batch in key order."""
    numbered = numbered_keys(df, key, partitions).withColumn("batch", F.floor(F.col("n") / size).cast("bigint"))
    grouped = numbered.groupBy("batch").agg(F.sort_array(F.collect_list("k")).alias("ks"))  # ``size`` keys at most
    return grouped.select(
        "batch",
        F.size("ks").cast("int").alias("n_keys"),
        F.array_join(F.transform("ks", lambda x: x.cast("string")), ",").alias("keys"),
    )
