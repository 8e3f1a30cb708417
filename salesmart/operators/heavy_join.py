"""Joins of facts whose rows crowd on a few keys with a dimension too large to send to every task.

The keys that hold more than a task's fair share of the facts are counted
first; there can be only a few of them.  Their dimension rows go to every task
(after their number is checked), so their facts stay where they are; all other
facts and dimension rows are shuffled and joined as usual.  This does not need
the engine to notice the skew while it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import own_path

MOST = 10_000  # dimension rows that are sent to every task


def heavy_keys(facts: DataFrame, key: str, share: float) -> DataFrame:
    """``(key, n)``: the keys with more than ``share`` of the rows of ``facts``, fewer than ``1 / share`` of them.

    Counted exactly, combined map-side.  A null key joins nothing and is left out.
    """
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    spark = facts.sparkSession
    counts = facts.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    path = own_path(spark, "key_counts")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    rows = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where((F.col("n") > share * rows) & F.col("key").isNotNull())


def join_heavy(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner", share: float | None = None) -> DataFrame:
    """``facts`` joined with ``dim`` (``inner`` or ``left``), both keys kept.

    ``share`` of the facts makes a key heavy (default: the fair share of a shuffle
    partition).  Where the heavy keys have over ``MOST`` dimension rows, or there
    are none, the ordinary join is taken.
    Column names must differ between the sides; null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if set(facts.columns) & set(dim.columns):
        raise ValueError("the sides share column names")
    width = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(facts, fact_key, share or 1 / max(2, width)).select("key")
    own = dim.join(F.broadcast(heavy), F.col(dim_key) == F.col("key"), "left_semi")
    on = F.col(fact_key) == F.col(dim_key)
    if heavy.isEmpty() or own.limit(MOST + 1).count() > MOST:
        return facts.join(dim, on, how)
    crowded = facts.join(F.broadcast(heavy), F.col(fact_key) == F.col("key"), "left_semi")
    others = facts.join(F.broadcast(heavy), F.col(fact_key) == F.col("key"), "left_anti")
    return crowded.join(F.broadcast(own), on, how).unionByName(others.join(dim, on, how))
