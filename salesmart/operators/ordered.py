"""Rows in order within a key, where one key may hold a large share of the rows.

A window over a key gathers all its rows in one task.  Here the rows are dealt
to ranges of (key, order) instead, so a key with a long history lies in several
ranges next to each other.  Inside a range an ordinary window answers; what a
range needs from the ranges before it is one value for the key that crosses its
border, found among at most as many values as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.session import own_path

PART = "__part"


def ranged(df: DataFrame, key: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``PART``, the number of its range of (key, order); landed, since the ranges come from a sample.

    ``order`` should tell the rows of a key apart as far as possible: rows equal
    in key and order stay in one range.  Nulls are the smallest values.
    """
    spark = df.sparkSession
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = own_path(spark, "ranges")
    df.repartitionByRange(width, *key, *order).withColumn(PART, F.spark_partition_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def _crossing(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that lie in more than one range (fewer than there are ranges)."""
    whole = F.struct(*key)
    ends = rows.groupBy(PART).agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    # One row per range: the window over them is as small as that.
    before = F.lag("last").over(Window.orderBy(PART))
    return ends.withColumn("before", before).where(F.col("first").eqNullSafe(F.col("before"))).select("first.*").distinct()


def same_key(left: str, right: str, key: list[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return on


def carried(rows: DataFrame, key: list[str], order: list[str], value: Column, name: str, own: bool = True, backward: bool = False) -> DataFrame:
    """``rows`` (from ``ranged``) with ``name``: the last non-null ``value`` of the key up to the row, in ``order``.

    ``own`` says whether the row's own value counts; ``backward`` looks from the
    end of the order, so at the next value instead of the last.  Null keys are a
    key of their own.  Rows equal in key and order see each other in no
    particular order.
    """
    rows = rows.withColumn("__value", value)
    ordered = [F.col(c).desc() if backward else F.col(c).asc() for c in order]
    here = Window.partitionBy(PART, *key).orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    # The value with which a range ends, of the keys that go on in the next range.
    latest = (F.min_by if backward else F.max_by)("__value", F.struct(*order))
    crossing = rows.where(F.col("__value").isNotNull()).alias("r").join(_crossing(rows, key).alias("c"), same_key("r", "c", key), "left_semi")
    ends = crossing.groupBy(PART, *key).agg(latest.alias("__end"))
    parts = rows.select(PART, *key).alias("r").join(_crossing(rows, key).alias("c"), same_key("r", "c", key), "left_semi").distinct()
    both = (F.col(f"p.{PART}") == F.col(f"e.{PART}")) & same_key("p", "e", key)
    ends = parts.alias("p").join(ends.alias("e"), both, "left").select("p.*", "e.__end")
    sides = Window.partitionBy(*key).orderBy(F.col(PART).desc() if backward else F.col(PART).asc()).rowsBetween(Window.unboundedPreceding, -1)
    border = ends.select(PART, *key, F.last("__end", ignorenulls=True).over(sides).alias("__border")).where(F.col("__border").isNotNull())
    seen = rows.withColumn("__here", F.last("__value", ignorenulls=True).over(here)).drop("__value")
    both = (F.col(f"s.{PART}") == F.col(f"b.{PART}")) & same_key("s", "b", key)
    joined = seen.alias("s").join(border.alias("b"), both, "left")
    columns = [F.col(f"s.`{c}`") for c in seen.columns if c not in ("__here", name)]
    return joined.select(*columns, F.coalesce("s.__here", "b.__border").alias(name))
