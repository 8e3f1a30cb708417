"""Difference of two tables that keep no log of their changes.

A digest tree stands over each table: a node is a range of key hashes, and its
digest combines the digests of the rows in it, whatever their order or place.
The trees are compared from the top: only ranges whose digests differ are
divided further, each step an aggregate of one row per range and task.  When
the ranges are small, the rows in those that differ, and no others, are joined.
So what is shuffled grows with the change; equal tables are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import own_path

STEP = 8  # bits by which a range is divided
MOST = 100_000  # ranges that are sent to every task (16 bytes each)


def _hash(columns: list[str], seed: int) -> Column:
    # A null does not change the hash, so which values are null is hashed, too.
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns])


def _hashed(df: DataFrame, key: list[str]) -> DataFrame:
    names = sorted(df.columns)
    return df.withColumns({"__key": _hash(sorted(key), 0), "__one": _hash(names, 1), "__two": _hash(names, 2)})


def _range(bits: int) -> Column:
    return F.shiftrightunsigned("__key", 64 - bits)


def _within(df: DataFrame, ranges: DataFrame | None, bits: int) -> DataFrame:
    """Rows of the ranges listed (at most ``MOST`` of them, counted before)."""
    if ranges is None:
        return df
    return df.join(F.broadcast(ranges), _range(bits) == F.col("__in"), "left_semi")


def _digests(df: DataFrame, bits: int, side: str) -> DataFrame:
    return df.groupBy(_range(bits).alias("__in")).agg(
        F.count(F.lit(1)).alias(f"{side}_n"), F.sum(F.col("__one").cast("decimal(38,0)")).alias(f"{side}_one"), F.bit_xor("__two").alias(f"{side}_two")
    )


def differing_rows(before: DataFrame, after: DataFrame, key: list[str], leaf: int = 1000) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in key ranges whose digests differ, of about ``leaf`` rows each.

    Runs an aggregate over both tables per level of the tree that differs (one
    where the tables are equal).  Where over ``MOST`` ranges differ, the change
    is large and what was found so far (at first: all rows) is returned.
    """
    spark = before.sparkSession
    a, b = _hashed(before, key), _hashed(after, key)
    ranges, bits = None, 0
    while bits < 64:
        left, right = (_digests(_within(t, ranges, bits), bits + STEP, s) for t, s in ((a, "a"), (b, "b")))
        both = left.join(right, "__in", "full")
        same = F.lit(True)
        for part in ("n", "one", "two"):
            same = same & F.col(f"a_{part}").eqNullSafe(F.col(f"b_{part}"))
        path = own_path(spark, "differing")
        both.where(~same).select("__in", F.greatest("a_n", "b_n").alias("__rows")).write.parquet(path)
        found = spark.read.schema("__in bigint, __rows bigint").parquet(path)
        n, largest = found.agg(F.count(F.lit(1)), F.max("__rows")).first()
        if n > MOST:
            break
        ranges, bits = found.select("__in"), bits + STEP
        if not n or largest <= leaf:
            break
    hashes = ["__key", "__one", "__two"]
    return _within(a, ranges, bits).drop(*hashes), _within(b, ranges, bits).drop(*hashes)


def table_diff(before: DataFrame, after: DataFrame, key: list[str], leaf: int = 1000) -> DataFrame:
    """Rows ``added``, ``removed`` or ``changed`` (``change_type``) from ``before`` to ``after``; the values of
    ``after``, of ``before`` for removed rows.

    Both tables have the same columns; ``key`` is unique in each
    (``audit.duplicate_keys``), null parts count as equal.  Values of map type
    are not supported.  Empty tables are fine.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the tables have different columns")
    names = before.columns
    a, b = differing_rows(before, after, key, leaf)
    a = a.select(F.struct(*names).alias("a"), *[F.col(k).alias(f"__{k}") for k in key])
    b = b.select(F.struct(*names).alias("b"), *[F.col(k).alias(f"__b_{k}") for k in key])
    on, same = F.lit(True), F.lit(True)
    for k in key:
        on = on & F.col(f"__{k}").eqNullSafe(F.col(f"__b_{k}"))
    for c in names:
        same = same & F.col("a")[c].eqNullSafe(F.col("b")[c])
    what = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(~same, "changed")
    joined = a.join(b, on, "full").withColumn("change_type", what).where("change_type is not null")
    return joined.select(*[F.when(F.col("b").isNull(), F.col("a")[c]).otherwise(F.col("b")[c]).alias(c) for c in names], "change_type")
