"""Append of rows whose keys a table does not hold yet, without shuffling the table.

The incoming keys are folded into a Bloom filter of fixed size, a small table of
64-bit words that every task gets; it meets the scan of the target, so only
target rows whose key may be among the incoming ones go on.  These few are
joined exactly.  A rerun of the same append finds all its keys and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.ordered import same_key
from salesmart.session import own_path

HASHES = 3
BITS_PER_KEY = 16  # about one false hit in 500 keys
LEAST_BITS, MOST_BITS = 12, 26  # as powers of two; at most 2**20 words of 16 bytes go to a task


def _position(key: list[str], seed: int, power: int) -> Column:
    # Which parts are null is hashed, too, as a null does not change the hash.
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key], *[F.col(k).isNull() for k in key]), F.lit(1 << power))


def key_filter(rows: DataFrame, key: list[str], power: int) -> DataFrame:
    """``(word, bits)``: a Bloom filter of ``2**power`` bits over the keys of ``rows``, words without a bit left out."""
    at = rows.select(F.explode(F.array(*[_position(key, seed, power) for seed in range(HASHES)])).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
    return at.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))


def may_hold(rows: DataFrame, key: list[str], words: DataFrame, power: int) -> DataFrame:
    """``rows`` whose key the filter may hold: all that it holds, and few others."""
    for seed in range(HASHES):
        at = _position(key, seed, power)
        bit = F.call_function("shiftrightunsigned", F.col("bits"), F.pmod(at, F.lit(64)).cast("int")).bitwiseAND(F.lit(1))
        hit = (F.col("word") == F.call_function("shiftright", at, F.lit(6))) & (bit == 1)
        rows = rows.join(F.broadcast(words), hit, "left_semi")
    return rows


def filter_power(keys: int) -> int:
    """Size of the filter for so many keys, as a power of two of bits."""
    return min(MOST_BITS, max(LEAST_BITS, (max(1, keys) * BITS_PER_KEY - 1).bit_length()))


def present_rows(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Keys of ``target`` that may be among those of ``incoming``: what the exact join reads of the target."""
    spark = target.sparkSession
    power = filter_power(incoming.count())
    path = own_path(spark, "key_filter")
    key_filter(incoming.select(*key), key, power).write.parquet(path)
    words = spark.read.schema("word bigint, bits bigint").parquet(path)
    return may_hold(target.select(*key), key, words, power)


def missing_rows(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``incoming`` whose key ``target`` does not hold; of repeated incoming keys one row.

    Null key parts count as equal.  Key columns need the same types on both
    sides.  With more keys than the largest filter serves well, more target rows
    reach the exact join; the result stays the same.
    """
    for k in key:
        if target.schema[k].dataType != incoming.schema[k].dataType:
            raise ValueError(f"column {k!r} has different types")
    there = present_rows(target, incoming, key)
    return incoming.dropDuplicates(key).alias("n").join(there.alias("t"), same_key("n", "t", key), "left_anti").select("n.*")


def append_once(path: str, incoming: DataFrame, key: list[str]) -> int:
    """Append to the Parquet table at ``path`` the rows whose keys it lacks; the number of rows added.

    The rows are landed before they are written, so the table is not read
    while it grows; two appends must not run at the same time.
    """
    spark = incoming.sparkSession
    target = spark.read.parquet(path)
    new = own_path(spark, "append")
    missing_rows(target, incoming.select(*target.columns), key).write.parquet(new)
    rows = spark.read.schema(target.schema).parquet(new)
    rows.write.mode("append").parquet(path)
    return rows.count()
