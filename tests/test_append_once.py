import pytest
from pyspark.sql import functions as F

from salesmart.operators import append_once as module
from salesmart.operators.append_once import append_once, missing_rows, present_rows

SCHEMA = "k int, part string, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_only_missing_keys_are_added(spark, tmp_dir):
    path = tmp_dir + "/t"
    spark.createDataFrame([(1, "a", 1), (2, None, 2), (None, None, 3)], SCHEMA).write.parquet(path)
    incoming = spark.createDataFrame([(1, "a", 9), (1, "b", 10), (None, None, 11), (None, "b", 12), (2, None, 13), (4, "x", 14)], SCHEMA)
    assert append_once(path, incoming, ["k", "part"]) == 3
    want = [(1, "a", 1), (1, "b", 10), (2, None, 2), (4, "x", 14), (None, "b", 12), (None, None, 3)]
    assert rows(spark.read.parquet(path)) == sorted(want, key=str)
    assert append_once(path, incoming, ["k", "part"]) == 0
    assert rows(spark.read.parquet(path)) == sorted(want, key=str)


def test_repeated_incoming_keys_add_one_row(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    got = rows(missing_rows(target, spark.createDataFrame([(2, "a", 1), (2, "a", 1), (1, "a", 5)], SCHEMA), ["k", "part"]))
    assert got == [(2, "a", 1)]


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1, "a", 1)], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert rows(missing_rows(none, some, ["k"])) == [(1, "a", 1)] and rows(missing_rows(some, none, ["k"])) == []


def test_few_target_rows_reach_the_join(spark):
    target = spark.range(200_000).withColumn("v", F.lit(1))
    incoming = spark.range(199_500, 200_500).withColumn("v", F.lit(2))
    read = present_rows(target, incoming, ["id"])
    assert 500 <= read.count() <= 500 + 200_000 / 100
    assert missing_rows(target, incoming, ["id"]).count() == 500


def test_a_filter_too_small_changes_nothing_but_the_rows_read(spark, monkeypatch):
    monkeypatch.setattr(module, "LEAST_BITS", 6)
    monkeypatch.setattr(module, "MOST_BITS", 6)
    target, incoming = spark.range(1000), spark.range(500, 1500)
    assert present_rows(target, incoming, ["id"]).count() == 1000
    assert rows(missing_rows(target, incoming, ["id"])) == sorted(((k,) for k in range(1000, 1500)), key=str)


def test_different_types_are_refused(spark):
    with pytest.raises(ValueError):
        missing_rows(spark.range(1), spark.range(1).withColumn("id", F.col("id").cast("int")), ["id"])
