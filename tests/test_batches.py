"""Key batches: every key once, consecutive runs, the same for any number of partitions."""

from salesmart.operators.batches import key_batches


def batches(df, size, partitions=None):
    return {r.batch: (r.n_keys, r["keys"]) for r in key_batches(df, "id", size, partitions).collect()}


def test_consecutive_runs_of_distinct_keys(spark):
    df = spark.createDataFrame([(k % 237,) for k in range(1000)] + [(None,)], "id long")
    got = batches(df, 50)
    keys = list(range(237))
    assert got == {i: (len(keys[i * 50 : i * 50 + 50]), ",".join(map(str, keys[i * 50 : i * 50 + 50]))) for i in range(5)}


def test_same_batches_for_any_number_of_partitions(spark):
    df = spark.createDataFrame([(k * 7919 % 100_003,) for k in range(5000)], "id long")
    assert batches(df, 50, 1) == batches(df, 50, 2) == batches(df, 50, 37)


def test_no_keys(spark):
    assert batches(spark.createDataFrame([(None,)], "id long"), 50) == {}
