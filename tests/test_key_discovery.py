import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from salesmart.operators.key_discovery import minimal_keys


def brute(rows, names, width):
    found = []
    for size in range(1, width + 1):
        for at in combinations(range(len(names)), size):
            values = [tuple(r[k] for k in at) for r in rows]
            inside = any(set(f) <= set(at) for f in found)
            if not inside and all(None not in v for v in values) and len(set(values)) == len(values):
                found.append(at)
    return [tuple(names[k] for k in at) for at in found]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_subsets(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "e"]
    rows = [(k // 7, k % 7, rng.randint(0, 6), rng.choice([None, *range(50)]), rng.randint(0, 40)) for k in range(rng.choice([20, 49]))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    assert minimal_keys(df, width=3) == brute(rows, names, 3)


def test_larger_table_with_a_near_key(spark):
    n = 40_000
    df = spark.range(n).select(
        F.col("id"), (F.col("id") % 200).alias("x"), F.floor(F.col("id") / 200).alias("y"),
        F.when(F.col("id") == 5, 6).otherwise(F.col("id")).alias("almost"), F.lit(1).alias("same"),
    )
    assert minimal_keys(df, width=2) == [("id",), ("x", "y"), ("x", "almost")]
    assert minimal_keys(df, columns=["x", "same", "almost"], width=3) == [("x", "almost")]


def test_empty_and_single_row(spark):
    assert minimal_keys(spark.createDataFrame([], "a int")) == []
    assert minimal_keys(spark.createDataFrame([(1, None)], "a int, b int")) == [("a",)]


def test_repeated_rows_have_no_key(spark):
    assert minimal_keys(spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")) == []
