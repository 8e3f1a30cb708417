import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators import table_diff as module
from salesmart.operators.table_diff import differing_rows, table_diff

SCHEMA = "k int, part string, v double, t string"


def brute(before, after):
    a, b = ({r[:2]: r for r in rows} for rows in (before, after))
    out = [(*r, "removed") for k, r in a.items() if k not in b] + [(*r, "added") for k, r in b.items() if k not in a]
    return sorted(out + [(*r, "changed") for k, r in b.items() if k in a and a[k] != r], key=str)


def diff(spark, before, after, **more):
    a, b = spark.createDataFrame(before, SCHEMA).repartition(3), spark.createDataFrame(after, SCHEMA).repartition(5)
    return sorted((tuple(r) for r in table_diff(a, b, ["k", "part"], **more).collect()), key=str)


def made(seed, n):
    rng = random.Random(seed)
    return [(k if k else None, rng.choice("ab") if k % 7 else None, rng.choice([None, 0.5, float(k)]), rng.choice([None, "x", "y"])) for k in range(n)]


@pytest.mark.parametrize("leaf", [1, 20, 10_000])
def test_against_a_full_join(spark, leaf):
    before = made(1, 400)
    rng = random.Random(2)
    after = [r if rng.random() < 0.9 else (*r[:3], "z") for r in before if rng.random() < 0.95] + [(k, "n", 1.0, None) for k in range(900, 920)]
    assert diff(spark, before, after, leaf=leaf) == brute(before, after)


def test_equal_empty_and_disjoint_tables(spark):
    rows = made(3, 50)
    assert diff(spark, rows, rows) == []
    assert diff(spark, [], []) == []
    assert diff(spark, rows, []) == brute(rows, [])
    assert diff(spark, [], rows) == brute([], rows)


def test_nulls_that_change_places(spark):
    before, after = [(1, "a", None, None), (None, "b", 1.0, "x"), (2, None, None, "x")], [(1, "a", None, "a"), (None, "b", None, "x"), (2, None, None, "x")]
    assert diff(spark, before, after) == brute(before, after)


def test_many_differing_ranges_fall_back_to_all_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "MOST", 5)
    before, after = made(4, 300), [(*r[:3], "changed") for r in made(4, 300)]
    assert diff(spark, before, after, leaf=1) == brute(before, after)


def test_rows_joined_grow_with_the_change(spark):
    before = spark.range(300_000).select("id", (F.col("id") * 3).alias("v"))
    for changes in (0, 1, 20):
        after = before.withColumn("v", F.when(F.col("id") % 15_000 < F.lit(1 if changes == 20 else 0), -1).when((F.col("id") == 7) & F.lit(changes == 1), -1).otherwise(F.col("v")))
        a, b = differing_rows(before, after, ["id"], leaf=100)
        assert a.count() == b.count() <= changes * 40
        assert table_diff(before, after, ["id"], leaf=100).count() == changes


def test_other_columns_are_refused(spark):
    with pytest.raises(ValueError):
        table_diff(spark.range(1), spark.range(1).withColumn("x", F.lit(1)), ["id"])
