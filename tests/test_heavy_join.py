import pytest
from pyspark.sql import functions as F

from salesmart.operators import heavy_join as module
from salesmart.operators.heavy_join import heavy_keys, join_heavy


@pytest.fixture
def sides(spark):
    """A third of the facts on one key, a tenth on a key without a dimension row, some without a key."""
    key = F.when(F.col("f") % 3 == 0, 7).when(F.col("f") % 10 == 1, -1).when(F.col("f") % 97 == 2, None).otherwise(F.col("f") % 5000)
    facts = spark.range(0, 60_000, 1, 12).select(F.col("id").alias("f")).withColumn("fk", key.cast("bigint"))
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return facts, dim


@pytest.fixture
def no_adaptive_help(spark):
    names = ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for n, value in zip(names, ("false", "-1", "-1", "false")):
        spark.conf.set(n, value)
    yield
    for n, value in zip(names, before):
        spark.conf.set(n, value)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_ordinary_join(sides, how, no_adaptive_help):
    facts, dim = sides
    got, want = join_heavy(facts, dim, "fk", "k", how, 0.05), facts.join(dim, F.col("fk") == F.col("k"), how)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_task_has_much_more_than_its_share(sides, no_adaptive_help):
    facts, dim = sides
    sizes = {}
    for name, df in (("heavy", join_heavy(facts, dim, "fk", "k")), ("plain", facts.join(dim, F.col("fk") == F.col("k")))):
        rows = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
        sizes[name] = max(r["count"] for r in rows)
    assert sizes["heavy"] <= 60_000 / 8 < 20_000 <= sizes["plain"]


def test_heavy_keys(sides):
    facts, _ = sides
    assert {r.key for r in heavy_keys(facts, "fk", 0.05).collect()} == {7, -1}
    assert heavy_keys(facts.limit(0), "fk", 0.05).isEmpty()
    with pytest.raises(ValueError):
        heavy_keys(facts, "fk", 1.0)


def test_too_many_dimension_rows_take_the_ordinary_join(sides, monkeypatch):
    facts, dim = sides
    monkeypatch.setattr(module, "MOST", 0)
    assert join_heavy(facts, dim, "fk", "k").count() == facts.join(dim, F.col("fk") == F.col("k")).count()


def test_shared_names_are_refused(spark):
    with pytest.raises(ValueError):
        join_heavy(spark.range(1), spark.range(1), "id", "id")
