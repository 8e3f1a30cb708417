"""A key that holds a third of all fact rows: joins stay whole and AQE splits
the hot partition (thresholds lowered so the effect shows at test size)."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators.joins import join_on, unmatched_dims
from salesmart.operators.rollups import sum_by

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def facts_and_dims(spark, n=30_000):
    facts = spark.range(n).select(
        F.col("id").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("CustomerId"),
        (F.col("id") % 97).cast("decimal(18,2)").alias("amount"),
    )
    dims = spark.range(0, 600).select(F.col("id").alias("CustomerId"), F.concat(F.lit("c"), F.col("id")).alias("name"))
    return facts, dims


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_hot_key_join_is_whole_and_split(spark, skew_conf, capsys, how):
    facts, dims = facts_and_dims(spark)
    out = join_on(facts, dims, "CustomerId", how)
    n = out.count()
    expected = {"inner": 30_000, "left": 30_000, "right": 30_000 + 100, "full": 30_000 + 100}[how]
    assert n == expected
    hot = sum(1 for i in range(30_000) if i % 3 == 0 or i % 500 == 7)
    assert out.filter(F.col("CustomerId") == 7).count() == hot
    out.collect()
    out.explain()
    assert "skew=true" in capsys.readouterr().out


def test_hot_key_aggregates_map_side(spark, skew_conf):
    facts, _ = facts_and_dims(spark)
    totals = {r.CustomerId: r.total for r in sum_by(facts, ["CustomerId"], {"total": "amount"}).collect()}
    assert len(totals) == 500
    assert sum(totals.values()) == sum(i % 97 for i in range(30_000))


def test_unmatched_dims_with_hot_key(spark, skew_conf):
    facts, dims = facts_and_dims(spark)
    assert sorted(r.CustomerId for r in unmatched_dims(dims, facts, "CustomerId").collect()) == list(range(500, 600))


def test_hot_item_asof_join_is_whole_and_split(spark, skew_conf, capsys):
    import datetime as dt

    from salesmart.operators import scd2

    spec = scd2.Scd2Spec(key="Item_Id", attrs=("Brand",), default_start=dt.datetime(2018, 1, 1))
    dim = scd2.initial_dimension(spark.createDataFrame([(k, "b0") for k in range(50)], "Item_Id long, Brand string"),
                                 spec, dt.datetime(2019, 1, 1))
    for i, t in enumerate([dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), dt.datetime(2022, 1, 1)], start=1):
        stage = spark.createDataFrame([(k, f"b{i}" if k == 7 or k % 5 == 0 else "b0") for k in range(50)],
                                      "Item_Id long, Brand string")
        dim = scd2.load(dim, stage, spec, t, "current")
    dim = spark.createDataFrame(dim.collect(), dim.schema)
    facts = spark.range(30_000).select(
        F.col("id").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("item"),
        (F.lit(dt.datetime(2019, 6, 1)) + F.make_dt_interval(F.col("id") % 1200)).cast("timestamp_ntz").alias("day"),
    )
    out = scd2.asof_join(facts, dim, "item", "day", spec)
    assert out.count() == 30_000  # every sale falls in exactly one version
    assert out.select("sale_id").distinct().count() == 30_000
    out.collect()  # run this plan itself so explain shows its final form
    out.explain()
    assert "skew=true" in capsys.readouterr().out
