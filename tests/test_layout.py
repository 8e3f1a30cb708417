"""Bucketed landing: a join of two tables bucketed on the key has no shuffle;
a stored log of changes is read with partition pruning on the version."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from salesmart.operators import changelog
from salesmart.sources.layout import land_bucketed
from tests.conftest import SF_SMALL


def test_bucketed_join_has_no_exchange(spark, tmp_dir, capsys):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bl = land_bucketed(li, "bucketed_lineitem", "l_orderkey", 8, os.path.join(tmp_dir, "bl"))
        bo = land_bucketed(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "bucketed_orders", "l_orderkey", 8,
                           os.path.join(tmp_dir, "bo"))
        joined = bl.join(bo, "l_orderkey")
        joined.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucketed_lineitem")
        spark.sql("DROP TABLE IF EXISTS bucketed_orders")


def test_stored_log_prunes_versions(spark, tmp_dir, capsys):
    base = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, qty int, note string")
    t0 = dt.datetime(2025, 1, 1)
    t1 = t0 + dt.timedelta(hours=1)
    log = changelog.initial_log(base, t0).unionByName(changelog.update_log(base, "k = 1", {"qty": "5"}, 1, t1))
    log.write.partitionBy("_version").parquet(os.path.join(tmp_dir, "log"))
    stored = spark.read.parquet(os.path.join(tmp_dir, "log"))
    changelog.as_of(stored, ["k"], changelog.Versions((t0, t1)), version=0).explain(mode="formatted")
    assert re.search(r"PartitionFilters: \[isnotnull\(_version#\d+\), \(_version#\d+ <= 0\)\]", capsys.readouterr().out)
