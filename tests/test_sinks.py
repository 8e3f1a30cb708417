"""Writers: create (fails if present), overwrite, append, typed create, copy."""

import os

import pytest
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from salesmart.sources.sinks import (
    append_by_name,
    append_path,
    copy_table,
    create_if_not_exists,
    create_table,
    ddl,
    overwrite_path,
    overwrite_table,
)


def test_create_then_fail_then_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    path = os.path.join(tmp_dir, "t1")
    create_table(df, "sink_t1", path=path)
    with pytest.raises(AnalysisException):
        create_table(df, "sink_t1", path=path)
    overwrite_table(spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string"), "sink_t1", path=path)
    assert spark.table("sink_t1").count() == 2
    spark.sql("DROP TABLE sink_t1")


def test_overwrite_and_append_path(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, batch string")
    overwrite_path(df, path, partition_by=["batch"])
    append_path(spark.createDataFrame([(3, "z")], "id int, batch string"), path, partition_by=["batch"])
    assert spark.read.parquet(path).count() == 3
    overwrite_path(spark.createDataFrame([(9, "x")], "id int, batch string"), path, partition_by=["batch"])
    got = sorted((r.id, r.batch) for r in spark.read.parquet(path).collect())
    assert got == [(2, "y"), (3, "z"), (9, "x")]  # only batch x replaced


def test_typed_create_and_insert_with_columns(spark, tmp_dir):
    schema = T.StructType([T.StructField("order_id", T.StringType(), False), T.StructField("qty", T.IntegerType())])
    assert ddl(schema) == "`order_id` string NOT NULL, `qty` int"
    create_if_not_exists(spark, "sink_t2", schema, os.path.join(tmp_dir, "t2"))
    create_if_not_exists(spark, "sink_t2", schema, os.path.join(tmp_dir, "t2"))  # no error the second time
    spark.sql("INSERT INTO sink_t2 (order_id) VALUES ('O-1')")
    assert spark.table("sink_t2").first().qty is None
    spark.sql("DROP TABLE sink_t2")


def test_append_by_name_and_copy(spark):
    target = spark.createDataFrame([(1, "N")], "id int, region string")
    rows = spark.createDataFrame([(2,)], "id int")
    out = append_by_name(target, rows).collect()
    assert sorted((r.id, r.region) for r in out) == [(1, "N"), (2, None)]
    copy = copy_table(spark, target, "copy_test")
    assert [tuple(r) for r in copy.collect()] == [(1, "N")]


@pytest.mark.parametrize("name", ["dim_customer", "fact_sales", "sales", "dim_item", "sales_fact"])
def test_declared_schemas_create(spark, tmp_dir, name):
    from salesmart.sources.schemas import TABLES

    table = f"sink_{name}"
    create_if_not_exists(spark, table, TABLES[name], os.path.join(tmp_dir, name))
    got = spark.table(table).schema
    assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in TABLES[name].fields]
    spark.sql(f"DROP TABLE {table}")


def test_two_copies_do_not_destroy_each_other(spark):
    from salesmart.plans import catalog

    catalog.load_all()
    for name in ("copy_table", "csv_combine"):
        a = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        b = catalog.QUERIES[name](spark, "/root/testdata/sf0.01")
        assert 0 < a.count() < b.count()


def test_shared_folder_outlives_the_session_and_must_be_shared():
    from types import SimpleNamespace

    from salesmart import session

    def spark_with(master, folder):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: "hdfs://x/ckpt/some-id", setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: folder))

    for master, folder in (("local[2]", "file:/x"), ("yarn", "hdfs://x/ckpt")):
        assert session.table_path(spark_with(master, folder), "t") == f"{folder}/tables/t"
        assert session.own_path(spark_with(master, folder), "t") != session.own_path(spark_with(master, folder), "t")
    with pytest.raises(RuntimeError, match="shared storage"):
        session.shared_dir(spark_with("yarn", "file:/x"))
