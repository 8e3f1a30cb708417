import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.operators import changelog
from salesmart.operators.changelog import Versions
from salesmart.operators.schema_history import SchemaHistory, append_log, as_of, schema_changes

T = [dt.datetime(2024, 5, d) for d in range(1, 9)]
BASE = SchemaHistory((("k", "bigint"), ("a", "string")))


@pytest.fixture
def table(spark):
    """v0 write; v1 add b; v2 update; v3 rename a to c; v4 rename c to d; v5 add a; v6 update; v7 rename k to id."""
    history = BASE.add_column(1, "b", "int").rename_column(3, "a", "c").rename_column(4, "c", "d").add_column(5, "a", "double").rename_column(7, "k", "id")
    log = append_log(None, changelog.initial_log(spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k bigint, a string"), T[0]), history, 0)
    log = append_log(log, changelog.stamp(spark.createDataFrame([(2, "y2", 5)], "k bigint, a string, b int"), 2, T[2], "U", "UPDATE"), history, 2)
    rows = spark.createDataFrame([(3, "z3", None, 1.5)], "k bigint, d string, b int, a double")
    log = append_log(log, changelog.stamp(rows, 6, T[6], "U", "UPDATE"), history, 6)
    return log, history, Versions(tuple(T))


@pytest.mark.parametrize(
    "version, names, rows",
    [
        (0, ["k", "a"], [(1, "x"), (2, "y"), (3, "z")]),
        (1, ["k", "a", "b"], [(1, "x", None), (2, "y", None), (3, "z", None)]),
        (2, ["k", "a", "b"], [(1, "x", None), (2, "y2", 5), (3, "z", None)]),
        (3, ["k", "c", "b"], [(1, "x", None), (2, "y2", 5), (3, "z", None)]),
        (4, ["k", "d", "b"], [(1, "x", None), (2, "y2", 5), (3, "z", None)]),
        (5, ["k", "d", "b", "a"], [(1, "x", None, None), (2, "y2", 5, None), (3, "z", None, None)]),
        (6, ["k", "d", "b", "a"], [(1, "x", None, None), (2, "y2", 5, None), (3, "z3", None, 1.5)]),
        (7, ["id", "d", "b", "a"], [(1, "x", None, None), (2, "y2", 5, None), (3, "z3", None, 1.5)]),
    ],
)
def test_each_version_has_its_columns(table, version, names, rows):
    log, history, versions = table
    df = as_of(log, history, ["k"], versions, version)
    assert df.columns == names and df.schema.simpleString() == history.schema(version).simpleString()
    assert sorted(map(tuple, df.collect())) == rows


def test_by_time_and_latest(table):
    log, history, versions = table
    assert as_of(log, history, ["k"], versions, ts=T[3] + dt.timedelta(hours=1)).columns == ["k", "c", "b"]
    assert as_of(log, history, ["k"], versions).columns == ["id", "d", "b", "a"]
    with pytest.raises(ValueError):
        as_of(log, history, ["k"], versions, 8)


def test_a_name_may_be_used_again(table):
    _, history, _ = table
    first = {c.name: c.id for c in history.columns(0)}
    last = {c.name: c.id for c in history.columns(7)}
    assert first["a"] == last["d"] != last["a"]


def test_restored_rows_keep_their_identities(table):
    log, history, versions = table
    restored = changelog.restore_rows(log, history.ids(0, ["k"]), versions, 0, T[7] + dt.timedelta(days=1))
    again = as_of(log.unionByName(restored), history, ["k"], versions.then(T[7] + dt.timedelta(days=1)))
    assert sorted(map(tuple, again.collect())) == [(1, "x", None, None), (2, "y", None, None), (3, "z", None, None)]


def test_only_needed_columns_are_read(table, spark, tmp_dir):
    log, history, versions = table
    log.write.partitionBy("_version").parquet(tmp_dir + "/log")
    stored = spark.read.parquet(tmp_dir + "/log")
    plan = as_of(stored, history, ["k"], versions, 2).select("k", "a")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("ReadSchema") :]
    assert "c0:" in scan and "c1:" in scan and "c2:" not in scan and "c3:" not in scan


@pytest.mark.parametrize(
    "change",
    [
        lambda h: h.add_column(1, "A", "int"),
        lambda h: h.rename_column(1, "zz", "q"),
        lambda h: h.rename_column(1, "a", "K"),
        lambda h: h.add_column(0, "q", "int"),
        lambda h: h.add_column(2, "q", "int").add_column(1, "r", "int"),
        lambda h: h.rename_column(1, "a", "b").rename_column(2, "a", "c"),
    ],
)
def test_impossible_changes_fail(change):
    with pytest.raises(ValueError):
        change(BASE)


def test_case_of_a_name_may_change(spark):
    history = BASE.rename_column(1, "a", "A")
    assert [c.name for c in history.columns(1)] == ["k", "A"]


def test_unknown_columns_of_rows_fail(spark):
    with pytest.raises(ValueError):
        BASE.stored(spark.range(1).withColumn("b", F.lit(1)), 0)


def test_listing(table):
    _, history, versions = table
    assert schema_changes(history, versions)[:2] == [(1, T[1], "ADD COLUMN b int"), (3, T[3], "RENAME COLUMN a TO c")]
