"""Log properties: as_of(latest) == current, restore(n) == state at n, NULL conditions,
counts, diff, and versions or times outside the log."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.operators import changelog as log_of
from salesmart.operators.changelog import Versions, add_column, delete_rows, rename_column, update_rows

SCHEMA = "k int, qty int, note string"
KEY = ["k"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def t(i):
    return dt.datetime(2025, 8, 1) + dt.timedelta(hours=i)


def test_null_condition_keeps_row(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3, "b")], SCHEMA)
    assert rows(delete_rows(df, "qty = 3")) == [(1, None, "a")]
    assert rows(update_rows(df, "qty = 3", {"qty": "4"})) == [(1, None, "a"), (2, 4, "b")]


def test_schema_evolution(spark):
    df = spark.createDataFrame([(1, 2, "a")], SCHEMA)
    added = add_column(df, "region", "string")
    assert added.collect()[0].region is None
    renamed = rename_column(added, "note", "note_code")
    assert renamed.columns == ["k", "qty", "note_code", "region"]


ops = st.lists(
    st.one_of(
        st.tuples(st.just("update"), st.integers(0, 4), st.integers(0, 9)),
        st.tuples(st.just("delete"), st.integers(0, 4), st.just(0)),
        st.tuples(st.just("restore"), st.integers(0, 6), st.just(0)),
    ),
    min_size=1,
    max_size=3,
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(ops=ops)
def test_versions_replay(spark, ops):
    base = spark.createDataFrame([(k, k % 5, f"n{k}") for k in range(12)], SCHEMA)
    log, versions, states = log_of.initial_log(base, t(0)), Versions((t(0),)), [rows(base)]
    for i, (op, a, b) in enumerate(ops, start=1):
        current = log_of.as_of(log, KEY, versions)
        if op == "update":
            new = log_of.update_log(current, F.col("qty") == a, {"qty": F.lit(b)}, i, t(i))
            state = update_rows(current, F.col("qty") == a, {"qty": F.lit(b)})
        elif op == "delete":
            new = log_of.delete_log(current, F.col("qty") == a, i, t(i))
            state = delete_rows(current, F.col("qty") == a)
        else:
            target = min(a, len(states) - 1)
            new = log_of.restore_rows(log, KEY, versions, target, t(i))
            state = spark.createDataFrame(states[target], SCHEMA)
        states.append(rows(state))
        log = spark.createDataFrame(log.unionByName(new).collect(), log.schema)
        versions = versions.then(t(i))
    for n, expected in enumerate(states):
        assert rows(log_of.as_of(log, KEY, versions, version=n)) == expected
    assert rows(log_of.as_of(log, KEY, versions, ts=t(len(states) - 2))) == states[-2]
    assert rows(log_of.as_of(log, KEY, versions)) == states[-1]


def small_log(spark):
    base = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], SCHEMA)
    log = log_of.initial_log(base, t(0)).unionByName(log_of.update_log(base, "k = 1", {"note": "'z'"}, 1, t(1)))
    return log.unionByName(log_of.delete_log(base, "k = 2", 2, t(2))), Versions((t(0), t(1), t(2)))


def test_diff(spark):
    log, versions = small_log(spark)
    assert {r.k: (r.note, r.change_type) for r in log_of.diff(log, KEY, versions, 0, 2).collect()} == {1: ("z", "changed"), 2: ("b", "removed")}
    assert {r.k: (r.note, r.change_type) for r in log_of.diff(log, KEY, versions, 2, 0).collect()} == {1: ("a", "changed"), 2: ("b", "added")}
    assert log_of.diff(log, KEY, versions, 1, 1).count() == 0


def test_versions_and_times_outside_the_log_are_refused(spark):
    log, versions = small_log(spark)
    for asked in ({"version": 3}, {"version": -1}, {"ts": t(-1)}, {"version": 0, "ts": t(0)}):
        with pytest.raises(ValueError):
            log_of.as_of(log, KEY, versions, **asked)
    with pytest.raises(ValueError, match="no version -1"):
        log_of.restore_rows(log, KEY, versions, -1, t(3))


def test_a_back_dated_version_is_refused(spark):
    log, versions = small_log(spark)
    with pytest.raises(ValueError, match="must grow"):
        versions.then(t(1))
    with pytest.raises(ValueError, match="must grow"):
        log_of.restore_rows(log, KEY, versions, 0, t(2))


def test_versions_of_a_stored_log(spark, tmp_dir):
    log, versions = small_log(spark)
    log.write.partitionBy("_version").parquet(f"{tmp_dir}/log")
    stored = spark.read.parquet(f"{tmp_dir}/log").select(*log.columns)
    assert log_of.versions_of(stored) == versions
    assert rows(log_of.as_of(stored, KEY, versions, version=1)) == [(1, 1, "z"), (2, 2, "b"), (3, 3, "c")]
    back = stored.unionByName(log_of.stamp(spark.createDataFrame([(9, 9, "x")], SCHEMA), 3, t(0), "I", "WRITE"))
    with pytest.raises(ValueError, match="must grow"):
        log_of.versions_of(back)


def test_duplicate_and_null_keys_are_found(spark):
    from salesmart.operators.audit import assert_unique, duplicate_keys

    dup = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (2, 4, "d")], SCHEMA)
    assert sorted((r.k, r.n) for r in duplicate_keys(dup, KEY).collect() if r.k is not None) == [(1, 2)]
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(dup, KEY)
