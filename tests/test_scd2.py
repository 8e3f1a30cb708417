"""Type 2 dimension cases: unchanged, changed, new, A -> B -> A, missing from
stage, sale at a start and at an end, sale before the first version, empty
inputs, and the same stage loaded twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.operators import scd2

SPEC = scd2.Scd2Spec(key="Item_Id", attrs=("Name", "Brand"), default_start=dt.datetime(2018, 1, 1),
                     surrogate="Item_SurrogateKey")
T1 = dt.datetime(2024, 3, 1, 10, 0)
T2 = dt.datetime(2024, 6, 1, 10, 0)
ITEM_COLS = "Item_Id int, Name string, Brand string"


def dim_from(spark, rows, start=dt.datetime(2020, 1, 1)):
    return scd2.initial_dimension(spark.createDataFrame(rows, ITEM_COLS), SPEC, start)


def stage(spark, rows):
    return spark.createDataFrame(rows, ITEM_COLS)


def by_key(df):
    out = {}
    for r in df.orderBy("Item_Id", "Valid_Start_Date").collect():
        out.setdefault(r.Item_Id, []).append(r)
    return out


def test_unchanged_changed_new_and_missing(spark):
    dim = dim_from(spark, [(1, "a", "X"), (2, "b", "Y"), (3, "c", "Z")])
    stg = stage(spark, [(1, "a", "X"), (2, "b", "Y2"), (4, "d", "W")])  # 3 missing from stage
    out = by_key(scd2.load(dim, stg, SPEC, T1))
    assert len(out[1]) == 1 and out[1][0].Valid_End_Date is None
    assert [r.Brand for r in out[2]] == ["Y", "Y2"]
    assert out[2][0].Valid_End_Date == T1 and out[2][1].Valid_Start_Date == T1 and out[2][1].Valid_End_Date is None
    assert out[3][0].Valid_End_Date is None  # not staged: stays open
    assert out[4][0].Valid_Start_Date == dt.datetime(2018, 1, 1)  # first seen: default start
    sks = [r.Item_SurrogateKey for rows in out.values() for r in rows]
    assert len(set(sks)) == len(sks) and all(len(s) == 64 for s in sks)


@pytest.mark.parametrize("match,inserted,open_rows", [("history", 0, 0), ("current", 1, 1)])
def test_a_b_a(spark, match, inserted, open_rows):
    dim = dim_from(spark, [(1, "a", "A")])
    dim = scd2.load(dim, stage(spark, [(1, "a", "B")]), SPEC, T1, match)
    closed = scd2.close_changed(dim, stage(spark, [(1, "a", "A")]), SPEC, T2)
    new = scd2.new_versions(closed, stage(spark, [(1, "a", "A")]), SPEC, T2, match)
    assert new.count() == inserted
    after = closed.unionByName(new)
    assert after.filter(F.col("Valid_End_Date").isNull()).count() == open_rows


def test_same_stage_twice_is_idempotent(spark):
    dim = dim_from(spark, [(1, "a", "X"), (2, "b", "Y")])
    stg = stage(spark, [(1, "a", "X2"), (2, "b", "Y"), (5, "e", "V")])
    once = scd2.load(dim, stg, SPEC, T1)
    twice = scd2.load(once, stg, SPEC, T2)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_empty_dimension_and_empty_stage(spark):
    empty_dim = dim_from(spark, []).limit(0)
    stg = stage(spark, [(1, "a", "X")])
    out = scd2.load(empty_dim, stg, SPEC, T1).collect()
    assert len(out) == 1 and out[0].Valid_Start_Date == dt.datetime(2018, 1, 1)
    dim = dim_from(spark, [(1, "a", "X")])
    same = scd2.load(dim, stage(spark, []), SPEC, T1)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, dim.collect()))


def test_asof_join_edges(spark):
    dim = dim_from(spark, [(1, "a", "A")])
    dim = scd2.load(dim, stage(spark, [(1, "a", "B")]), SPEC, T1)
    versions = {r.Brand: r.Item_SurrogateKey for r in dim.collect()}
    facts = spark.createDataFrame(
        [(10, 1, dt.datetime(2020, 1, 1)),  # exactly at the first start
         (11, 1, T1 - dt.timedelta(microseconds=1)),
         (12, 1, T1),  # exactly at the end of A = start of B
         (13, 1, dt.datetime(2019, 12, 31)),  # before any version
         (14, 2, T1)],  # unknown item
        "Order_No int, Item_ID int, Sales_Date timestamp_ntz",
    )
    got = {r.Order_No: r.Item_SurrogateKey for r in scd2.asof_join(facts, dim, "Item_ID", "Sales_Date", SPEC).collect()}
    assert got == {10: versions["A"], 11: versions["A"], 12: versions["B"]}
    dropped = scd2.unmatched_facts(facts, dim, "Item_ID", "Sales_Date", SPEC)
    assert sorted(r.Order_No for r in dropped.collect()) == [13, 14]


def test_intervals_never_overlap_and_one_open_row(spark):
    import random

    rnd = random.Random(7)
    dim = dim_from(spark, [(k, "n", "b0") for k in range(20)])
    times = [dt.datetime(2021 + i, 1, 1) for i in range(4)]
    staged = set()
    for t in times:
        rows = [(k, "n", f"b{rnd.randint(0, 2)}") for k in range(25) if rnd.random() < 0.8]
        staged = {r[0] for r in rows}
        dim = scd2.load(dim, stage(spark, rows), SPEC, t, "current")
        dim = spark.createDataFrame(dim.collect(), dim.schema)  # keep the test plan small
    for key, rows in by_key(dim).items():
        opened = [r for r in rows if r.Valid_End_Date is None]
        assert len(opened) <= 1
        if key in staged:
            assert len(opened) == 1
        for a, b in zip(rows, rows[1:]):
            assert a.Valid_End_Date is not None and a.Valid_End_Date <= b.Valid_Start_Date


def test_bucketed_asof_join_equals_plain(spark):
    import random

    rnd = random.Random(3)
    dim = dim_from(spark, [(k, "n", "b0") for k in range(6)], start=dt.datetime(2019, 1, 1))
    for i, t in enumerate([dt.datetime(2020, 3, 1), dt.datetime(2020, 3, 9), dt.datetime(2021, 7, 1), dt.datetime(2023, 1, 1)]):
        dim = scd2.load(dim, stage(spark, [(k, "n", f"b{i}{rnd.randint(0, 1)}") for k in range(6)]), SPEC, t)
    dim = spark.createDataFrame(dim.collect(), dim.schema)
    facts = spark.createDataFrame(
        [(i, rnd.randint(0, 7), dt.datetime(2018, 6, 1) + dt.timedelta(days=rnd.randint(0, 2200), hours=rnd.randint(0, 23)))
         for i in range(400)],
        "Order_No int, Item_ID int, Sales_Date timestamp_ntz",
    )
    plain = sorted(tuple(r) for r in scd2.asof_join(facts, dim, "Item_ID", "Sales_Date", SPEC).collect())
    for days in (30, 365):
        bucketed = scd2.asof_join(facts, dim, "Item_ID", "Sales_Date", SPEC, bucket_days=days)
        assert sorted(tuple(r) for r in bucketed.collect()) == plain
    assert len(plain) > 0


def test_csv_items_to_dimension_with_declared_schema(spark, tmp_dir):
    """Landed item CSV -> normalised columns -> type 2 dimension whose columns
    and types are the declared item dimension's."""
    import os

    from salesmart.sources.csv import read_landed_csv
    from salesmart.sources.schemas import DIM_ITEM

    header = "Item Id,Name,Brand Id,Category Id,Sub Category Id,Brand,Category,Sub Category"
    lines = [f"{i},Item {i},{i % 3},{i % 2},{i % 4},Brand {i % 3},Category {i % 2},Sub Cat {i % 4}" for i in range(1, 8)]
    path = os.path.join(tmp_dir, "item.csv")
    with open(path, "wb") as f:
        f.write(b"\xef\xbb\xbf" + ("\r\n".join([header] + lines) + "\r\n").encode())
    items = read_landed_csv(spark, path)
    spec = scd2.Scd2Spec(
        key="Item_Id",
        attrs=("Name", "Brand_Id", "Category_Id", "Sub_Category_Id", "Brand", "Category", "Sub_Category"),
        default_start=dt.datetime(2018, 1, 1),
        surrogate="Item_SurrogateKey",
    )
    dim = scd2.initial_dimension(items, spec, dt.datetime(2018, 1, 1))
    assert [(f.name, f.dataType) for f in dim.schema.fields] == [(f.name, f.dataType) for f in DIM_ITEM.fields]
    changed = items.withColumn("Brand", F.when(F.col("Item_Id") == 3, F.lit("Brand X")).otherwise(F.col("Brand")))
    after = scd2.load(dim, changed, spec, T1)
    assert after.count() == 8
    assert after.filter(F.col("Valid_End_Date").isNull()).count() == 7


def test_rerun_of_a_fact_batch_replaces_it(spark, tmp_dir):
    """Loading the same staged facts twice leaves them once: the batch is
    landed with dynamic partition overwrite on its batch id."""
    import os

    dim = dim_from(spark, [(1, "a", "A"), (2, "b", "B")])
    facts = spark.createDataFrame(
        [(10, 1, dt.datetime(2021, 1, 1), "b1"), (11, 2, dt.datetime(2021, 1, 2), "b1")],
        "Order_No int, Item_ID int, Sales_Date timestamp_ntz, batch string",
    )
    other = facts.withColumn("batch", F.lit("b0"))
    path = os.path.join(tmp_dir, "sales_fact")
    scd2.land_facts(scd2.asof_join(other, dim, "Item_ID", "Sales_Date", SPEC), path, "batch")
    for _ in range(2):
        scd2.land_facts(scd2.asof_join(facts, dim, "Item_ID", "Sales_Date", SPEC), path, "batch")
    landed = spark.read.parquet(path)
    assert landed.count() == 4
    assert {r.batch: r["count"] for r in landed.groupBy("batch").count().collect()} == {"b0": 2, "b1": 2}


def test_stage_with_a_repeated_key_is_refused(spark):
    with pytest.raises(ValueError, match="not unique"):
        scd2.check_stage(stage(spark, [(1, "a", "Y"), (1, "a", "Z")]), SPEC)


def test_versions_within_a_second_have_their_own_keys(spark):
    dim = dim_from(spark, [(1, "a", "X")], start=dt.datetime(2024, 1, 1, 0, 0, 0, 100_000))
    out = scd2.load(dim, stage(spark, [(1, "a", "Y")]), SPEC, dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)).collect()
    assert len({r.Item_SurrogateKey for r in out}) == len(out) == 2


def test_bucketed_unmatched_facts_equal_plain(spark):
    dim = dim_from(spark, [(1, "a", "X"), (2, "b", "Y")])
    facts = spark.createDataFrame(
        [(i, i % 4, dt.datetime(2019, 1, 1) + dt.timedelta(days=13 * i)) for i in range(80)], "Order_No int, Item_ID int, Sales_Date timestamp_ntz"
    )
    plain = sorted(map(tuple, scd2.unmatched_facts(facts, dim, "Item_ID", "Sales_Date", SPEC).collect()))
    assert plain and sorted(map(tuple, scd2.unmatched_facts(facts, dim, "Item_ID", "Sales_Date", SPEC, bucket_days=90).collect())) == plain
    none = facts.limit(0)
    assert scd2.asof_join(none, dim, "Item_ID", "Sales_Date", SPEC, bucket_days=90).collect() == []
