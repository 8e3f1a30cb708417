import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators import scd2
from salesmart.operators.history import asof_carried, load_extracts, overlapping_versions, repeated_extracts, unmatched_carried
from salesmart.operators.ordered import carried, ranged

SPEC = scd2.Scd2Spec(key="k", attrs=("a", "b"), default_start=dt.datetime(2000, 1, 1))
DIM = "SurrogateKey string, k bigint, a string, b int, Valid_Start_Date timestamp_ntz, Valid_End_Date timestamp_ntz"
FACTS = "f int, fk bigint, on_date timestamp_ntz"
STAGE = "k bigint, a string, b int, at timestamp_ntz"


def day(n):
    return dt.datetime(2010, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("own, backward", [(True, False), (False, False), (False, True)])
def test_carried_over_borders(spark, parts, own, backward):
    rng = random.Random(parts)
    data = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), n, rng.choice([None, None, None, n])) for n in range(200)]
    df = ranged(spark.createDataFrame(data, "k int, n int, v int"), ["k"], ["n"], parts)
    got = {r.n: r.c for r in carried(df, ["k"], ["n"], F.col("v"), "c", own, backward).collect()}
    for k, n, _ in data:
        seen = [x for kk, nn, x in data if kk == k and x is not None and ((nn > n) if backward else (nn < n or own and nn == n))]
        assert got[n] == ((min(seen) if backward else max(seen)) if seen else None)


def history(rng, keys=6):
    """Versions of several keys that do not overlap, some with gaps and some of no length."""
    out = []
    for k in range(keys):
        at = rng.randint(0, 20)
        for _ in range(rng.randint(0, 12)):
            end = at + rng.randint(0, 15)
            last = rng.random() < 0.1
            out.append((f"s{len(out)}", k, rng.choice("xyz"), 1, day(at), None if last else day(end)))
            if last:
                break
            at = end + rng.choice([0, 0, 0, 5])
    return out


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 4), (3, 16)])
def test_asof_equals_the_interval_join(spark, seed, parts):
    rng = random.Random(seed)
    dim = spark.createDataFrame(history(rng), DIM)
    facts = [(n, rng.choice([None, 9, 2, *range(6)]), rng.choice([None, *[day(rng.randint(0, 150)) for _ in range(6)]])) for n in range(400)]
    facts = spark.createDataFrame(facts + facts[:20], FACTS)
    assert overlapping_versions(dim, SPEC, parts).count() == 0
    assert rows(asof_carried(facts, dim, "fk", "on_date", SPEC, parts)) == rows(scd2.asof_join(facts, dim, "fk", "on_date", SPEC))
    assert rows(unmatched_carried(facts, dim, "fk", "on_date", SPEC, parts)) == rows(scd2.unmatched_facts(facts, dim, "fk", "on_date", SPEC))


def test_empty_sides(spark):
    dim, facts = spark.createDataFrame([], DIM), spark.createDataFrame([(1, 1, day(1))], FACTS)
    assert rows(asof_carried(facts, dim, "fk", "on_date", SPEC)) == []
    assert rows(unmatched_carried(facts, dim, "fk", "on_date", SPEC)) == [(1, 1, day(1))]
    assert rows(asof_carried(facts.limit(0), dim, "fk", "on_date", SPEC)) == []


def test_overlaps_are_listed(spark):
    dim = spark.createDataFrame([("s", 1, "x", 1, day(0), day(9)), ("t", 1, "x", 1, day(8), None), ("u", 2, "x", 1, day(0), None)], DIM)
    assert [r.SurrogateKey for r in overlapping_versions(dim, SPEC).collect()] == ["t"]


def test_a_hot_key_with_a_long_history_is_spread(spark):
    n = 100_000
    versions = spark.range(n).select(
        F.col("id").cast("string").alias("SurrogateKey"), F.lit(1).cast("bigint").alias("k"), F.lit("x").alias("a"), F.lit(1).alias("b"),
        (F.lit(day(0)) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("Valid_Start_Date"),
        (F.lit(day(0)) + F.make_dt_interval(mins=(F.col("id") + 1).cast("int"))).cast("timestamp_ntz").alias("Valid_End_Date"),
    )
    facts = spark.range(60_000).select(
        F.col("id").cast("int").alias("f"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).cast("bigint").alias("fk"),
        (F.lit(day(0)) + F.make_dt_interval(mins=F.pmod(F.col("id") * 37, F.lit(n)).cast("int"), secs=F.lit(30))).cast("timestamp_ntz").alias("on_date"),
    )
    keyed = asof_carried(facts, versions, "fk", "on_date", SPEC, 12)
    assert keyed.count() == 20_000
    assert keyed.where(F.col("SurrogateKey").cast("long") != F.pmod(F.col("f").cast("long") * 37, F.lit(n))).count() == 0
    # The key lies in several ranges, none of them much larger than the others.
    stream = ranged(facts.unionByName(versions.select(F.lit(0).alias("f"), F.col("k").alias("fk"), F.col("Valid_Start_Date").alias("on_date"))), ["fk"], ["on_date"], 12)
    sizes = [r["count"] for r in stream.groupBy("__part").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 3 * sum(sizes) / len(sizes)


def one_by_one(spark, dim, staged):
    """The dimension after one load per extract time, in order."""
    for at in sorted({r[3] for r in staged}):
        stage = spark.createDataFrame([r[:3] for r in staged if r[3] == at], "k bigint, a string, b int")
        dim = spark.createDataFrame(scd2.load(dim, stage, SPEC, at).collect(), DIM)
    return dim


@pytest.mark.parametrize("seed, parts", [(1, 2), (2, 5)])
def test_extracts_equal_loads_one_by_one(spark, seed, parts):
    rng = random.Random(seed)
    start = scd2.initial_dimension(spark.createDataFrame([(k, "x", 1) for k in (1, 2, 3, 4)], "k bigint, a string, b int"), SPEC, day(0))
    staged = [(k, rng.choice(["x", "y", None]), rng.choice([1, 2]), day(10 * n)) for n in range(1, 7) for k in range(8) if rng.random() < 0.7]
    want = one_by_one(spark, start, staged)
    got = load_extracts(start, spark.createDataFrame(staged, STAGE), SPEC, "at", parts)
    assert got.columns == SPEC.dim_columns
    assert rows(got) == rows(want)
    # In two halves, too: what the first load made is the second's dimension.
    half = spark.createDataFrame(load_extracts(start, spark.createDataFrame([r for r in staged if r[3] <= day(30)], STAGE), SPEC, "at").collect(), DIM)
    assert rows(load_extracts(half, spark.createDataFrame([r for r in staged if r[3] > day(30)], STAGE), SPEC, "at", parts)) == rows(want)


@pytest.mark.parametrize("late", [10, 20, 30, 40])
def test_a_late_extract_divides_a_version(spark, late):
    # States that all differ from their neighbours, so that the versions hold every extract.
    staged = [(k, f"{k}{n}", n, day(10 * n)) for n in (1, 2, 3, 4) for k in range(3)]
    none = spark.createDataFrame([], DIM)
    start = scd2.initial_dimension(spark.createDataFrame([(0, "x", 1), (1, "x", 1), (2, "x", 1)], "k bigint, a string, b int"), SPEC, day(0))
    want = one_by_one(spark, start, staged)
    first = spark.createDataFrame(one_by_one(spark, start, [r for r in staged if r[3] != day(late)]).collect(), DIM)
    assert rows(load_extracts(first, spark.createDataFrame([r for r in staged if r[3] == day(late)], STAGE), SPEC, "at")) == rows(want)
    assert rows(load_extracts(none, spark.createDataFrame(staged, STAGE), SPEC, "at")) == rows(one_by_one(spark, none, staged))


def test_gaps_and_versions_of_no_length(spark):
    old = [("s", 1, "x", 1, day(0), day(5)), ("t", 1, "x", 1, day(9), None), ("u", 2, "x", 1, day(3), day(3)), ("v", None, "x", 1, day(3), None)]
    dim = spark.createDataFrame(old, DIM)
    staged = spark.createDataFrame([(1, "x", 1, day(4)), (1, "x", 1, day(12)), (None, "x", 1, day(4)), (3, "x", 1, None), (2, "y", 1, day(8))], STAGE)
    got = rows(load_extracts(dim, staged, SPEC, "at"))
    assert [r[1:] for r in got if r[1] == 1] == [(1, "x", 1, day(0), day(5)), (1, "x", 1, day(9), None)]
    assert {r[0] for r in got} >= {"s", "t", "u", "v"}
    assert [r[1:] for r in got if r[1] == 2 and r[0] != "u"] == [(2, "y", 1, day(8), None)]
    assert len(got) == 5


def test_a_hot_key_of_many_extracts(spark):
    staged = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias("k"),
        (F.col("id") / 3 / 4).cast("int").cast("string").alias("a"), F.lit(1).alias("b"),
        (F.lit(day(0)) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("at"),
    )
    got = load_extracts(spark.createDataFrame([], DIM), staged, SPEC, "at", 10).where("k = 1").cache()
    assert got.count() == 2500
    assert got.where("Valid_End_Date is null").count() == 1
    starts = [r[0] for r in got.select("Valid_Start_Date").orderBy("Valid_Start_Date").collect()]
    ends = [r[0] for r in got.select("Valid_End_Date").orderBy(F.col("Valid_End_Date").asc_nulls_last()).collect()]
    assert ends[:-1] == starts[1:] and starts[0] == SPEC.default_start


def test_repeated_extracts_are_listed(spark):
    staged = spark.createDataFrame([(1, "x", 1, day(1)), (1, "y", 1, day(1)), (2, "x", 1, day(1)), (None, "x", 1, day(1))], STAGE)
    assert {(r.k, r.n) for r in repeated_extracts(staged, SPEC, "at").collect()} == {(1, 2), (None, 1)}
