"""Exact distributed percentiles against brute force; describe of mixed tables."""

import datetime as dt
import math
import random
import statistics
from decimal import Decimal

import pytest

from salesmart.operators.profile import column_quantiles, describe_long, describe_text, disc_rank, exact_quantiles, summary_long

PROBS = [0.0001, 0.25, 0.5, 0.75, 0.99, 1.0]


def brute(values, p):
    v = sorted(values, key=lambda x: (x != x, x))
    return v[disc_rank(len(v), p) - 1]


@pytest.mark.parametrize("buckets", [2, 8, 4096])
def test_exact_quantiles_match_brute_force(spark, buckets):
    rnd = random.Random(buckets)
    hot = rnd.uniform(0, 100)
    n = 3000 if buckets > 2 else 300
    a = [hot if rnd.random() < 0.34 else rnd.uniform(0, 100) for _ in range(n)]  # a third in one value
    b = [float(rnd.randint(0, 5)) for _ in range(n)]
    c = [rnd.gauss(0, 1) * 10 ** rnd.randint(-3, 6) for _ in range(n)]
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double")
    got = {(r.column_name, r.p): r.value for r in exact_quantiles(df, ["a", "b", "c"], PROBS, buckets=buckets).collect()}
    for name, vals in (("a", a), ("b", b), ("c", c)):
        for p in PROBS:
            assert got[(name, p)] == brute(vals, p), (name, p)


def test_own_types_are_exact(spark):
    big = [2**53 + 1, 2**53 + 3, 2**53 + 5, -(2**63), 2**63 - 1]
    cents = [Decimal("0.01"), Decimal("0.02"), Decimal("12345678901234567.89"), Decimal("-1.10"), Decimal("0.02")]
    df = spark.createDataFrame(list(zip(big, cents)), "a bigint, b decimal(38,2)")
    for p in PROBS:
        assert column_quantiles(df, ["a"], [p])["a"][p] == brute(big, p)
        assert column_quantiles(df, ["b"], [p], buckets=3)["b"][p] == brute(cents, p)


def test_nan_and_infinities_are_ranked_and_little_is_collected(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    rnd = random.Random(5)
    values = [rnd.uniform(-1, 1) for _ in range(3000)] + [float("nan"), float("inf"), -float("inf"), 1.7e308, -1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    seen = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (seen.append(collect(self)), seen[-1])[1])
    got = column_quantiles(df, ["x"], [0.0001, 0.5, 0.9996, 1.0], buckets=16)["x"]
    want = [brute(values, p) for p in got]
    assert all(a == b or (a != a and b != b) for a, b in zip(got.values(), want))
    assert max(map(len, seen)) <= 4 * 16


def test_nulls_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 1.0), (None, 1.0)], "x double, y double")
    got = {(r.column_name, r.p): r.value for r in exact_quantiles(df, ["x", "y"], [0.5]).collect()}
    assert got == {("x", 0.5): 2.0, ("y", 0.5): 1.0}
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, ["x"], [0.5]).first().value is None


def test_describe_and_summary(spark):
    vals = [float(i) for i in range(1, 11)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = describe_long(df, ["x"]).first()
    assert d["count"] == 10 and d["mean"] == 5.5 and d["min"] == 1.0 and d["max"] == 10.0
    assert math.isclose(d["stddev"], statistics.stdev(vals))
    s = summary_long(df, ["x"]).first()
    assert (s.p25, s.p50, s.p75) == (3.0, 5.0, 8.0)
    approx = summary_long(df, ["x"], exact=False).first()
    assert approx.p50 in (5.0, 6.0)


def test_small_means_are_not_rounded_away(spark):
    df = spark.createDataFrame([(1e-8,), (3e-8,)], "x double")
    assert math.isclose(describe_long(df).first()["mean"], 2e-8)


def test_a_mixed_table(spark):
    rows = [(1, "b", dt.date(2024, 1, 2), 0.5, Decimal("1.50"), True), (2**60 + 1, "a", None, None, Decimal("2.25"), None), (None, None, dt.date(2023, 1, 2), 1.5, None, False)]
    df = spark.createDataFrame(rows, "i bigint, s string, d date, x double, m decimal(9,2), f boolean")
    got = {r.column_name: r for r in summary_long(df).collect()}
    assert [got[c]["count"] for c in df.columns] == [2, 2, 2, 2, 2, 2]
    assert (got["i"].min_text, got["i"].max_text) == ("1", str(2**60 + 1)) and got["i"].p50 == 1.0
    assert (got["s"].min_text, got["s"].max_text, got["s"].mean, got["s"].p50) == ("a", "b", None, None)
    assert (got["d"].min_text, got["d"].max_text) == ("2023-01-02", "2024-01-02")
    assert (got["x"].min, got["x"].max, got["x"].min_text) == (0.5, 1.5, None)
    assert (got["m"].min_text, got["m"].p75) == ("1.50", 2.25)
    assert [r.column_name for r in describe_text(df).collect()] == ["s"]
