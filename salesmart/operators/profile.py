"""Column profiles: ``describe`` and ``summary`` of whole, mixed tables.

``describe_long`` computes count, mean, sample standard deviation, min and max
of every column in **one** aggregate pass (partial aggregates per task, one
tiny merge) and unpivots the single result row to one row per column.  Numbers
have mean, stddev, min and max as doubles; every type but the floating ones also
has its exact smallest and largest value as text.

``exact_quantiles`` gives exact discrete percentiles (the SQL ``PERCENTILE_DISC``
rank ``ceil(p * n)``) in the column's own type without holding a column's values
in one task.  For each column, a target's value window starts as the whole range
and is narrowed by grouped histograms: one scan of that column, limited to the
open windows, counts equal-width buckets (at most ``buckets`` rows per window
reach the driver), and the bucket with the target rank, cut to the values found
in it, is the next window.  The smallest and the largest value of a window fall
in different buckets, so each round narrows every window, until it holds one
value: the answer.  Infinities and NaN, which no width divides, are counted
apart and ranked as Spark sorts them (NaN largest).
``summary_long(..., exact=False)`` uses ``percentile_approx`` (bounded sketch,
Spark's own ``summary`` behaviour) instead.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def describe_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column (all of ``df`` by default), one pass: column_name,
    count, mean, stddev, min, max (numbers only), min_text, max_text (all types
    but floating numbers: exact, binary order for text)."""
    cols = df.columns if cols is None else cols
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x, number = F.col(c), is_numeric(df, c)
        text = not isinstance(df.schema[c].dataType, _FLOATS)
        d = x.cast("double") if number else F.lit(None).cast("double")
        parts = {
            "count": F.count(x),
            "mean": F.avg(d),
            "stddev": F.stddev_samp(d),
            "min": F.min(d),
            "max": F.max(d),
            "min_text": F.min(x).cast("string") if text else F.first(F.lit(None).cast("string")),
            "max_text": F.max(x).cast("string") if text else F.first(F.lit(None).cast("string")),
        }
        aggs += [a.alias(f"c{i}_{n}") for n, a in parts.items()]
        rows.append(F.struct(F.lit(c).alias("column_name"), *[F.col(f"c{i}_{n}").alias(n) for n in parts]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def disc_rank(n: int, p: float) -> int:
    """1-based rank of the discrete ``p`` percentile among ``n`` values."""
    return max(1, math.ceil(Fraction(str(p)) * n))


def _bucket(x: Column, lo, hi, kind: T.DataType, buckets: int) -> Column:
    """Bucket of a value of [lo, hi]: ``lo`` falls in the first and ``hi`` in the last one."""
    if isinstance(kind, _FLOATS):
        # Halves first: the width of a window may exceed the largest double.
        width = F.lit(hi / 2 - lo / 2)
        share = (x.cast("double") / 2 - F.lit(lo / 2)) / width
        return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")
    # Exact for integers and decimals: whole units of the last digit, no rounding.
    unit = 10 ** getattr(kind, "scale", 0)
    step = -(-(int(hi * unit) - int(lo * unit) + 1) // buckets)
    if isinstance(kind, T.IntegralType) and hi - lo < 2**62:
        place = x.cast("bigint") - F.lit(lo)
        return ((place - place % F.lit(step)) / F.lit(step)).cast("int")  # a multiple of the step: exact
    place = (x.cast(T.DecimalType(38, getattr(kind, "scale", 0))) - F.lit(lo)) * F.lit(unit)
    return F.floor(place.cast("decimal(38,0)") / F.lit(step).cast("decimal(38,0)")).cast("int")


@dataclass(frozen=True)
class _Range:
    """The finite values of a column: how many, least and largest; the others by value."""

    n: int
    lo: object
    hi: object
    specials: dict


def _ranges(df: DataFrame, cols: list[str]) -> dict[str, _Range]:
    """All columns in one aggregate pass."""
    inf, aggs = float("inf"), []
    for i, c in enumerate(cols):
        x = F.col(c)
        if isinstance(df.schema[c].dataType, _FLOATS):
            tests = (x == -inf, x == inf, F.isnan(x))
            aggs += [F.count_if(t).alias(f"c{i}_{k}") for k, t in enumerate(tests)]
            x = F.when(~(F.isnan(x) | (F.abs(x) == inf)), x)
        aggs += [F.count(x).alias(f"c{i}_n"), F.min(x).alias(f"c{i}_lo"), F.max(x).alias(f"c{i}_hi")]
    row = df.agg(*aggs).first().asDict() if aggs else {}
    out = {}
    for i, c in enumerate(cols):
        specials = {v: row.get(f"c{i}_{k}", 0) for k, v in enumerate((-inf, inf, math.nan))}
        out[c] = _Range(row[f"c{i}_n"], row[f"c{i}_lo"], row[f"c{i}_hi"], specials)
    return out


def _narrow(df: DataFrame, column: str, probs: list[float], found: _Range, buckets: int) -> dict:
    """``{p: value}`` of one column by narrowing value windows."""
    inf, kind = float("inf"), df.schema[column].dataType
    below, above, nans = (found.specials[v] for v in found.specials)
    n = below + found.n + above + nans
    x = F.col("__x")
    answers: dict = dict.fromkeys(probs)
    windows: dict = {}  # p -> (lo, hi, values below lo, rank)
    for p in probs if n else []:
        rank = disc_rank(n, p)
        if rank <= below:
            answers[p] = -inf
        elif rank <= below + found.n:
            windows[p] = (found.lo, found.hi, below, rank)
        else:
            answers[p] = inf if rank <= below + found.n + above else math.nan
    while True:
        for p in [p for p, w in windows.items() if w[0] == w[1]]:
            answers[p] = windows.pop(p)[0]
        if not windows:
            return answers
        # Windows of one column are equal or disjoint: a value lies in one at most.
        ranges = sorted({w[:2] for w in windows.values()})
        which, bucket = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (lo, hi) in enumerate(ranges):
            inside = x.between(F.lit(lo), F.lit(hi))
            which = F.when(inside, i).otherwise(which)
            bucket = F.when(inside, _bucket(x, lo, hi, kind, buckets)).otherwise(bucket)
        # The outer bounds reach the scan as a range filter.
        values = df.select(F.col(column).alias("__x")).where(x.between(F.lit(ranges[0][0]), F.lit(ranges[-1][1])))
        cells = values.select(x, which.alias("w"), bucket.alias("b")).where("w is not null")
        counts = cells.groupBy("w", "b").agg(F.count(F.lit(1)).alias("m"), F.min(x).alias("lo"), F.max(x).alias("hi"))
        histogram = sorted(counts.collect(), key=lambda r: (r["w"], r["b"]))
        for p, (lo, hi, before, rank) in windows.items():
            for r in histogram:
                if r["w"] != ranges.index((lo, hi)):
                    continue
                if before + r["m"] >= rank:
                    windows[p] = (r["lo"], r["hi"], before, rank)
                    break
                before += r["m"]
            else:
                raise RuntimeError(f"rank {rank} of {column} not found")


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = 4096) -> dict[str, dict]:
    """``{column: {p: value}}`` of numeric columns, each in its own type; None where it has no value.

    The columns are narrowed side by side: their scans are jobs of their own.
    """
    found = _ranges(df, cols)
    with ThreadPoolExecutor(max_workers=4) as pool:
        answers = pool.map(lambda c: _narrow(df, c, probs, found[c], buckets), cols)
        return dict(zip(cols, answers))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = 4096) -> DataFrame:
    """``(column_name, p, value)``: exact discrete percentiles as doubles (see ``column_quantiles`` for own types)."""
    found = column_quantiles(df, cols, probs, buckets)
    rows = [(c, float(p), None if v is None else float(v)) for c in cols for p, v in found[c].items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")


def summary_long(
    df: DataFrame,
    cols: list[str] | None = None,
    probs: tuple[float, ...] = (0.25, 0.5, 0.75),
    exact: bool = True,
    accuracy: int = 10_000,
    buckets: int = 4096,
) -> DataFrame:
    """``describe_long`` plus percentile columns ``p25``, ``p50``, ``p75`` ... (numbers only)."""
    cols = df.columns if cols is None else cols
    names = [f"p{round(p * 100)}" for p in probs]
    numbers = [c for c in cols if is_numeric(df, c)]
    if exact:
        found = column_quantiles(df, numbers, list(probs), buckets)
        rows = [(c, *[None if found[c][p] is None else float(found[c][p]) for p in probs]) for c in numbers]
        schema = ", ".join(["column_name string", *[f"{n} double" for n in names]])
        pivot = df.sparkSession.createDataFrame(rows, schema)
    else:
        sketches = [
            F.struct(F.lit(c).alias("column_name"), F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias("qs"))
            for c in numbers
        ]
        pivot = df.agg(F.array(*sketches).alias("a")).select(F.inline("a")).select(
            "column_name", *[F.col("qs")[i].alias(n) for i, n in enumerate(names)]
        )
    return describe_long(df, cols).join(pivot, "column_name", "left").select(
        "column_name", "count", "mean", "stddev", "min", *names, "max", "min_text", "max_text"
    )


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def describe_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per text column (all by default): count of non-NULL values,
    smallest and largest value (binary order); one pass."""
    cols = text_columns(df) if cols is None else cols
    return describe_long(df, cols).select("column_name", "count", F.col("min_text").alias("min"), F.col("max_text").alias("max"))
