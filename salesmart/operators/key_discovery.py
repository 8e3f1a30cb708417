"""Which column sets of a table are keys: no null, no value twice, and no smaller key inside.

A search by levels, from single columns up.  One pass over the table per level
estimates the distinct values of every candidate by a sketch (fixed memory per
candidate, combined map-side); candidates whose estimate is clearly below the
row count are out.  The few that are left are checked exactly, one grouped
aggregate each.  A set that holds a key already found is never tried, nor is one
whose columns' distinct counts multiply to fewer than the rows.
"""

from __future__ import annotations

from itertools import combinations
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.audit import duplicate_keys

ERROR = 0.02  # relative standard deviation of a sketch
SIGMAS = 6  # an estimate further below the row count is no key
AT_ONCE = 64  # sketches of one pass


def _estimates(df: DataFrame, candidates: list[tuple[str, ...]]) -> list[int]:
    """Estimated distinct values of each candidate, ``AT_ONCE`` candidates a pass."""
    out: list[int] = []
    for k in range(0, len(candidates), AT_ONCE):
        some = candidates[k : k + AT_ONCE]
        # A hash of the columns stands for their values: a collision only lowers an estimate by far less than its error.
        sketches = [F.approx_count_distinct(F.xxhash64(*[F.col(f"`{c}`") for c in names]), ERROR).alias(str(n)) for n, names in enumerate(some)]
        out += list(df.agg(*sketches).first())
    return out


def minimal_keys(df: DataFrame, columns: list[str] | None = None, width: int = 3) -> list[tuple[str, ...]]:
    """The minimal keys of ``df`` of at most ``width`` columns, by size and then in column order.

    ``columns`` are the candidates (default: all; map columns cannot be keys).
    Columns with a null are in no key.  A table without rows has no key that
    its data could show, and gives none; a table of one row gives each of its columns.
    """
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    rows = counts["__n"]
    if not rows:
        return []
    columns = [c for c in columns if counts[c] == rows]
    least = rows * (1 - SIGMAS * ERROR)
    found: list[tuple[str, ...]] = []
    distinct: dict[str, int] = {}
    for size in range(1, min(width, len(columns)) + 1):
        candidates = [
            names
            for names in combinations(columns, size)
            if not any(set(key) <= set(names) for key in found) and (size == 1 or prod(distinct[c] for c in names) >= least)
        ]
        estimates = _estimates(df, candidates)
        if size == 1:
            # An estimate may be low: the bound above is for the true counts.
            distinct = {names[0]: max(1, int(n * (1 + SIGMAS * ERROR)) + 1) for names, n in zip(candidates, estimates)}
        likely = [names for names, n in zip(candidates, estimates) if n >= least]
        found += [names for names in likely if duplicate_keys(df.select(*[f"`{c}`" for c in names]), list(names)).isEmpty()]
    return found


def key_report(tables: dict[str, DataFrame], width: int = 3) -> DataFrame:
    """``(table_name, key_columns, n_columns)`` of the minimal keys of several tables."""
    rows = [(name, ",".join(key), len(key)) for name, df in tables.items() for key in minimal_keys(df, width=width)]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, key_columns string, n_columns int")
