"""Roll facts up to dimension attributes.

Large facts are aggregated *before* they are joined: a sum by order key, then
by customer key, then by nation key.  Each step is a partial + final hash
aggregate (map-side combine), so a hot key that holds a third of the rows is
collapsed inside every map task before the shuffle, and every join after the
first aggregate sees one row per key.  Because money sums are exact decimals,
the result equals aggregating the joined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.measures import TOTAL


def sum_by(df: DataFrame, keys: list[str], measures: dict[str, Column | str], total: str = TOTAL) -> DataFrame:
    """``groupBy(keys).agg(sum(m) AS name ...)``, exact; ``total`` is the type of the sums
    (give one with the scale of unrounded measures to round later)."""
    aggs = [F.sum(F.col(m) if isinstance(m, str) else m).cast(total).alias(name) for name, m in measures.items()]
    return df.groupBy(*keys).agg(*aggs)


def roll_up(
    amounts: DataFrame,
    key: str,
    mapping: DataFrame,
    map_key: str,
    to_key: str,
    measures: list[str],
    how: str = "inner",
) -> DataFrame:
    """Move per-``key`` totals one level up a dimension path.

    ``amounts`` holds one row per ``key``; ``mapping`` maps ``map_key`` (== key)
    to ``to_key``.  The result holds one row per ``to_key`` (NULL for facts
    without a mapping row when ``how='left'``).
    """
    m = mapping.select(F.col(map_key).alias("__mk"), F.col(to_key))
    joined = amounts.join(m, F.col(key) == F.col("__mk"), how).drop("__mk")
    return sum_by(joined, [to_key], {c: c for c in measures})


def top_k(df: DataFrame, k: int, by: str, tie_break: list[str]) -> DataFrame:
    """``top k by <by> desc`` with a deterministic tie-break.

    Planned as TakeOrderedAndProject: every task keeps its own top k and one
    merge picks the final k, so the input is never globally sorted.
    """
    order = [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_break]
    return df.orderBy(*order).limit(k)


def totals_with_dimension(
    facts: DataFrame,
    fact_key: str,
    amount: Column | str,
    dims: DataFrame,
    dim_key: str,
    attrs: dict[str, str],
    how: str = "left",
    key_name: str = "CustomerId",
    total_name: str = "TotalSales",
    unknown: dict[str, str] | None = None,
) -> DataFrame:
    """``SELECT COALESCE(d.key, f.key), d.attrs.., SUM(amount) .. LEFT JOIN .. GROUP BY ..``.

    Facts are summed per fact key first (map-side combined), so the dimension
    join meets one row per key; grouping by ``COALESCE(d.key, f.key)`` and the
    dimension attributes is the same grouping because the join is on key
    equality.  ``unknown`` fills attributes of keys missing from the dimension.
    """
    per_key = sum_by(facts, [fact_key], {total_name: amount})
    d = dims.select(F.col(dim_key).alias("__dk"), *[F.col(src).alias(dst) for dst, src in attrs.items()])
    joined = per_key.join(d, F.col(fact_key) == F.col("__dk"), how)
    unknown = unknown or {}
    cols = [F.coalesce(F.col("__dk"), F.col(fact_key)).alias(key_name)]
    cols += [
        (F.coalesce(F.col(a), F.lit(unknown[a])) if a in unknown else F.col(a)).alias(a) for a in attrs
    ]
    return joined.select(*cols, total_name)
