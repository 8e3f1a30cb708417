"""Fact-to-dimension joins and key audits.

All joins are equi-joins; Spark picks the strategy and nothing is hinted: a join
is a sort-merge join unless AQE, on measured shuffle sizes, turns it into a
broadcast (the session turns off broadcasts from static file size estimates).
Skewed fact keys are split by AQE's
skew-join handling for inner, left-outer and anti joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOIN_TYPES = ("inner", "left", "right", "full", "left_anti", "left_semi")


def join_on(facts: DataFrame, dims: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join in the using-column form: the key appears once (coalesced for full joins).

    A full outer join is planned as ``facts LEFT JOIN dims`` plus the dimension
    rows without facts (a left anti join), a right join as ``facts JOIN dims``
    plus those rows: the same rows, but every part is a join whose skewed fact
    partitions AQE can split, which it cannot do for the fact side of a full or
    right outer join.
    """
    if how not in JOIN_TYPES + ("anti", "leftanti", "semi", "outer", "left_outer", "right_outer"):
        raise ValueError(f"unknown join type {how!r}")
    if how not in ("full", "outer", "right", "right_outer"):
        return facts.join(dims, on=key, how=how)
    # Columns that both sides have travel under another name through the union.
    shared = (set(facts.columns) & set(dims.columns)) - {key}
    inner = dims.select(*[F.col(c).alias(f"__dim_{c}") if c in shared else F.col(c) for c in dims.columns])
    matched = facts.join(inner, on=key, how="left" if how in ("full", "outer") else "inner")
    dims_only = inner.join(facts.select(key).distinct(), on=key, how="left_anti")
    whole = matched.unionByName(dims_only, allowMissingColumns=True)
    return whole.select(*[F.col(c).alias(c.removeprefix("__dim_")) for c in matched.columns])


@dataclass(frozen=True)
class Dim:
    """One dimension of a star join.

    ``fact_key`` / ``dim_key`` may differ in name (and case).  ``columns`` selects
    the dimension attributes kept; ``drop`` removes fact columns that the
    dimension supersedes (a customer's City/State in favour of geography's).
    """

    df: DataFrame
    fact_key: str
    dim_key: str | None = None
    how: str = "inner"
    columns: tuple[str, ...] | None = None
    drop: tuple[str, ...] = ()


def star_join(fact: DataFrame, dims: list[Dim]) -> DataFrame:
    """Join a fact with several dimensions in turn.

    Differently named keys are joined by condition and the dimension's copy of
    the key is dropped, so no ambiguous column survives (Spark resolves names
    without regard to case, so ``ItemID`` and ``ItemId`` would clash).
    """
    out = fact
    for d in dims:
        dim_key = d.dim_key or d.fact_key
        dim = d.df
        if d.columns is not None:
            dim = dim.select(dim_key, *[c for c in d.columns if c != dim_key])
        if d.drop:
            out = out.drop(*d.drop)
        if dim_key == d.fact_key:
            out = out.join(dim, on=d.fact_key, how=d.how)
        else:
            renamed = f"__dim_{dim_key}"
            dim = dim.withColumnRenamed(dim_key, renamed)
            out = out.join(dim, F.col(d.fact_key) == F.col(renamed), d.how).drop(renamed)
    return out


def orphan_facts(facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Facts whose key is in no dimension row (``LEFT JOIN .. WHERE dim.key IS NULL``).

    Written as a left anti join: one pass, fact columns only, no NULL padding.
    A NULL fact key matches nothing and is reported as orphan, as the
    outer-join form does.
    """
    dim_key = dim_key or fact_key
    keys = dims.select(F.col(dim_key).alias("__k"))
    return facts.join(keys, F.col(fact_key) == F.col("__k"), "left_anti")


def unmatched_dims(dims: DataFrame, facts: DataFrame, dim_key: str, fact_key: str | None = None) -> DataFrame:
    """Dimension members without any fact.

    The fact keys are reduced to distinct keys first (map-side combined), so a
    key that holds a third of the facts reaches the join as one row.
    """
    fact_key = fact_key or dim_key
    keys = facts.select(F.col(fact_key).alias("__k")).distinct()
    return dims.join(keys, F.col(dim_key) == F.col("__k"), "left_anti")


def full_join_ordered(
    facts: DataFrame,
    dims: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_id: str,
    fact_cols: list[str],
    dim_cols: list[str],
    fact_key_alias: str = "FactKey",
    dim_key_alias: str = "DimKey",
) -> DataFrame:
    """Full outer join keeping both keys, ordered: matched and orphan facts
    first, then dimension members without facts; within that by key and fact id.

    The sort is a range-partitioned (distributed) sort."""
    f = facts.select(F.col(fact_id), F.col(fact_key).alias(fact_key_alias), *fact_cols)
    d = dims.select(F.col(dim_key).alias(dim_key_alias), *dim_cols)
    # Full outer join as left join + unmatched dimension rows (skew-splittable parts).
    on = F.col(fact_key_alias) == F.col(dim_key_alias)
    matched = f.join(d, on, "left")
    dims_only = d.join(f.select(F.col(fact_key_alias)).distinct(), on, "left_anti")
    joined = matched.unionByName(dims_only, allowMissingColumns=True).select(*matched.columns)
    no_fact = F.when(F.col(fact_key_alias).isNull(), 1).otherwise(0)
    return joined.orderBy(
        no_fact.asc(),
        F.coalesce(F.col(fact_key_alias), F.col(dim_key_alias)).asc_nulls_first(),
        F.col(fact_id).asc_nulls_first(),
    )
