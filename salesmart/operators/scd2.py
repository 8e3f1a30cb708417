"""Slowly changing dimension, type 2, and point-in-time fact loading.

A dimension row is valid on ``[start, end)``; the open (current) row has
``end`` NULL.  One load at ``run_ts`` (a single argument for all steps):

1. ``close_changed``: open rows whose staged row differs in any tracked
   attribute get ``end = run_ts``;
2. ``new_versions``: staged rows equal to no dimension row are inserted, open,
   starting at ``run_ts`` - or at ``default_start`` when the key was never seen;
3. ``asof_join``: each fact takes the surrogate key of the version valid on
   the fact's date (``start <= date < coalesce(end, max)``).

``match='history'`` compares staged rows with every version (the procedure's
behaviour: after A -> B -> A nothing is inserted and the key ends without an
open row); ``match='current'`` compares with the rows still open after step 1,
which always leaves exactly one open row per staged key.

Every step is a join on the business key, so the dimension and the stage are
hash-partitioned by that key; the fact join is an equi-join on the key with
the date range as a residual condition (AQE splits a hot fact key).  Inputs
are frames and nothing is mutated: the load is one lazy plan, written once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.timebins import ts_literal

# Fixed value: the open end used by the interval test (the largest timestamp
# with microsecond precision; a 7th fractional digit cannot be stored).
OPEN_END = "9999-12-31 23:59:59.999999"


@dataclass(frozen=True)
class Scd2Spec:
    key: str
    attrs: tuple[str, ...]
    default_start: dt.datetime
    start: str = "Valid_Start_Date"
    end: str = "Valid_End_Date"
    surrogate: str = "SurrogateKey"

    @property
    def row_columns(self) -> list[str]:
        return [self.key, *self.attrs]

    @property
    def dim_columns(self) -> list[str]:
        return [self.surrogate, self.key, *self.attrs, self.start, self.end]


def surrogate_key(key: Column, start: Column) -> Column:
    """Deterministic surrogate key of a version: SHA-256 of ``key|start``, the start to the microsecond."""
    return F.sha2(F.concat_ws("|", key.cast("string"), F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSSSSS")), 256)


def initial_dimension(rows: DataFrame, spec: Scd2Spec, start: dt.datetime) -> DataFrame:
    """A first load: every row open from ``start``."""
    s = ts_literal(start)
    return rows.select(
        surrogate_key(F.col(spec.key), s).alias(spec.surrogate),
        *spec.row_columns,
        s.alias(spec.start),
        F.lit(None).cast("timestamp_ntz").alias(spec.end),
    )


def _staged(stage: DataFrame, spec: Scd2Spec) -> DataFrame:
    return stage.select(F.col(spec.key).alias("__k"), *[F.col(a).alias(f"__s_{a}") for a in spec.attrs])


def _differs(spec: Scd2Spec) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(f"__s_{a}")) for a in spec.attrs])


def changed_rows(dim: DataFrame, stage: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Open dimension rows whose staged row differs in any attribute."""
    joined = dim.join(_staged(stage, spec), F.col(spec.key) == F.col("__k"), "inner")
    return joined.filter(F.col(spec.end).isNull() & _differs(spec)).select(*dim.columns)


def close_changed(dim: DataFrame, stage: DataFrame, spec: Scd2Spec, run_ts: dt.datetime) -> DataFrame:
    """Step 1: set ``end = run_ts`` on open rows whose staged row differs."""
    joined = dim.join(_staged(stage, spec), F.col(spec.key) == F.col("__k"), "left")
    close = F.col(spec.end).isNull() & F.col("__k").isNotNull() & _differs(spec)
    return joined.select(
        *[
            F.when(close, ts_literal(run_ts)).otherwise(F.col(c)).alias(c) if c == spec.end else F.col(c)
            for c in dim.columns
        ]
    )


def new_versions(
    dim_closed: DataFrame, stage: DataFrame, spec: Scd2Spec, run_ts: dt.datetime, match: str = "current"
) -> DataFrame:
    """Step 2: staged rows equal to no (open) dimension row, as new open versions."""
    if match not in ("current", "history"):
        raise ValueError("match must be 'current' or 'history'")
    ref = dim_closed if match == "history" else dim_closed.filter(F.col(spec.end).isNull())
    # Distinct attribute sets per key: repeated identical versions collapse map-side.
    ref = ref.select(F.col(spec.key).alias("__rk"), *[F.col(a).alias(f"__r_{a}") for a in spec.attrs]).distinct()
    same = reduce(
        lambda a, b: a & b,
        [F.col(spec.key) == F.col("__rk")] + [F.col(a).eqNullSafe(F.col(f"__r_{a}")) for a in spec.attrs],
    )
    fresh = stage.select(*spec.row_columns).join(ref, same, "left_anti")
    seen = dim_closed.select(F.col(spec.key).alias("__seen")).distinct()
    start = (
        F.when(F.col("__seen").isNull(), ts_literal(spec.default_start)).otherwise(ts_literal(run_ts))
    )
    return (
        fresh.join(seen, F.col(spec.key) == F.col("__seen"), "left")
        .withColumn(spec.start, start)
        .withColumn(spec.end, F.lit(None).cast("timestamp_ntz"))
        .withColumn(spec.surrogate, surrogate_key(F.col(spec.key), F.col(spec.start)))
        .select(*spec.dim_columns)
    )


def check_stage(stage: DataFrame, spec: Scd2Spec) -> None:
    """Fail if a staged key is null or repeated (it would close and insert twice); run it before a load."""
    from salesmart.operators.audit import assert_unique

    assert_unique(stage, [spec.key])


def load(dim: DataFrame, stage: DataFrame, spec: Scd2Spec, run_ts: dt.datetime, match: str = "current") -> DataFrame:
    """Steps 1 and 2: the dimension after one load (closed rows plus new versions).

    Lazy; the stage must hold one row per key (``check_stage``).
    """
    closed = close_changed(dim, stage, spec, run_ts).select(*spec.dim_columns)
    return closed.unionByName(new_versions(closed, stage, spec, run_ts, match))


def _valid_on(dim_alias_key: str, spec: Scd2Spec, fact_key: str, fact_ts: str) -> Column:
    return (
        (F.col(fact_key) == F.col(dim_alias_key))
        & (F.col(fact_ts) >= F.col(spec.start))
        & (F.col(fact_ts) < F.coalesce(F.col(spec.end), F.lit(OPEN_END).cast("timestamp_ntz")))
    )


def _bucketed_versions(dim: DataFrame, facts: DataFrame, fact_ts: str, spec: Scd2Spec, bucket_days: int, cols):
    """Versions repeated once per ``bucket_days`` bucket they overlap, clipped
    to the buckets the facts span (two scalars from one aggregate)."""
    lo, hi = facts.agg(F.min(fact_ts), F.max(fact_ts)).first()
    if lo is None:
        return None
    first, last = _day(lo) // bucket_days, _day(hi) // bucket_days
    start_b = F.floor(F.unix_date(F.to_date(F.col(spec.start))) / bucket_days)
    end_b = F.floor(F.unix_date(F.to_date(F.col(spec.end))) / bucket_days)
    from_b = F.greatest(start_b, F.lit(first)).cast("long")
    to_b = F.least(F.coalesce(end_b, F.lit(last)), F.lit(last)).cast("long")
    return dim.select(*cols, F.explode(F.sequence(from_b, F.greatest(from_b, to_b))).alias("__b"))


def _day(value) -> int:
    return (value.date() - dt.date(1970, 1, 1)).days


def _versions_for(facts: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, spec: Scd2Spec, bucket_days: int | None, cols):
    """(facts, versions, condition) of the point-in-time join, by key or by key and date bucket."""
    valid = _valid_on("__dk", spec, fact_key, fact_ts)
    if bucket_days is None:
        return facts, dim.select(*cols), valid
    d = _bucketed_versions(dim, facts, fact_ts, spec, bucket_days, cols)
    if d is None:  # no dated fact
        d = dim.select(*cols, F.lit(0).cast("long").alias("__b")).limit(0)
    bucket = F.floor(F.unix_date(F.to_date(F.col(fact_ts))) / bucket_days).cast("long")
    return facts.withColumn("__fb", bucket), d, valid & (F.col("__fb") == F.col("__b"))


def asof_join(
    facts: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, spec: Scd2Spec, bucket_days: int | None = None
) -> DataFrame:
    """Step 3: facts with the surrogate key of the version valid on their date.

    Inner join: facts dated before the first version of their key drop out
    (see ``unmatched_facts``).  The join is an equi-join on the key with the
    date range as residual; AQE splits a hot key and broadcasts a version table
    that measures small.  With ``bucket_days`` the date bucket joins the
    equi-key too, so a key with a long version history only compares a fact with
    the versions overlapping its bucket (one aggregate over the facts bounds the
    buckets when the frame is built).
    """
    cols = [F.col(spec.key).alias("__dk"), F.col(spec.start), F.col(spec.end), F.col(spec.surrogate)]
    f, d, on = _versions_for(facts, dim, fact_key, fact_ts, spec, bucket_days, cols)
    return f.join(d, on, "inner").select(*[F.col(c) for c in facts.columns], spec.surrogate)


def unmatched_facts(
    facts: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, spec: Scd2Spec, bucket_days: int | None = None
) -> DataFrame:
    """Facts that no version covers (the rows the inner join drops)."""
    cols = [F.col(spec.key).alias("__dk"), F.col(spec.start), F.col(spec.end)]
    f, d, on = _versions_for(facts, dim, fact_key, fact_ts, spec, bucket_days, cols)
    return f.join(d, on, "left_anti").select(*facts.columns)


def land_facts(keyed: DataFrame, path: str, batch: str) -> None:
    """Write keyed facts by ``batch``: a rerun replaces the batches it holds and leaves the others."""
    from salesmart.sources.sinks import overwrite_path

    overwrite_path(keyed, path, partition_by=[batch])
