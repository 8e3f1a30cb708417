"""Versioned tables as an append-only log of row changes.

A log is a frame of rows ``(data columns..., _version, _ts, _op, _operation)``
with ``_op`` in I (insert), U (update, the new values) and D (delete, the last
values); how and where it is stored is the caller's matter.  A table at version
``n`` is the latest log row per key with ``_version <= n``, dropping keys whose
latest row is a delete.  A log partitioned by ``_version`` on storage lets an
as-of read prune whole partitions.

``Versions`` names the versions of a log and their times, which must grow; a
version or time outside them is an error, and a time is resolved to its version
before anything is read.

The latest-row-per-key step is ``row_number() OVER (PARTITION BY key ORDER BY
_version DESC) = 1``.  Spark plans it with a partial ``WindowGroupLimit``
before the shuffle (top-1 per key inside every map task) and a final one
after it, so a key with very many versions is reduced before it moves and is
never gathered in one place.  ``diff`` and ``restore_rows`` look only at keys
that changed between the two versions.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.timebins import ts_literal

META = ("_version", "_ts", "_op", "_operation")


@dataclass(frozen=True)
class Versions:
    """Versions 0, 1, .. of a log by their times."""

    times: tuple[dt.datetime, ...]

    def __post_init__(self):
        if any(b <= a for a, b in zip(self.times, self.times[1:])):
            raise ValueError("version times must grow")

    @property
    def next(self) -> int:
        return len(self.times)

    def then(self, ts: dt.datetime) -> "Versions":
        """With one more version; its time must be after the last one's."""
        return Versions((*self.times, ts))

    def number(self, version: int | None = None, ts: dt.datetime | None = None) -> int:
        """The version asked for: by number, the last one at a time, or the latest."""
        if version is not None and ts is not None:
            raise ValueError("give a version or a time, not both")
        if ts is not None:
            version = bisect_right(self.times, ts) - 1
            if version < 0:
                raise ValueError(f"no version at {ts}: the first is of {self.times[0] if self.times else None}")
        elif version is None:
            version = self.next - 1
        if not 0 <= version < self.next:
            raise ValueError(f"no version {version}: the log has {self.next}")
        return version


def versions_of(log: DataFrame) -> Versions:
    """The versions of a stored log (one small aggregate, one row per version to the driver)."""
    rows = log.groupBy("_version").agg(F.min("_ts").alias("first"), F.max("_ts").alias("last")).orderBy("_version").collect()
    if [r["_version"] for r in rows] != list(range(len(rows))):
        raise ValueError("versions must be numbered from 0 without a gap")
    if any(r["first"] != r["last"] for r in rows):
        raise ValueError("a version has rows of several times")
    return Versions(tuple(r["first"] for r in rows))


def _cond(condition: str | Column) -> Column:
    c = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(c, F.lit(False))  # a NULL condition leaves the row alone


def _value(v: str | Column) -> Column:
    return F.expr(v) if isinstance(v, str) else v


def data_columns(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in META]


def stamp(df: DataFrame, version: int, ts: dt.datetime, op: str | Column, operation: str) -> DataFrame:
    op_col = F.lit(op) if isinstance(op, str) else op
    return df.withColumns(
        {
            "_version": F.lit(version).cast("int"),
            "_ts": ts_literal(ts),
            "_op": op_col,
            "_operation": F.lit(operation),
        }
    )


def initial_log(df: DataFrame, ts: dt.datetime, version: int = 0) -> DataFrame:
    """Version 0: every row inserted (``saveAsTable``)."""
    return stamp(df, version, ts, "I", "WRITE")


# -- plain state transforms ------------------------------------------------
def update_rows(state: DataFrame, condition: str | Column, assignments: dict[str, str | Column]) -> DataFrame:
    """``UPDATE .. SET a = .., b = .. WHERE cond``: right-hand sides read the old
    values; assigned values keep the column's type."""
    hit = _cond(condition)
    types = dict(state.dtypes)
    cols = []
    for c in state.columns:
        if c in assignments:
            new = _value(assignments[c]).cast(types[c])
            cols.append(F.when(hit, new).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return state.select(*cols)


def delete_rows(state: DataFrame, condition: str | Column) -> DataFrame:
    """``DELETE .. WHERE cond``; rows where the condition is NULL stay."""
    return state.filter(~_cond(condition))


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """``ALTER TABLE .. ADD COLUMN``: existing rows read NULL."""
    return df.withColumn(name, F.lit(None).cast(data_type))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """``ALTER TABLE .. RENAME COLUMN``: the same data under the new name."""
    if old not in df.columns:
        raise ValueError(f"no column {old!r}")
    return df.withColumnRenamed(old, new)


# -- log writers -------------------------------------------------------------
def update_log(state, condition, assignments, version: int, ts: dt.datetime) -> DataFrame:
    """Log rows of an update: the touched rows with their new values."""
    hit = _cond(condition)
    touched = update_rows(state.filter(hit), F.lit(True), assignments)
    return stamp(touched, version, ts, "U", "UPDATE")


def delete_log(state, condition, version: int, ts: dt.datetime) -> DataFrame:
    """Log rows of a delete: the removed rows with their last values."""
    return stamp(state.filter(_cond(condition)), version, ts, "D", "DELETE")


def as_of(
    log: DataFrame, key: list[str], versions: Versions, version: int | None = None, ts: dt.datetime | None = None
) -> DataFrame:
    """The table as of a version number or a time (latest when both are None)."""
    sel = log.filter(F.col("_version") <= versions.number(version, ts))
    newest = Window.partitionBy(*key).orderBy(F.col("_version").desc())
    latest = sel.withColumn("__rn", F.row_number().over(newest))
    return latest.filter((F.col("__rn") == 1) & (F.col("_op") != "D")).select(*data_columns(log))


def _two_states(log: DataFrame, key: list[str], v_from: int, v_to: int) -> DataFrame:
    """Keys with log rows between two versions, with their rows at both as structs
    ``a`` and ``b`` (null where the key is absent): one aggregate over these keys' log rows."""
    lo, hi = min(v_from, v_to), max(v_from, v_to)
    data = data_columns(log)
    version = F.col("_version")
    changed = log.filter((version > lo) & (version <= hi)).select(*key).distinct()
    rows = log.filter(version <= hi).join(changed, key, "left_semi")
    row = F.struct(F.col("_op").alias("op"), *[F.col(c).alias(c) for c in data])

    def state(v: int) -> Column:
        last = F.max_by(F.when(version <= v, row), F.when(version <= v, version))
        return F.when(last["op"] != "D", last)

    return rows.groupBy(*key).agg(state(v_from).alias("a"), state(v_to).alias("b"))


def _changed(states: DataFrame, data: list[str], key: list[str], names: tuple[str, str, str]) -> tuple[Column, list[Column]]:
    """What happened to each key (added, removed, changed or null) and the columns that show it."""
    a, b = F.col("a"), F.col("b")
    same = F.lit(True)
    for c in data:
        same = same & a[c].eqNullSafe(b[c])
    what = (
        F.when(a.isNull() & b.isNotNull(), names[0]).when(b.isNull() & a.isNotNull(), names[1]).when(a.isNotNull() & ~same, names[2])
    )
    return what, [(F.col(c) if c in key else F.when(b.isNull(), a[c]).otherwise(b[c])).alias(c) for c in data]


def diff(log: DataFrame, key: list[str], versions: Versions, v_from: int, v_to: int) -> DataFrame:
    """Rows that differ between two versions: ``added``, ``removed``, ``changed``.

    Values are those of ``v_to`` (of ``v_from`` for removed rows).
    """
    data = data_columns(log)
    states = _two_states(log, key, versions.number(v_from), versions.number(v_to))
    what, columns = _changed(states, data, key, ("added", "removed", "changed"))
    return states.select(*columns, what.alias("change_type")).filter(F.col("change_type").isNotNull())


def restore_rows(log: DataFrame, key: list[str], versions: Versions, target: int, ts: dt.datetime) -> DataFrame:
    """Log rows of a new version, of time ``ts``, that equals version ``target``.

    History is kept: a restore is a new version, as a versioned table does.
    """
    new = versions.then(ts)
    data = data_columns(log)
    states = _two_states(log, key, versions.next - 1, versions.number(target))
    what, columns = _changed(states, data, key, ("I", "D", "U"))
    rows = states.select(*columns, what.alias("__op")).filter(F.col("__op").isNotNull())
    return stamp(rows, new.next - 1, ts, F.col("__op"), "RESTORE").select(*data, *META)


def change_counts(log: DataFrame) -> DataFrame:
    """One row per version that changed rows: its operation, time and row counts."""
    return (
        log.groupBy(F.col("_version").alias("version"), F.col("_operation").alias("operation"))
        .agg(
            F.max("_ts").alias("timestamp"),
            F.count_if(F.col("_op") == "I").alias("num_inserted"),
            F.count_if(F.col("_op") == "U").alias("num_updated"),
            F.count_if(F.col("_op") == "D").alias("num_deleted"),
        )
        .select("version", "timestamp", "operation", "num_inserted", "num_updated", "num_deleted")
        .orderBy("version")
    )
