"""Schema changes of a versioned table as versions of their own.

A column has an identity that renames do not touch.  ``SchemaHistory`` folds the
base columns and the changes (``AddColumn``, ``RenameColumn``) up to a version
into that version's names, each with its identity and type.  Log rows are kept
under identities, so one stored log serves every version: what is written is
translated from the names of its version, what is read into the names of the
version asked for.  Rows older than a column read NULL in it, as a versioned
table gives them; reading an older version leaves later columns out.

Everything here is a projection, so as-of reads prune columns and versions as
``changelog.as_of`` does.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import changelog
from salesmart.operators.changelog import META, Versions


@dataclass(frozen=True)
class AddColumn:
    version: int
    name: str
    data_type: str


@dataclass(frozen=True)
class RenameColumn:
    version: int
    old: str
    new: str


@dataclass(frozen=True)
class Column_:
    """A column at some version: its identity in the log, its name there and its type."""

    id: str
    name: str
    data_type: str


@dataclass(frozen=True)
class SchemaHistory:
    """The columns of version 0 and the changes, in order of their versions."""

    base: tuple[tuple[str, str], ...]
    changes: tuple[AddColumn | RenameColumn, ...] = ()

    def __post_init__(self):
        versions = [c.version for c in self.changes]
        if versions != sorted(versions) or any(v < 1 for v in versions):
            raise ValueError("schema changes must be in order of their versions, from 1 on")
        names = [n.lower() for n, _ in self.base]
        if len(set(names)) != len(names):
            raise ValueError("a column name occurs twice")
        self.columns(versions[-1] if versions else 0)

    @classmethod
    def of(cls, df: DataFrame) -> "SchemaHistory":
        """The history of a table that begins with the columns of ``df``."""
        return cls(tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields))

    def add_column(self, version: int, name: str, data_type: str) -> "SchemaHistory":
        return SchemaHistory(self.base, (*self.changes, AddColumn(version, name, data_type)))

    def rename_column(self, version: int, old: str, new: str) -> "SchemaHistory":
        return SchemaHistory(self.base, (*self.changes, RenameColumn(version, old, new)))

    def columns(self, version: int) -> list[Column_]:
        """The columns as of a version: the fold of all changes up to it.  Names are told apart regardless of case."""
        now = [Column_(f"c{k}", n, t) for k, (n, t) in enumerate(self.base)]
        born = len(now)
        for change in self.changes:
            added = isinstance(change, AddColumn)
            new = change.name if added else change.new
            born += added
            if change.version > version:
                continue
            taken = {c.name.lower(): k for k, c in enumerate(now)}
            if added:
                if new.lower() in taken:
                    raise ValueError(f"version {change.version}: there is a column {new!r}")
                now.append(Column_(f"c{born - 1}", new, change.data_type))
                continue
            at = taken.get(change.old.lower())
            if at is None:
                raise ValueError(f"version {change.version}: no column {change.old!r}")
            if taken.get(new.lower(), at) != at:
                raise ValueError(f"version {change.version}: there is a column {new!r}")
            now[at] = Column_(now[at].id, new, now[at].data_type)
        return now

    def ids(self, version: int, names: list[str]) -> list[str]:
        """Identities of columns that a version knows by these names."""
        known = {c.name.lower(): c.id for c in self.columns(version)}
        missing = [n for n in names if n.lower() not in known]
        if missing:
            raise ValueError(f"version {version} has no column {missing[0]!r}")
        return [known[n.lower()] for n in names]

    def stored(self, rows: DataFrame, version: int) -> DataFrame:
        """Rows written at a version, under identities; ``META`` columns stay.  Columns that the rows lack are not
        written, and read NULL."""
        data = [c for c in rows.columns if c not in META]
        ids = self.ids(version, data)
        return rows.select(*[F.col(f"`{n}`").alias(i) for n, i in zip(data, ids)], *[c for c in rows.columns if c in META])

    def shown(self, rows: DataFrame, version: int) -> DataFrame:
        """Stored rows under the names, and in the order, of a version."""
        types = dict(rows.dtypes)
        columns = []
        for c in self.columns(version):
            value = F.col(c.id) if c.id in types else F.lit(None)
            columns.append(value.cast(c.data_type).alias(c.name))
        return rows.select(*columns)

    def schema(self, version: int) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.data_type)) for c in self.columns(version)])


def append_log(log: DataFrame | None, rows: DataFrame, history: SchemaHistory, version: int) -> DataFrame:
    """The stored log with the log rows (under the names of ``version``) of one more version."""
    new = history.stored(rows, version)
    return new if log is None else log.unionByName(new, allowMissingColumns=True)


def as_of(log: DataFrame, history: SchemaHistory, key: list[str], versions: Versions, version: int | None = None, ts: dt.datetime | None = None) -> DataFrame:
    """The table as of a version or a time (latest when both are None): its rows under that version's columns.

    ``log`` is stored by ``append_log``; ``key`` names the key columns as
    version 0 does.  An unknown version or a time before the first is an error.
    """
    at = versions.number(version, ts)
    return history.shown(changelog.as_of(log, history.ids(0, key), versions, at), at)


def schema_changes(history: SchemaHistory, versions: Versions) -> list[tuple[int, dt.datetime, str]]:
    """(version, time, what) of every change, for a table's history listing."""
    out = []
    for c in history.changes:
        what = f"ADD COLUMN {c.name} {c.data_type}" if isinstance(c, AddColumn) else f"RENAME COLUMN {c.old} TO {c.new}"
        out.append((c.version, versions.times[c.version], what))
    return out
