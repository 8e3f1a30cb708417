"""Type 2 dimensions with long histories: point-in-time keys and many extracts at once.

Both work on one stream of a key's events in time order, dealt to ranges of
(key, time) by ``operators.ordered``: a key with a third of all facts, or with
very many versions, is split in time, and no fact is compared with any version
but the last one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.timebins import ts_literal
from salesmart.operators.audit import duplicate_keys
from salesmart.operators.ordered import carried, ranged
from salesmart.operators.scd2 import OPEN_END, Scd2Spec, surrogate_key

_NTZ = "timestamp_ntz"


def overlapping_versions(dim: DataFrame, spec: Scd2Spec, partitions: int | None = None) -> DataFrame:
    """Versions that begin before the one before them (of the same key) has ended.

    The joins below take the last version begun, which is the valid one only
    where this is empty; versions of no length (end at or before the start) are
    never valid and left out.
    """
    rows = ranged(_lasting(dim, spec), [spec.key], [spec.start], partitions)
    until = F.coalesce(F.col(spec.end), _open_end())
    rows = carried(rows, [spec.key], [spec.start], until, "__until", own=False)
    return rows.where(F.col(spec.start) < F.col("__until")).select(*dim.columns)


def _open_end() -> Column:
    return F.lit(OPEN_END).cast(_NTZ)


def _is_lasting(spec: Scd2Spec) -> Column:
    known = F.col(spec.key).isNotNull() & F.col(spec.start).isNotNull()
    return known & (F.col(spec.end).isNull() | (F.col(spec.end) > F.col(spec.start)))


def _lasting(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    return dim.where(_is_lasting(spec))


def _with_version(facts: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, spec: Scd2Spec, partitions: int | None) -> DataFrame:
    """``fact`` (struct) and ``version`` (struct of the surrogate, null where no version covers it)."""
    version = F.struct(F.coalesce(F.col(spec.end), _open_end()).alias("until"), F.col(spec.surrogate).alias("surrogate"))
    versions = _lasting(dim, spec).select(
        F.col(spec.key).alias("key"), F.col(spec.start).cast(_NTZ).alias("at"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("nth"), version.alias("begun")
    )
    dated = facts.select(
        F.col(fact_key).alias("key"),
        F.col(fact_ts).cast(_NTZ).alias("at"),
        F.lit(1).alias("kind"),
        # Tells equal facts of one instant apart, so that the ranges can divide them.
        F.monotonically_increasing_id().alias("nth"),
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("fact"),
    )
    stream = versions.unionByName(dated, allowMissingColumns=True)
    order = ["at", "kind", "nth"]
    found = carried(ranged(stream, ["key"], order, partitions), ["key"], order, F.col("begun"), "version")
    valid = F.col("key").isNotNull() & (F.col("at") < F.col("version.until"))
    return found.where("kind = 1").select("fact", F.when(valid, F.col("version")).alias("version"))


def asof_carried(facts: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, spec: Scd2Spec, partitions: int | None = None) -> DataFrame:
    """Facts with the surrogate key of the version valid on their date, as ``scd2.asof_join`` gives them.

    Facts and versions are sorted together by (key, time) and the last version
    begun is carried to the facts after it, over the borders of the ranges too.
    The work per fact does not depend on the number of versions of its key.
    Facts that no version covers, and facts without key or date, drop out (see
    ``unmatched_carried``).  Versions of a key must not overlap
    (``overlapping_versions``).
    """
    found = _with_version(facts, dim, fact_key, fact_ts, spec, partitions).where(F.col("version").isNotNull())
    return found.select("fact.*", F.col("version.surrogate").alias(spec.surrogate))


def unmatched_carried(facts: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, spec: Scd2Spec, partitions: int | None = None) -> DataFrame:
    """Facts that ``asof_carried`` drops."""
    return _with_version(facts, dim, fact_key, fact_ts, spec, partitions).where(F.col("version").isNull()).select("fact.*")


def repeated_extracts(extracts: DataFrame, spec: Scd2Spec, extracted_at: str) -> DataFrame:
    """Keys staged twice at one time, and rows without key or time, with their counts: which state holds is not known."""
    return duplicate_keys(extracts, [spec.key, extracted_at])


def load_extracts(dim: DataFrame, extracts: DataFrame, spec: Scd2Spec, extracted_at: str, partitions: int | None = None) -> DataFrame:
    """The dimension after all ``extracts``: the rows that ``scd2.load`` gives (``match='current'``) for one extract
    after the other, each at its own time.

    ``extracts`` has a row per key and time it was staged (``extracted_at``;
    audit with ``repeated_extracts``).  All states of a key are put in time
    order: those of the dimension's versions at their starts, none where a
    version ends and no other begins, and the staged ones.  A state equal to the
    one before it says nothing; each other one is a version that lasts until the
    next.  So an extract older than the newest version (a late one) divides the
    version of its time, as if it had been loaded then.

    The first state of a key that the dimension does not know starts at
    ``default_start``; any other at its time.  Versions that stay keep their
    surrogate; versions of no length, and those without a key or a start, stay
    as they are.  Staged rows without a key or time are left out; an empty
    dimension or no extract is fine.
    """
    state = F.struct(*spec.attrs)
    key, order = [spec.key], ["at", "kind"]
    lasting = _lasting(dim, spec)
    begun = lasting.select(
        spec.key, F.col(spec.start).cast(_NTZ).alias("at"), F.lit(1).alias("kind"), state.alias("state"), F.col(spec.surrogate).alias("sk")
    )
    # The end of a version is a state of its own, none, unless another begins there.
    none = F.lit(None).cast(begun.schema["state"].dataType)
    ended = lasting.where(F.col(spec.end).isNotNull()).select(spec.key, F.col(spec.end).cast(_NTZ).alias("at"))
    ended = ended.join(begun, [spec.key, "at"], "left_anti").withColumns({"kind": F.lit(0), "state": none})
    staged = extracts.where(F.col(spec.key).isNotNull() & F.col(extracted_at).isNotNull())
    staged = staged.select(spec.key, F.col(extracted_at).cast(_NTZ).alias("at"), F.lit(2).alias("kind"), state.alias("state"))
    states = begun.unionByName(ended, allowMissingColumns=True).unionByName(staged, allowMissingColumns=True)
    # Islands: a state that differs from the one before it begins a version ..
    rows = carried(ranged(states, key, order, partitions), key, order, F.struct("state"), "before", own=False)
    turns = rows.where(F.col("before").isNull() | ~F.col("state").eqNullSafe(F.col("before.state")))
    turns = turns.select(*key, *order, "state", "sk", F.col("before").isNull().alias("first"))
    # .. that lasts until the next one.
    turns = carried(ranged(turns, key, order, partitions), key, order, F.col("at"), "until", own=False, backward=True)
    seen = dim.select(F.col(spec.key).alias("__seen")).where("__seen is not null").distinct()
    versions = turns.where(F.col("state").isNotNull()).join(seen, F.col(spec.key) == F.col("__seen"), "left")
    start = F.when(F.col("first") & F.col("__seen").isNull(), ts_literal(spec.default_start)).otherwise(F.col("at"))
    made = versions.select(*key, *[F.col("state")[a].alias(a) for a in spec.attrs], start.alias(spec.start), F.col("until").alias(spec.end), "sk")
    made = made.withColumn(spec.surrogate, F.coalesce("sk", surrogate_key(F.col(spec.key), F.col(spec.start))))
    idle = dim.where(~F.coalesce(_is_lasting(spec), F.lit(False)))
    return made.select(*spec.dim_columns).unionByName(idle.select(*spec.dim_columns))
