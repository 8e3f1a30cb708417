"""Key audits standing in for PRIMARY KEY enforcement.

Spark does not enforce keys.  ``duplicate_keys`` lists key values held by more
than one row, and keys with a NULL part, with their row counts: one grouped
aggregate, combined map-side, so a key repeated in a third of all rows costs
one row per task before the shuffle.  ``assert_unique`` fails with a few
example keys (a bounded ``take``) when the audit finds anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """``key..., n``: keys that occur more than once or have a NULL part."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") > 1) | any_null)


def assert_unique(df: DataFrame, key: list[str], examples: int = 5) -> None:
    """Raise ``ValueError`` naming up to ``examples`` offending keys."""
    bad = duplicate_keys(df, key).take(examples)
    if bad:
        shown = ", ".join(str(tuple(r[k] for k in key)) + f" x{r['n']}" for r in bad)
        raise ValueError(f"key {key} is not unique or has NULLs: {shown}")
