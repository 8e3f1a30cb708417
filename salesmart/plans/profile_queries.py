"""Table profiles: ``describe()`` and ``summary()`` of whole tables in long form."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from salesmart.operators.key_discovery import key_report
from salesmart.operators.profile import describe_long, describe_text, summary_long
from salesmart.plans.catalog import query
from salesmart.plans.mart import Mart

DIGITS = 6  # mean and stddev are compared rounded: partial sums may meet in any order
WHOLE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FLOATING = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
OTHER = ["l_returnflag", "l_linestatus", "l_shipdate"]


def _column_sql(c: str, quantiles: bool) -> str:
    number = c not in OTHER
    x = f"CAST({c} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"
    text = "CAST(NULL AS VARCHAR)" if c in FLOATING else "{}"
    lo, hi = (text.format(f"CAST({f}({c}) AS VARCHAR)") for f in ("MIN", "MAX"))
    qs = ""
    if quantiles:
        exprs = [f"quantile_disc({x}, {p})" if number else "CAST(NULL AS DOUBLE)" for p in (0.25, 0.5, 0.75)]
        qs = ", " + ", ".join(f"{e} AS p{n}" for e, n in zip(exprs, (25, 50, 75)))
    return (
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({x}), {DIGITS}) AS mean, "
        f"ROUND(STDDEV_SAMP({x}), {DIGITS}) AS stddev, MIN({x}) AS min, MAX({x}) AS max, "
        f"{lo} AS min_text, {hi} AS max_text{qs} FROM lineitem"
    )


def _table_sql(quantiles: bool = False) -> str:
    return "\nUNION ALL\n".join(_column_sql(c, quantiles) for c in [*WHOLE, *FLOATING, *OTHER])


def _rounded(df):
    return df.withColumns({c: F.round(c, DIGITS) for c in ("mean", "stddev")})


@query("describe_table", _table_sql())
def describe_table(spark, root):
    """count / mean / stddev / min / max of every column of a mixed table, one pass."""
    return _rounded(describe_long(Mart(spark, root).lineitem))


@query("summary_table", _table_sql(quantiles=True))
def summary_table(spark, root):
    """``describe`` plus exact 25 / 50 / 75 % (discrete) percentiles of the numbers."""
    return _rounded(summary_long(Mart(spark, root).lineitem))


TEXT_COLS = ["c_name", "c_mktsegment"]


@query(
    "describe_text",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, MIN({c}) AS min, MAX({c}) AS max FROM customer"
        for c in TEXT_COLS
    ),
)
def describe_text_q(spark, root):
    """``describe()`` of every text column: count, min, max."""
    return describe_text(Mart(spark, root).customer)


# The columns of the tables whose keys are looked for.
KEYED_TABLES = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value"),
}


def _candidate_sql(table: str, names: tuple[str, ...]) -> str:
    values = f"({', '.join(names)})" if len(names) > 1 else names[0]
    filled = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(names)}' AS key_columns, {len(names)} AS n_columns, "
        f"count(*) > 0 AND count(*) = count(DISTINCT {values}) AND bool_and({filled}) AS is_key FROM {table}"
    )


_CANDIDATES = " UNION ALL ".join(
    _candidate_sql(table, names) for table, columns in KEYED_TABLES.items() for size in (1, 2) for names in combinations(columns, size)
)


@query(
    "key_discovery",
    f"""
WITH k AS ({_CANDIDATES})
SELECT table_name, key_columns, n_columns FROM k
WHERE is_key AND NOT EXISTS (
  SELECT 1 FROM k s WHERE s.is_key AND s.table_name = k.table_name AND s.n_columns < k.n_columns
    AND list_contains(string_split(k.key_columns, ','), s.key_columns))
""",
)
def key_discovery(spark, root):
    """Minimal keys of one or two columns of the sales tables and the events."""
    m = Mart(spark, root)
    return key_report({name: m.t(name).select(*columns) for name, columns in KEYED_TABLES.items()}, width=2)
