"""Join types, key audits and customer totals with unmatched keys.

The join-type queries filter both sides first, by an *attribute* predicate, as
the shapes they restate do: the facts are the orders of one year, the
curated customer dimension is one market segment.  The audits, the ordered full
join and the customer totals run on whole tables whose keys really have gaps:
documents without labels, customers without events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.operators.heavy_join import join_heavy
from salesmart.operators.joins import full_join_ordered, join_on, orphan_facts, unmatched_dims
from salesmart.plans.catalog import query
from salesmart.plans.mart import Mart

# Fixed value: the label the source reports for keys missing from the dimension.
UNKNOWN_CUSTOMER = "(Unknown Customer)"

YEAR_FROM, YEAR_TO = dt.date(1997, 1, 1), dt.date(1998, 1, 1)
SEGMENT = "BUILDING"
HAVING_MIN = 2_500_000

FACTS_SQL = (
    "(SELECT o_custkey AS CustomerId, o_orderkey, o_orderdate, o_totalprice FROM orders "
    "WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01')"
)
DIMS_SQL = f"(SELECT c_custkey AS CustomerId, c_name, c_nationkey FROM customer WHERE c_mktsegment = '{SEGMENT}')"
LINE_AMOUNT_SQL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(18,2))"
)


def _sides(spark, root):
    m = Mart(spark, root)
    facts = m.orders.filter((F.col("o_orderdate") >= F.lit(YEAR_FROM)) & (F.col("o_orderdate") < F.lit(YEAR_TO))).select(
        F.col("o_custkey").alias("CustomerId"), "o_orderkey", "o_orderdate", "o_totalprice"
    )
    dims = m.customer.filter(F.col("c_mktsegment") == SEGMENT).select(
        F.col("c_custkey").alias("CustomerId"), "c_name", "c_nationkey"
    )
    return facts, dims


def _using_sql(how: str) -> str:
    key = "COALESCE(f.CustomerId, d.CustomerId)" if how == "FULL" else ("d.CustomerId" if how == "RIGHT" else "f.CustomerId")
    return (
        f"SELECT {key} AS CustomerId, f.o_orderkey, f.o_orderdate, f.o_totalprice, d.c_name, d.c_nationkey "
        f"FROM {FACTS_SQL} f {how} JOIN {DIMS_SQL} d ON f.CustomerId = d.CustomerId"
    )


@query("join_inner", _using_sql("INNER"))
def join_inner(spark, root):
    facts, dims = _sides(spark, root)
    return join_on(facts, dims, "CustomerId", "inner")


@query("join_left", _using_sql("LEFT"))
def join_left(spark, root):
    facts, dims = _sides(spark, root)
    return join_on(facts, dims, "CustomerId", "left")


@query("join_right", _using_sql("RIGHT"))
def join_right(spark, root):
    facts, dims = _sides(spark, root)
    return join_on(facts, dims, "CustomerId", "right")


@query("join_full", _using_sql("FULL"))
def join_full(spark, root):
    """Full outer join in the using form: the key is coalesced from both sides."""
    facts, dims = _sides(spark, root)
    return join_on(facts, dims, "CustomerId", "full")


@query(
    "anti_facts",
    f"SELECT * FROM {FACTS_SQL} f WHERE NOT EXISTS (SELECT 1 FROM {DIMS_SQL} d WHERE d.CustomerId = f.CustomerId)",
)
def anti_facts(spark, root):
    """Facts whose customer is not in the dimension (``"anti"`` join)."""
    facts, dims = _sides(spark, root)
    return join_on(facts, dims, "CustomerId", "anti")


@query(
    "anti_dims",
    f"SELECT * FROM {DIMS_SQL} d WHERE NOT EXISTS (SELECT 1 FROM {FACTS_SQL} f WHERE d.CustomerId = f.CustomerId)",
)
def anti_dims(spark, root):
    """Dimension members without facts (anti join, sides swapped)."""
    facts, dims = _sides(spark, root)
    return join_on(dims, facts.select("CustomerId").distinct(), "CustomerId", "left_anti")


@query(
    "orphan_facts",
    """
SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d
LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.doc_id IS NULL
""",
)
def orphan_facts_q(spark, root):
    """Facts without a dimension row (documents without labels) as a left anti join."""
    m = Mart(spark, root)
    docs = m.t("documents").select("doc_id", "lang", "source", "n_chars")
    return orphan_facts(docs, m.t("labels"), "doc_id")


@query(
    "unsold_dims",
    """
SELECT c.* FROM customer c
LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON e.user_id = c.c_custkey
WHERE e.user_id IS NULL
""",
)
def unsold_dims(spark, root):
    """Dimension members without any fact: customers with no event."""
    m = Mart(spark, root)
    return unmatched_dims(m.customer, m.events, "c_custkey", "user_id")


@query(
    "full_join_ordered",
    """
SELECT d.doc_id AS FactDocId, l.doc_id AS DimDocId, l.quality, l.toxic, d.lang, d.n_chars, d.doc_id
FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id
ORDER BY CASE WHEN d.doc_id IS NULL THEN 1 ELSE 0 END, COALESCE(d.doc_id, l.doc_id), d.doc_id
""",
)
def full_join_ordered_q(spark, root):
    """Full outer join of whole tables keeping both keys, ordered by CASE, COALESCE and fact id."""
    m = Mart(spark, root)
    return full_join_ordered(
        m.t("documents"),
        m.t("labels"),
        "doc_id",
        "doc_id",
        "doc_id",
        ["lang", "n_chars"],
        ["quality", "toxic"],
        fact_key_alias="FactDocId",
        dim_key_alias="DimDocId",
    )


def _customer_totals_sql(name_expr: str, having: str = "") -> str:
    return f"""
SELECT COALESCE(c.c_custkey, s.o_custkey) AS CustomerId, {name_expr} AS Name,
       CAST(SUM({LINE_AMOUNT_SQL}) AS DECIMAL(38,2)) AS TotalSales
FROM lineitem JOIN orders s ON l_orderkey = s.o_orderkey
LEFT JOIN customer c ON s.o_custkey = c.c_custkey
GROUP BY COALESCE(c.c_custkey, s.o_custkey), {name_expr}
{having}
ORDER BY TotalSales DESC
"""


def _customer_totals(spark, root, unknown_name: str | None):
    """Net sales per ordering customer, left-joined to the customer dimension.

    Totals are built per customer key first; the dimension join then meets one
    row per key.  ``COALESCE(dim.key, fact.key)`` keeps orphan keys visible.
    """
    m = Mart(spark, root)
    dims = m.customer.select("c_custkey", "c_name")
    per_cust = m.customer_totals()
    joined = per_cust.join(dims, F.col("o_custkey") == F.col("c_custkey"), "left")
    name = F.col("c_name") if unknown_name is None else F.coalesce(F.col("c_name"), F.lit(unknown_name))
    return joined.select(
        F.coalesce(F.col("c_custkey"), F.col("o_custkey")).alias("CustomerId"), name.alias("Name"), "TotalSales"
    )


@query("sales_per_customer", _customer_totals_sql("c.c_name"))
def sales_per_customer(spark, root):
    return _customer_totals(spark, root, None).orderBy(F.col("TotalSales").desc())


@query(
    "having_total",
    _customer_totals_sql(
        f"COALESCE(c.c_name, '{UNKNOWN_CUSTOMER}')",
        f"HAVING SUM({LINE_AMOUNT_SQL}) > {HAVING_MIN}",
    ),
)
def having_total(spark, root):
    """Group filter after aggregation (HAVING total > threshold)."""
    totals = _customer_totals(spark, root, UNKNOWN_CUSTOMER)
    return totals.filter(F.col("TotalSales") > HAVING_MIN).orderBy(F.col("TotalSales").desc())


@query(
    "join_heavy_keys",
    """
SELECT l_orderkey, l_linenumber, l_suppkey, s_suppkey, s_name, s_nationkey
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
""",
)
def join_heavy_keys(spark, root):
    """Facts with their suppliers: suppliers of over a hundredth of all lines are sent to the lines, the rest is shuffled."""
    m = Mart(spark, root)
    facts = m.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return join_heavy(facts, m.supplier.select("s_suppkey", "s_name", "s_nationkey"), "l_suppkey", "s_suppkey", "left", share=0.01)
