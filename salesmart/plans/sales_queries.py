"""Sales-mart scans, projections, filters, measures, star join and roll-ups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.measures import (
    EXACT_TOTAL,
    TOTAL,
    line_amount,
    money,
    with_sales_measures,
)
from salesmart.operators.joins import Dim, star_join
from salesmart.operators.rollups import sum_by, top_k
from salesmart.plans.catalog import query
from salesmart.plans.mart import Mart, part_measures
from salesmart.sources.tables import SALES_TABLES, read_tables, register_views, scan_limit, table_set_counts

# SQL fragments identical to the column functions in functions.measures.
LINE_AMOUNT_SQL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(18,2))"
)
GROSS_SQL = "CAST(l_extendedprice AS DECIMAL(18,2))"
COGS_SQL = "CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(28,4))"
DISCOUNT_SQL = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(28,4))"
PERCENT_AMOUNT_SQL = (
    "CAST(CAST(l_quantity AS DECIMAL(9,2)) * CAST(p_retailprice AS DECIMAL(12,2)) "
    "* ((100 - CAST(l_discount * 100 AS DECIMAL(5,2))) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,2))"
)


# -- scans ---------------------------------------------------------------
@query("scan_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000")
def scan_limit_q(spark, root):
    """The first 1000 rows by key, so the rows are defined."""
    return scan_limit(Mart(spark, root).orders, 1000, ["o_orderkey"])


@query("scan_full", "SELECT * FROM orders")
def scan_full(spark, root):
    """Table scan by name through the catalog (``spark.read.table``)."""
    views = register_views(spark, root, ["orders"])
    return spark.read.table(views["orders"])


@query(
    "table_set_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in SALES_TABLES),
)
def table_set_counts_q(spark, root):
    """Load a named set of tables (workbook sheets) and report each row count."""
    return table_set_counts(read_tables(spark, root, SALES_TABLES))


@query("take_n", "SELECT * FROM events ORDER BY ts, event_id LIMIT 100")
def take_n(spark, root):
    """``take 100`` / ``head()``: a bounded sample, ordered so it is reproducible."""
    return scan_limit(Mart(spark, root).events, 100, ["ts", "event_id"])


@query(
    "inline_rows",
    """
WITH flags(flag, label, factor) AS (
  VALUES ('A', 'Accepted', CAST(1 - 0.05 AS DECIMAL(3,2))),
         ('N', 'Not returned', CAST(1 - 0.00 AS DECIMAL(3,2))),
         ('R', 'Returned', CAST(1 - 0.10 AS DECIMAL(3,2)))
)
SELECT f.flag, f.label, f.factor, COUNT(*) AS lines,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * f.factor) AS DECIMAL(38,4)) AS NetAmount
FROM lineitem JOIN flags f ON l_returnflag = f.flag
GROUP BY f.flag, f.label, f.factor
""",
)
def inline_rows(spark, root):
    """Inline ``VALUES`` rows with computed cells (``1 - 0.05``), joined to the facts.

    The facts are aggregated by flag first; the three inline rows are broadcast.
    """
    flags = spark.sql(
        "SELECT flag, label, CAST(factor AS DECIMAL(3,2)) AS factor FROM VALUES "
        "('A', 'Accepted', 1 - 0.05), ('N', 'Not returned', 1 - 0.00), ('R', 'Returned', 1 - 0.10) "
        "AS t(flag, label, factor)"
    )
    per_flag = Mart(spark, root).lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).alias("gross")
    )
    return per_flag.join(F.broadcast(flags), F.col("l_returnflag") == F.col("flag")).select(
        "flag", "label", "factor", "lines", (F.col("gross") * F.col("factor")).cast("decimal(38,4)").alias("NetAmount")
    )


# -- projection and filters ---------------------------------------------
@query("project_cols", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def project_cols(spark, root):
    return Mart(spark, root).lineitem.select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "project_computed",
    f"""
SELECT l_orderkey, p_brand AS Brand, p_type AS Category, l_quantity AS Qty,
       {GROSS_SQL} AS Gross, {LINE_AMOUNT_SQL} AS NetAmount
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def project_computed(spark, root):
    """Renamed columns and computed ones side by side."""
    m = Mart(spark, root)
    joined = star_join(m.lineitem, [Dim(m.part, "l_partkey", "p_partkey", columns=("p_brand", "p_type"))])
    return joined.select(
        "l_orderkey",
        F.col("p_brand").alias("Brand"),
        F.col("p_type").alias("Category"),
        F.col("l_quantity").alias("Qty"),
        money("l_extendedprice").alias("Gross"),
        line_amount("l_extendedprice", "l_discount").alias("NetAmount"),
    )


@query(
    "filter_between",
    """
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
WHERE l_shipdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
""",
)
def filter_between(spark, root):
    """Inclusive range filter (``between``), pushed into the Parquet scan."""
    li = Mart(spark, root).lineitem
    lo, hi = dt.date(1996, 1, 1), dt.date(1996, 12, 31)
    return li.filter(F.col("l_shipdate").between(F.lit(lo), F.lit(hi))).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"
    )


@query(
    "filter_date_eq",
    """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate > DATE '1997-06-30' AND o_orderpriority = '1-URGENT'
""",
)
def filter_date_eq(spark, root):
    """A comparison and an equality in one predicate."""
    o = Mart(spark, root).orders
    return o.filter((F.col("o_orderdate") > F.lit(dt.date(1997, 6, 30))) & (F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )


@query(
    "filter_multi",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_quantity > 1
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
  AND l_suppkey IN (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')
""",
)
def filter_multi(spark, root):
    """Lines of one region and category with more than one piece.

    Case-sensitive equality.  The dimension predicates become semi joins so the
    fact rows are neither widened nor duplicated; AQE broadcasts a side whose
    measured size is small.
    """
    m = Mart(spark, root)
    regions = m.region.filter(F.col("r_name") == "EUROPE")
    nations = m.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    suppliers = m.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    parts = m.part.filter(F.col("p_type") == "ECONOMY")
    return (
        m.lineitem.filter(F.col("l_quantity") > 1)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    )


@query(
    "transform_fn",
    "SELECT * FROM orders WHERE o_orderstatus = 'F'",
)
def transform_fn(spark, root):
    """A user cleaning function applied with ``DataFrame.transform``."""

    def clean_data(df):
        return df.filter(F.col("o_orderstatus") == "F")

    return Mart(spark, root).orders.transform(clean_data)


# -- measures --------------------------------------------------------------
@query(
    "line_amount",
    f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, {LINE_AMOUNT_SQL} AS LineAmount
FROM lineitem
""",
)
def line_amount_q(spark, root):
    """Net line amount ``CAST(Qty*UnitPrice*(1-Discount) AS DECIMAL(18,2))``."""
    return Mart(spark, root).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        line_amount("l_extendedprice", "l_discount").alias("LineAmount"),
    )


@query(
    "line_amount_percent",
    f"""
SELECT l_orderkey, l_linenumber, CAST(l_discount * 100 AS DECIMAL(5,2)) AS DiscountPct,
       {PERCENT_AMOUNT_SQL} AS LineAmount
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def line_amount_percent(spark, root):
    """The net line amount from quantity, unit price and a discount in percent."""
    m = Mart(spark, root)
    joined = star_join(m.lineitem, [Dim(m.part, "l_partkey", "p_partkey", columns=("p_retailprice",))])
    rows = joined.withColumn("DiscountPct", (F.col("l_discount") * 100).cast("decimal(5,2)"))
    amount = line_amount(qty="l_quantity", price="p_retailprice", discount="DiscountPct", rate_unit="percent")
    return rows.select("l_orderkey", "l_linenumber", "DiscountPct", amount.alias("LineAmount"))


@query(
    "star_join_drop",
    """
SELECT o_orderkey, o_orderdate, n_name, r_name
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
  ON c_nationkey = g.n_nationkey
""",
)
def star_join_drop(spark, root):
    """A star join whose later dimension supersedes columns of the rows so far."""
    m = Mart(spark, root)
    geo = m.nation.join(m.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = m.customer.withColumn("n_name", F.col("c_name")).withColumn("r_name", F.col("c_mktsegment"))
    return star_join(
        m.orders.select("o_orderkey", "o_orderdate", "o_custkey"),
        [
            Dim(customer, "o_custkey", "c_custkey", columns=("c_nationkey", "n_name", "r_name")),
            Dim(geo, "c_nationkey", "n_nationkey", columns=("n_name", "r_name"), drop=("n_name", "r_name")),
        ],
    ).select("o_orderkey", "o_orderdate", "n_name", "r_name")


# Type names of the scan for the type names of the oracle's own description of the table.
_TYPES_SQL = "CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END"
_LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(
    "column_names",
    f"""
WITH c AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n_values, count(*) - count({c}) AS n_nulls FROM lineitem" for c in _LINE_COLUMNS)})
SELECT column_name, {_TYPES_SQL} AS data_type, n_values, n_nulls FROM (DESCRIBE lineitem) JOIN c USING (column_name)
""",
)
def column_names(spark, root):
    """The columns of a scan with their types, and how many values and nulls each holds."""
    li = Mart(spark, root).lineitem
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.count(F.col(c)).alias("n_values"), F.count_if(F.col(c).isNull()).alias("n_nulls"))
        for c, t in li.dtypes
    ]
    return li.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@query(
    "measures",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       {GROSS_SQL} AS Gross, {COGS_SQL} AS COGS, {DISCOUNT_SQL} AS Discount,
       CAST({GROSS_SQL} - {COGS_SQL} AS DECIMAL(28,4)) AS GrossMargin
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def measures(spark, root):
    """Derived columns Gross, COGS, Discount (fraction rate) and GrossMargin."""
    m = Mart(spark, root)
    joined = star_join(m.lineitem, [Dim(m.part, "l_partkey", "p_partkey", columns=("p_retailprice",))])
    return with_sales_measures(
        joined, qty="l_quantity", cost="p_retailprice", amount="l_extendedprice", rate="l_discount"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "Gross", "COGS", "Discount", "GrossMargin")


@query(
    "star_join",
    f"""
SELECT l_orderkey, l_linenumber, o_orderdate, o_custkey, c_name, n_name, p_brand, p_type,
       {LINE_AMOUNT_SQL} AS LineAmount
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
""",
)
def star_join_q(spark, root):
    """Fact with four dimensions; differently named keys; dimension keys dropped.

    The nation joins the customers first, so the facts never move by the few
    nation keys.
    """
    m = Mart(spark, root)
    customer = star_join(m.customer, [Dim(m.nation, "c_nationkey", "n_nationkey", columns=("n_name",))])
    joined = star_join(
        m.lineitem,
        [
            Dim(m.orders, "l_orderkey", "o_orderkey", columns=("o_orderdate", "o_custkey")),
            Dim(customer, "o_custkey", "c_custkey", columns=("c_name", "n_name")),
            Dim(m.part, "l_partkey", "p_partkey", columns=("p_brand", "p_type")),
        ],
    )
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "o_orderdate",
        "o_custkey",
        "c_name",
        "n_name",
        "p_brand",
        "p_type",
        line_amount("l_extendedprice", "l_discount").alias("LineAmount"),
    )


# -- roll-ups -----------------------------------------------------------------
@query("row_count", "SELECT COUNT(*) AS Count FROM lineitem")
def row_count(spark, root):
    """Number of fact rows."""
    return Mart(spark, root).lineitem.agg(F.count(F.lit(1)).alias("Count"))


@query(
    "totals_by_geo",
    f"""
SELECT n_name, r_name,
       CAST(SUM({GROSS_SQL}) AS DECIMAL(38,2)) AS TotalGross,
       CAST(SUM({COGS_SQL}) AS DECIMAL(38,2)) AS TotalCOGS,
       CAST(SUM({DISCOUNT_SQL}) AS DECIMAL(38,2)) AS TotalDiscount
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY n_name, r_name
""",
)
def totals_by_geo(spark, root):
    """Sums of Gross, COGS and Discount by the customer's geography (nation, region).

    Line measures need the part (unit cost), then everything is summed per
    order, per customer and per nation before the fixed-size geography joins.
    """
    m = Mart(spark, root)
    lines = star_join(m.lineitem, [Dim(m.part, "l_partkey", "p_partkey", columns=("p_retailprice",))])
    lines = with_sales_measures(lines, "l_quantity", "p_retailprice", "l_extendedprice", "l_discount")
    cols = ["Gross", "COGS", "Discount"]
    same = {c: c for c in cols}
    per_order = sum_by(lines, ["l_orderkey"], same, EXACT_TOTAL)
    per_cust = sum_by(
        per_order.join(m.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")),
        ["o_custkey"],
        same,
        EXACT_TOTAL,
    )
    per_nation = sum_by(
        per_cust.join(m.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")),
        ["c_nationkey"],
        same,
        EXACT_TOTAL,
    )
    geo = m.nation.join(m.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return per_nation.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", "r_name", *[F.col(c).cast(TOTAL).alias(f"Total{c}") for c in cols]
    )


@query(
    "totals_by_brand",
    f"""
SELECT p_brand AS Brand, p_type AS Category,
       CAST(SUM({GROSS_SQL}) AS DECIMAL(38,2)) AS TotalGross,
       CAST(SUM({COGS_SQL}) AS DECIMAL(38,2)) AS TotalCOGS,
       AVG(l_quantity) AS AvgQty,
       CAST(SUM({DISCOUNT_SQL}) AS DECIMAL(38,2)) AS TotalDiscount
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand, p_type
""",
)
def totals_by_brand(spark, root):
    """By Brand and Category: sums and the mean quantity.

    The mean quantity is named for what it is, ``AvgQty``.
    """
    per_part = part_measures(Mart(spark, root))
    return per_part.groupBy(F.col("p_brand").alias("Brand"), F.col("p_type").alias("Category")).agg(
        F.sum("Gross").cast(TOTAL).alias("TotalGross"),
        F.sum("COGS").cast(TOTAL).alias("TotalCOGS"),
        (F.sum("QtyD") / F.sum("Lines")).alias("AvgQty"),
        F.sum("Discount").cast(TOTAL).alias("TotalDiscount"),
    )


@query(
    "sales_by_category",
    f"""
SELECT p_type AS Category, CAST(SUM({GROSS_SQL}) AS DECIMAL(38,2)) AS TotalSales, SUM(l_quantity) AS TotalQty
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_type
""",
)
def sales_by_category(spark, root):
    """Sold amount and quantity per category."""
    per_part = part_measures(Mart(spark, root))
    return per_part.groupBy(F.col("p_type").alias("Category")).agg(
        F.sum("Gross").cast(TOTAL).alias("TotalSales"), F.sum("QtyD").alias("TotalQty")
    )


@query(
    "margin_by_brand",
    f"""
SELECT p_brand AS Brand, CAST(SUM({GROSS_SQL}) AS DECIMAL(38,2)) AS TotalSales,
       CAST(SUM({GROSS_SQL} - {COGS_SQL}) AS DECIMAL(38,2)) AS TotalGrossMargin
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand
""",
)
def margin_by_brand(spark, root):
    """Sales and gross margin per brand."""
    per_part = part_measures(Mart(spark, root))
    return per_part.groupBy(F.col("p_brand").alias("Brand")).agg(
        F.sum("Gross").cast(TOTAL).alias("TotalSales"),
        F.sum(F.col("Gross") - F.col("COGS")).cast(TOTAL).alias("TotalGrossMargin"),
    )


@query(
    "top5_brand_type",
    f"""
SELECT p_brand AS Brand, p_type AS Category, CAST(SUM({GROSS_SQL}) AS DECIMAL(38,2)) AS TotalSales
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand, p_type
ORDER BY TotalSales DESC, Brand, Category
LIMIT 5
""",
)
def top5_brand_type(spark, root):
    """The five best-selling pairs of brand and category."""
    per_part = part_measures(Mart(spark, root))
    grouped = per_part.groupBy(F.col("p_brand").alias("Brand"), F.col("p_type").alias("Category")).agg(
        F.sum("Gross").cast(TOTAL).alias("TotalSales")
    )
    return top_k(grouped, 5, "TotalSales", ["Brand", "Category"])


@query(
    "sales_by_state",
    f"""
SELECT n.n_name AS State, CAST(SUM({LINE_AMOUNT_SQL}) AS DECIMAL(38,2)) AS TotalSales
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name
ORDER BY TotalSales DESC, State
""",
)
def sales_by_state(spark, root):
    """Facts rolled up to a dimension attribute (state totals), inner joins."""
    return Mart(spark, root).sales_by_nation()

