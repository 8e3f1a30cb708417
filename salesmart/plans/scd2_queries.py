"""Type 2 item dimension over ``part`` and the point-in-time load of ``lineitem``.

Scenario (derived from the whole tables by attribute predicates):
* previous load: parts of size <= 45, open since 1992-01-01;
* staged extract: every part; PROMO parts arrive with a changed brand;
* run time 1998-06-17; keys never seen start at 1996-01-01;
* facts: every lineitem, by ship date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.operators import history, scd2
from salesmart.plans.catalog import query
from salesmart.plans.mart import Mart
from salesmart.session import own_path

SPEC = scd2.Scd2Spec(
    key="Item_Id",
    attrs=("Name", "Brand", "Category", "Size"),
    default_start=dt.datetime(1996, 1, 1),
    surrogate="Item_SurrogateKey",
)
FIRST_LOAD = dt.datetime(1992, 1, 1)
RUN_TS = dt.datetime(1998, 6, 17)
MATCH = "history"


def _items(m: Mart, staged: bool):
    brand = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.col("p_brand"), F.lit("-R"))).otherwise(F.col("p_brand"))
        if staged
        else F.col("p_brand")
    )
    return m.part.select(
        F.col("p_partkey").alias("Item_Id"),
        F.col("p_name").alias("Name"),
        brand.alias("Brand"),
        F.col("p_type").alias("Category"),
        F.col("p_size").alias("Size"),
    )


def _inputs(spark, root):
    m = Mart(spark, root)
    dim = scd2.initial_dimension(_items(m, False).filter(F.col("Size") <= 45), SPEC, FIRST_LOAD)
    return m, dim, _items(m, True)


def _facts(m: Mart):
    return m.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


SK_SQL = "sha256(CAST(Item_Id AS VARCHAR) || '|' || strftime(Valid_Start_Date, '%Y-%m-%d %H:%M:%S.%f'))"
CTE = f"""
WITH dim0 AS (
  SELECT p_partkey AS Item_Id, p_name AS Name, p_brand AS Brand, p_type AS Category, p_size AS Size,
         TIMESTAMP '1992-01-01 00:00:00' AS Valid_Start_Date, CAST(NULL AS TIMESTAMP) AS Valid_End_Date
  FROM part WHERE p_size <= 45),
stg AS (
  SELECT p_partkey AS Item_Id, p_name AS Name,
         CASE WHEN p_type = 'PROMO' THEN p_brand || '-R' ELSE p_brand END AS Brand,
         p_type AS Category, p_size AS Size
  FROM part),
closed AS (
  SELECT d.Item_Id, d.Name, d.Brand, d.Category, d.Size, d.Valid_Start_Date,
         CASE WHEN d.Valid_End_Date IS NULL AND s.Item_Id IS NOT NULL
                   AND (d.Name <> s.Name OR d.Brand <> s.Brand OR d.Category <> s.Category OR d.Size <> s.Size)
              THEN TIMESTAMP '1998-06-17 00:00:00' ELSE d.Valid_End_Date END AS Valid_End_Date
  FROM dim0 d LEFT JOIN stg s ON d.Item_Id = s.Item_Id),
new_rows AS (
  SELECT s.Item_Id, s.Name, s.Brand, s.Category, s.Size,
         CASE WHEN s.Item_Id IN (SELECT Item_Id FROM closed)
              THEN TIMESTAMP '1998-06-17 00:00:00' ELSE TIMESTAMP '1996-01-01 00:00:00' END AS Valid_Start_Date,
         CAST(NULL AS TIMESTAMP) AS Valid_End_Date
  FROM stg s
  WHERE NOT EXISTS (
    SELECT 1 FROM closed t
    WHERE t.Item_Id = s.Item_Id AND t.Name = s.Name AND t.Brand = s.Brand
      AND t.Category = s.Category AND t.Size = s.Size)),
dim1 AS (
  SELECT {SK_SQL} AS Item_SurrogateKey, * FROM closed
  UNION ALL
  SELECT {SK_SQL} AS Item_SurrogateKey, * FROM new_rows)
"""
DIM_COLS = "Item_SurrogateKey, Item_Id, Name, Brand, Category, Size, Valid_Start_Date, Valid_End_Date"
VALID_ON = (
    "l_partkey = Item_Id AND l_shipdate >= Valid_Start_Date "
    "AND l_shipdate < COALESCE(Valid_End_Date, TIMESTAMP '9999-12-31 23:59:59.999999')"
)


@query(
    "scd2_changed",
    f"""{CTE}
SELECT {SK_SQL} AS Item_SurrogateKey, * FROM dim0 d
WHERE Valid_End_Date IS NULL AND EXISTS (SELECT 1 FROM stg s WHERE d.Item_Id = s.Item_Id
  AND (d.Name <> s.Name OR d.Brand <> s.Brand OR d.Category <> s.Category OR d.Size <> s.Size))
""",
)
def scd2_changed(spark, root):
    """Open rows whose staged row differs in any tracked attribute."""
    _, dim, stage = _inputs(spark, root)
    return scd2.changed_rows(dim, stage, SPEC)


@query("scd2_close", f"{CTE} SELECT {SK_SQL} AS Item_SurrogateKey, * FROM closed")
def scd2_close(spark, root):
    """The dimension after closing changed rows at the run time."""
    _, dim, stage = _inputs(spark, root)
    return scd2.close_changed(dim, stage, SPEC, RUN_TS)


@query("scd2_new_versions", f"{CTE} SELECT {SK_SQL} AS Item_SurrogateKey, * FROM new_rows")
def scd2_new_versions(spark, root):
    """Staged rows equal to no version: new open rows (first-seen keys start at the default)."""
    _, dim, stage = _inputs(spark, root)
    closed = scd2.close_changed(dim, stage, SPEC, RUN_TS)
    return scd2.new_versions(closed, stage, SPEC, RUN_TS, MATCH)


@query("scd2_dimension", f"{CTE} SELECT {DIM_COLS} FROM dim1")
def scd2_dimension(spark, root):
    """The dimension after one load, surrogate keys filled for every version."""
    _, dim, stage = _inputs(spark, root)
    return scd2.load(dim, stage, SPEC, RUN_TS, MATCH)


# The current match compares with open rows only: the closed rows are left out of the comparison.
CURRENT = CTE.replace(
    "AND t.Brand = s.Brand\n      AND t.Category = s.Category AND t.Size = s.Size)",
    "AND t.Brand = s.Brand\n      AND t.Category = s.Category AND t.Size = s.Size AND t.Valid_End_Date IS NULL)",
).replace("FROM part WHERE p_size <= 45)", "FROM part WHERE p_size <= 45\n" + "  UNION ALL " + """
  SELECT p_partkey, p_name, p_brand || '-R', p_type, p_size, TIMESTAMP '1991-01-01 00:00:00', TIMESTAMP '1992-01-01 00:00:00'
  FROM part WHERE p_type = 'PROMO' AND p_size <= 45)""")


def _reopened_inputs(spark, root):
    """The inputs with a closed first version of the PROMO parts that equals their staged row (A, then B, then A again)."""
    m, dim, stage = _inputs(spark, root)
    first = dt.datetime(1991, 1, 1)
    old = stage.filter((F.col("Category") == "PROMO") & (F.col("Size") <= 45))
    old = scd2.initial_dimension(old, SPEC, first).withColumn(SPEC.end, F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    return m, dim.unionByName(old), stage


@query("scd2_new_versions_current", f"{CURRENT} SELECT {SK_SQL} AS Item_SurrogateKey, * FROM new_rows")
def scd2_new_versions_current(spark, root):
    """New versions when only open rows count: a value that comes back opens a version again."""
    _, dim, stage = _reopened_inputs(spark, root)
    return scd2.new_versions(scd2.close_changed(dim, stage, SPEC, RUN_TS), stage, SPEC, RUN_TS, "current")


@query("scd2_dimension_current", f"{CURRENT} SELECT {DIM_COLS} FROM dim1")
def scd2_dimension_current(spark, root):
    """The dimension after a load that compares with open rows (the default)."""
    _, dim, stage = _reopened_inputs(spark, root)
    return scd2.load(dim, stage, SPEC, RUN_TS)


@query(
    "scd2_fact_load",
    f"""{CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, Item_SurrogateKey, CAST(year(l_shipdate) AS INTEGER) AS batch
FROM lineitem JOIN dim1 ON {VALID_ON}
""",
)
def scd2_fact_load(spark, root):
    """Keyed facts landed by batch (ship year); the last batches are loaded again and replace themselves."""
    m, dim, stage = _inputs(spark, root)
    facts = _facts(m).withColumn("batch", F.year("l_shipdate"))
    dim = scd2.load(dim, stage, SPEC, RUN_TS, MATCH)
    path = own_path(spark, "facts")
    # The first load has the last year's facts without the newest; their batch comes again, whole.
    newest = dt.datetime(1998, 6, 17)
    for part in (facts.where(F.col("l_shipdate") < newest), facts.where("batch >= 1998")):
        keyed = scd2.asof_join(part, dim, "l_partkey", "l_shipdate", SPEC)
        scd2.land_facts(keyed, path, "batch")
    return spark.read.schema(keyed.schema).parquet(path)


@query(
    "scd2_asof_join",
    f"""{CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, Item_SurrogateKey
FROM lineitem JOIN dim1 ON {VALID_ON}
""",
)
def scd2_asof_join(spark, root):
    """Facts with the surrogate key valid on the ship date (interval join)."""
    m, dim, stage = _inputs(spark, root)
    return scd2.asof_join(_facts(m), scd2.load(dim, stage, SPEC, RUN_TS, MATCH), "l_partkey", "l_shipdate", SPEC)


@query(
    "scd2_unmatched_facts",
    f"""{CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM dim1 WHERE {VALID_ON})
""",
)
def scd2_unmatched_facts(spark, root):
    """Facts dated before the first version of their item (dropped by the inner join)."""
    m, dim, stage = _inputs(spark, root)
    return scd2.unmatched_facts(_facts(m), scd2.load(dim, stage, SPEC, RUN_TS, MATCH), "l_partkey", "l_shipdate", SPEC)


@query(
    "scd2_asof_carried",
    f"""{CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, Item_SurrogateKey
FROM lineitem JOIN dim1 ON {VALID_ON}
""",
)
def scd2_asof_carried(spark, root):
    """Facts with the surrogate key valid on the ship date, carried along (key, time) ranges."""
    m, dim, stage = _inputs(spark, root)
    return history.asof_carried(_facts(m), scd2.load(dim, stage, SPEC, RUN_TS, MATCH), "l_partkey", "l_shipdate", SPEC)


@query(
    "scd2_unmatched_carried",
    f"""{CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM dim1 WHERE {VALID_ON})
""",
)
def scd2_unmatched_carried(spark, root):
    """Facts that no version covers, by the same stream."""
    m, dim, stage = _inputs(spark, root)
    return history.unmatched_carried(_facts(m), scd2.load(dim, stage, SPEC, RUN_TS, MATCH), "l_partkey", "l_shipdate", SPEC)


# A customer's dimension and its staged states: the order priority, extracted on each order date.
CUSTOMER = scd2.Scd2Spec(
    key="Customer_Id", attrs=("Priority",), default_start=dt.datetime(1991, 1, 1), surrogate="Customer_SurrogateKey"
)
EXTRACTS = f"""
WITH staged AS (
  SELECT o_custkey AS Customer_Id, CAST(o_orderdate AS TIMESTAMP) AS since, max(o_orderpriority) AS Priority FROM orders GROUP BY ALL),
known AS (
  SELECT c_custkey AS Customer_Id, TIMESTAMP '1992-01-01 00:00:00' AS since, '3-MEDIUM' AS Priority FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
states AS (SELECT *, 1 AS kind FROM known UNION ALL SELECT *, 2 FROM staged),
turns AS (
  SELECT *, lag(Priority) OVER w IS NULL AS first FROM states
  WINDOW w AS (PARTITION BY Customer_Id ORDER BY since, kind) QUALIFY lag(Priority) OVER w IS DISTINCT FROM Priority),
versions AS (
  SELECT Customer_Id, Priority, lead(since) OVER (PARTITION BY Customer_Id ORDER BY since, kind) AS Valid_End_Date,
         CASE WHEN first AND kind = 2 THEN TIMESTAMP '1991-01-01 00:00:00' ELSE since END AS Valid_Start_Date FROM turns)
SELECT sha256(CAST(Customer_Id AS VARCHAR) || '|' || strftime(Valid_Start_Date, '%Y-%m-%d %H:%M:%S.%f')) AS Customer_SurrogateKey,
       Customer_Id, Priority, Valid_Start_Date, Valid_End_Date
FROM versions
"""


@query("scd2_load_extracts", EXTRACTS)
def scd2_load_extracts(spark, root):
    """All staged states of all customers in one load: the same versions as one load per extract date."""
    m = Mart(spark, root)
    known = m.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    known = known.select(F.col("c_custkey").alias("Customer_Id"), F.lit("3-MEDIUM").alias("Priority"))
    dim = scd2.initial_dimension(known, CUSTOMER, dt.datetime(1992, 1, 1))
    at = F.col("o_orderdate").cast("timestamp_ntz").alias("at")
    staged = m.orders.groupBy(F.col("o_custkey").alias("Customer_Id"), at).agg(F.max("o_orderpriority").alias("Priority"))
    return history.load_extracts(dim, staged, CUSTOMER, "at")
