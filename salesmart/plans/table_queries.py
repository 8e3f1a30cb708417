"""Versioned tables (change log), DML, schema evolution and table writes.

Demo history over ``orders`` (key ``o_orderkey``, unique):
v0 WRITE all rows; v1 UPDATE status 'P' -> 'F' and price * 0.85;
v2 DELETE priority '5-LOW'; v3 RESTORE to version 1.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from salesmart.operators import changelog
from salesmart.operators.append_once import append_once
from salesmart.operators.changelog import Versions, add_column, delete_rows, rename_column, update_rows
from salesmart.operators.schema_history import SchemaHistory, append_log, as_of as schema_as_of
from salesmart.operators.table_diff import table_diff
from salesmart.plans.catalog import query
from salesmart.plans.mart import Mart
from salesmart.session import own_path
from salesmart.sources.sinks import (
    append_by_name,
    append_path,
    copy_table,
    create_if_not_exists,
    create_table,
    overwrite_path,
    overwrite_table,
)

KEY = ["o_orderkey"]
T0, T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3, 4))
UPDATE_WHEN = "o_orderstatus = 'P'"
UPDATE_SET = {"o_orderstatus": "'F'", "o_totalprice": "o_totalprice * 0.85"}
DELETE_WHEN = "o_orderpriority = '5-LOW'"

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
V1_SQL = (
    "o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 0.85 ELSE o_totalprice END AS o_totalprice, "
    "o_orderdate, o_orderpriority"
)
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def orders_log(spark, root):
    """The demo log and its versions, as one lazy frame: rows of a write, an update, a delete and a restore."""
    orders = Mart(spark, root).orders
    versions = Versions((T0, T1, T2))
    updated = update_rows(orders, UPDATE_WHEN, UPDATE_SET)
    log = (
        changelog.initial_log(orders, T0)
        .unionByName(changelog.update_log(orders, UPDATE_WHEN, UPDATE_SET, 1, T1))
        .unionByName(changelog.delete_log(updated, DELETE_WHEN, 2, T2))
    )
    restored = changelog.restore_rows(log, KEY, versions, 1, T3)
    return log.unionByName(restored), versions.then(T3)


@query("as_of_version", f"SELECT {V1_SQL} FROM orders")
def as_of_version(spark, root):
    """The table as of a version number."""
    log, versions = orders_log(spark, root)
    return changelog.as_of(log, KEY, versions, version=1)


@query("as_of_timestamp", f"SELECT {V1_SQL} FROM orders WHERE o_orderpriority <> '5-LOW'")
def as_of_timestamp(spark, root):
    """The table as of a time between the delete (v2) and the restore (v3)."""
    log, versions = orders_log(spark, root)
    return changelog.as_of(log, KEY, versions, ts=dt.datetime(2024, 1, 3, 12, 0))


@query(
    "table_history",
    """
SELECT CAST(0 AS INTEGER) AS version, TIMESTAMP '2024-01-01 00:00:00' AS timestamp, 'WRITE' AS operation,
       (SELECT COUNT(*) FROM orders) AS num_inserted, CAST(0 AS BIGINT) AS num_updated, CAST(0 AS BIGINT) AS num_deleted
UNION ALL
SELECT 1, TIMESTAMP '2024-01-02 00:00:00', 'UPDATE', 0, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P'), 0
UNION ALL
SELECT 2, TIMESTAMP '2024-01-03 00:00:00', 'DELETE', 0, 0, (SELECT COUNT(*) FROM orders WHERE o_orderpriority = '5-LOW')
UNION ALL
SELECT 3, TIMESTAMP '2024-01-04 00:00:00', 'RESTORE', (SELECT COUNT(*) FROM orders WHERE o_orderpriority = '5-LOW'), 0, 0
""",
)
def table_history(spark, root):
    """Rows inserted / updated / deleted by each version of a log."""
    return changelog.change_counts(orders_log(spark, root)[0])


@query(
    "restore_version",
    f"""
SELECT {V1_SQL}, CAST(3 AS INTEGER) AS _version, TIMESTAMP '2024-01-04 00:00:00' AS _ts,
       'I' AS _op, 'RESTORE' AS _operation
FROM orders WHERE o_orderpriority = '5-LOW'
""",
)
def restore_version(spark, root):
    """Restoring version 1: the compensating rows of the new version."""
    return orders_log(spark, root)[0].where("_version = 3")


@query(
    "version_diff",
    f"""
SELECT {ORDER_COLS}, 'removed' AS change_type FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL
SELECT {V1_SQL}, 'changed' AS change_type FROM orders
WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'P'
""",
)
def version_diff(spark, root):
    """Rows that differ between version 0 and version 2."""
    log, versions = orders_log(spark, root)
    return changelog.diff(log, KEY, versions, 0, 2)


@query(
    "versioned_update",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_quantity = 2 THEN 4 ELSE l_quantity END AS l_quantity,
       CASE WHEN l_quantity = 2 THEN l_extendedprice / l_quantity * 4 ELSE l_extendedprice END AS l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
""",
)
def versioned_update(spark, root):
    """``update(condition="Qty = 2", set={"Qty": "4", ..})``; right sides see old values."""
    return update_rows(
        Mart(spark, root).lineitem,
        "l_quantity = 2",
        {"l_quantity": "4", "l_extendedprice": "l_extendedprice / l_quantity * 4"},
    )


@query("versioned_delete", "SELECT * FROM lineitem WHERE NOT COALESCE(l_quantity = 3, false)")
def versioned_delete(spark, root):
    """``delete("Qty = 3")``; a NULL condition keeps the row."""
    return delete_rows(Mart(spark, root).lineitem, "l_quantity = 3")


@query("add_column", "SELECT *, CAST(NULL AS VARCHAR) AS o_region FROM orders")
def add_column_q(spark, root):
    """A new column: old rows read NULL."""
    return add_column(Mart(spark, root).orders, "o_region", "string")


@query(
    "rename_column",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority AS o_priority_code FROM orders",
)
def rename_column_q(spark, root):
    """The same data under a new column name."""
    return rename_column(Mart(spark, root).orders, "o_orderpriority", "o_priority_code")


@query(
    "append_rows",
    """
SELECT * FROM lineitem WHERE l_shipdate < DATE '1999-01-01'
UNION ALL
SELECT * FROM lineitem WHERE l_shipdate >= DATE '1999-01-01'
""",
)
def append_rows(spark, root):
    """The loaded table plus a new batch."""
    li = Mart(spark, root).lineitem
    cut = F.lit(dt.date(1999, 1, 1))
    return append_by_name(li.filter(F.col("l_shipdate") < cut), li.filter(F.col("l_shipdate") >= cut))


@query(
    "append_missing_cols",
    """
SELECT o.*, r_name AS o_region FROM orders o
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE o_orderdate < DATE '1998-01-01'
UNION ALL
SELECT o.*, NULL AS o_region FROM orders o WHERE o_orderdate >= DATE '1998-01-01'
""",
)
def append_missing_cols(spark, root):
    """An append with fewer columns: the missing one becomes NULL."""
    m = Mart(spark, root)
    cut = F.lit(dt.date(1998, 1, 1))
    geo = m.nation.join(m.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("o_region")
    )
    cust = m.customer.select("c_custkey", "c_nationkey").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    old = (
        m.orders.filter(F.col("o_orderdate") < cut)
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .select(*m.orders.columns, "o_region")
    )
    return append_by_name(old, m.orders.filter(F.col("o_orderdate") >= cut))


@query("copy_table", "SELECT * FROM orders")
def copy_table_q(spark, root):
    """A copy of a table, written and read back."""
    return copy_table(spark, Mart(spark, root).orders, "orders_copy")


@query("create_table", "SELECT * FROM supplier")
def create_table_q(spark, root):
    """``saveAsTable`` of a new table, read back from the catalog."""
    name = f"created_{uuid.uuid4().hex}"
    create_table(Mart(spark, root).supplier, name, path=own_path(spark, "created"))
    return spark.table(name)


@query("overwrite_table", "SELECT * FROM supplier WHERE s_acctbal > 0")
def overwrite_table_q(spark, root):
    """``mode("overwrite").saveAsTable``: a second load replaces the first."""
    name, path = f"replaced_{uuid.uuid4().hex}", own_path(spark, "replaced")
    rows = Mart(spark, root).supplier
    overwrite_table(rows, name, path=path)
    overwrite_table(rows.where("s_acctbal > 0"), name, path=path)
    return spark.table(name)


@query(
    "overwrite_path",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 1000",
)
def overwrite_path_q(spark, root):
    """``mode("overwrite").save`` by partition: a rerun of one batch replaces that batch alone."""
    path = own_path(spark, "batches")
    rows = Mart(spark, root).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    overwrite_path(rows, path, partition_by=["o_orderstatus"])
    overwrite_path(rows.where("o_orderstatus = 'P' AND o_totalprice > 1000"), path, partition_by=["o_orderstatus"])
    return spark.read.schema(rows.schema).parquet(path)


@query("typed_create", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def typed_create_q(spark, root):
    """``CREATE TABLE IF NOT EXISTS`` with declared columns, then an append of matching rows."""
    rows = Mart(spark, root).supplier.select("s_suppkey", "s_name", "s_nationkey")
    name, path = f"typed_{uuid.uuid4().hex}", own_path(spark, "typed")
    create_if_not_exists(spark, name, rows.schema, path)
    append_path(rows, path)
    spark.catalog.refreshTable(name)
    return spark.table(name)


@query(
    "duplicate_keys",
    """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""",
)
def duplicate_keys_q(spark, root):
    """Primary-key audit: (order, line number) pairs held by more than one row."""
    from salesmart.operators.audit import duplicate_keys

    return duplicate_keys(Mart(spark, root).lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "table_diff",
    f"""
WITH b AS (
  SELECT {ORDER_COLS.replace("o_totalprice", "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice")}
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN a.o_custkey ELSE b.o_custkey END AS o_custkey,
       CASE WHEN b.o_orderkey IS NULL THEN a.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN b.o_orderkey IS NULL THEN a.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       CASE WHEN b.o_orderkey IS NULL THEN a.o_orderdate ELSE b.o_orderdate END AS o_orderdate,
       CASE WHEN b.o_orderkey IS NULL THEN a.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority,
       CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change_type
FROM (SELECT {ORDER_COLS} FROM orders) a FULL JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice IS DISTINCT FROM b.o_totalprice
""",
)
def table_diff_q(spark, root):
    """Difference of two plain tables: ``orders`` and a copy with rows changed, removed and added."""
    orders = Mart(spark, root).orders.select(*ORDER_COLS.split(", "))
    late = "o_orderstatus = 'P' AND o_orderpriority"
    after = delete_rows(update_rows(orders, f"{late} = '1-URGENT'", {"o_totalprice": "o_totalprice * 2"}), f"{late} = '5-LOW'")
    added = orders.where(f"{late} = '2-HIGH'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return table_diff(orders, after.unionByName(added), KEY)


# A table whose columns change: v0 WRITE; v1 ADD region; v2 UPDATE of it; v3 RENAME o_custkey TO customer;
# v4 DELETE priority '5-LOW'; v5 RENAME customer TO buyer; v6 RENAME region TO market.
SCHEMA_TIMES = tuple(dt.datetime(2024, 2, d) for d in range(1, 8))
_REGION = "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || '/' || o_orderstatus END"


def _evolving(spark, root):
    """The stored log, its schema history and its versions."""
    orders = Mart(spark, root).orders.select(*ORDER_COLS.split(", "))
    history = SchemaHistory.of(orders).add_column(1, "region", "string")
    history = history.rename_column(3, "o_custkey", "customer").rename_column(5, "customer", "buyer").rename_column(6, "region", "market")
    log = append_log(None, changelog.initial_log(orders, SCHEMA_TIMES[0]), history, 0)
    versions = Versions(SCHEMA_TIMES)
    region = {"region": "o_orderpriority || '/' || o_orderstatus"}
    now = schema_as_of(log, history, KEY, versions, 1)
    log = append_log(log, changelog.update_log(now, "o_orderstatus = 'P'", region, 2, SCHEMA_TIMES[2]), history, 2)
    now = schema_as_of(log, history, KEY, versions, 3)
    log = append_log(log, changelog.delete_log(now, DELETE_WHEN, 4, SCHEMA_TIMES[4]), history, 4)
    return log, history, versions


@query("schema_added_column", f"SELECT {ORDER_COLS}, CAST(NULL AS VARCHAR) AS region FROM orders")
def schema_added_column(spark, root):
    """As of the version that adds a column: all rows read NULL in it, though later versions fill it."""
    log, history, versions = _evolving(spark, root)
    return schema_as_of(log, history, KEY, versions, ts=dt.datetime(2024, 2, 2, 12))


@query("schema_before_changes", f"SELECT {ORDER_COLS} FROM orders")
def schema_before_changes(spark, root):
    """As of version 0: the old names, without the column added later."""
    log, history, versions = _evolving(spark, root)
    return schema_as_of(log, history, KEY, versions, 0)


@query("schema_renamed_column", f"SELECT {ORDER_COLS.replace('o_custkey', 'o_custkey AS customer')}, {_REGION} AS region FROM orders")
def schema_renamed_column(spark, root):
    """As of the first rename, after the update of the added column and before the delete."""
    log, history, versions = _evolving(spark, root)
    return schema_as_of(log, history, KEY, versions, 3)


@query("schema_latest", f"SELECT {ORDER_COLS.replace('o_custkey', 'o_custkey AS buyer')}, {_REGION} AS market FROM orders WHERE o_orderpriority <> '5-LOW'")
def schema_latest(spark, root):
    """The table now: a column renamed twice, another renamed after its update, rows deleted in between."""
    log, history, versions = _evolving(spark, root)
    return schema_as_of(log, history, KEY, versions)


@query(
    "append_once",
    f"""
SELECT {ORDER_COLS} FROM orders
UNION ALL
SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
""",
)
def append_once_q(spark, root):
    """A landed table after the same append ran twice: rows whose keys it holds already, and new ones, each once."""
    orders = Mart(spark, root).orders.select(*ORDER_COLS.split(", "))
    path = own_path(spark, "orders_appended")
    orders.write.parquet(path)
    pending = orders.where("o_orderstatus = 'P'")
    incoming = pending.unionByName(pending.withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    for _ in range(2):
        append_once(path, incoming, KEY)
    return spark.read.schema(orders.schema).parquet(path)
