"""Time-binned trends, text and JSON extraction, key batches, engagement."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.measures import TOTAL, engagement_rate, money
from salesmart.functions.text import (
    clean_value,
    date_of_iso,
    iso_duration_seconds,
    load_stamp,
    read_as_cp1252,
    repair_decoding,
    url_from_template,
)
from salesmart.functions.timebins import newer_than, time_bin
from salesmart.operators.batches import key_batches
from salesmart.plans.catalog import query
from salesmart.plans.landing import land_channel_pages, land_item_parts, land_list_pages, land_video_pages
from salesmart.plans.mart import Mart
from salesmart.sources.json import (
    chained_pages,
    first_upload_playlist,
    flatten_videos,
    json_counter,
    load_rejects,
    page_items,
    read_pages,
)

NOW = dt.datetime(2024, 2, 1)
LOOKBACK_DAYS = 3600
RUN_TS = dt.datetime(2024, 2, 1, 6, 30)
URL_TEMPLATE = "https://video.example/watch?v={id}"


def _binned_sales(spark, root, days: int):
    ev = Mart(spark, root).events
    recent = ev.filter(newer_than("ts", NOW, LOOKBACK_DAYS))
    return (
        recent.groupBy(time_bin("ts", days).alias("bin_start"))
        .agg(F.sum(money("value")).cast(TOTAL).alias("DailySales"))
        .orderBy("bin_start")
    )


_BIN_SQL = """
SELECT {bin} AS bin_start, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS DailySales
FROM events WHERE ts > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 3600 DAY
GROUP BY 1 ORDER BY 1
"""


@query("daily_sales", _BIN_SQL.format(bin="date_trunc('day', ts)"))
def daily_sales(spark, root):
    """Sales per day of the recent events, in time order."""
    return _binned_sales(spark, root, 1)


@query("weekly_sales", _BIN_SQL.format(bin="time_bucket(INTERVAL 7 DAY, ts)"))
def weekly_sales(spark, root):
    """Seven-day bins aligned to 0001-01-01 (Mondays)."""
    return _binned_sales(spark, root, 7)


@query(
    "json_flatten",
    "SELECT event_id, user_id, event_type, COALESCE(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k FROM events",
)
def json_flatten(spark, root):
    """JSON text column to a typed field: 0 where it is missing, NULL where it is malformed."""
    ev = Mart(spark, root).events
    return ev.select("event_id", "user_id", "event_type", json_counter("props", "k").alias("k"))


@query(
    "json_rejects",
    """
SELECT event_type, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE props IS NOT NULL AND NOT json_valid(props)
                        OR json_extract_string(CASE WHEN json_valid(props) THEN props END, '$.k') IS NOT NULL
                           AND TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props END, '$.k') AS BIGINT) IS NULL) AS n_rejected
FROM events GROUP BY event_type
""",
)
def json_rejects(spark, root):
    """Rows whose counter is malformed, by event type (``json_flatten`` reads them as NULL)."""
    ev = Mart(spark, root).events
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(json_counter("props", "k").isNull()).alias("n_rejected")
    )


@query(
    "key_batches",
    """
WITH k AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey IS NOT NULL),
r AS (SELECT k, CAST(floor((row_number() OVER (ORDER BY k) - 1) / 50) AS BIGINT) AS batch FROM k)
SELECT batch, CAST(COUNT(*) AS INTEGER) AS n_keys,
       string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS keys
FROM r GROUP BY batch
""",
)
def key_batches_q(spark, root):
    """Order keys in comma-joined batches of 50 (one API call per batch)."""
    return key_batches(Mart(spark, root).orders, "o_orderkey", size=50)


@query(
    "engagement_rate",
    """
WITH u AS (
  SELECT user_id,
         COUNT(*) FILTER (WHERE event_type = 'view') AS view_count,
         COUNT(*) FILTER (WHERE event_type = 'click') AS like_count,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS comment_count
  FROM events GROUP BY user_id)
SELECT user_id, view_count, like_count, comment_count,
       CASE WHEN view_count > 0 THEN (like_count + comment_count) / view_count * 100 ELSE 0.0 END AS engagement_rate
FROM u
""",
)
def engagement_rate_q(spark, root):
    """Per user: (clicks + purchases) / views * 100, 0 without views."""
    ev = Mart(spark, root).events
    per_user = ev.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("view_count"),
        F.count_if(F.col("event_type") == "click").alias("like_count"),
        F.count_if(F.col("event_type") == "purchase").alias("comment_count"),
    )
    return per_user.withColumn("engagement_rate", engagement_rate("view_count", "like_count", "comment_count"))


# The video pages that were landed whole, and the durations of their items.
_LANDED_SQL = """
WITH e AS (SELECT *, (event_id * 7919) % 20000 AS secs FROM events WHERE (event_id // 50) % 23 <> 5),
d AS (
  SELECT *,
    CASE WHEN event_type = 'error' THEN NULL ELSE
      (CASE WHEN event_type = 'signup' THEN 'P1D' ELSE 'P' END) || 'T'
      || (CASE WHEN secs // 3600 > 0 THEN CAST(secs // 3600 AS VARCHAR) || 'H' ELSE '' END)
      || (CASE WHEN (secs % 3600) // 60 > 0 THEN CAST((secs % 3600) // 60 AS VARCHAR) || 'M' ELSE '' END)
      || (CASE WHEN secs % 60 > 0 THEN CAST(secs % 60 AS VARCHAR) || 'S' ELSE '' END)
      || (CASE WHEN secs = 0 THEN '0S' ELSE '' END)
    END AS duration,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE secs END AS INTEGER) AS duration_seconds
  FROM e)
"""


def _video_items(spark, root):
    return page_items(read_pages(spark, land_video_pages(spark, root)))


@query("duration_seconds", f"{_LANDED_SQL} SELECT 'v' || CAST(event_id AS VARCHAR) AS video_id, duration, duration_seconds FROM d")
def duration_seconds(spark, root):
    """ISO-8601 duration text of landed videos to seconds with built-ins (days ignored, NULL gives 0).

    The oracle computes the expected seconds arithmetically, not by parsing.
    """
    items = _video_items(spark, root).select(F.col("v.id").alias("video_id"), F.col("v.contentDetails.duration").alias("duration"))
    return items.withColumn("duration_seconds", iso_duration_seconds("duration"))


@query(
    "url_build",
    "SELECT page_id, 'https://video.example/watch?v=' || CAST(page_id AS VARCHAR) AS video_url FROM pages",
)
def url_build(spark, root):
    """String template ``...watch?v={id}``."""
    pages = Mart(spark, root).t("pages")
    return pages.select("page_id", url_from_template(URL_TEMPLATE, "page_id").alias("video_url"))


@query(
    "to_date_text",
    """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
       CAST(substr(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), 1, 10) AS DATE) AS published_date
FROM events
""",
)
def to_date_text(spark, root):
    """ISO timestamp text to its date (``to_date("published_at")``)."""
    ev = Mart(spark, root).events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at")
    )
    return ev.withColumn("published_date", date_of_iso("published_at"))


@query(
    "stamp_rows",
    f"SELECT event_id, event_type, '{RUN_TS.isoformat()}' AS extracted_at FROM events",
)
def stamp_rows(spark, root):
    """One load stamp per run on every row (the run time is an argument)."""
    return Mart(spark, root).events.select("event_id", "event_type", load_stamp(RUN_TS).alias("extracted_at"))


@query(
    "clean_text",
    r"""
WITH c AS (
  SELECT doc_id,
         trim(regexp_replace(regexp_replace(replace(text, 'â€“', '–'), '(\[[a-z]{1,2}\][ \t\r\n]*)+\z', ''),
                             '[ \t\r\n]+', ' ', 'g')) AS clean
  FROM documents)
SELECT doc_id, length(clean) AS n_chars_clean, md5(clean) AS clean_md5 FROM c
""",
)
def clean_text(spark, root):
    """Value clean-up over whole texts: dash repair, footnote tails, blank runs, trim."""
    docs = Mart(spark, root).t("documents").select("doc_id", clean_value("text").alias("clean"))
    return docs.select(
        "doc_id", F.length("clean").cast("bigint").alias("n_chars_clean"), F.md5("clean").alias("clean_md5")
    )


@query(
    "video_load",
    f"""{_LANDED_SQL},
v AS (
  SELECT 'v' || CAST(event_id AS VARCHAR) AS video_id, event_type AS title,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         'user' || CAST(user_id AS VARCHAR) AS channel_title,
         CASE WHEN event_type = 'signup' THEN 0 ELSE user_id * 3 + event_id % 5 END AS view_count,
         CASE WHEN event_type = 'signup' THEN 0 WHEN event_id % 97 = 11 THEN NULL ELSE event_id % 7 END AS like_count,
         CASE WHEN event_type = 'signup' THEN 0 ELSE event_id % 3 END AS comment_count,
         duration,
         CASE WHEN event_type = 'purchase' THEN 'unlisted' ELSE 'public' END AS privacy_status,
         CASE WHEN event_type = 'error' THEN '' ELSE 'https://img.example/' || CAST(event_id AS VARCHAR) || '.jpg' END
           AS thumbnail_url,
         'https://video.example/watch?v=v' || CAST(event_id AS VARCHAR) AS video_url,
         '{RUN_TS.isoformat()}' AS extracted_at, duration_seconds
  FROM d)
SELECT video_id, title, published_at, channel_title, view_count, like_count, comment_count, duration,
       privacy_status, thumbnail_url, video_url, extracted_at,
       CAST(substr(published_at, 1, 10) AS DATE) AS published_date, duration_seconds,
       CASE WHEN view_count > 0 THEN (like_count + comment_count) / view_count * 100 ELSE 0.0 END AS engagement_rate
FROM v
""",
)
def video_load(spark, root):
    """API loader: landed JSON pages -> items -> flat video rows with the
    loader's defaults (missing counters 0, missing thumbnail '') and the
    derived date, duration seconds and engagement rate."""
    return flatten_videos(_video_items(spark, root), RUN_TS, URL_TEMPLATE)


@query(
    "page_rejects",
    """
WITH p AS (SELECT event_id // 50 AS page FROM events GROUP BY 1)
SELECT COUNT(*) AS n_pages, COUNT(*) FILTER (WHERE page % 23 = 5) AS n_rejected,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM events
        WHERE (event_id // 50) % 23 <> 5 AND event_type <> 'signup' AND event_id % 97 = 11) AS rejected_counters
FROM p
""",
)
def page_rejects(spark, root):
    """What a load could not read: landed pages that are no JSON document, and counters that are no numbers."""
    return load_rejects(read_pages(spark, land_video_pages(spark, root)))


@query(
    "playlist_uploads",
    """
SELECT c_custkey AS channel,
       CASE WHEN c_nationkey <> 7 AND c_mktsegment NOT IN ('FURNITURE', 'MACHINERY') THEN 'UU' || CAST(c_custkey AS VARCHAR) END AS uploads,
       c_nationkey = 7 AS rejected
FROM customer
""",
)
def playlist_uploads(spark, root):
    """First upload playlist of every landed channel answer, with the answers that could not be read."""
    return first_upload_playlist(land_channel_pages(spark, root))


@query(
    "page_chains",
    """
WITH RECURSIVE o AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, o_custkey // 10 AS list,
         row_number() OVER l AS nth, lead(o_orderkey) OVER l AS after, nth_value(o_orderkey, 3) OVER w AS third
  FROM orders WINDOW l AS (PARTITION BY o_custkey // 10 ORDER BY o_orderkey),
       w AS (PARTITION BY o_custkey // 10 ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
h AS (
  SELECT o_orderkey * 2 AS page, CAST(list AS VARCHAR) AS playlist,
         CASE WHEN nth > 1 THEN 't' || CAST(o_orderkey AS VARCHAR) END AS token,
         't' || CAST(coalesce(after, CASE WHEN list % 7 = 0 THEN third END) AS VARCHAR) AS next_token, o_orderstatus
  FROM o WHERE nth = 1 OR o_orderpriority <> '5-LOW' OR nth % 5 <> 0),
p AS (
  SELECT page, playlist, token, next_token FROM h
  UNION ALL SELECT page + 1, playlist, token, next_token FROM h WHERE o_orderstatus = 'P'),
n AS (
  SELECT playlist, coalesce(token, '') AS token, next_token, page FROM p
  QUALIFY row_number() OVER (PARTITION BY playlist, coalesce(token, '') ORDER BY page DESC) = 1),
c AS (SELECT playlist, next_token AS token, min(page) AS prev FROM n WHERE next_token IS NOT NULL GROUP BY ALL),
k AS (SELECT n.*, c.prev FROM n LEFT JOIN c USING (playlist, token)),
w AS (
  SELECT page AS chain, page, 1 AS position FROM k WHERE prev IS NULL
  UNION ALL SELECT w.chain, k.page, w.position + 1 FROM w JOIN k ON k.prev = w.page),
r AS (
  SELECT page AS chain, page, 1 AS position FROM k WHERE page NOT IN (SELECT page FROM w)
  UNION ALL SELECT r.chain, k.page, r.position + 1 FROM r JOIN k ON k.prev = r.page WHERE k.page <> r.chain),
a AS (
  SELECT chain, page, position, false AS ring FROM w
  UNION ALL SELECT chain, page, position, true FROM r QUALIFY chain = min(chain) OVER (PARTITION BY page)),
f AS (SELECT a.*, k.playlist, k.token, k.next_token FROM a JOIN k USING (page)),
e AS (
  SELECT DISTINCT ON (l.chain) l.chain, l.ring, l.next_token, t.page AS next_page, t.chain AS next_chain, s.token AS first_token
  FROM f l LEFT JOIN f t ON t.playlist = l.playlist AND t.token = l.next_token JOIN f s ON s.page = l.chain
  ORDER BY l.chain, l.position DESC),
s AS (
  SELECT chain, CASE WHEN ring OR next_chain = chain THEN 'loop' WHEN next_page IS NOT NULL THEN 'joined'
                     WHEN next_token IS NOT NULL THEN 'break' WHEN first_token <> '' THEN 'no_start' ELSE 'complete' END AS status
  FROM e)
SELECT p.page, p.playlist, p.token, p.next_token, false AS rejected, a.chain, CAST(a.position AS BIGINT) AS position,
       coalesce(s.status, 'replaced') AS status, coalesce(s.status, 'replaced') = 'complete' AS is_complete
FROM p LEFT JOIN a USING (page) LEFT JOIN s USING (chain)
""",
)
def page_chains_q(spark, root):
    """Landed list pages in the order of their next-page tokens, with what is missing of each list."""
    return chained_pages(land_list_pages(spark, root))


@query(
    "csv_combine",
    "SELECT p_partkey AS Item_Id, p_name AS Name, p_brand AS Brand, p_type AS Category, "
    "CAST(p_size AS VARCHAR) AS Size FROM part",
)
def csv_combine(spark, root):
    """Landed CSV folder -> one frame: ``part`` is landed as CSV parts with a
    header of blank-separated names in a folder of its own, then read back with
    header normalisation, id casts and value cleaning."""
    from salesmart.session import own_path
    from salesmart.sources.csv import combine_folder, land_csv

    folder = own_path(spark, "landed_csv")
    items = Mart(spark, root).part.select(
        F.col("p_partkey").alias("Item Id"),
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("Brand"),
        F.col("p_type").alias("Category"),
        F.col("p_size").alias("Size"),
    )
    land_csv(items, folder)
    return combine_folder(spark, folder, id_type="bigint").drop("source_file")


@query(
    "csv_layouts",
    """
SELECT CAST(p_partkey AS INTEGER) AS Item_Id, CASE WHEN p_size <= 40 THEN p_name END AS Name,
       CASE WHEN p_size > 20 THEN p_brand END AS Brand, CASE WHEN p_size > 40 THEN CAST(p_size AS INTEGER) END AS Size,
       CASE WHEN p_size <= 20 THEN CAST(p_retailprice AS DECIMAL(38,10)) END AS Unit_Price
FROM part
""",
)
def csv_layouts(spark, root):
    """A landed CSV folder whose parts differ in columns and their order, as one typed frame."""
    from salesmart.sources.csv_layouts import combine_layouts

    return combine_layouts(spark, land_item_parts(spark, root)).drop("source_file")


@query(
    "csv_type_choice",
    """
WITH t AS (
  SELECT p_partkey, CASE WHEN p_size <= 40 THEN p_name END AS name, CASE WHEN p_size > 20 THEN p_brand END AS brand,
         CASE WHEN p_size > 40 THEN p_size END AS size, CASE WHEN p_size <= 20 THEN p_retailprice END AS price FROM part)
SELECT 'Item_Id' AS column_name, count(p_partkey) AS n_values, 'int' AS data_type FROM t
UNION ALL SELECT 'Name', count(name), 'string' FROM t
UNION ALL SELECT 'Brand', count(brand), 'string' FROM t
UNION ALL SELECT 'Size', count(size), 'int' FROM t
UNION ALL SELECT 'Unit_Price', count(price), 'decimal(38,10)' FROM t
""",
)
def csv_type_choice(spark, root):
    """What type each column of the landed parts takes, and of how many values."""
    from salesmart.sources.csv_layouts import combine_as_text, explain_types

    return explain_types(combine_as_text(spark, land_item_parts(spark, root))).select("column_name", "n_values", "data_type")


@query(
    "repair_text",
    """
SELECT doc_id, md5(text) AS repaired_md5, coalesce(source IN ('src1', 'src2', 'src5') AND regexp_matches(text, '[^\\x00-\\x7F]'), false) AS was_broken
FROM documents
""",
)
def repair_text(spark, root):
    """Whole texts of some sources read with the wrong code page, repaired; the texts of the others stay as they are."""
    docs = Mart(spark, root).t("documents")
    broken = F.when(F.col("source").isin("src1", "src2", "src5"), read_as_cp1252("text")).otherwise(F.col("text")).alias("landed")
    docs = docs.select("doc_id", broken).withColumn("repaired", repair_decoding("landed"))
    return docs.select("doc_id", F.md5("repaired").alias("repaired_md5"), (~F.col("repaired").eqNullSafe(F.col("landed"))).alias("was_broken"))
