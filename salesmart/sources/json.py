"""Landed JSON API pages to flat rows.

Each landed page is one JSON text per row (one file line per page).  Pages are
parsed with an explicit schema (``from_json``; no inference pass), their
``items`` exploded, and nested fields read with a default where any level of
them is absent.  Counters arrive as text: a missing counter becomes 0, a
malformed one NULL (and is counted by ``rejected_counters``) instead of stopping
the load.  A page that is no JSON document keeps its text in ``_corrupt_record``
and is counted by ``rejected_pages``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.text import date_of_iso, iso_duration_seconds, load_stamp, url_from_template
from salesmart.functions.measures import engagement_rate

_S = T.StringType()

VIDEO_ITEM = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("title", _S),
                    T.StructField("publishedAt", _S),
                    T.StructField("channelTitle", _S),
                    T.StructField(
                        "thumbnails",
                        T.StructType([T.StructField("high", T.StructType([T.StructField("url", _S)]))]),
                    ),
                    T.StructField("resourceId", T.StructType([T.StructField("videoId", _S)])),
                ]
            ),
        ),
        T.StructField(
            "statistics",
            T.StructType(
                [T.StructField("viewCount", _S), T.StructField("likeCount", _S), T.StructField("commentCount", _S)]
            ),
        ),
        T.StructField("contentDetails", T.StructType([T.StructField("duration", _S)])),
        T.StructField("status", T.StructType([T.StructField("privacyStatus", _S)])),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("nextPageToken", _S),
        T.StructField("items", T.ArrayType(VIDEO_ITEM)),
        T.StructField("_corrupt_record", _S),
    ]
)

def parse_pages(text: DataFrame, column: str = "value") -> DataFrame:
    """Page texts as a ``page`` column."""
    return text.select(F.from_json(column, PAGE, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("page"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page files (one JSON document per line) as a ``page`` column."""
    return parse_pages(spark.read.text(path))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """``(n_pages, n_rejected)``: all pages and those that could not be parsed."""
    bad = F.col("page._corrupt_record").isNotNull()
    return pages.agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(bad).alias("n_rejected"))


def page_items(pages: DataFrame) -> DataFrame:
    """All items of all pages, one row each; pages without items, and those that are no JSON document, add no row."""
    readable = pages.where(F.col("page._corrupt_record").isNull())
    return readable.select(F.explode(F.col("page.items")).alias("v"))


def counter(c: Column) -> Column:
    """Text counter to long: missing -> 0, malformed -> NULL."""
    return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(c.try_cast("long"))


def json_counter(text: str | Column, field: str) -> Column:
    """A counter of a flat JSON text: 0 where the text or the field is missing, NULL where either is malformed."""
    schema = f"`{field}` string, _corrupt_record string"
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return F.when(parsed["_corrupt_record"].isNull(), counter(parsed[field]))


def flatten_videos(items: DataFrame, run_ts: dt.datetime, url_template: str) -> DataFrame:
    """Flat video rows with the loader's defaults, plus the derived columns."""
    v = F.col("v")
    flat = items.select(
        v["id"].alias("video_id"),
        v["snippet"]["title"].alias("title"),
        v["snippet"]["publishedAt"].alias("published_at"),
        v["snippet"]["channelTitle"].alias("channel_title"),
        counter(v["statistics"]["viewCount"]).alias("view_count"),
        counter(v["statistics"]["likeCount"]).alias("like_count"),
        counter(v["statistics"]["commentCount"]).alias("comment_count"),
        v["contentDetails"]["duration"].alias("duration"),
        v["status"]["privacyStatus"].alias("privacy_status"),
        F.coalesce(v["snippet"]["thumbnails"]["high"]["url"], F.lit("")).alias("thumbnail_url"),
        url_from_template(url_template, v["id"]).alias("video_url"),
        load_stamp(run_ts).alias("extracted_at"),
    )
    return with_video_metrics(flat)


def with_video_metrics(df: DataFrame) -> DataFrame:
    """``published_date``, ``duration_seconds`` and ``engagement_rate``."""
    return df.withColumns(
        {
            "published_date": date_of_iso("published_at"),
            "duration_seconds": iso_duration_seconds("duration"),
            "engagement_rate": engagement_rate("view_count", "like_count", "comment_count"),
        }
    )


def _bad_counters(v: Column) -> Column:
    """Counters of an item whose text is present but not a number."""
    bad = F.lit(0)
    for name in ("viewCount", "likeCount", "commentCount"):
        c = v["statistics"][name]
        bad = bad + F.when(c.isNotNull() & c.try_cast("long").isNull(), 1).otherwise(0)
    return bad


def rejected_counters(flat_source: DataFrame) -> DataFrame:
    """Number of counters whose text is present but not a number."""
    return flat_source.agg(F.sum(_bad_counters(F.col("v"))).alias("rejected_counters"))


def load_rejects(pages: DataFrame) -> DataFrame:
    """``(n_pages, n_rejected, rejected_counters)`` of a load, in one pass: pages, those that are no JSON document, and
    counters of the others that are no numbers."""
    broken = F.col("page._corrupt_record").isNotNull()
    items = F.coalesce("page.items", F.array().cast(PAGE["items"].dataType))
    counters = F.when(broken, 0).otherwise(F.aggregate(items, F.lit(0), lambda n, v: n + _bad_counters(v))).cast("bigint")
    return pages.agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(broken).alias("n_rejected"), F.coalesce(F.sum(counters), F.lit(0).cast("bigint")).alias("rejected_counters")
    )


def first_upload_playlist(channel_pages: DataFrame) -> DataFrame:
    """The upload playlist of each channel answer: that of its first item, NULL where there is none.

    Keeps the columns beside ``value`` and adds ``uploads`` and ``rejected``, true
    for an answer that is no JSON document.
    """
    schema = "items array<struct<contentDetails: struct<relatedPlaylists: struct<uploads: string>>>>, _corrupt_record string"
    parsed = channel_pages.withColumn("p", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    rejected = F.col("p._corrupt_record").isNotNull()
    uploads = F.get(F.col("p.items"), 0)["contentDetails"]["relatedPlaylists"]["uploads"]
    beside = [c for c in channel_pages.columns if c != "value"]
    return parsed.select(*beside, F.when(~rejected, uploads).alias("uploads"), rejected.alias("rejected"))


def chained_pages(list_pages: DataFrame) -> DataFrame:
    """Landed list pages (page, playlist, token, value) at their places in the chains of their lists.

    The next page is the one whose token ``value`` names (``nextPageToken``); a
    page that is no JSON document names none and is told by ``rejected``.  See
    ``operators.chains.page_chains`` for the columns added.
    """
    from salesmart.operators.chains import page_chains

    page = F.from_json("value", PAGE, {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = list_pages.withColumn("__page", page)
    rejected = F.col("__page._corrupt_record").isNotNull()
    tokens = parsed.select("page", "playlist", "token", F.when(~rejected, F.col("__page.nextPageToken")).alias("next_token"), rejected.alias("rejected"))
    return page_chains(tokens, "page", "playlist", "token", "next_token")


def playlist_video_ids(pages: DataFrame) -> DataFrame:
    """Video ids of playlist pages (``items[].snippet.resourceId.videoId``)."""
    return page_items(pages).select(F.col("v.snippet.resourceId.videoId").alias("video_id"))
