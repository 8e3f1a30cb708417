"""Stand-in landings: API pages as a loader would have stored them, made from the given tables.

No given table holds API pages, so these functions write some, in the schema the
jobs read; they parse nothing and order nothing.  As in a real landing, some
downloads broke off (half a JSON text), some counters are no numbers, some
pages were never landed and some were fetched twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.plans.mart import Mart
from salesmart.session import own_path


def _duration_text():
    secs = F.pmod(F.col("event_id") * 7919, F.lit(20000))
    h, m, s = F.floor(secs / 3600), F.floor(F.pmod(secs, F.lit(3600)) / 60), F.pmod(secs, F.lit(60))

    def part(v, unit):
        return F.when(v > 0, F.concat(v.cast("string"), F.lit(unit))).otherwise(F.lit(""))

    body = F.concat(
        F.when(F.col("event_type") == "signup", F.lit("P1D")).otherwise(F.lit("P")),
        F.lit("T"),
        part(h, "H"),
        part(m, "M"),
        part(s, "S"),
        F.when(secs == 0, F.lit("0S")).otherwise(F.lit("")),
    )
    return F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(body)


def _broken_off(text: str, when: Column) -> Column:
    return F.when(when, F.expr(f"substr({text}, 1, length({text}) div 2)")).otherwise(F.col(text))


def land_video_pages(spark: SparkSession, root: str) -> str:
    """Path of landed video pages, a JSON text per line: a page per 50 consecutive event ids, each item a nested
    video document; fields that are NULL are left out of the JSON, as an API omits them (no thumbnail for errors,
    no statistics for signups)."""
    ev = Mart(spark, root).events
    not_error, not_signup = F.col("event_type") != "error", F.col("event_type") != "signup"
    thumbnail = F.concat(F.lit("https://img.example/"), F.col("event_id").cast("string"), F.lit(".jpg"))
    likes = F.when(F.col("event_id") % 97 == 11, F.lit("n/a")).otherwise(F.pmod(F.col("event_id"), F.lit(7)).cast("string"))
    item = F.struct(
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("id"),
        F.struct(
            F.col("event_type").alias("title"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("channelTitle"),
            F.when(not_error, F.struct(F.struct(thumbnail.alias("url")).alias("high"))).alias("thumbnails"),
        ).alias("snippet"),
        F.when(
            not_signup,
            F.struct(
                (F.col("user_id") * 3 + F.pmod(F.col("event_id"), F.lit(5))).cast("string").alias("viewCount"),
                likes.alias("likeCount"),
                F.pmod(F.col("event_id"), F.lit(3)).cast("string").alias("commentCount"),
            ),
        ).alias("statistics"),
        F.struct(_duration_text().alias("duration")).alias("contentDetails"),
        F.struct(
            F.when(F.col("event_type") == "purchase", F.lit("unlisted")).otherwise(F.lit("public")).alias("privacyStatus")
        ).alias("status"),
    )
    pages = ev.groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(F.collect_list(item).alias("items"))
    pages = pages.select("page", F.to_json(F.struct(F.col("page").cast("string").alias("nextPageToken"), "items")).alias("text"))
    path = own_path(spark, "video_pages")
    pages.select(_broken_off("text", F.col("page") % 23 == 5).alias("value")).write.text(path)
    return path


def land_channel_pages(spark: SparkSession, root: str) -> DataFrame:
    """Landed channel answers (channel, value): a JSON text per customer; some channels have no items, some answers broke off."""
    c = Mart(spark, root).customer
    uploads = F.concat(F.lit("UU"), F.col("c_custkey").cast("string"))
    item = F.struct(F.struct(F.struct(F.when(F.col("c_mktsegment") != "MACHINERY", uploads).alias("uploads")).alias("relatedPlaylists")).alias("contentDetails"))
    text = (
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit('{"items": []}'))
        .when(F.col("c_mktsegment") == "BUILDING", F.to_json(F.struct(F.array(item, item).alias("items"))))
        .otherwise(F.to_json(F.struct(F.array(item).alias("items"))))
    )
    rows = c.select(F.col("c_custkey").alias("channel"), "c_nationkey", text.alias("text"))
    path = own_path(spark, "channel_pages")
    rows.select("channel", _broken_off("text", F.col("c_nationkey") == 7).alias("value")).write.parquet(path)
    return spark.read.schema("channel bigint, value string").parquet(path)


def land_list_pages(spark: SparkSession, root: str) -> DataFrame:
    """Landed list pages (page, playlist, token, value): a list per ten customers, a page per order."""
    o = Mart(spark, root).orders
    in_list = Window.partitionBy("playlist").orderBy("o_orderkey")
    o = o.withColumn("playlist", F.floor(F.col("o_custkey") / 10).cast("bigint"))
    o = o.withColumns({"nth": F.row_number().over(in_list), "after": F.lead("o_orderkey").over(in_list)})
    o = o.withColumn("third", F.max(F.when(F.col("nth") == 3, F.col("o_orderkey"))).over(Window.partitionBy("playlist")))
    following = F.coalesce("after", F.when(F.col("playlist") % 7 == 0, F.col("third")))
    landed = o.where((F.col("nth") == 1) | (F.col("o_orderpriority") != "5-LOW") | (F.col("nth") % 5 != 0))
    video = F.struct(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("id"))
    next_token = F.concat(F.lit("t"), following.cast("string")).alias("nextPageToken")
    rows = landed.select(
        (F.col("o_orderkey") * 2).alias("page"),
        F.col("playlist").cast("string").alias("playlist"),
        F.when(F.col("nth") > 1, F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))).alias("token"),
        F.to_json(F.struct(next_token, F.array(video).alias("items"))).alias("value"),
        "o_orderstatus",
    )
    again = rows.where("o_orderstatus = 'P'").withColumn("page", F.col("page") + 1)
    path = own_path(spark, "list_pages")
    rows.unionByName(again).drop("o_orderstatus").write.parquet(path)
    return spark.read.schema("page bigint, playlist string, token string, value string").parquet(path)


def land_item_parts(spark: SparkSession, root: str) -> str:
    """Path of a folder of CSV parts of the items, small, middle and large ones each with columns of their own."""
    part = Mart(spark, root).part
    item, name, brand = F.col("p_partkey").alias("Item Id"), F.col("p_name").alias("Name"), F.col("p_brand").alias("Brand")
    path = own_path(spark, "item_parts")
    for rows in (
        part.where("p_size <= 20").select(item, name, F.col("p_retailprice").alias("Unit Price")),
        part.where("p_size > 20 AND p_size <= 40").select(brand, name, item),
        part.where("p_size > 40").select(item, F.col("p_size").alias("Size\t"), brand),
    ):
        rows.write.mode("append").option("header", True).csv(path)
    return path
