"""Landed CSV / JSON and the text helpers."""

import datetime as dt
import json
import os

import pytest

from salesmart.functions.text import clean_header, date_of_iso, iso_duration_seconds, url_from_template
from salesmart.sources.csv import combine_folder, read_landed_csv
from salesmart.sources.json import (
    first_upload_playlist,
    flatten_videos,
    page_items,
    playlist_video_ids,
    read_pages,
    rejected_counters,
)

ITEM_HEADER = "Item Id,Name,Brand Id,Category Id,Sub Category Id,Brand,Category,Sub Category"


def item_line(i):
    return f"{i},Item {i},{i % 12 + 1},{i % 5 + 1},{i % 14 + 1},Brand {i % 12 + 1},Category {i % 5 + 1},Sub Cat {i % 14 + 1}"


def write(path, text, bom=False):
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if bom else b"") + text.encode("utf-8"))


def test_csv_header_bom_crlf_tabs_and_values(spark, tmp_dir):
    p = os.path.join(tmp_dir, "geo.csv")
    write(p, '"City Id",City,"State\t\t"\r\n1,New York,New York\r\n6,Philadelphia[e],Pennsylvania\r\n'
             "45,Virginia Beach[m],Virginia\r\n90,Winstonâ€“Salem,North Carolina\r\n", bom=True)
    df = read_landed_csv(spark, p)
    assert df.columns == ["City_Id", "City", "State"]
    assert dict(df.dtypes)["City_Id"] == "int"
    got = {r.City_Id: r.City for r in df.collect()}
    assert got == {1: "New York", 6: "Philadelphia", 45: "Virginia Beach", 90: "Winston–Salem"}


def test_item_header_matches_dimension_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "item.csv")
    write(p, ITEM_HEADER + "\r\n" + "\r\n".join(item_line(i) for i in range(1, 56)) + "\r\n", bom=True)
    df = read_landed_csv(spark, p)
    assert df.columns == ["Item_Id", "Name", "Brand_Id", "Category_Id", "Sub_Category_Id", "Brand", "Category",
                          "Sub_Category"]
    assert df.count() == 55


def test_combine_folder(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "combine")
    os.makedirs(folder)
    ranges = {"1.csv": range(1, 4), "2.csv": range(4, 8), "3.csv": range(8, 15)}
    for name, ids in ranges.items():
        write(os.path.join(folder, name), ITEM_HEADER + "\r\n" + "\r\n".join(item_line(i) for i in ids) + "\r\n")
    df = combine_folder(spark, folder)
    assert df.count() == 14
    per_file = {r.source_file: r["count"] for r in df.groupBy("source_file").count().collect()}
    assert per_file == {"1.csv": 3, "2.csv": 4, "3.csv": 7}
    assert sorted(r.Item_Id for r in df.collect()) == list(range(1, 15))


def test_clean_header():
    assert clean_header("﻿Sub Category ") == "Sub_Category"
    assert clean_header("State\t\t") == "State"


@pytest.mark.parametrize(
    "text,seconds",
    [("PT0000000005S", 5), ("PT99999999999S", None), ("PT1H2M3S", 3723), ("PT45S", 45), ("PT15M", 900), ("P1DT2H", 7200), (None, 0), ("", 0), ("PT0S", 0)],
)
def test_iso_duration(spark, text, seconds):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(iso_duration_seconds("d").alias("s")).first().s == seconds


def test_date_of_iso_and_url(spark):
    df = spark.createDataFrame([("2024-03-05T23:30:00Z", "abc"), ("bad", "x")], "p string, id string")
    out = df.select(date_of_iso("p").alias("d"), url_from_template("https://v.example/watch?v={id}", "id").alias("u"))
    rows = out.collect()
    assert rows[0].d == dt.date(2024, 3, 5) and rows[1].d is None
    assert rows[0].u == "https://v.example/watch?v=abc"


def _video(i, stats=True, thumb=True, views="10"):
    v = {"id": f"v{i}", "snippet": {"title": f"t{i}", "publishedAt": "2024-01-02T03:04:05Z", "channelTitle": "c"},
         "contentDetails": {"duration": "PT1H2M3S"}, "status": {"privacyStatus": "public"}}
    if thumb:
        v["snippet"]["thumbnails"] = {"high": {"url": f"https://img/{i}.jpg"}}
    if stats:
        v["statistics"] = {"viewCount": views, "likeCount": "2", "commentCount": "3"}
    return v


def test_json_pages_flatten(spark, tmp_dir):
    pages = [
        {"items": [_video(1), _video(2, stats=False)], "nextPageToken": "p2"},
        {"items": [_video(3, thumb=False), _video(4, views="0"), _video(5, views="x1")]},
        {"nextPageToken": None},  # a page without items adds no row
    ]
    p = os.path.join(tmp_dir, "pages.jsonl")
    write(p, "\n".join(json.dumps(x) for x in pages) + "\n")
    raw = read_pages(spark, p)
    items = page_items(raw)
    flat = {r.video_id: r for r in flatten_videos(items, dt.datetime(2024, 5, 1, 12), "https://v.example/watch?v={id}").collect()}
    assert set(flat) == {"v1", "v2", "v3", "v4", "v5"}
    assert flat["v1"].view_count == 10 and flat["v1"].engagement_rate == pytest.approx(50.0)
    assert flat["v2"].view_count == 0 and flat["v2"].engagement_rate == 0.0  # no statistics: 0
    assert flat["v3"].thumbnail_url == ""
    assert flat["v4"].engagement_rate == 0.0
    assert flat["v5"].view_count is None  # malformed counter: NULL and counted
    assert rejected_counters(items).first().rejected_counters == 1
    assert flat["v1"].duration_seconds == 3723 and flat["v1"].published_date == dt.date(2024, 1, 2)
    assert flat["v1"].extracted_at == "2024-05-01T12:00:00"


def test_playlist_pages(spark, tmp_dir):
    p = os.path.join(tmp_dir, "channel.jsonl")
    write(p, json.dumps({"items": [{"contentDetails": {"relatedPlaylists": {"uploads": "UU1"}}}]}) + "\n")
    assert first_upload_playlist(spark.read.text(p)).first().uploads == "UU1"
    q = os.path.join(tmp_dir, "playlist.jsonl")
    write(q, json.dumps({"items": [{"snippet": {"resourceId": {"videoId": "a"}}},
                                   {"snippet": {"resourceId": {"videoId": "b"}}}], "nextPageToken": "n"}) + "\n"
             + json.dumps({"items": [{"snippet": {"resourceId": {"videoId": "c"}}}]}) + "\n")
    assert sorted(r.video_id for r in playlist_video_ids(read_pages(spark, q)).collect()) == ["a", "b", "c"]


def test_footnotes_go_only_at_the_end(spark):
    from salesmart.functions.text import clean_value

    df = spark.createDataFrame([("x[i] = a[j] + 1",), ("Town[e]",), ("Town[e][ab] ",), ("[a] b",)], "v string")
    assert [r[0] for r in df.select(clean_value("v")).collect()] == ["x[i] = a[j] + 1", "Town", "Town", "[a] b"]


def test_csv_part_with_another_column_order_is_refused(spark, tmp_dir):
    write(os.path.join(tmp_dir, "1.csv"), "Item Id,Brand,Name\n1,b1,n1\n")
    write(os.path.join(tmp_dir, "2.csv"), "Item Id,Name,Brand\n2,n2,b2\n")
    with pytest.raises(Exception, match="(?i)header"):
        combine_folder(spark, tmp_dir).collect()


def test_csv_bad_ids_are_counted(spark, tmp_dir):
    from salesmart.sources.csv import rejected_ids

    write(os.path.join(tmp_dir, "1.csv"), "Item Id,Name,Brand Id\n1,n,2\nx7,n,\n,n,y\n")
    got = {r.column_name: r.n_rejected for r in rejected_ids(spark, tmp_dir).collect()}
    assert got == {"Item_Id": 1, "Brand_Id": 1}
    assert sorted(str(r.Item_Id) for r in combine_folder(spark, tmp_dir).collect()) == ["1", "None", "None"]


def test_broken_pages_are_counted(spark, tmp_dir):
    from salesmart.sources.json import rejected_pages

    p = os.path.join(tmp_dir, "pages.jsonl")
    write(p, json.dumps({"items": [_video(1)]}) + "\n{broken\n[1, 2\n")
    raw = read_pages(spark, p)
    assert tuple(rejected_pages(raw).first()) == (3, 2)
    assert page_items(raw).count() == 1


def test_malformed_counters_are_null(spark):
    from salesmart.sources.json import json_counter

    df = spark.createDataFrame([('{"k": 7}',), ("{}",), (None,), ('{"k": 2.5}',), ('{"k": "x"}',), ("{broken",), ('{"k": null}',)], "t string")
    assert [r[0] for r in df.select(json_counter("t", "k")).collect()] == [7, 0, 0, None, None, None, 0]
