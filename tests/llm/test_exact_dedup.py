import hashlib
from collections import defaultdict

import pytest

from salesmart.llm.exact_dedup import exact_dedup, exact_groups, radices

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(_LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        seen = False
        for i in ids:
            stays = i == keep and not seen
            seen = seen or i == keep
            out.append((i, hashlib.sha256(text.encode()).hexdigest(), keep, len(ids), stays))
    return sorted(out, key=str)


def found(df):
    rows = exact_groups(df).collect()
    return sorted(((r["id"], r["digest"].hex(), r["keep_id"], r["group_size"], r["kept"]) for r in rows), key=str)


@pytest.mark.parametrize("width", ["3", "8", "70"])
def test_whole_tables_at_any_width(spark, docs, edge, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        for df in (edge, docs) if width != "70" else (edge,):
            assert found(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_third_of_the_rows_in_one_group(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i % 700}") for i in range(3000)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)) == brute(rows)


def test_kept_rows_keep_their_columns(edge):
    out = exact_dedup(edge)
    assert out.schema == edge.schema
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(kept) == len({(t or "").translate(_LOWER) for _, t in [(r["doc_id"], r["text"]) for r in edge.collect()]})
    assert (6, "One two.") in kept and (12, None) in kept


def test_smallest_can_stay(spark):
    df = spark.createDataFrame([(2, "a"), (1, "A"), (3, "b")], "doc_id bigint, text string")
    assert {r["doc_id"] for r in exact_dedup(df, keep="smallest").collect()} == {1, 3}


def test_empty_table(empty):
    assert found(empty) == [] and exact_dedup(empty).count() == 0


def test_radices_cover_the_width():
    for width in (1, 2, 3, 8, 9, 64, 65, 5000):
        bits = radices(width)
        assert 1 << sum(bits) >= width and max(bits) <= 3
