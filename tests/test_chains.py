import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators.chains import chain_ranks, page_chains

PAGES = "page bigint, playlist string, token string, next string"


def brute(rows) -> dict:
    """page -> (chain, position, status) by walking from page to page."""
    nodes: dict = {}
    for page, of, token, nxt in sorted(rows):
        nodes[of, token or ""] = (page, nxt or None)
    prev, named_by = {}, {}
    for (of, _), (page, nxt) in nodes.items():
        if nxt is not None and (of, nxt) in nodes:
            named_by.setdefault((of, nxt), []).append(page)
    node_of = {page: (k, nxt) for k, (page, nxt) in nodes.items()}
    follows = {}
    for k, pages in named_by.items():
        prev[nodes[k][0]] = min(pages)
        follows[min(pages)] = nodes[k][0]
    out, placed = {}, set()

    def walk(first, ring):
        chain, at = [], first
        while at is not None and at not in placed:
            chain.append(at)
            placed.add(at)
            at = follows.get(at)
        (of, token), _ = node_of[first]
        nxt = node_of[chain[-1]][1]
        if ring:
            status = "loop"
        elif nxt is not None and (of, nxt) in nodes:
            status = "loop" if nodes[of, nxt][0] in chain else "joined"
        elif nxt is not None:
            status = "break"
        else:
            status = "complete" if token == "" else "no_start"
        # A chain that begins in the middle tells so unless something worse ends it.
        for n, page in enumerate(chain, 1):
            out[page] = (first, n, status)

    for page in node_of:
        if page not in prev:
            walk(page, False)
    for page in sorted(node_of):
        if page not in placed:
            walk(page, True)
    return {r[0]: out.get(r[0], (None, None, "replaced")) for r in rows}


def check(spark, rows, parts=4):
    df = page_chains(spark.createDataFrame(rows, PAGES).repartition(parts), "page", "playlist", "token", "next")
    got = {r.page: (r.chain, r.position, r.status) for r in df.collect()}
    assert df.count() == len(rows)
    assert got == brute(rows)
    return got


def test_each_kind_of_chain(spark):
    rows = [
        (1, "a", None, "t2"), (2, "a", "t2", "t3"), (3, "a", "t3", None),  # complete
        (4, "b", "", "gone"),  # break
        (5, "c", "t5", "t6"), (6, "c", "t6", None),  # no start
        (7, "d", None, "t8"), (8, "d", "t8", "t9"), (9, "d", "t9", "t8"),  # leads back into itself
        (10, "e", "t10", "t11"), (11, "e", "t11", "t10"),  # a ring
        (12, "f", "t12", "t12"),  # a ring of one
        (13, "g", None, "t15"), (14, "g", "t14", "t15"), (15, "g", "t15", ""),  # two pages name one
        (16, "a", "t2", "other"),  # fetched again: replaces page 2
        (17, None, None, None),
    ]
    got = check(spark, rows)
    assert got[2] == (None, None, "replaced")
    assert got[9] == (7, 3, "loop") and got[11] == (10, 2, "loop") and got[12] == (12, 1, "loop")
    assert got[14][2] == "joined" and got[17] == (17, 1, "complete")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_links(spark, seed):
    rng = random.Random(seed)
    rows = []
    for page in range(150):
        token = rng.choice(["", None, *[f"t{k}" for k in range(30)]])
        rows.append((page, rng.choice("abc"), token, rng.choice(["", None, *[f"t{k}" for k in range(34)]])))
    check(spark, rows)


def test_empty(spark):
    assert page_chains(spark.createDataFrame([], PAGES), "page", "playlist", "token", "next").collect() == []


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "a", None, None)], PAGES).withColumns({"id": F.lit("x"), "prev": F.lit(2), "value": F.lit("{}")})
    row = page_chains(df, "page", "playlist", "token", "next").first().asDict()
    assert row["id"] == "x" and row["prev"] == 2 and row["is_complete"] is True


def test_a_long_chain_takes_few_rounds(spark):
    n = 1_000_000
    links = spark.range(n).select((F.col("id") * 7919 % n).alias("id"), F.when(F.col("id") > 0, (F.col("id") - 1) * 7919 % n).alias("prev"))
    ranks = chain_ranks(links)
    wrong = ranks.where((F.col("chain") != 0) | (F.col("id") != (F.col("position") - 1) * 7919 % n))
    assert ranks.count() == n and wrong.count() == 0


def test_two_large_rings(spark):
    n = 3000
    links = spark.range(n).select("id", F.pmod(F.col("id") - 2, F.lit(n)).alias("prev"))
    got = {r.id: (r.chain, r.position, r.looped) for r in chain_ranks(links).collect()}
    assert got == {k: (k % 2, k // 2 + 1, True) for k in range(n)}
