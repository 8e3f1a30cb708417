import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from salesmart.llm.components import components
from salesmart.llm.simhash import fingerprint, near_dedup, simhash_components
from salesmart.llm.trie_join import connect, near_edges, reached

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    at = {p: i for i, p in enumerate(distinct)}
    roots = groups_of(len(distinct), [(i, j) for i in range(len(distinct)) for j in range(i) if (distinct[i] ^ distinct[j]).bit_count() <= 3])
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[roots[at[p]]].append(i)
    return sorted(((i, p, min(least[roots[at[p]]], default=None)) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def found(df):
    return sorted(((r["id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash_components(df).collect()), key=str)


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c", "a b c d", "x\x85y \x1c z\x0bq İ ſ", "w " * 5000])
def test_fingerprint(text):
    assert fingerprint((text or "").encode(), 3) == brute_print(text)


def test_whole_tables(docs, edge):
    for df in (docs, edge):
        assert found(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def near_values(rng, n, centres, most):
    out = set()
    base = [rng.getrandbits(64) for _ in range(centres)]
    while len(out) < n:
        v = rng.choice(base) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, most)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize(("n", "centres", "most", "budget"), [(2, 1, 2, 3), (400, 20, 5, 3), (1500, 2, 6, 3), (300, 5, 2, 0), (300, 5, 4, 1)])
def test_trie_connects_what_links_connect(n, centres, most, budget):
    values = near_values(random.Random(n), n, centres, most)
    want = groups_of(n, [(i, j) for i in range(n) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= budget])
    assert len(set(zip(want, groups_of(n, [(i, int(x)) for i, x in enumerate(connect(values, 0, 0, budget))]), strict=True))) == len(set(want))


def test_prefix_tasks_together_connect_the_same(spark):
    values = near_values(random.Random(3), 500, 8, 5)
    df = spark.createDataFrame([(int(v.view(np.int64)),) for v in values], "fp bigint").repartition(5)
    for bits in (1, 4, 7):
        at = {int(v.view(np.int64)): i for i, v in enumerate(values)}
        edges = [(at[r["u"]], at[r["v"]]) for r in near_edges(df, "fp", bits, 3).collect()]
        want = groups_of(500, [(i, j) for i in range(500) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 3])
        got = groups_of(500, edges)
        assert len(set(zip(want, got, strict=True))) == len(set(want)) == len(set(got))


def test_reached():
    assert sorted(reached(4, 1).tolist()) == [0, 1, 2, 4, 8]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 180)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (7, 8), (8, 7), (7, 8)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    names = sorted({x for a, b in links if a != b for x in (a, b)})
    at = {x: i for i, x in enumerate(names)}
    roots = groups_of(len(names), [(at[a], at[b]) for a, b in links if a != b])
    least = {r: min(x for x, y in zip(names, roots, strict=True) if y == r) for r in roots}
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {x: least[r] for x, r in zip(names, roots, strict=True)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_near_dedup_keeps_one_of_each(docs, edge):
    for df in (docs, edge):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        out = near_dedup(df)
        assert out.schema == df.schema
        kept = sorted((r["doc_id"] for r in out.collect()), key=str)
        assert kept == sorted({c for _, _, c in brute(rows)}, key=str)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(1200):
        own = list(words)
        if i % 3 == 0:
            own[rng.randrange(400)] = f"x{i}"
        else:
            own = [f"y{i}_{k % 90}" for k in range(120)]
        rows.append((i, " ".join(own)))
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)) == brute(rows)


def test_empty_table(empty):
    assert simhash_components(empty).collect() == [] and near_dedup(empty).collect() == []
