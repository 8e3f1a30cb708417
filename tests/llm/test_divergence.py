import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import divergence as module
from salesmart.llm.divergence import divergence, interned, price, probabilities, slices

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200) -> set[tuple]:
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        terms = TERM.findall((r["text"] or "").translate(LOWER))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in in_docs[lang].items() if n >= 3)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        every, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for a in sources:
            values = [(sum((every[a][t] - every[b][t]) ** 2 // every[b][t] for t in kept), b) for b in sources if b != a]
            values.sort(key=lambda v: (-v[0], v[1].encode()))
            out |= {(lang, a, "pair", b, v, k) for k, (v, b) in enumerate(values, 1)}
            used = [((every[a][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, a][t] and every[a][t] > q[t]]
            used.sort(key=lambda v: (-v[0], v[1].encode()))
            out |= {(lang, a, "term", t, v, k) for k, (v, t) in enumerate(used[:top], 1)}
    return out


def found(df, **more) -> set[tuple]:
    rows = [tuple(r) for r in divergence(df, **more).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_against_plain_sums(docs):
    assert found(docs) == brute(docs.collect())


@pytest.mark.parametrize("block, tile", [(4, 1), (64, 3), (100_000, 2)])
def test_blocks_and_tiles_change_nothing(docs, block, tile):
    assert found(docs.limit(90), block=block, tile=tile) == brute(docs.limit(90).collect())


def test_edge_rows(edge):
    assert found(edge) == brute(edge.collect())


def test_empty_table(empty):
    assert found(empty) == set()


def test_groups_without_kept_terms(spark):
    df = spark.createDataFrame([("a", "en", "x"), (None, "en", "y"), ("", None, None), ("b", "", "z")], "text string, lang string, source string")
    assert found(df) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1), ("", "", "pair", "z", 0, 1), ("", "z", "pair", "", 0, 1)}


def test_ties_rank_by_item(spark):
    rows = [(f"{w} x", "en", s) for s in ("s", "t") for w in ("b", "a", "é", "Ü")] * 3
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert found(df) == brute(df.collect())


def test_a_group_with_most_rows_and_a_long_text(spark, monkeypatch):
    hot = [("the cat sat on the mat", "en", "hot")] * 200
    rest = [(f"the dog {k % 7} Ran to w{k % 5}w", "en", f"s{k}") for k in range(90)]
    long = [(" ".join(f"t{'abcdefghij'[k % 10]}é{'xyz'[k % 3]}" for k in range(60_000)), "en", "s1")] * 3
    df = spark.createDataFrame(hot + rest + long, "text string, lang string, source string")
    assert found(df) == brute(df.collect())


def test_slices_cut_no_term(monkeypatch):
    raw = "ab cdefghijklmnop q, éééééé r".encode()
    for size in range(1, 40):
        monkeypatch.setattr(module, "SLICE", size)
        parts = list(slices(raw))
        assert b"".join(parts) == raw
        assert [t for part in parts for t in TERM.findall(part.decode())] == TERM.findall(raw.decode())
    assert list(slices(b"")) == [b""]


@pytest.mark.parametrize("size, held", [(1 << 22, 10**6), (20, 5), (60, 10**6), (3, 7)])
def test_counts_of_a_task(monkeypatch, size, held):
    import pyarrow as pa

    monkeypatch.setattr(module, "SLICE", size)
    monkeypatch.setattr(module, "HELD", held)
    texts = ["", *(f"A b c{'é' * (k % 4)}-d_E b{k} \x7f zZ" for k in range(40)), "  ", "x" * 70]
    rows = [(f"l{k % 2}", f"s{k % 3}", t) for k, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2].encode() for r in rows], pa.binary())], ["lang", "source", "text"])
    n, docs, groups = Counter(), Counter(), set()
    for out in module.count_terms(iter([batch])):
        for r in out.to_pylist():
            key = (r["lang"], r["source"], r["term"])
            if r["term"] == "":
                assert key not in groups
                groups.add(key)
            n[key] += r["n"]
            docs[key] += r["docs"]
    want_n, want_docs = Counter(), Counter()
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(LOWER))
        want_n.update((lang, source, t) for t in terms)
        want_docs.update((lang, source, t) for t in set(terms))
    assert groups == {(lang, source, "") for lang, source, _ in rows}
    assert +n == want_n and +docs == want_docs


@pytest.mark.parametrize("trees, ids", [(2, 1), (3, 5), (6, 64), (4, 100)])
def test_traversal_equals_plain_pricing(trees, ids):
    rng = np.random.default_rng(trees * ids)
    counts = rng.poisson(0.7, (trees, ids)) * rng.integers(1, 4, (trees, 1))
    counts[-1] = counts[0]
    leaves, roots, levels = interned(counts)
    assert roots[-1] == roots[0]
    scale = [int(c.sum()) + ids for c in counts]
    p = np.array([probabilities(leaves, s) for s in scale])
    absent = 0 if leaves[0] < 0 else -1
    for a in range(trees):
        others = np.array([b for b in range(trees) if b != a])
        there, back = price(a, others, roots, levels, p, absent)
        for k, b in enumerate(others):
            pa_, pb = ([1 + 10**9 * (int(c) + 1) // scale[x] for c in counts[x]] for x in (a, b))
            assert there[k] == sum((x - y) ** 2 // y for x, y in zip(pa_, pb, strict=True))
            assert back[k] == sum((y - x) ** 2 // x for x, y in zip(pa_, pb, strict=True))


def test_large_counts_stay_exact():
    leaves = np.array([0, 1, 10**13], np.int64)
    assert probabilities(leaves, 10**13 + 5).tolist() == [1 + 10**9 * (c + 1) // (10**13 + 5) for c in (0, 1, 10**13)]


def test_extra_columns_do_not_clash(docs):
    more = docs.limit(40).withColumns({c: F.lit(1) for c in ("term", "n", "docs", "tile", "block", "scale", "value", "rank")})
    assert found(more) == brute(docs.limit(40).collect())
