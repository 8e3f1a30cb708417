import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import substring_dedup as module
from salesmart.llm.substring_dedup import anchors, deep_nodes, gram_hashes, substring_dedup, substring_report

LAST = 2**63 - 1


def brute(rows, window) -> list[tuple]:
    """(id, n_words, n_removed, sha, spans) of each row, from the definition."""
    words = [(r["doc_id"], (r["text"] or "").encode().split()) for r in rows]
    least: dict[tuple, int] = {}
    for i, w in words:
        own = LAST if i is None else i
        for k in range(len(w) - window + 1):
            at = tuple(w[k : k + window])
            least[at] = min(least.get(at, LAST), own)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < (LAST if i is None else i):
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        edges = [k for k in range(len(w) + 1) if (k > 0 and gone[k - 1]) != (k < len(w) and gone[k])]
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), str(list(zip(edges[::2], edges[1::2], strict=True)))))
    return sorted(out, key=str)


def report(df, window, **more):
    rows = substring_report(df, window=window, **more).collect()
    return sorted([(r.id, r.n_words, r.n_removed, r.kept_sha256, str([(s.begin, s.end) for s in r.spans or []])) for r in rows], key=str)


def table(spark, texts, parts=5):
    return spark.createDataFrame(texts, "doc_id bigint, text string").repartition(parts)


def made(seed: int, n: int = 60) -> list[tuple]:
    """Texts of few words with passages, copies and repeats planted at random."""
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d e f g h".split()) + rng.choice(["", "", "1"])
    passages = [[word() for _ in range(rng.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            w += p[a:] + [word() for _ in range(rng.randint(0, 9))]
        rows.append((rng.choice([i, i, i, None, 3]), rng.choice([" ", "\n", "  \t"]).join(w)))
    return rows + rows[:5]


def test_whole_documents(docs):
    got = [r[:4] for r in report(docs, 50)]
    assert got == [r[:4] for r in brute(docs.collect(), 50)]
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("seed, window, gram, most", [(1, 12, 4, 8192), (2, 12, 4, 1), (3, 7, 1, 2), (4, 20, 10, 3), (5, 9, 9, 1), (6, 1, 1, 4), (7, 2, 1, 1)])
def test_random_texts_with_split_groups(spark, seed, window, gram, most):
    rows = made(seed)
    df = table(spark, rows)
    assert report(df, window, gram=gram, most=most) == brute(df.collect(), window)


def test_edge_rows(edge):
    assert report(edge, 50) == brute(edge.collect(), 50)
    assert report(edge, 1) == brute(edge.collect(), 1)


def test_empty_table(empty):
    assert report(empty, 50) == []
    assert substring_dedup(empty).collect() == []


def test_one_word_over_and_over(spark):
    rows = [(1, "ha " * 4000), (2, "x " + "ha " * 300 + "y"), (3, "ha " * 49), (4, "ha " * 50)]
    df = table(spark, rows)
    assert report(df, 50) == brute(df.collect(), 50)


def test_very_long_words_and_texts(spark):
    long = "z" * 100_000
    body = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, f"{long} " * 60), (2, f"q {long} " * 60), (3, f"{long} " * 55 + "end"), (4, body), (5, "start " + body + " end")]
    df = table(spark, rows)
    assert report(df, 50) == brute(df.collect(), 50)


def test_a_hot_passage_between_different_words(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    line = " ".join(f"l{k}" for k in range(14))
    rows = [(k, " ".join(f"u{k}x{j}" for j in range(30)) + f" {passage} {line} " + " ".join(f"v{k}x{j}" for j in range(30))) for k in range(120)]
    df = table(spark, rows)
    assert report(df, 50, most=16) == brute(df.collect(), 50)


def test_a_third_of_the_rows_are_copies_or_repeats(spark):
    body = " ".join(f"w{k}" for k in range(120))
    rows = [(k, body) for k in range(100)] + [(7, body)] * 100 + [(None, body)] * 50 + [(k + 200, body.replace("w60 ", f"n{k} ")) for k in range(100)]
    df = table(spark, rows)
    assert report(df, 50, most=8) == brute(df.collect(), 50)


def test_no_word_of_a_clean_text_goes(spark):
    rng = random.Random(5)
    df = table(spark, [(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(300))) for i in range(30)])
    assert all(r[2] == 0 for r in report(df, 50))


def test_texts_without_their_repeats(spark):
    body = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(1, body, "a"), (2, f"before\n{body}  after  that", "b"), (3, "left  as it\tis ", "c"), (4, None, "d")], "doc_id bigint, text string, piece string")
    out = substring_dedup(df)
    assert out.schema == df.schema
    assert {tuple(r) for r in out.collect()} == {(1, body, "a"), (2, "before after that", "b"), (3, "left  as it\tis ", "c"), (4, None, "d")}


def test_columns_with_the_names_used_inside(spark):
    names = ["row", "id", "ord", "prefixes", "piece", "words", "window", "payload", "n_words"]
    body = " ".join(f"w{k}" for k in range(60))
    df = table(spark, [(1, body), (2, body + " x")]).withColumns({c: F.lit(1) for c in names})
    assert report(df, 50) == brute(df.collect(), 50)
    assert substring_dedup(df).columns == df.columns


def test_anchor_is_the_first_smallest():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 8, 41):
        grams = rng.integers(0, 6, 200).astype(np.uint64)
        want = [s + int(np.argmin(grams[s : s + width])) for s in range(200 - width + 1)]
        assert anchors(grams, width).tolist() == want
    assert len(anchors(np.zeros(3, np.uint64), 4)) == 0


def test_gram_hash_depends_on_the_gram_only():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 500).astype(np.uint64)
    for gram in (1, 2, 7, 10):
        h = gram_hashes(words, gram)
        seen = {}
        for k in range(len(h)):
            assert seen.setdefault(tuple(words[k : k + gram]), h[k]) == h[k]
        assert len(set(seen.values())) == len(seen)


def test_nodes_are_equal_prefixes():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2, 300)
    starts, groups = np.arange(280), rng.integers(0, 2, 280)
    for window in (1, 5, 8, 13):
        nodes = deep_nodes(ids, groups, starts, window)
        keys = [(g, tuple(ids[s : s + window])) for g, s in zip(groups, starts, strict=True)]
        assert len(set(zip(nodes.tolist(), keys, strict=True))) == len(set(keys)) == len(set(nodes.tolist()))


def test_split_parts_hold_every_window_once():
    import pyarrow as pa

    words = [b"w%d" % k for k in range(30)]
    piece = pa.RecordBatch.from_arrays([pa.array([b"p"]), pa.array([b" ".join(words)]), pa.array([0]), pa.array([9], pa.int32()), pa.array([1]), pa.array([2])], ["piece", "words", "prefix", "left", "low", "high"])
    for width in (5, 2, 1):
        windows = []
        for out in module.split_pieces(21, width)(iter([piece])):
            for r in out.to_pylist():
                part = r["words"].split(b" ")
                windows += [tuple(part[k : k + 21]) for k in range(len(part) - 20)]
                assert words[r["at"] : r["at"] + len(part)] == part
        assert sorted(windows) == sorted(tuple(words[k : k + 21]) for k in range(10))
