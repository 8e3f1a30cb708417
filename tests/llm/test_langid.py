import itertools
import zlib

import numpy as np
import pytest

from salesmart.llm import langid


def brute_posteriors(emit, step, start):
    """Label distributions of one sequence, by summing over all label sequences."""
    n, labels = emit.shape
    marginal, pair, total = np.zeros((n, labels)), np.zeros((labels, labels)), 0.0
    for ys in itertools.product(range(labels), repeat=n):
        score = start[ys[0]] + sum(emit[t, y] for t, y in enumerate(ys)) + sum(step[a, b] for a, b in itertools.pairwise(ys))
        p = np.exp(score)
        total += p
        for t, y in enumerate(ys):
            marginal[t, y] += p
        for a, b in itertools.pairwise(ys):
            pair[a, b] += p
    return marginal / total, pair / total


def test_forward_backward():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 6, 3])
    emit = rng.normal(size=(4, 6, 3))
    step, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    got, pairs = langid.posteriors(emit, lengths, step, start, pairs=True)
    want = [brute_posteriors(emit[i, :n], step, start) for i, n in enumerate(lengths)]
    for i, n in enumerate(lengths):
        assert np.allclose(got[i, :n], want[i][0]) and not got[i, n:].any()
    assert np.allclose(pairs, sum(p for _, p in want))
    sums, _ = langid.posteriors(emit.astype(np.float32), lengths, step, start, sums=True)
    assert np.allclose(sums, got.sum(axis=1), atol=1e-4)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "ab", "Straße", "x" * 300, "ab", "中文字"]
    ids, begin = langid.word_features(words, 1 << 12, {"ab": 1})
    ends = [*begin[1:], len(ids)]
    for k, w in enumerate(words):
        alone, _ = langid.word_features([w], 1 << 12, {"ab": 1})
        assert ids[begin[k] : ends[k]].tolist() == alone.tolist()
        marked = len(w) + 2
        assert len(alone) == (marked - 1) + (marked - 2) + {3: 0, 4: 1}.get(marked, 2) + (w == "ab")


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def model(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    return df, langid.train(langid.training_rows(df, "doc_id", "text", "lang", F.lit(True), langid.Sample(rows=40)))


def test_code_switched_words(spark):
    """A text that changes language gets labels that change with it."""
    df, crf = model(spark)
    by = {lang: [langid.WORDS(r["text"])[:40] for r in df.where(f"lang = '{lang}'").limit(12).collect()] for lang in ("en", "de")}
    tagger = langid.Tagger(crf)
    right = total = 0
    for a, b in zip(by["en"], by["de"], strict=False):
        scores = tagger.word_scores([a + b])[0][None].astype(float)
        got = langid.posteriors(scores, np.array([len(a + b)]), crf.step, crf.start)[0][0].argmax(axis=1)
        want = [crf.languages.index("en")] * len(a) + [crf.languages.index("de")] * len(b)
        right += int((got == np.array(want)).sum())
        total += len(want)
    assert right >= 0.9 * total


def test_forgetting_words_changes_nothing(spark):
    df, crf = model(spark)
    texts = [r["text"] for r in df.limit(40).collect()]
    small = langid.Tagger(crf, known=50)
    for a, b in zip(langid.Tagger(crf).mean_labels(texts), small.mean_labels(texts), strict=True):
        assert np.allclose(a, b, atol=1e-5)


def test_edge_rows(edge, empty, spark):
    rows = langid.identify(edge).collect()
    assert len(rows) == edge.count()
    text = {}
    for r in edge.collect():
        text.setdefault(r["doc_id"], []).append(r["text"])
    for r in rows:
        blank = [t for t in text[r["doc_id"]] if not langid.WORDS(t or "")]
        if len(blank) == len(text[r["doc_id"]]):
            assert r["lang_pred"] == "und" and r["score"] == 0
        if r["doc_id"] is None:
            assert not r["held_out"]
    assert langid.identify(empty).collect() == []
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in langid.identify(unlabelled).collect()] == [(1, False, "und", 0.0)]


def test_sample_keeps_its_bounds(spark):
    from pyspark.sql import functions as F

    rows = [(1, f"one text {i % 3}", "en") for i in range(400)] + [(2 + i, f"ein Text {i}", "de") for i in range(20)] + [(50, "mot " * 30, "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = langid.training_rows(df, "doc_id", "text", "lang", F.lit(True), langid.Sample(rows=10, chars=40))
    assert sorted(t for t, lang in got if lang == "en") == ["one text 0", "one text 1", "one text 2"]
    assert sum(lang == "de" for _, lang in got) == 10
    assert [t for t, lang in got if lang == "fr"] == [("mot " * 30)[:40]]
    with pytest.raises(ValueError):
        langid.training_rows(df, "doc_id", "text", "lang", F.lit(True), langid.Sample(languages=2))


def test_numerals_are_no_letters(spark):
    """No letter gives und, whatever digits and numerals there are."""
    assert langid.WORDS("12 ½ ² Ⅷ ① _") == []
    assert langid.WORDS("x² naïve ½a_b ß") == ["x", "naïve", "a", "b", "ß"]
    rows = [(i, "the house and the garden " * 8, "en") for i in range(8)] + [(i, "das haus und der garten " * 8, "de") for i in range(8, 16)]
    df = spark.createDataFrame([*rows, (99, "12 ½ ² Ⅷ ①", None)], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df).collect()}
    assert found[99] == "und" and found[0] == "en"
