import re
from collections import Counter

import pytest

from salesmart.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    bad = [x for x in lines if brute_fails(x)]
    kept = not failed and 100 * sum(map(len, bad)) <= 40 * sum(map(len, lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed, kept


def brute_fails(line):
    n = len(WORD.findall(line))
    closing = line.rstrip(" \t\n\r\x0b\x0c").rstrip("\"'”’»)]")
    ended = bool(closing) and closing[-1] in ".!?…。！？"
    stops = len(re.findall(r"""[.!?…。！？]["'”’»)\]]*[ \t\n\r\x0b\x0c]""", line))
    separators = sum(c in "|»›•" for c in line)
    return (
        (not ended and 30 * stops < n)
        or re.search(q.NOTICES, line, re.IGNORECASE) is not None
        or sum(c in "#*$%&|<>!" for c in line) > n
        or (separators >= 2 and 4 * separators >= n)
    )


@pytest.mark.parametrize(
    "text",
    [
        None, "", "\n\n", "a b c a b c a b c", "x " * 200, "The end.\nThe end.\n\nThe end", "Home | About | News\n" * 4 + "A real sentence ends here. " * 20,
        "One \x85 two\x1cthree é ſ.", "He said (\"yes.\")] ", "ABC!! DEF!! GHI!!", "a\x0bb\x0cc\rd.", "All Rights Reserved by us.", "a b c d e f a b c g h d e f.",
    ],
)
def test_one_text(text):
    assert q.judge(text, q.Limits())[:7] == brute(text)


def test_whole_tables(docs, edge):
    for df in (docs, edge):
        got = sorted(map(str, (tuple(r)[:8] for r in q.quality_report(df).collect())))
        assert got == sorted(str((r["doc_id"], *brute(r["text"]))) for r in df.collect())


def test_labels_agree(spark, docs):
    """Rows labelled good are kept when they are long enough; rows labelled bad mostly go."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = q.quality_report(whole).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) == len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_filter_removes_lines(spark):
    body = "\n".join(f"Line {i} has w{i * 3} and x{i * 5} with y{i * 7} in it." for i in range(20))
    df = spark.createDataFrame([(1, body + "\nHome | About | News | Help", 0, None), (2, body, 5, "x")], "doc_id int, text string, n_chars int, kept string")
    out = sorted(q.quality_filter(df, length_col="n_chars").collect())
    assert out[0]["text"] == body and out[0]["n_chars"] == len(body)
    assert tuple(out[1]) == (2, body, 5, "x")


def test_filter_keeps_columns(edge, empty):
    assert q.quality_filter(edge).schema == edge.schema
    assert q.quality_filter(empty).collect() == [] and q.quality_report(empty).collect() == []
