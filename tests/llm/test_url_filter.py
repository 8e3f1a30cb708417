import re
from collections import defaultdict

import pytest

from salesmart.llm import url_filter as u
from salesmart.llm.queries import URL_RULES

TREE = u.Tree()


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return re.sub("[A-Z]", lambda x: x.group().lower(), m.group(1)), m.group(2)


def rule(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(str(r)), default=None)


def segments(path):
    path = re.sub("[0-9]+", "{n}", path)
    m = re.match(r"(?s)^(/[^/]*)?(/[^/]*)?(.*)$", path)
    return tuple(x or "" for x in m.groups())


def brute(rows):
    """The tree by plain dictionaries."""
    found = [(i, *parts(url)) for i, url in rows]
    rules = [rule(h, p) for _, h, p in found]
    keys = [(h, *segments(p)) for _, h, p in found]
    blocked = [r is not None and r.verdict == "block" for r in rules]
    count = defaultdict(lambda: [0, 0])
    for k, b in zip(keys, blocked, strict=True):
        count[k[0]][0] += 1
        count[k[0]][1] += b
    q = {k: (count[k[0]][1] + TREE.weight * 0.5) / (count[k[0]][0] + TREE.weight) for k in keys}
    template = {k: (k[0],) for k in keys}
    for level in range(1, 4):
        child, above = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for k, b in zip(keys, blocked, strict=True):
            for table, name in ((child, (template[k], k[level])), (above, template[k])):
                table[name][0] += 1
                table[name][1] += b
        general = {}
        for (t, s), (n, b) in child.items():
            pn, pb = above[t]
            rate = pb / pn
            rare = n < TREE.min_count or n < TREE.min_share * pn
            general[t, s] = "/*" if rare or abs(b / n - rate) <= TREE.z * (rate * (1 - rate) / n) ** 0.5 else s
        new = {k: (*template[k], general[template[k], k[level]]) for k in set(keys)}
        merged = defaultdict(lambda: [0, 0])
        for k, b in zip(keys, blocked, strict=True):
            merged[new[k]][0] += 1
            merged[new[k]][1] += b
        q = {k: (merged[new[k]][1] + TREE.weight * q[k]) / (merged[new[k]][0] + TREE.weight) for k in set(keys)}
        template = new
    return sorted(
        (
            (i, h, p, str(r) if r else None, r.verdict if r else "block" if q[k] > TREE.limit else "allow")
            for (i, h, p), r, k in zip(found, rules, keys, strict=True)
        ),
        key=str,
    )


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "HTTP://A.NET/x?q#f", "https://example.net/en/1", "https://x.example.net/en",
    "https://example.com/de/?a", "https://aexample.com/de/x", "https://b.org/fr/1", "https://b.org/fr", "http://net:80/x", "http://u@net/y",
    "x://y://net/z", "http://m.org/" + "a/" * 4000, "http://É.ORG/fr/é", "http://b.org//fr/", "http://b.org/\nfr/",
]


def found(df):
    return sorted((tuple(r) for r in u.judge_urls(df, URL_RULES).collect()), key=str)


def test_edge_urls(spark):
    rows = [(i, x) for i, x in enumerate(URLS)] + [(None, "http://net/"), (3, "http://net/"), (3, "http://net/")]
    df = spark.createDataFrame([(i, x, "n", 1, 0.5) for i, x in rows], "page_id bigint, url string, host string, s1 int, q double")
    assert found(df) == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    assert found(df) == brute([(r["page_id"], r["url"]) for r in df.select("page_id", "url").collect()])


def test_templates_generalise_and_split(spark):
    rows = [(i, f"http://shop.example.com/de/{i}") for i in range(60)] + [(100 + i, f"http://shop.example.com/blog/{i}") for i in range(60)]
    # The root path has no rule, and hardly any label: the tree decides.
    rows += [(200 + i, f"http://spam.net?x={i}") for i in range(20)] + [(300 + i, f"http://spam.net/{i}") for i in range(200)]
    out = found(spark.createDataFrame(rows, "page_id bigint, url string"))
    assert out == brute(rows)
    verdict = {r[0]: r[4] for r in out}
    assert verdict[0] == "block" and verdict[100] == "allow"


def test_only_native_operators(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = u.judge_urls(df, URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "page_id bigint, url string")) == []
