import hashlib

import pytest
from pyspark.sql import functions as F

from salesmart.llm import manifest
from salesmart.llm.manifest import FAN, build_manifest, fold, manifest_audit, proofs, record_digest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in COLUMNS)))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Last node and, for each leaf, its (before, after) from the leaf up, level by level in plain Python."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + FAN, len(nodes))) for k in range(0, len(nodes), FAN)]
        for run in runs:
            for at in run:
                for i in under[at]:
                    paths[i].append(("".join(nodes[b] for b in run if b < at), "".join(nodes[b] for b in run if b > at)))
        under = [[i for at in run for i in under[at]] for run in runs]
        nodes = [h("".join(nodes[at] for at in run)) for run in runs]
    return nodes[0], paths


def brute(rows) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g in names}
    made = {g: tree([leaf(r) for r in ordered[g]]) for g in names}
    root, tops = tree([made[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        for r, path in zip(ordered[g], made[g][1], strict=True):
            out.append((r["doc_id"], leaf(r), made[g][0], root, h("".join(a + b for a, b in path + top))))
    return out


def key(row):
    return tuple((v is None, str(v)) for v in row)


def audited(df, given=None):
    return manifest_audit(df, COLUMNS, "doc_id", F.lit(None).cast("string") if given is None else given)


def check(df):
    rows = audited(df).collect()
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(brute(df.collect()), key=key)
    assert all(r.verified and r.folded_root == r.root for r in rows)


def test_against_plain_tree(spark, docs):
    check(docs)


def test_edge_rows(edge):
    check(edge)


@pytest.mark.parametrize("sizes", [[1], [513], [1, 2, 7, 8, 9, 63, 64, 65, 512]])
def test_sizes(spark, sizes):
    rows = [(i, "s", f"l{n}", 1, str(i)) for n in sizes for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars int, text string"))


def test_many_groups_of_uneven_sizes(spark):
    df = spark.range(300).select(
        F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("source"), F.sqrt("id").cast("int").cast("string").alias("lang"), F.lit(1).alias("n_chars"), F.lit("é").alias("text")
    )
    check(df.unionByName(df.limit(1).withColumn("lang", F.lit(None).cast("string"))))


def test_empty_table(empty):
    made = build_manifest(empty, COLUMNS)
    assert made.root is None
    assert audited(empty).collect() == []


def test_a_changed_value_is_found(docs):
    given = F.when(F.col("doc_id") % 3 == 0, record_digest([F.upper("text") if c == "text" else F.col(c) for c in COLUMNS]))
    rows = {r.doc_id: r for r in audited(docs, given).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, r in rows.items():
        same = i % 3 != 0 or texts[i] is None or texts[i].upper() == texts[i]
        assert r.verified == same


def test_null_and_dash_differ(spark):
    df = spark.createDataFrame([(1, "-", 1), (1, None, 1), (1, "", 1), (1, "1:", 1)], "doc_id bigint, text string, lang int")
    assert build_manifest(df, ["doc_id", "text"]).leaves.select("leaf").distinct().count() == 4


def test_a_third_of_the_rows_repeat_one(spark):
    one = spark.range(400).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("same").alias("text"))
    none = spark.range(400).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("x").alias("text"))
    rest = spark.range(400).select((F.col("id") + 8).alias("doc_id"), F.lit("a").alias("source"), F.lit("de").alias("lang"), F.lit(1).alias("n_chars"), F.lit("y").alias("text"))
    df = one.unionByName(none).unionByName(rest)
    check(df)
    # Repeated rows are ranked in more than one task.
    assert build_manifest(df, COLUMNS).leaves.where("group = '=en'").select(F.max("idx")).first()[0] == 799


def test_each_proof_folds_to_the_root_and_the_store_is_content_addressed(docs):
    made = build_manifest(docs, COLUMNS)
    bad = proofs(made).where(fold(F.col("leaf"), F.col("path")) != F.lit(made.root))
    assert bad.count() == 0
    for level in made.store + made.top_store:
        assert level.where(manifest.digest(F.array_join("children", "")) != F.col("digest")).count() == 0
