import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from salesmart.llm import quality
from salesmart.llm.queries import ORACLE, QUERIES
from tests.llm import test_exact_dedup, test_simhash

SF = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {q.split("_")[0] + "_" for q in QUERIES} == names and len(QUERIES) == 13
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    cursor = con.execute(ORACLE[name])
    assert sorted(c[0] for c in cursor.description) == columns
    at = [[c[0] for c in cursor.description].index(c) for c in columns]
    assert got == sorted(str(tuple(r[i] for i in at)) for r in cursor.fetchall())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = stages["quality_rules"](spark, docs, SF)
    assert kept.schema == docs.schema
    want = {i: t if j[-1] is None else j[-1] for i, t in before.items() if (j := quality.judge(t, quality.Limits()))[6]}
    after = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert after == want

    rows = list(after.items())
    frame = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in rows], docs.schema)
    unique = stages["exact_dedup"](spark, frame, SF)
    assert unique.columns == columns
    ids = sorted(r["doc_id"] for r in unique.collect())
    assert ids == sorted(i for i, _, _, _, stays in test_exact_dedup.brute(rows) if stays)

    near = stages["simhash_near_dedup"](spark, unique, SF)
    assert near.columns == columns
    left = [(i, after[i]) for i in ids]
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({c for _, _, c in test_simhash.brute(left)})

    clean = stages["secret_scan"](spark, frame, SF)
    assert clean.columns == columns and clean.count() == len(rows)
    assert clean.where("text rlike '[0-9a-f]{16,}'").count() == 0

    packed = stages["packing"](spark, clean, SF).collect()
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert set(total) == set(after)
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in packed)


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_stages_on_edge_rows(spark, edge, empty):
    for table in (edge, empty):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.schema == docs.schema, name
                docs = out
            out.collect()


def test_each_text_goes_through_python_once_per_pass(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality_rules", "secret_scan"):
        plan = stages[name](spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [") + plan.count("ArrowEvalPython(") == 1 or plan.count("ArrowEvalPython") == 1, name
