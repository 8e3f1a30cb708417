"""Physical plan shape: built-ins only, no cross joins, pushed filters, pruned reads,
aggregation before the first shuffle of the flagship."""

import pytest

import __spark_entry__ as entry
from salesmart.plans import catalog
from tests.conftest import SF_SMALL

catalog.load_all()
QUERIES = dict(catalog.QUERIES)
WRITES = {"copy_table", "create_table", "overwrite_table", "overwrite_path", "typed_create", "csv_combine", "scd2_fact_load", "key_batches"}
SIDE_EFFECT_FREE = sorted(set(QUERIES) - WRITES)


def plan(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", SIDE_EFFECT_FREE)
def test_no_python_udf_and_no_cross_join(spark, capsys, name):
    text = plan(QUERIES[name](spark, SF_SMALL), capsys)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, f"{name}: {bad}"


def test_filter_pushed_and_columns_pruned(spark, capsys):
    text = plan(QUERIES["filter_between"](spark, SF_SMALL), capsys)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_flagship_aggregates_before_shuffling(spark, capsys):
    text = plan(entry.entry(spark), capsys)
    first_exchange = text.index("Exchange")
    assert "partial_sum" in text
    head = text[text.index("(1) Scan parquet"):]
    assert head.index("partial_sum") < head.index("Exchange")
    assert first_exchange > 0


def test_semi_joins_for_dimension_predicates(spark, capsys):
    text = plan(QUERIES["filter_multi"](spark, SF_SMALL), capsys)
    assert "LeftSemi" in text


def test_changed_keys_are_shuffled_once(spark, capsys):
    text = plan(QUERIES["version_diff"](spark, SF_SMALL), capsys)
    assert "LeftSemi" in text and "FullOuter" not in text
