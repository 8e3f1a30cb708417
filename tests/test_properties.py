"""Join algebra on random keys (NULLs and duplicates included):
inner + anti = left, left + unmatched dims = full, right = inner + unmatched dims,
and the join forms agree with Spark's own outer joins."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.operators.joins import join_on, orphan_facts, unmatched_dims

keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=0, max_size=12)


def frames(spark, fact_keys, dim_keys):
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(fact_keys)], "sale_id int, k int")
    dims = spark.createDataFrame([(k, f"d{k}") for k in dim_keys], "k int, name string")
    return facts, dims


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_keys=keys, dim_keys=keys)
def test_join_algebra(spark, fact_keys, dim_keys):
    facts, dims = frames(spark, fact_keys, dim_keys)
    inner = join_on(facts, dims, "k", "inner").count()
    left = join_on(facts, dims, "k", "left").count()
    anti = orphan_facts(facts, dims, "k").count()
    unmatched = unmatched_dims(dims, facts, "k").count()
    assert inner + anti == left
    assert bag(join_on(facts, dims, "k", "full")) == bag(facts.join(dims, "k", "full"))
    assert bag(join_on(facts, dims, "k", "right")) == bag(facts.join(dims, "k", "right"))
    assert join_on(facts, dims, "k", "full").count() == left + unmatched


def test_shared_column_names_join_as_spark_does(spark):
    facts = spark.createDataFrame([(1, 1, "f"), (2, 9, "g")], "sale_id int, k int, name string")
    dims = spark.createDataFrame([(1, "d1"), (3, "d3")], "k int, name string")
    for how in ("full", "right"):
        assert bag(join_on(facts, dims, "k", how)) == bag(facts.join(dims, "k", how))
