"""Connected components of an edge table, as DataFrame rounds.

Alternates two steps until nothing changes: every vertex links its larger
neighbours to the smallest vertex it sees, then its smaller neighbours and
itself to the smallest of those.  Each round is two aggregations and two joins;
the edges are landed after each, so a lost executor repeats one round at most.
No vertex's neighbours are ever gathered: the steps need a minimum per vertex
only, which is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import land


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of ``edges`` (u, v: bigint); ``root`` is the smallest vertex of its component.

    Edges with equal ends or null ends say nothing; repeated edges count once.
    An empty edge table gives no rows.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = land(edges.distinct(), "edges")
    before = None
    while True:
        now = _state(edges)
        if now == before or not now[0]:
            break
        before, edges = now, land(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Larger neighbours of every vertex go to the smallest one it sees.
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("larger"))
    return up.join(smallest, "u").select(F.col("larger").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
