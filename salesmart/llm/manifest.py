"""Merkle manifest of a table: a content-addressed tree of digests, with a proof for every row.

Rows are leaves, in order within their group (a language, say).  Every ``FAN`` consecutive nodes of a group become one
node, level by level, down to a subroot; the subroots, in order of their groups, become the root in the same way.
Each node is a record of the store, its digest to the digests of its children.

Proofs are read from that store alone, from the root downwards: the digits of a leaf's rank, most significant first,
say which child to follow, and the children not selected are a segment of its path.  Requests that share their
leading digits stand on the same node and descend as one row, so a level has a row per node and not per leaf.  At
the leaf the segments are reversed, and folding a leaf with them gives the root again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import land, looked_up, shuffle_width

FAN = 8
_SEGMENTS = "array<struct<before: string, after: string>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: group, idx, leaf and the columns carried along; ``groups``: group, idx, subroot, height; ``store``
    and ``top_store``: per level, from the leaves' parents on, the records (digest, children) of the groups' trees
    and of the tree over the subroots; ``root``: null for an empty table."""

    leaves: DataFrame
    groups: DataFrame
    store: list[DataFrame]
    top_store: list[DataFrame]
    root: str | None


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(value.cast("binary"), 256)


def record_digest(columns: list[Column]) -> Column:
    """Digest of a row: every value as its UTF-8 byte count, ``:`` and itself, a null as ``-``."""
    texts = [c.cast("string") for c in columns]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with idx, the position in their ``group`` by ``order``, and size, the rows of the group.

    Ranks come from range partitions and their counts per group, so a group of any share of the rows is ranked in many
    tasks; ``order`` should end in a column that tells repeated rows apart.
    """
    width = shuffle_width(rows.sparkSession)
    ordered = rows.repartitionByRange(width, "group", *order).sortWithinPartitions("group", *order)
    ordered = land(ordered.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftrightunsigned("_at", 33).alias("_part")
    cells = ordered.groupBy("group", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("group")
    before = F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")
    cells = cells.select("group", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"))
    placed = ordered.withColumn("_part", part).join(cells, ["group", "_part"])
    return placed.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def grow(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` (group, idx, size, digest), as records, and the last node of every group with its
    height."""
    levels, ends, height = [], [nodes.where("size = 1").withColumn("height", F.lit(0))], 0
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        height += 1
        run = nodes.where("size > 1").groupBy("group", F.expr(f"idx div {FAN}").alias("idx"))
        run = run.agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("nodes"), F.max("size").alias("size"))
        children = F.col("nodes").getField("digest")
        size = F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size")
        nodes = land(run.select("group", "idx", digest(F.array_join(children, "")).alias("digest"), children.alias("children"), size), f"{label}{height}")
        levels.append(nodes)
        ends.append(nodes.where("size = 1").drop("children").withColumn("height", F.lit(height)))
        most = -(-most // FAN)
    last = ends[0].select("group", "digest", "height")
    for more in ends[1:]:
        last = last.unionByName(more.select("group", "digest", "height"))
    return levels, last


def build_manifest(df: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "lang", **carried: Column) -> Manifest:
    """The manifest of ``df``: a leaf per row, of the values of ``columns`` in that order.

    Leaves of a group (``group_col``, null a group of its own and first) ascend by ``id_col``, nulls first; rows of
    equal ids are in the order of their leaves, and repeated rows are leaves as often as they occur.  Null, empty and
    very long values are leaves like others.  ``carried`` columns go along with the leaves under their names; other
    columns of ``df`` are not read.  An empty table has no leaves, no records and a null root.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("group")
    columns_ = [F.col(c) for c in columns]
    more = [c.alias(name) for name, c in carried.items()]
    rows = df.select(group, F.col(id_col).alias("_id"), record_digest(columns_).alias("leaf"), F.monotonically_increasing_id().alias("_row"), *more)
    leaves = land(ranked(rows, ["_id", "leaf", "_row"], "sorted").drop("_id", "_row"), "leaves")
    store, subroots = grow(leaves.select("group", "idx", "size", F.col("leaf").alias("digest")), "nodes")
    ends = subroots.select(F.lit("").alias("group"), F.col("group").alias("of"), F.col("digest").alias("subroot"), "height")
    groups = land(ranked(ends, ["of"], "groups"), "subroots")
    top_store, last = grow(groups.select("group", "idx", "size", F.col("subroot").alias("digest")), "top")
    root = last.first()
    groups = groups.select(F.col("of").alias("group"), "idx", "subroot", "height")
    return Manifest(leaves, groups, store, top_store, root["digest"] if root else None)


def records(level: DataFrame) -> DataFrame:
    """The store's records of a level: equal digests have equal children and are one record."""
    return level.select("digest", "children").distinct()


def segment(children: Column, digit: Column) -> Column:
    """The children that a request does not select: those before and those after, joined."""
    before = F.array_join(F.slice(children, F.lit(1), digit), "")
    after = F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def descend(requests: DataFrame, level: DataFrame) -> DataFrame:
    """The requests (digest, idx, path, more) one level further down: a row per child, its segment added to the path."""
    found = looked_up(requests, records(level), ["digest"], F.col("idx"), shuffle_width(requests.sparkSession))
    one = found.select("*", F.posexplode("children").alias("_digit", "_child"))
    path = F.concat("path", F.array(segment(F.col("children"), F.col("_digit"))))
    moved = {"digest": F.col("_child"), "idx": F.col("idx") * FAN + F.col("_digit"), "path": path}
    return one.withColumns(moved).drop("children", "_digit", "_child")


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof: the columns of ``leaves``, subroot, root and path, the segments from the leaf's run
    up to the root.  A level whose run is the node alone has an empty segment; a lone leaf has none below its subroot."""
    spark = manifest.leaves.sparkSession
    here = spark.range(0 if manifest.root is None else 1)
    here = land(here.select(F.lit(manifest.root).alias("digest"), F.lit(0).cast("bigint").alias("idx"), F.array().cast(_SEGMENTS).alias("path")), "root")
    for n, level in reversed(list(enumerate(manifest.top_store))):
        here = land(descend(here, level), f"top-path{n}")
    # From here on each group's requests, from the level at which its subroot stands.
    entered = land(here.select("idx", "path").join(manifest.groups, "idx").withColumn("idx", F.lit(0).cast("bigint")), "entered")
    entered = entered.withColumn("digest", F.col("subroot"))
    here = entered.limit(0)
    for height in range(len(manifest.store), 1, -1):
        here = here.unionByName(entered.where(F.col("height") == height))
        here = land(descend(here, manifest.store[height - 1]), f"path{height}")
    last = entered.where("height = 0").withColumn("children", F.lit(None).cast("array<string>"))
    if manifest.store:
        here = here.unionByName(entered.where("height = 1"))
        last = last.unionByName(looked_up(here, records(manifest.store[0]), ["digest"], F.col("idx"), shuffle_width(spark)))
    last = last.select("group", F.col("idx").alias("_run"), "path", "children", "subroot")
    found = manifest.leaves.withColumn("_run", F.expr(f"idx div {FAN}")).join(last, ["group", "_run"])
    own = F.array(segment(F.col("children"), F.expr(f"cast(idx % {FAN} as int)")))
    path = F.concat(F.when(F.col("children").isNotNull(), own).otherwise(F.array().cast(_SEGMENTS)), F.reverse("path"))
    return found.withColumns({"path": path, "root": F.lit(manifest.root)}).drop("_run", "children")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf upwards and left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest_audit(df: DataFrame, columns: list[str], id_col: str, given: Column, group_col: str = "lang") -> DataFrame:
    """One row per row of ``df``: the id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``given`` is the leaf digest that somebody holds for the row now (``record_digest`` of the values held); it is
    folded with the proof of the original leaf, and verified says whether that gives the root.  A null ``given``
    stands for the original leaf.  The rules of ``build_manifest`` hold; an empty table gives no rows.
    """
    rows = proofs(build_manifest(df, columns, id_col, group_col, **{id_col: F.col(id_col), "given": given}))
    folded = rows.withColumn("folded_root", fold(F.coalesce("given", "leaf"), F.col("path")))
    sha = proof_digest(F.col("path")).alias("proof_sha256")
    return folded.select(id_col, "leaf", "subroot", "root", sha, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
