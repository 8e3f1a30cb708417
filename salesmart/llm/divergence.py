"""Divergence of the sources of a language from each other and from the language as a whole.

The term counts of a group (language, source) are the leaves of a segment tree over term ids.  Trees are hash-consed:
a node is the pair of its children, equal pairs get one id, so identical subtrees of counts are shared between all
groups.  Two trees are priced together from the roots down; equal pairs of nodes are met once, with the number of
times they occur, and only pairs of leaves (two counts) are priced.

Term ids are dealt to blocks of a few thousand, each the root of its own subtree, and the groups of a language to
tiles; a task prices the trees of two tiles in one block, and the prices of the blocks add up.  So no task holds a
vocabulary, and none holds all sources of a language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import land, looked_up, shuffle_width, utf8

# The unit of the probabilities, the least documents of a kept term, the reported terms.
UNIT = 1_000_000_000
MIN_DOCS = 3
TOP = 200
# Bytes of terms, A-Z lower-cased; all others become blanks.
_TERMS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_BLANK = np.array([b == 32 for b in _TERMS])

BLOCK = 4096  # terms of a block, on average
TILE = 64  # groups of a tile, on average
SLICE = 1 << 22  # bytes of text whose terms are counted at once
HELD = 500_000  # counts that a task combines before it passes them on
HELD_BYTES = 1 << 25

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def slices(raw: bytes) -> Iterator[bytes]:
    """``raw`` in parts of about ``SLICE`` bytes that cut no term."""
    at = 0
    while len(raw) - at > SLICE:
        end = at + SLICE
        while True:  # to the next byte of no term
            ahead = _BLANK[np.frombuffer(raw, np.uint8, min(SLICE, len(raw) - end), end)]
            if ahead.any() or end + len(ahead) == len(raw):
                end += int(ahead.argmax()) if ahead.any() else len(ahead)
                break
            end += len(ahead)
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw


def counted(groups: list[int], texts: list[bytes]) -> pa.Table:
    """(group, term, n, docs) of some texts, each of a group."""
    split = pc.split_pattern(pa.array([t.translate(_TERMS) for t in texts], pa.large_binary()).cast(pa.large_string()), " ")
    found = split.flatten()
    real = pc.not_equal(found, "")
    of = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
    terms = found.filter(real).dictionary_encode()
    size = max(1, len(terms.dictionary))
    # Per text first, so that a text counts once among the documents of a term.
    pairs, times = np.unique(of * size + terms.indices.to_numpy(), return_counts=True)
    pairs, at = np.unique(np.array(groups, np.int64)[pairs // size] * size + pairs % size, return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, at, times)
    term = terms.dictionary.take(pa.array(pairs % size)).cast(pa.string())
    return pa.table({"group": pairs // size, "term": term, "n": n, "docs": np.bincount(at, minlength=len(pairs))})


class Tally:
    """Occurrences and documents of every term, per group (lang, source); bounded by passing them on."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}
        self.waiting: tuple[list[int], list[bytes]] = ([], [])
        self.tables: list[pa.Table] = []
        self.size = self.told = 0

    def add(self, group: tuple[str, str], raw: bytes) -> Iterator[pa.RecordBatch]:
        at = self.number.setdefault(group, len(self.number))
        if len(raw) > SLICE:
            yield from self._long(at, raw)
            return
        self.waiting[0].append(at)
        self.waiting[1].append(raw)
        self.size += len(raw)
        if self.size > SLICE:
            self._count()
            if sum(t.num_rows for t in self.tables) > HELD or sum(t.nbytes for t in self.tables) > HELD_BYTES:
                yield from self.rows()

    def _long(self, group: int, raw: bytes) -> Iterator[pa.RecordBatch]:
        """A long text by slices; which of its terms are new is known by their hashes, 16 bytes each."""
        seen: set[bytes] = set()
        for part in slices(raw):
            found = counted([group], [part])
            hashes = [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in found["term"].to_pylist()]
            new = np.array([h not in seen for h in hashes], np.int64)
            seen.update(hashes)
            self.tables.append(found.set_column(3, "docs", pa.array(new, pa.int64())))
            if sum(t.num_rows for t in self.tables) > HELD or sum(t.nbytes for t in self.tables) > HELD_BYTES:
                yield from self.rows()

    def _count(self) -> None:
        if self.waiting[0]:
            self.tables.append(counted(*self.waiting))
        self.waiting, self.size = ([], []), 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What is counted so far; a group not told before gives a row with an empty term, too."""
        self._count()
        names = list(self.number)
        langs, sources = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))
        new = len(names) - self.told
        if new:
            none = pa.array(np.zeros(new, np.int64))
            yield pa.RecordBatch.from_arrays([langs[self.told :], sources[self.told :], pa.array([""] * new), none, none], schema=_COUNTS_ARROW)
        self.told = len(names)
        if self.tables:
            held = pa.concat_tables(self.tables)
            if len(self.tables) > 1:
                held = held.group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["group", "term", "n", "docs"])
            held = held.combine_chunks()
            group = held["group"].combine_chunks()
            columns = [langs.take(group), sources.take(group), *(held[c].combine_chunks() for c in ("term", "n", "docs"))]
            yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS_ARROW)
        self.tables = []


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text as bytes) rows to ``COUNTS``, combined within the task."""
    tally = Tally()
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            yield from tally.add((lang, source), text.as_py())
    yield from tally.rows()


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``COUNTS`` of every group; each group has a row with an empty term and zeros as well."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]
    rows = df.select(*names, utf8(F.col(text_col)).alias("text")).mapInArrow(count_terms, COUNTS)
    # The tasks have combined their counts already: dealt before the aggregate, which then combines once.
    dealt = rows.repartition(shuffle_width(df.sparkSession), "lang", "source", "term")
    return dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def interned(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Hash-consed segment trees over the rows of ``counts`` (trees x ids).

    Returns the count of every leaf id, the root of every tree, and per level from the leaves up the children
    (left, right) of its nodes.  Rows are filled to a power of two with a leaf of its own, count -1.
    """
    width = 1 << max(0, counts.shape[1] - 1).bit_length()
    filled = np.full((counts.shape[0], width), -1, np.int64)
    filled[:, : counts.shape[1]] = counts
    leaves, nodes = np.unique(filled, return_inverse=True)
    nodes = nodes.reshape(filled.shape)
    levels, size = [], len(leaves)
    while nodes.shape[1] > 1:
        pairs, above = np.unique(nodes[:, ::2] * np.int64(size) + nodes[:, 1::2], return_inverse=True)
        levels.append((pairs // size, pairs % size))
        nodes, size = above.reshape(len(counts), -1), len(pairs)
    return leaves, nodes[:, 0], levels


def probabilities(leaves: np.ndarray, scale: int) -> np.ndarray:
    """p of every count, exactly; ``scale`` is the group's count sum plus the number of kept terms."""
    if len(leaves) and leaves[-1] >= np.iinfo(np.int64).max // UNIT - 1:
        return np.array([1 + UNIT * (int(c) + 1) // scale for c in leaves], np.int64)
    return 1 + UNIT * (leaves + 1) // scale


def price(mine: int, others: np.ndarray, roots: np.ndarray, levels, p: np.ndarray, absent: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of tree ``mine`` against each of ``others``, and of each of these against it.

    The traversal keeps distinct (other, node, node) triples with their multiplicity, a level at a time.
    ``p`` has a row per tree and a column per leaf; pairs of the leaf ``absent`` cost nothing.
    """
    who, u, v = np.arange(len(others)), np.full(len(others), roots[mine]), roots[others]
    times = np.ones(len(others), np.int64)
    for left, right in reversed(levels):
        size = np.int64(max(left.max(), right.max()) + 1)
        key = np.concatenate([(who * size + side[u]) * size + side[v] for side in (left, right)])
        key, at = np.unique(key, return_inverse=True)
        summed = np.zeros(len(key), np.int64)
        np.add.at(summed, at, np.concatenate([times, times]))
        who, u, v, times = key // size // size, key // size % size, key % size, summed
    real = u != absent
    who, u, v, times = who[real], u[real], v[real], times[real]
    a, b = p[mine, u], p[others[who], v]
    square = (a - b) * (a - b)
    there, back = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64)
    np.add.at(there, who, square // b * times)
    np.add.at(back, who, square // a * times)
    return there, back


def price_tiles(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
    """One block of two tiles of a language: rows (source, tile, scale) without a term are its trees (n: the terms of the
    block), the others their counts above 0; gives (lang, source, item, value) for the ordered pairs of trees in different tiles or, where both are
    one, of all its trees."""
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    head = part.filter(pc.is_null(part.column("term")))
    sources = head.column("source").to_pylist()
    tile = head.column("tile").to_numpy()
    scale = [int(s) for s in head.column("scale").to_pylist()]
    row = {s: k for k, s in enumerate(sources)}
    body = part.filter(pc.is_valid(part.column("term")))
    terms = head.column("n")[0].as_py()
    counts = np.zeros((len(sources), terms), np.int64)
    if body.num_rows:
        words = body.column("term").combine_chunks().dictionary_encode()
        at = words.indices.to_numpy()
        n = body.column("n").to_numpy()
        # Rare terms next to each other: their subtrees are the ones that groups share.
        total = np.zeros(len(words.dictionary), np.int64)
        np.add.at(total, at, n)
        place = np.empty(len(total), np.int64)
        place[np.argsort(total, kind="stable")] = np.arange(terms - len(total), terms)
        counts[[row[s] for s in body.column("source").to_pylist()], place[at]] = n
    out: tuple[list, list, list] = ([], [], [])
    if counts.shape[1]:
        leaves, roots, levels = interned(counts)
        absent = 0 if leaves[0] < 0 else -1
        p = np.array([probabilities(leaves, s) for s in scale])
    for a in np.flatnonzero(tile == low):
        others = np.flatnonzero(tile == high)
        others = others[others > a] if low == high else others
        if not len(others):
            continue
        there = back = np.zeros(len(others), np.int64)
        if counts.shape[1]:
            there, back = price(a, others, roots, levels, p, absent)
        for b, x, y in zip(others.tolist(), there.tolist(), back.tolist(), strict=True):
            out[0].extend((sources[a], sources[b]))
            out[1].extend((sources[b], sources[a]))
            out[2].extend((x, y))
    same = pa.array([lang] * len(out[0]), pa.string())
    return pa.table({"lang": same, "source": pa.array(out[0], pa.string()), "item": pa.array(out[1], pa.string()), "value": pa.array(out[2], pa.int64())})


def p_of(n: str, scale: str):
    """p of a count, exactly; in integers as long as they hold it."""
    wide = f"(cast({UNIT} as decimal(11,0)) * cast({n} + 1 as decimal(19,0))) div cast({scale} as decimal(19,0))"
    return F.expr(f"1 + if({n} < {(1 << 63) // UNIT - 2}, {UNIT} * ({n} + 1) div {scale}, {wide})")


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank: what every source of a language is from the others, and by which terms.

    A null text, language or source reads as ''.  Terms are runs of letters and non-ASCII characters, A-Z
    lower-cased; a language keeps those in at least ``min_docs`` of its rows (repeated rows count as often as they
    occur).  Part ``pair`` has every other source of the language; a language of one source has none, and where no
    term is kept all values are 0.  Part ``term`` has the ``top`` terms that the group uses more than its language.
    Equal values rank by item.  Texts of any length are read in slices; other columns are not read; an empty table
    gives no rows.
    """
    counts = land(term_counts(df, text_col, lang_col, source_col), "terms")
    groups = counts.where("term = ''").select("lang", "source")
    of_term = Window.partitionBy("lang", "term")
    whole = {"total": F.sum("n").over(of_term), "in_docs": F.sum("docs").over(of_term)}
    # One row of each term stands for it where terms are counted.
    first = F.row_number().over(of_term.orderBy("source")) == 1
    kept = counts.where("term <> ''").withColumn("first", first).withColumns(whole).where(F.col("in_docs") >= min_docs)
    kept = land(kept.select("lang", "source", "term", "n", "total", "first"), "kept")
    langs = kept.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    tiles = groups.groupBy("lang").agg(F.expr(f"(count(1) + {tile - 1}) div {tile}").alias("tiles"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    stats = groups.join(tiles, "lang").join(langs, "lang", "left").join(sizes, ["lang", "source"], "left").na.fill(0, ["v", "lang_n", "group_n"])
    blocks = F.greatest(F.lit(1).cast("bigint"), F.expr(f"(v + {block - 1}) div {block}")).alias("blocks")
    own_tile = F.expr("cast(pmod(xxhash64(source), tiles) as int)").alias("tile")
    stats = land(stats.select("lang", "source", "v", "tiles", blocks, own_tile, (F.col("group_n") + F.col("v")).alias("scale"), (F.col("lang_n") + F.col("v")).alias("lang_scale")), "groups")
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(stats, kept).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(ranks))
    used = _of_groups(kept, stats.select("lang", "source", "scale", "lang_scale"))
    used = used.withColumns({"p": p_of("n", "scale"), "q": p_of("total", "lang_scale")}).where("p > q")
    value = F.expr("((p - q) * (p - q)) div q")
    terms = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top)
    return pairs.select(*terms.columns).unionByName(terms)


def _of_groups(kept: DataFrame, stats: DataFrame) -> DataFrame:
    return looked_up(kept, stats, ["lang", "source"], F.col("term"), shuffle_width(kept.sparkSession))


def _pairs(stats: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, item, value of the ordered pairs of groups, summed over the blocks."""
    trees = stats.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    own_block = F.expr("pmod(xxhash64(term), blocks)").alias("block")
    leaves = _of_groups(kept, stats.select("lang", "source", "tile", "tiles", "blocks", "scale"))
    # Terms that two tiles lack still count, so the trees know how many terms their block has.
    known = leaves.where("first").groupBy("lang", own_block).agg(F.count(F.lit(1)).alias("n"))
    trees = trees.join(known, ["lang", "block"], "left").na.fill(0, ["n"])
    trees = trees.select("lang", "source", "tile", "tiles", "block", "scale", F.lit(None).cast("string").alias("term"), "n")
    leaves = leaves.select("lang", "source", "tile", "tiles", own_block, "scale", "term", "n")
    # Every tile meets itself and each other tile once.
    met = F.explode(F.expr("sequence(0, cast(tiles - 1 as int))"))
    dealt = trees.unionByName(leaves).withColumn("with", met).drop("tiles")
    dealt = dealt.withColumns({"low": F.least("tile", "with"), "high": F.greatest("tile", "with")}).drop("with")
    priced = dealt.groupBy("lang", "block", "low", "high").applyInArrow(price_tiles, "lang string, source string, item string, value bigint")
    return priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
