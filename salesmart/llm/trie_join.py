"""Self-join of 64-bit values at a small Hamming distance, by a binary trie.

The trie of the values is traversed by pairs of nodes of equal depth.  A pair
carries the number of bits in which its two prefixes differ; each step adds the
next bit of both, and a pair whose differing bits exceed the error budget is
dropped with everything below it.  In a sorted array a node is a range, so a
step over many pairs is a few array operations.

The join returns connections, not pairs: links are folded into a union-find as
they are found, and a pair of nodes whose values are all connected already is
dropped too.  A dense group of near copies thus costs about its size.

The trie's top is split by its first bits: the task of a prefix holds its own
subtree and those of larger prefixes within the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import shuffle_width

FRONTIER = 1 << 18  # node pairs handled at once
LEAF = 8  # node pairs of at most so many value pairs are compared directly


class Forest:
    """Union-find over array positions; every label points to the smallest position of its tree."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self._run_end: np.ndarray | None = None

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                return
            self._run_end = None
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                jumped = label[label]
                if np.array_equal(jumped, label):
                    break
                label[:] = jumped

    def one_tree(self, lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> np.ndarray:
        """Whether all positions of both ranges are in one tree already."""
        if self._run_end is None:
            n = len(self.label)
            change = np.flatnonzero(self.label[1:] != self.label[:-1]) + 1
            self._run_end = np.append(change, n)[np.searchsorted(change, np.arange(n), side="right")]
        return (self.label[lo] == self.label[lo2]) & (self._run_end[lo] >= hi) & (self._run_end[lo2] >= hi2)


def near(x: np.ndarray, y: np.ndarray, budget: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= budget


def connect(values: np.ndarray, own: int, bits: int, budget: int) -> np.ndarray:
    """Labels of ``values`` (sorted, distinct, unsigned) after linking the subtree ``own`` of depth
    ``bits`` with itself and with every other subtree present."""
    forest = Forest(len(values))
    if len(values) < 2:
        return forest.label
    prefix = values >> np.uint64(64 - bits) if bits else np.zeros(len(values), np.uint64)
    # A first pass over near positions: dense groups are connected before the traversal.
    mine = prefix == np.uint64(own)
    for step in (1, 2, 3):
        a = np.flatnonzero(mine[:-step] & mine[step:] & near(values[:-step], values[step:], budget))
        forest.unite(a, a + step)
    begin = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    end = np.r_[begin[1:], len(values)]
    at = int(np.searchsorted(prefix[begin], np.uint64(own)))
    if at == len(begin) or prefix[begin[at]] != own:
        return forest.label
    err = np.bitwise_count(prefix[begin] ^ np.uint64(own)).astype(np.int64)
    ok = err <= budget
    begin, end, err = begin[ok], end[ok], err[ok]
    lo, hi = np.searchsorted(prefix, np.uint64(own)), np.searchsorted(prefix, np.uint64(own), side="right")
    n = len(begin)
    todo = [(bits, np.full(n, lo), np.full(n, hi), begin, end, err)]
    while todo:
        depth, alo, ahi, blo, bhi, err = todo.pop()
        if len(alo) > FRONTIER:
            todo += [(depth, *(c[k : k + FRONTIER] for c in (alo, ahi, blo, bhi, err))) for k in range(0, len(alo), FRONTIER)]
            continue
        open_ = ~forest.one_tree(alo, ahi, blo, bhi)
        small = (ahi - alo) * (bhi - blo) <= LEAF if depth < 64 else np.ones(len(alo), bool)
        _compare(values, forest, alo, ahi, blo, bhi, open_ & small, budget)
        deep = open_ & ~small
        if deep.any():
            todo.append((depth + 1, *_step(values, depth, *(c[deep] for c in (alo, ahi, blo, bhi, err)), budget)))
    return forest.label


def _compare(values, forest, alo, ahi, blo, bhi, chosen, budget) -> None:
    """Compare all value pairs of the chosen, small node pairs."""
    alo, blo, na, nb = alo[chosen], blo[chosen], (ahi - alo)[chosen], (bhi - blo)[chosen]
    size = na * nb
    if not size.sum():
        return
    pair = np.repeat(np.arange(len(size)), size)
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    a, b = alo[pair] + nth // nb[pair], blo[pair] + nth % nb[pair]
    linked = near(values[a], values[b], budget) & (a != b)
    forest.unite(a[linked], b[linked])


def _step(values, depth, alo, ahi, blo, bhi, err, budget) -> tuple[np.ndarray, ...]:
    """The children of node pairs: equal next bits, then differing ones while the budget lasts."""
    a = _middle(values, depth, alo)
    b = _middle(values, depth, blo)
    a, b = np.clip(a, alo, ahi), np.clip(b, blo, bhi)
    room = err < budget
    other = room & (alo != blo)  # a node with itself: its two children meet once
    parts = [
        (alo, a, blo, b, err, slice(None)),
        (a, ahi, b, bhi, err, slice(None)),
        (alo, a, b, bhi, err + 1, room),
        (a, ahi, blo, b, err + 1, other),
    ]
    columns = [np.concatenate([p[i][p[5]] for p in parts]) for i in range(5)]
    filled = (columns[0] < columns[1]) & (columns[2] < columns[3])
    return tuple(c[filled] for c in columns)


def _middle(values, depth, lo) -> np.ndarray:
    """Where the values with the next bit set begin, for the nodes that start at ``lo``."""
    bit = np.uint64(1) << np.uint64(63 - depth)
    return np.searchsorted(values, (values[lo] & ~(bit - np.uint64(1))) | bit)


def reached(bits: int, budget: int) -> np.ndarray:
    """Differences between a prefix and those it meets: values of ``bits`` bits with at most ``budget`` set."""
    every = np.arange(1 << bits, dtype=np.uint64)
    return every[np.bitwise_count(every) <= budget]


def near_edges(values: DataFrame, column: str, bits: int, budget: int) -> DataFrame:
    """(u, v): a spanning forest, for each prefix, of the values within ``budget`` bits of another.

    ``values`` holds distinct 64-bit values as bigint.  The edges of all
    prefixes together connect exactly the values that links connect.  Two values
    of equal components may be connected in several prefixes.
    """
    masks = reached(bits, budget)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Send the values of a batch to the tasks of all prefixes that need them, packed."""
        for batch in batches:
            v = np.sort(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            prefix = v >> np.uint64(64 - bits)
            homes, packed = [], []
            for p in np.unique(prefix):
                mine = v[np.searchsorted(prefix, p) : np.searchsorted(prefix, p, side="right")].tobytes()
                meets = p ^ masks
                meets = meets[meets <= p]
                homes.append(meets.astype(np.int32))
                packed += [mine] * len(meets)
            if homes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(homes), pa.int32()), pa.array(packed, pa.binary())], ["home", "packed"])

    def join(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        v = np.unique(np.frombuffer(b"".join(part.column("packed").to_pylist()), np.uint64))
        label = connect(v, key[0].as_py(), bits, budget)
        child = np.flatnonzero(label != np.arange(len(v)))
        return pa.table({"u": pa.array(v[child].view(np.int64)), "v": pa.array(v[label[child]].view(np.int64))})

    # In value order a subtree is packed by one task, or by a few where it is large.
    ordered = values.select(F.col(column).cast("bigint").alias("v")).repartitionByRange(shuffle_width(values.sparkSession), "v").sortWithinPartitions("v")
    dealt = ordered.mapInArrow(deal, "home int, packed binary")
    return dealt.groupBy("home").applyInArrow(join, "u bigint, v bigint")
