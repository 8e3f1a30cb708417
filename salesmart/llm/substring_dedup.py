"""Removal of passages that a document with a smaller id holds already, by prefix-partitioned suffix trees over words.

Two texts share a passage of ``window`` words where two suffixes of the texts share a prefix of that many words: a node
of the suffix tree at that depth or deeper with leaves in both.  The tree is never built whole:

1. *Copies.*  Of equal texts only the one with the smallest id goes on; all windows of the others are its windows.
2. *Prefixes.*  In every window one word position is its anchor: where the hash of the next ``gram`` words is
   smallest.  Equal windows have equal anchors, so the suffixes whose windows share an anchor are a group that the
   prefix at the anchor names, and every suffix is in just one group.  Prefixes that occur in one document only are
   dropped before any text moves.
3. *Contexts.*  Consecutive suffixes with one anchor travel as one piece of text, long enough for the windows of all.
   Equal pieces are combined, so a group of copies is one piece with its smallest id.
4. *Variable-length prefixes.*  A group with too many different pieces for a task is split by longer prefixes: its
   suffixes are dealt to narrower ranges of distance from the anchor, whose windows have more words in common (all of
   them in the last step).  Groups with one document are dropped again.
5. *Subtrees.*  A task holds the suffixes of a few groups at a time and orders them by prefixes of doubling length; the
   classes of suffixes with ``window`` words in common are the deep nodes of the subtree, and the smallest id below a
   node is told to all its leaves.

Neighbouring leaves of one document merge into its maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from xxhash import xxh64_intdigest

from salesmart.llm.common import land, looked_up, shuffle_width, utf8

GRAM = 10  # words of the first prefixes
PIECES = 8192  # different pieces of a group that a task may hold
LONGEST = 64  # bytes of a word that travel; a longer one travels as its digest
SEED = 11
WORDS = 1 << 16  # words hashed at once
_LAST = np.iinfo(np.int64).max
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)

PIECE = "piece binary, words binary, prefix bigint, `left` int, low bigint, high bigint"
LINK = "piece binary, at int, child binary, words binary, prefix bigint, `left` int, low bigint, high bigint"
FOUND = "piece binary, at int, least array<bigint>"


def bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``raw`` (runs other than ASCII white space) begin and end."""
    inside = np.r_[False, ~_SPACE[np.frombuffer(raw, np.uint8)], False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), WORDS):
        a, b = starts[k : k + WORDS].tolist(), ends[k : k + WORDS].tolist()
        words = [raw[x:y] for x, y in zip(a, b, strict=True)]
        out[k : k + WORDS] = np.fromiter(map(xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))
    return out


def spans_of(n: int) -> list[int]:
    """Powers of two, largest first, that sum to ``n``."""
    return [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]


def gram_hashes(words: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` words, from those of runs of doubling length."""
    if len(words) < gram:
        return np.zeros(0, np.uint64)
    n = len(words) - gram + 1
    with np.errstate(over="ignore"):
        runs, power, length, out, at = {1: words}, {1: _BASE}, 1, np.zeros(n, np.uint64), 0
        while 2 * length <= gram:
            half = runs[length]
            runs[2 * length] = half[:-length] * power[length] + half[length:]
            power[2 * length] = power[length] * power[length]
            length *= 2
        for part in spans_of(gram):
            out = out * power[part] + runs[part][at : at + n]
            at += part
        # Mixed, so that the order of the hashes says nothing of the words.
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the position of its smallest, the first of equals."""

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)

    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, length = np.arange(len(grams)), 1
    while 2 * length <= width:
        best = better(best[:-length], best[length:])
        length *= 2
    return better(best[:n], best[width - length : width - length + n]) if length < width else best[:n]


class Text:
    """The words of one text: their number ``n`` and where they lie in ``raw``."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.starts, self.ends = bounds(raw)
        self.n = len(self.starts)

    def runs(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The runs of windows with one anchor: first window, number of windows, distance to the anchor, prefix there."""
        grams = gram_hashes(word_hashes(self.raw, self.starts, self.ends), gram) if self.n >= window else np.zeros(0, np.uint64)
        at = anchors(grams, window - gram + 1)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        return first, np.diff(np.r_[first, len(at)]), at[first] - first, grams[at[first]].view(np.int64)

    def words(self, begin: int, end: int) -> list[bytes]:
        a, b = self.starts[begin:end].tolist(), self.ends[begin:end].tolist()
        return [self.raw[x:y] for x, y in zip(a, b, strict=True)]

    def digest(self, removed: np.ndarray | None = None) -> tuple[int, str]:
        """How many words are removed, and the SHA-256 of the others joined by single spaces."""
        stay = np.flatnonzero(~removed) if removed is not None else np.arange(self.n)
        sha, before = hashlib.sha256(), b""
        for k in range(0, len(stay), WORDS):
            a, b = self.starts[stay[k : k + WORDS]].tolist(), self.ends[stay[k : k + WORDS]].tolist()
            sha.update(before + b" ".join([self.raw[x:y] for x, y in zip(a, b, strict=True)]))
            before = b" "
        return self.n - len(stay), sha.hexdigest()


def prefixes_udf(window: int, gram: int):
    """Column function: UTF-8 bytes to the number of words, the digest of all words and the distinct prefixes at anchors."""

    @arrow_udf("n_words bigint, sha string, prefixes array<bigint>")
    def found(texts: pa.Array) -> pa.Array:
        n, sha, prefixes = [], [], []
        for t in texts:
            text = Text(t.as_py() or b"")
            n.append(text.n)
            sha.append(text.digest()[1])
            prefixes.append(np.unique(text.runs(window, gram)[3]))
        ends = np.r_[0, np.cumsum([len(p) for p in prefixes])]
        flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(sha, pa.string()), lists], ["n_words", "sha", "prefixes"])

    return found


def travelling(words: list[bytes]) -> bytes:
    """Words joined by spaces; a long word is a tab, which no word holds, and its digest."""
    return b" ".join([w if len(w) <= LONGEST else b"\t" + hashlib.sha256(w).digest().hex().encode() for w in words])


def named(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def cut_pieces(window: int, gram: int):
    """(row, ord, text, prefixes) to the pieces of the runs whose prefix is listed: a row (row, start, piece, ord) for
    each, and a row ``PIECE`` for each different one, combined within the task as far as ``PIECES`` allows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        different: dict[bytes, list] = {}
        for batch in batches:
            rows, orders = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for row, order, raw, live in zip(rows, orders, batch.column(2), batch.column(3), strict=True):
                text = Text(raw.as_py())
                first, count, left, prefix = text.runs(window, gram)
                for k in np.flatnonzero(np.isin(prefix, live.values.to_numpy())).tolist():
                    words = travelling(text.words(first[k], first[k] + count[k] + window - 1))
                    piece = named(words)
                    out.append((row, int(first[k]), piece, None, None, None, order, None))
                    same = different.get(piece)
                    if same is None:
                        different[piece] = [words, int(prefix[k]), int(left[k]), order, order]
                    else:
                        same[3:] = min(same[3], order), max(same[4], order)
                    if len(out) >= PIECES:
                        yield _batch(out, _CUT)
                        out = []
                if len(different) >= 4 * PIECES:
                    yield from told(different)
            if out:
                yield _batch(out, _CUT)
        yield from told(different)

    def told(different: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
        if different:
            yield _batch([(None, None, piece, *more) for piece, more in different.items()], _CUT)
        different.clear()

    return cut


_OF = [("words", pa.binary()), ("prefix", pa.int64()), ("left", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]
_CUT = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("piece", pa.binary()), *_OF])
_LINK = pa.schema([("piece", pa.binary()), ("at", pa.int32()), ("child", pa.binary()), *_OF])
_FOUND = pa.schema([("piece", pa.binary()), ("at", pa.int32()), ("least", pa.list_(pa.int64()))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def split_pieces(window: int, width: int):
    """``PIECE`` rows to their parts by ranges of ``width`` distances from the anchor, each under a longer prefix."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for piece, joined, _, left, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = joined.split(b" ")
                last = left - (len(words) - window)  # distance of the last window
                for near in range(last // width * width, left + 1, width):
                    far = min(left, near + width - 1)
                    at, end = left - far, left - max(near, last) + window
                    part = b" ".join(words[at:end])
                    # What all windows of the range have in common.
                    core = words[left - near : left - near - width + 1 + window]
                    prefix = named(b"%d " % near + b" ".join(core))
                    out.append((piece, at, named(part), part, int.from_bytes(prefix[:8], "little", signed=True), far, low, high))
                    if len(out) >= PIECES:
                        yield _batch(out, _LINK)
                        out = []
            if out:
                yield _batch(out, _LINK)

    return split


def deep_nodes(ids: np.ndarray, groups: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """The node at depth ``window`` of each suffix in ``starts``: suffixes share it when they are of one group and agree
    in their first ``window`` words (``ids``).  Prefixes of doubling length are ranked in turn, exactly."""
    ranks, length, nodes, at = {1: ids}, 1, groups, 0
    while 2 * length <= window:
        r = ranks[length]
        pair = r[:-length] * np.int64(r.max() + 1) + r[length:]
        ranks[2 * length] = np.unique(pair, return_inverse=True)[1]
        length *= 2
    for part in spans_of(window):
        r = ranks[part]
        nodes = np.unique(nodes * np.int64(r.max() + 1) + r[starts + at], return_inverse=True)[1]
        at += part
    return nodes


def subtrees(window: int):
    """``PIECE`` rows sorted by prefix to ``FOUND``: per window of a piece the smallest id that has it, where some id has not."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        number: dict[int, int] = {}
        ids, begin, counts, low, high, groups = [], [], [], [], [], []
        for _, joined, prefix, _, lo, hi in rows:
            words = joined.split(b" ")
            begin.append(len(ids))
            ids += [known.setdefault(w, len(known)) for w in words]
            counts.append(len(words) - window + 1)
            low.append(lo)
            high.append(hi)
            groups.append(number.setdefault(prefix, len(number)))
        count = np.array(counts)
        of = np.repeat(np.arange(len(rows)), count)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        nodes = deep_nodes(np.array(ids, np.int64), np.array(groups)[of], np.array(begin)[of] + nth, window)
        least = np.full(nodes.max() + 1, _LAST)
        np.minimum.at(least, nodes, np.array(low)[of])
        least = least[nodes]
        shared = np.bincount(of, least < np.array(high)[of], len(rows)) > 0
        ends = np.cumsum(count)
        out = [(rows[k][0], 0, least[ends[k] - counts[k] : ends[k]]) for k in np.flatnonzero(shared).tolist()]
        if out:
            yield _batch(out, _FOUND)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Whole groups only; a group has at most PIECES rows.
                if len(held) >= PIECES and row[2] != held[-1][2]:
                    yield from solve(held)
                    held = []
                held.append(row)
        if held:
            yield from solve(held)

    return grouped


def cover_udf(window: int, with_text: bool):
    """Column function: (UTF-8 bytes, starts of windows to remove) to n_removed, kept_sha256, spans and kept_text (null
    unless ``with_text``)."""

    @arrow_udf("n_removed bigint, kept_sha256 string, spans array<struct<begin: bigint, `end`: bigint>>, kept_text string")
    def covered(texts: pa.Array, windows: pa.Array) -> pa.Array:
        out = []
        for t, w in zip(texts, windows, strict=True):
            text = Text(t.as_py())
            step = np.zeros(text.n + 1, np.int64)
            starts = w.values.to_numpy()
            np.add.at(step, starts, 1)
            np.add.at(step, starts + window, -1)
            removed = np.cumsum(step[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.r_[False, removed, False])).reshape(-1, 2)
            kept = b" ".join([b" ".join(text.words(a, b)) for a, b in gaps(edges, text.n)]).decode("utf-8") if with_text else None
            out.append((*text.digest(removed), [{"begin": a, "end": b} for a, b in edges.tolist()], kept))
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        types = (pa.int64(), pa.string(), spans, pa.string())
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, types, strict=True)], ["n_removed", "kept_sha256", "spans", "kept_text"])

    return covered


def gaps(spans: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The ranges of ``n`` words that no span has."""
    edges = np.r_[0, spans.ravel(), n].reshape(-1, 2)
    return [(a, b) for a, b in edges.tolist() if a < b]


def listed_prefixes(firsts: DataFrame) -> DataFrame:
    """(row, live): of each row the prefixes that another ``ord`` has, too."""
    at_anchor = firsts.select("row", "ord", F.explode("prefixes").alias("prefix"))
    several = at_anchor.groupBy("prefix").agg(F.min("ord").alias("low"), F.max("ord").alias("high")).where("low < high").select("prefix")
    # A prefix that very many texts have is divided by the skew join of the adaptive plan: the rows are three numbers.
    return at_anchor.select("row", "prefix").join(several, "prefix").groupBy("row").agg(F.collect_list("prefix").alias("live"))


def repeated_windows(live: DataFrame, window: int, gram: int, most: int) -> DataFrame:
    """(row, windows): the starts of the windows of each row that a smaller ``ord`` has, too.

    ``live`` is landed and has row, ord, text (bytes) and the prefixes to look at; equal rows say the same.
    """
    lanes = shuffle_width(live.sparkSession)
    cut = live.select("row", "ord", "text", "live").mapInArrow(cut_pieces(window, gram), f"row bigint, start int, {PIECE}")
    cut = land(cut, "pieces")
    same = ["piece", "words", "prefix", "left"]
    columns = [*same, "low", "high"]
    entries, width, levels = cut.where("row is null").select(*columns), window - gram + 1, []
    links: list[DataFrame] = []
    while True:
        distinct = entries.groupBy(*same).agg(F.min("low").alias("low"), F.max("high").alias("high"))
        entries = land(distinct, "entries")
        sizes = entries.groupBy("prefix").agg(F.count(F.lit(1)).alias("pieces"), F.min("low").alias("lowest"), F.max("high").alias("highest"))
        sizes = land(sizes.where("lowest < highest").select("prefix", "pieces"), "sizes")
        # A small group has at most ``most`` rows, so its join needs no lanes.
        small = entries.join(sizes.where(F.col("pieces") <= most).select("prefix"), "prefix", "left_semi").select(*columns)
        ordered = small.repartition(lanes, "prefix").sortWithinPartitions("prefix")
        levels.append(land(ordered.mapInArrow(subtrees(window), FOUND), "found"))
        large = sizes.where(F.col("pieces") > most).select("prefix")
        if width == 1 or large.isEmpty():
            break
        width = max(1, width // 2)
        large = looked_up(entries, large, ["prefix"], F.col("piece"), lanes).select(*columns)
        split = land(large.mapInArrow(split_pieces(window, width), LINK), "links")
        links.append(split.select("piece", "at", "child"))
        entries = split.select(F.col("child").alias("piece"), *columns[1:])

    # Up again: what is found for a part holds for the pieces it was cut from.
    found = levels[-1]
    for link, above in zip(reversed(links), reversed(levels[:-1]), strict=True):
        of_parts = looked_up(link, found.select(F.col("piece").alias("child"), F.col("at").alias("_at"), "least"), ["child"], F.col("piece"), lanes)
        found = land(above.unionByName(of_parts.select("piece", (F.col("at") + F.col("_at")).alias("at"), "least")), "found")
    at = cut.where("row is not null").select("row", "start", "piece", F.col("low").alias("ord"))
    hits = looked_up(at, found, ["piece"], F.col("row"), lanes)
    starts = hits.select("row", "ord", F.posexplode("least").alias("nth", "first"), (F.col("start") + F.col("at")).alias("from"))
    starts = starts.where("first < ord").select("row", (F.col("from") + F.col("nth")).alias("window"))
    return starts.groupBy("row").agg(F.collect_set("window").alias("windows"))


def substring_report(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = GRAM, most: int = PIECES, payload: Column | None = None
) -> DataFrame:
    """One row per row of ``df``: the id, n_words, n_removed, kept_sha256 (digest of the kept words joined by single
    spaces) and spans (word positions of the maximal repeats; null where no word is removed); with ``payload`` also
    kept_text (null where no word is removed) and payload.

    A word is removed when it lies in a window of ``window`` words that starts in a row with a smaller id, too;
    windows are judged on the input.  A null text has no words, a text of fewer than ``window`` words none to remove.
    Rows of equal ids do not remove from each other, nor does a row from itself; a null id counts as larger than any
    other (as the largest bigint).  Texts of any length are read whole, their words in slices.  Other columns are not
    read, unless in ``payload``; an empty table gives no rows.
    """
    gram = min(gram, window)
    text = utf8(F.col(text_col))
    order = F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(_LAST))).alias("ord")
    text_id = F.unhex(F.md5(text)).alias("text_id")
    more = [payload.alias("payload")] if payload is not None else []
    base = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), order, text_id, prefixes_udf(window, gram)(text).alias("seen"), *more)
    base = land(base.select("row", "id", "ord", "text_id", "seen.*", *["payload" for _ in more]), "words")
    # Of equal texts the first row; rows that repeat its id share its result.
    first = base.groupBy("text_id").agg(F.min(F.struct("ord", "row")).alias("first")).select("first.row")
    firsts = land(base.select("row", "ord", "text_id", "prefixes").join(first, "row", "left_semi"), "firsts")
    listed = firsts.select("row", "ord", "text_id").join(listed_prefixes(firsts), "row")
    live = land(df.select(order, text_id, text.alias("text")).join(listed, ["ord", "text_id"]), "live")
    windows = repeated_windows(live, window, gram, most)
    cover = cover_udf(window, payload is not None)(F.col("text"), F.col("windows")).alias("cover")
    hit = live.select("row", "text").join(windows, "row").select("row", cover).select("row", "cover.*").dropDuplicates(["row"])
    known = firsts.select("row", "ord", "text_id").join(hit, "row", "left").withColumnRenamed("row", "of")
    found = base.select("id", "ord", "text_id", "n_words", "sha", *["payload" for _ in more]).join(known, ["ord", "text_id"], "left")
    # A copy of a text with a smaller id goes whole, if it has a window.
    copy = F.col("of").isNull() & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("n_words").alias("end")))
    out = [
        "id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
    ]
    if payload is not None:
        out += [F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"), "payload"]
    return found.select(*out)


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``df`` with repeated passages cut out of its texts; all rows, columns, names and types as they were.

    A text that loses words is its kept words joined by single spaces; others stay as they are.  The rules of
    ``substring_report`` hold.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = substring_report(df, id_col, text_col, window, payload=whole)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("payload").getField(text_col))
    return rows.select(*[text.alias(c) if c == text_col else F.col("payload").getField(c).alias(c) for c in df.columns])
