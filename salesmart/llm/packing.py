"""Harmonic sequence packing.

A document's ids (with the end id) are cut into pieces by length alone: full
sequences first, then the rest by reciprocal-capacity classes.  Class k holds
pieces of at most capacity/k ids, and a sequence of class k takes exactly k of
them.  A rest that fills its class up to a small slack goes there whole;
otherwise it gives off a piece of exactly capacity/(k+1) ids and what is left
is cut the same way.  Each worker fills its own sequences class by class,
without looking at any other.  What does not fill a sequence (fewer than k
pieces of a class) goes on to a worker that serves ``FAN_IN`` workers, and so on
until one worker is left; it holds less than one sequence of every class and
packs these first-fit, longest first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import land, shuffle_width
from salesmart.llm.pieces import PieceIds

FAN_IN = 32
_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PLACED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def cut(n: int, capacity: int, slack: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in document order."""
    lengths = [capacity] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if k * n >= capacity - slack:
            lengths.append(n)
            break
        lengths.append(capacity // (k + 1))
        n -= capacity // (k + 1)
    return lengths


class _Tokenizer:
    """Ids of a ``tokenizers`` file with a byte-level BPE model, by cached pieces.

    The model of the library is asked once for each new piece; a text that
    holds an added token goes through the library whole.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._added = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        model, shown = self._whole.model, dict(enumerate(_byte_letters()))
        self._ids = PieceIds(pattern, lambda piece: [t.id for t in model.tokenize(piece.encode("utf-8").decode("latin-1").translate(shown))])

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        for t in self._added:
            whole |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        others = self._ids.encoded(texts.filter(pa.array(~whole)))
        for k in range(len(texts)):
            yield np.array(self._whole.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u4") if whole[k] else next(others)


def _byte_letters() -> list[str]:
    """The printable character that byte-level models use for each byte: itself where it is printable, else the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


_TOKENIZERS: dict[tuple[str, str], _Tokenizer] = {}  # one per Python worker


def _tokenizer(path: str, pattern: str) -> _Tokenizer:
    if (path, pattern) not in _TOKENIZERS:
        _TOKENIZERS[path, pattern] = _Tokenizer(path, pattern)
    return _TOKENIZERS[path, pattern]


def cut_rows(path: str, pattern: str, end_id: int, capacity: int, slack: int):
    """Rows (doc_id, text) to the rows of their pieces, with the CRC-32 of each piece's ids."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(path, pattern)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            of, starts, lengths, sums, totals = [], [], [], [], []
            for k, found in enumerate(own.encoded(batch.column(1))):
                ids = memoryview(found.tobytes() + end)
                total = len(ids) // 4
                at = 0
                for n in cut(total, capacity, slack):
                    of.append(k)
                    starts.append(at)
                    lengths.append(n)
                    sums.append(zlib.crc32(ids[4 * at : 4 * (at + n)]))
                    totals.append(total)
                    at += n
            numbers = [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *numbers], _OUT)

    return pieces


def fill_classes(capacity: int, level: int, worker_bits: int):
    """Fill the sequences of one worker (one partition, sorted by class); pieces left over get a null sequence.

    A sequence's id is (level, worker, number in the worker), so no two workers share one.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the pieces of a sequence begun, at most one class' worth
        numbered = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            kind = held.column("kind").to_numpy()
            # Positions within each class, then the whole sequences among them.
            begin = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(kind) else np.zeros(0, int)
            size = np.diff(np.r_[begin, len(kind)])
            first = np.repeat(begin, size)
            nth = np.arange(len(kind)) - first
            full = np.repeat(size // kind[begin], size) if len(kind) else size
            done = nth < full * kind
            last_open = (~done) & (first == (begin[-1] if len(begin) else 0))  # its class may go on in the next batch
            yield from _numbered(held.filter(pa.array(done)), nth[done] // kind[done], first[done], level, worker_bits, numbered)
            numbered += int((size // kind[begin]).sum()) if len(kind) else 0
            yield from _left(held.filter(pa.array(~done & ~last_open)))
            held = held.filter(pa.array(last_open)).combine_chunks()
        if held is not None:
            yield from _left(held)

    return fill


def _numbered(table: pa.Table, nth_bin: np.ndarray, first: np.ndarray, level: int, worker_bits: int, numbered: int) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    length = table.column("length").to_numpy()
    new = np.r_[True, (nth_bin[1:] != nth_bin[:-1]) | (first[1:] != first[:-1])]
    number = np.cumsum(new) - 1
    before = np.cumsum(length) - length
    offset = before - before[new][number]
    worker = table.column("worker").to_numpy()
    ids = (np.int64(level) << 58) + (worker.astype(np.int64) << (58 - worker_bits)) + numbered + number
    yield from _rows(table, pa.array(ids, pa.int64()), pa.array(offset, pa.int64()))


def _left(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if table.num_rows:
        none = pa.nulls(table.num_rows, pa.int64())
        yield from _rows(table, none, none)


def _rows(table: pa.Table, ids: pa.Array, offset: pa.Array) -> Iterator[pa.RecordBatch]:
    return iter(table.select(_OUT).append_column("sequence_id", ids).append_column("offset", offset).combine_chunks().to_batches())


def first_fit(capacity: int, level: int):
    """Pack the pieces of the last worker, longest first, each into the fullest-numbered sequence that has room."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room: list[int] = []
        open_from = 0
        for batch in batches:
            ids, offsets = [], []
            for n in batch.column("length").to_pylist():
                k = next((i for i in range(open_from, len(room)) if room[i] >= n), len(room))
                if k == len(room):
                    room.append(capacity)
                ids.append((level << 58) + k)
                offsets.append(capacity - room[k])
                room[k] -= n
                while open_from < len(room) and not room[open_from]:
                    open_from += 1
            if ids:
                yield from _rows(pa.Table.from_batches([batch]), pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()))

    return pack


def harmonic_pack(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1, slack: int | None = None) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids; one row per piece.

    A document's ids are those of the tokenizer file (no special tokens added)
    and ``end_id``; a null or empty text is ``end_id`` alone.  Returns doc_id,
    start (ids of the document before the piece), length, ids_crc32, doc_tokens,
    sequence_id and offset.  Each id lies in one piece, pieces of a sequence lie
    gapless from offset 0.  ``slack`` (default capacity/64) bounds the padding
    of a filled sequence.  A text of any length is tokenized whole and cut into
    as many pieces as it needs; ties in length go by id and place.  Repeated rows
    are packed as often as they occur, null ids stay null, other columns are not
    read; an empty table gives none.
    """
    spark = df.sparkSession
    slack = capacity // 64 if slack is None else slack
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # Landed: every later round works on these small rows, not on the texts.
    cut_up = rows.mapInArrow(cut_rows(path, pattern, end_id, capacity, slack), PIECE)
    # Numbered, so that repeated rows are dealt to all workers.
    pieces = land(cut_up.withColumn("nth", F.monotonically_increasing_id()), "pieces")

    workers, level, placed = shuffle_width(spark), 0, []
    worker_bits = max(1, (workers - 1).bit_length())
    todo, own = pieces, F.pmod(F.xxhash64("nth"), F.lit(workers)).cast("int")
    while True:
        spread = _classed(todo, own, capacity).repartitionById(workers, F.col("worker")).sortWithinPartitions("kind", "doc_id", "start", "length", "ids_crc32")
        filled = spread.mapInArrow(fill_classes(capacity, level, worker_bits), PLACED)
        filled = land(filled, f"filled{level}")
        placed.append(filled.where("sequence_id is not null"))
        todo, level = filled.where("sequence_id is null").drop("sequence_id", "offset"), level + 1
        if workers == 1:
            break
        workers = -(-workers // FAN_IN)
        own = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(workers)).cast("int")
    rest = todo.repartitionById(1, F.lit(0)).sortWithinPartitions(F.desc("length"), "doc_id", "start", "ids_crc32")
    placed.append(rest.mapInArrow(first_fit(capacity, level), PLACED))
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def _classed(pieces: DataFrame, worker: Column, capacity: int) -> DataFrame:
    kind = F.floor(F.lit(capacity) / F.col("length")).cast("bigint")
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", worker.alias("worker"), kind.alias("kind"))
