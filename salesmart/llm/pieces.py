"""Splitting a text by a tokenizer pattern, piece by piece, through caches.

The patterns of byte-level BPE tokenizers attach one leading space to a word
and never cross a space that has a non-space on both sides.  A text may
therefore be cut at such spaces: what follows the cut, with its space, is split
the same way in any context.  These chunks repeat a lot, so their ids are
cached; a chunk that is new is split by the pattern itself and its pieces are
looked up in a second cache.

An Arrow array of texts is cut, and its chunks are numbered, at once; each
different word of a group of texts is looked up once, and the ids of the texts
are gathered from those of the words.
"""

from __future__ import annotations

import re
from array import array as pack
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from salesmart.llm.common import Cache

# White space of the pattern (Unicode White_Space).
SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"
# A chunk that any such pattern splits into a word and the punctuation after it.
_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!#-&(-/:-@\[-`{-~"
_WORD = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)").fullmatch
_WORDS = f"^(?P<word>[{_LETTERS}]+)(?P<rest>[{_MARKS}]*)$"
_AT_SPACE = regex.compile(r"(?<=\S) (?=\S)")
_WHITE = "".join(f"\\x{{{ord(s):x}}}" for s in SPACES)
_UNSAFE = f"^ | $| [{_WHITE}]|[{_WHITE}] "  # a space that is no place to cut
_EMPTY, _SPACE = (pa.scalar(s, pa.large_string()) for s in ("", " "))
SIZE = 1 << 22  # bytes of text whose chunks are numbered at once
_BESIDE = [pair for s in SPACES for pair in (f" {s}", f"{s} ")]


class PieceIds:
    """Token ids of whole texts: ``encode_piece`` gives the ids of one match of ``pattern``.

    Ids are kept as little-endian unsigned 32-bit integers in ``bytes``, a small
    part of the memory that lists of Python numbers would take.
    """

    def __init__(self, pattern: str, encode_piece: Callable[[str], Iterable[int]], cached: int = 250_000):
        self._find = regex.compile(pattern).findall
        self._pieces = Cache(lambda piece: pack("I", encode_piece(piece)).tobytes() if piece else b"", cached)
        self._chunks = Cache(self._spaced, cached)

    def _spaced(self, chunk: str) -> bytes:
        if plain := _WORD(chunk):
            word, rest = plain.groups()
            return self._pieces[" " + word] + (self._pieces[rest] if rest else b"")
        return self._split(" " + chunk)

    def _split(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._find(text)))

    def packed(self, text: str) -> bytes:
        """The ids of ``text``, packed."""
        if not text:
            return b""
        first, *rest = chunks(text)
        return self._split(first) + b"".join(map(self._chunks.__getitem__, rest))

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of an array, in order; null and empty texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = pc.binary_length(texts).to_numpy()
        at = 0
        while at < len(texts):
            end = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), SIZE)))
            if size[at] > 2 * SIZE:
                yield np.frombuffer(b"".join(map(self.packed_part, parts(texts[at].as_py()))), "<u4")
                end = at + 1
            else:
                yield from self._group(texts.slice(at, end - at))
            at = end

    def packed_part(self, part: tuple[str, bool]) -> bytes:
        """The ids of a part of a text; whether a space comes before it is its second item."""
        text, spaced = part
        cut = chunks(text) if text else [""]
        ids, _ = self._ids_of(pa.array(cut, pa.large_string()), np.arange(0 if spaced else 1))
        return ids.tobytes()

    def _group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        unsafe = pc.match_substring_regex(texts, _UNSAFE)
        lists = pc.split_pattern(texts.filter(pc.invert(unsafe)), " ")
        cut = [_AT_SPACE.split(t) for t in texts_of(texts.filter(unsafe))]
        values = pa.concat_arrays([lists.flatten(), pa.array([c for t in cut for c in t], pa.large_string())])
        count = np.r_[np.diff(lists.offsets.to_numpy()), np.array([len(t) for t in cut], np.int64)].astype(np.int64)
        last = np.cumsum(count)
        ids, ends = self._ids_of(values, last - count)
        stop = ends[last - 1]
        # Safe texts come first in ``values``; back to the order of ``texts``.
        place = np.argsort(np.argsort(unsafe.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        start = np.r_[0, stop[:-1]]
        for k in place.tolist():
            yield ids[start[k] : stop[k]]

    def _ids_of(self, values: pa.Array, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of chunks and where each chunk's end; no space comes before the chunks at ``firsts``."""
        encoded = values.dictionary_encode()
        table, word, rest = self._looked_up(encoded.dictionary)
        index = encoded.indices.to_numpy()
        # Two entries of the table for each chunk.
        index = np.stack([word[index], rest[index]], axis=1)
        index[firsts, 0], index[firsts, 1] = len(table) + np.arange(len(firsts)), 0
        table += map(self._split, texts_of(values.take(pa.array(firsts))))
        length = np.fromiter(map(len, table), np.int64, len(table)) // 4
        flat = np.frombuffer(b"".join(table), "<u4")
        begin = np.cumsum(length) - length
        index = index.ravel()
        n = length[index]
        ends = np.cumsum(n)
        at = np.repeat(begin[index] - (ends - n), n)
        at += np.arange(len(at))
        return flat[at], ends[1::2]

    def _looked_up(self, chunks_: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """A table of ids whose first entry is empty, and for each of the chunks, all different and after a space, the
        two entries that make its ids."""
        split = pc.extract_regex(chunks_, _WORDS)
        plain = split.is_valid()
        table, places = [b""], []
        others = chunks_.filter(pc.invert(plain))
        split = split.filter(plain)
        for pieces in (pc.binary_join_element_wise(_EMPTY, split.field("word"), _SPACE), split.field("rest"), others):
            encoded = pieces.dictionary_encode()
            places.append(encoded.indices.to_numpy().astype(np.int64) + len(table))
            cache = self._chunks if pieces is others else self._pieces
            table += map(cache.__getitem__, texts_of(encoded.dictionary))
        at = plain.to_numpy(zero_copy_only=False)
        word, rest = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        word[at], rest[at], word[~at] = places
        return table, word, rest


def texts_of(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """A long text cut at spaces that have a non-space on both sides, and whether such a space comes before the part."""
    at = 0
    while True:
        cut = _AT_SPACE.search(text, at + SIZE)
        yield text[at : cut.start() if cut else len(text)], at > 0
        if not cut:
            return
        at = cut.end()


def chunks(text: str) -> list[str]:
    """``text`` cut at every space that has a non-space on both sides."""
    if text[0] == " " or text[-1] == " " or any(pair in text for pair in _beside(text)):
        return _AT_SPACE.split(text)
    return text.split(" ")


def _beside(text: str) -> Iterator[str]:
    return _BESIDE if not text.isascii() else (p for p in _BESIDE if p.isascii())
