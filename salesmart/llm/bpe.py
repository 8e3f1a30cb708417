"""Byte-level BPE encoding and decoding by longest-match backtracking.

Bytes are mapped to Latin-1 characters, so a pyahocorasick trie over the
vocabulary gives the longest token that starts at a byte.  The encoder walks
the piece with these longest tokens and steps back to the next shorter token, or to the token before, when two neighbours do
not fit.  Two tokens fit when the merges would keep the border between them:
their concatenation, encoded, is just the two.  A sequence whose neighbours all
fit is the one the merges produce, so the result is exact.  Fits are memoised,
and a byte position from which no completion exists is never entered twice, so
the work is linear in the piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from salesmart.llm.pieces import PieceIds


class BytePairCodec:
    """Encoder and decoder for a rank file (one ``base64(token) rank`` a line)."""

    def __init__(self, path: str, pattern: str, cached: int = 250_000):
        self.bytes_of: dict[int, bytes] = {}
        with open(path, "rb") as lines:
            for token, rank in map(bytes.split, lines):
                self.bytes_of[int(rank)] = base64.b64decode(token)
        self._text = {r: b.decode("latin-1") for r, b in self.bytes_of.items()}
        self._size = {r: len(b) for r, b in self.bytes_of.items()}
        self._rank = {t: r for r, t in self._text.items()}
        missing = [b for b in range(256) if chr(b) not in self._rank]
        if missing:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self._trie = ahocorasick.Automaton()
        for text, rank in self._rank.items():
            self._trie.add_word(text, rank)
        self._deepest = max(self._size.values())
        self._on_path: dict[str, int] = {}  # trie path -> longest token on it; no more entries than trie nodes
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._shorter: dict[int, int | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._ids = PieceIds(pattern, self.encode_piece, cached)

    def packed(self, text: str) -> bytes:
        """Ids of a whole text, each match of the pattern encoded separately, as unsigned 32-bit integers."""
        return self._ids.packed(text)

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of an array, in order."""
        return self._ids.encoded(texts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece, merged as a whole."""
        text = piece.encode("utf-8").decode("latin-1")
        whole = self._rank.get(text)
        if whole is not None:
            return [whole]
        size_of, next_shorter, known_fits, fits = self._size, self._shorter, self._fits, self.fits
        longest, n = self._longest, len(text)
        out: list[int] = []
        closed: set[int] = set()  # positions that lead nowhere
        at, token, last = 0, longest(text, 0), -1
        while True:
            end = at + size_of[token]
            if end not in closed and (last < 0 or (known if (known := known_fits.get((last, token))) is not None else fits(last, token))):
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest(text, end)
                continue
            shorter = next_shorter[token] if token in next_shorter else self._next_shorter(token)
            if shorter is None:
                closed.add(at)
                token = out.pop()
                at -= size_of[token]
                last = out[-1] if out else -1
            else:
                token = shorter

    def _longest(self, text: str, at: int) -> int:
        """The longest token that starts at ``at``."""
        ahead = text[at : at + self._deepest]
        path = ahead[: self._trie.longest_prefix(ahead)]
        token = self._on_path.get(path)
        if token is None:
            token = self._on_path[path] = next(r for n in range(len(path), 0, -1) if (r := self._rank.get(path[:n])) is not None)
        return token

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges keep the border between two neighbouring tokens."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= 1_000_000:
                self._fits.clear()
            known = self._fits[left, right] = self._kept_apart(left, right, len(self._rank) + 1)
        return known

    def _kept_apart(self, left: int, right: int, below: int) -> bool:
        """Undo the merges of both tokens from the last to the first.  At each state the pair at the
        border must not form a token that would have been merged before the merge just undone."""
        while True:
            joined = self._rank.get(self._text[left] + self._text[right])
            if joined is not None and joined < below:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            # The later merge is undone first; of equal merges the left one happens first.
            if b is None or (a is not None and left > right):
                below, left = left, a[1]
            else:
                below, right = right + 1, b[0]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; none for a single byte."""
        if token not in self._parts:
            found = None
            left = self._next_shorter(token)
            while left is not None:
                right = self._rank.get(self._text[token][len(self._text[left]) :])
                if left < token and right is not None and right < token and self._kept_apart(left, right, token):
                    found = (left, right)
                    break
                left = self._next_shorter(left)
            self._parts[token] = found
        return self._parts[token]

    def _next_shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self._shorter:
            text = self._text[token]
            self._shorter[token] = next((r for n in range(len(text) - 1, 0, -1) if (r := self._rank.get(text[:n])) is not None), None)
        return self._shorter[token]


_CODECS: dict[tuple[str, str], BytePairCodec] = {}  # one per Python worker


def codec(path: str, pattern: str) -> BytePairCodec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = BytePairCodec(path, pattern)
    return _CODECS[path, pattern]


DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_udf(path: str, pattern: str):
    """Column function: text to its token ids (null: none)."""

    @arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([own.encode(t.as_py() or "") for t in texts], pa.list_(pa.int32()))

    return encoded


def decode_udf(path: str, pattern: str):
    """Column function: token ids to bytes (null: none)."""

    @arrow_udf("binary")
    def decoded(lists: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([own.decode(ids.as_py() or []) for ids in lists], pa.binary())

    return decoded


def round_trip_digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again; one row per row of ``df``.

    Returns ``id_col``, ``n_tokens``, ``ids_sha256`` (ids as little-endian
    unsigned 32-bit integers) and ``decoded_sha256``.  Null and empty texts give
    no ids and the digests of nothing.  Repeated rows and null ids stay as they
    are; other columns are not read.  The ids never leave the task, so a very
    long text costs one list of ids.
    """

    @arrow_udf(DIGEST)
    def digest(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        counts, encoded, decoded = [], [], []
        for ids in own.encoded(texts):
            counts.append(len(ids))
            encoded.append(hashlib.sha256(ids.tobytes()).hexdigest())
            decoded.append(hashlib.sha256(own.decode(ids.tolist())).hexdigest())
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(id_col), digest(F.col(text_col)).alias("_digest")).select(id_col, "_digest.*")
