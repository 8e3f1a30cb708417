"""Secret scan: fixed patterns, and a randomness test battery for other tokens.

Base spans come from three patterns (assigned credentials, access keys, long
hex runs).  The battery looks at every other token of 16 or more characters, and
at its parts between slashes: it infers the smallest encoding whose alphabet holds the
token, maps the token to symbol values and tests them against uniformly random
symbols by

- a chi-squared test of the alphabet's uniformity,
- a runs test about the alphabet's middle,
- a serial-correlation test at lag one,

and combines the three p-values by Fisher's method.  What the battery does not reject is random as far as a token of
its length can tell.  Beside it stands the other explanation, that the token is written like the words of the corpus:
a symbol model of these words (transitions between the characters of all shorter words of the table) gives each token
the likelihood ratio of uniform symbols against it.  The longer a token, the further its ratio can go.

A likelihood ratio against the model is an e-value, so step-up control over all distinct tokens of the table holds the
false-discovery share: of m tokens, k are flagged when the k largest ratios all reach m / (k * ``max_false``).  That
needs no least number of tokens: one key among a thousand words is found as well as a thousand keys.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from salesmart.llm.common import Cache, utf8
from salesmart.llm.quality import replaced

# The base patterns, their kinds in order and least lengths.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS = 12, 18
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

LEAST = 16  # characters of a token
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
PART = re.compile(r"[^/]{16,}")
# Encodings by alphabet, smallest first; a token takes the first that holds it.
ALPHABETS = (
    ("digits", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
_VALUES = [{c: i for i, c in enumerate(a)} for _, a in ALPHABETS]
P_MIN = 0.01  # a token with a smaller combined p is not random
BIN = 0.25  # width of the bins of log likelihood ratios, natural
TOP_BIN = 400  # ratios from here on are one bin
SLICE = 1 << 22  # bytes of a text whose symbols are counted at once

# Characters of words and tokens.  Beside the transitions read in the words stand those of names that are put together
# (fixed values): in this share of transitions the next character is of the same kind this often, else a sign
# as often as a letter or digit.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
PUT_TOGETHER, SAME_KIND = 0.2, 0.7
_CODE = np.full(256, -1)
_CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
_KIND = np.array([0] * 26 + [1] * 26 + [2] * 10 + [3] * 4)
_SIGN = 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, sorted; code points, end exclusive."""
    spans = []
    folded = text.encode("utf-8", "surrogatepass").lower()
    if any(k in folded for k in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def symbol_counts(raw: bytes) -> np.ndarray:
    """Transitions (from, to) within the words of a text that are shorter than tokens; the last row counts first symbols."""
    n = len(SYMBOLS)
    out = np.zeros((n + 1, n), np.int64)
    for part in _parts(raw):
        code = _CODE[np.frombuffer(b" " + part + b" ", np.uint8)]
        edges = np.flatnonzero((code[1:] < 0) != (code[:-1] < 0)) + 1
        begin, end = edges[::2], edges[1::2]
        begin, end = begin[end - begin < LEAST], end[end - begin < LEAST]
        short = np.zeros(len(code) + 1, np.int64)
        short[begin] += 1
        short[end] -= 1
        inside = np.cumsum(short[:-1]) > 0
        np.add.at(out[n], code[begin], 1)
        pair = inside[1:] & inside[:-1] & (code[:-1] >= 0) & (code[1:] >= 0)
        out[:n] += np.bincount(code[:-1][pair] * n + code[1:][pair], minlength=n * n).reshape(n, n)
    return out


def _parts(raw: bytes):
    """``raw`` in parts of about ``SLICE`` bytes, cut before a blank."""
    at = 0
    while at < len(raw):
        cut = raw.find(b" ", at + SLICE)
        cut = len(raw) if cut < 0 else cut
        yield raw[at:cut]
        at = cut


class Words:
    """How the words of a corpus are written: log probabilities of a first symbol and of each next one."""

    def __init__(self, counts: np.ndarray):
        n = len(SYMBOLS)
        size = np.bincount(_KIND)
        same = _KIND[:, None] == _KIND[None, :]
        sign = (_KIND == _SIGN) / size[_SIGN]
        others = ~same & (_KIND != _SIGN)[None, :]
        others = others / others.sum(axis=1, keepdims=True)
        # A sign is followed by any letter or digit.
        change = np.where((_KIND == _SIGN)[:, None], others, 0.5 * sign[None, :] + 0.5 * others)
        names = np.where(same, SAME_KIND / size[_KIND][None, :], 0) + (1 - SAME_KIND) * change
        common = (counts.sum(axis=0) + 1) / (counts.sum() + n)
        words = (counts[:n] + n * common) / (counts[:n].sum(axis=1, keepdims=True) + n)
        self.first = np.log((1 - PUT_TOGETHER) * (counts[n] + n * common) / (counts[n].sum() + n) + PUT_TOGETHER / n)
        self.next = np.log((1 - PUT_TOGETHER) * words + PUT_TOGETHER * names)

    def log_probability(self, token: str) -> float:
        code = _CODE[np.frombuffer(token.encode("ascii"), np.uint8)]
        return float(self.first[code[0]] + self.next[code[:-1], code[1:]].sum())


def spans_of_tokens(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the tokens, and of their parts between slashes, that overlap no base span; a token comes before
    its parts."""
    found = []
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # where the spans up to each have ended

    def free(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return not before or reach[before - 1] <= a

    for m in TOKEN.finditer(text):
        spans = [m.span()]
        if "/" in m.group():
            spans += [(m.start() + x.start(), m.start() + x.end()) for x in PART.finditer(m.group()) if x.end() - x.start() < m.end() - m.start()]
        found += [(a, b) for a, b in spans if free(a, b)]
    return found


def encoding(token: str) -> int:
    """Number of the smallest alphabet that holds the token."""
    return next(k for k, v in enumerate(_VALUES) if all(c in v for c in token))


def bin_of(token: str, words: Words) -> int:
    """Bin of the token's log likelihood ratio of random symbols against words; -1 where the battery rejects them."""
    kind = encoding(token)
    if randomness_p([_VALUES[kind][c] for c in token], len(_VALUES[kind])) < P_MIN:
        return -1
    ratio = -len(token) * math.log(len(_VALUES[kind])) - words.log_probability(token)
    return min(TOP_BIN, max(0, math.floor(ratio / BIN)))


def flagged(text: str, base: list[tuple[int, int, int]], judged: Cache, least: int | None) -> list[tuple[int, int]]:
    """(start, end) of the tokens from bin ``least`` on; parts of a flagged token are not listed again."""
    spans: list[tuple[int, int]] = []
    if least is None:
        return spans
    for a, b in spans_of_tokens(text, base):
        if judged[text[a:b]] >= least and not (spans and b <= spans[-1][1]):
            spans.append((a, b))
    return spans


def randomness_p(symbols: list[int], size: int) -> float:
    """Combined p-value of the battery: uniform on (0, 1) for random symbols of an alphabet of ``size``."""
    n = len(symbols)
    tests = (_chi_squared_p(symbols, size), _runs_p(symbols, size), _serial_p(symbols))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in tests)
    # Chi-squared tail with 6 degrees of freedom, in closed form.
    half = fisher / 2
    return math.exp(-half) * (1 + half + half * half / 2) if n > 1 else 0.0


def _chi_squared_p(symbols: list[int], size: int) -> float:
    """Upper tail of Pearson's statistic, by a gamma with its exact mean and variance under uniformity."""
    n = len(symbols)
    counts: dict[int, int] = {}
    for s in symbols:
        counts[s] = counts.get(s, 0) + 1
    x = sum(c * c for c in counts.values()) * size / n - n
    mean, var = size - 1, 2 * (size - 1) * (n - 1) / n
    # Wilson-Hilferty: the cube root of a gamma variable is nearly normal.
    shape = mean * mean / var
    z = ((max(x, 0.0) / mean) ** (1 / 3) - (1 - 1 / (9 * shape))) * 3 * math.sqrt(shape)
    return 0.5 * math.erfc(z / math.sqrt(2))


def _runs_p(symbols: list[int], size: int) -> float:
    """Two-sided p of the number of runs above and below the middle of the alphabet."""
    high = [2 * s >= size for s in symbols]
    a = sum(high)
    b = len(high) - a
    n = a + b
    if not a or not b:
        return 2.0 ** (1 - n)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    return math.erfc(abs(runs - mean) / math.sqrt(2 * var)) if var > 0 else 1.0


def _serial_p(symbols: list[int]) -> float:
    """Two-sided p of the correlation between neighbouring symbols."""
    n = len(symbols)
    mean = sum(symbols) / n
    square = sum((s - mean) ** 2 for s in symbols)
    if not square:
        return 1e-300
    r = sum((x - mean) * (y - mean) for x, y in zip(symbols, symbols[1:], strict=False)) / square
    return math.erfc(abs(r + 1 / n) * math.sqrt(n / 2))


def threshold(histogram: dict[int, int], max_false: float) -> int | None:
    """The bin from which tokens are flagged: the smallest whose every ratio reaches (all tokens) / (flagged *
    ``max_false``); none where no bin does.  Tokens of bin -1 count among all."""
    every, flagged_, found = sum(histogram.values()), 0, None
    for b in sorted((b for b in histogram if b > 0), reverse=True):
        flagged_ += histogram[b]
        if b * BIN >= math.log(every / (flagged_ * max_false)):
            found = b
    return found


def symbol_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (bytes) to (cell, n) of their symbol counts, combined within the task."""
    total = np.zeros((len(SYMBOLS) + 1, len(SYMBOLS)), np.int64)
    for batch in batches:
        # Words do not go from one text to the next.
        total += symbol_counts(b" ".join(t.as_py() for t in batch.column(0)))
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total.ravel()[cell], pa.int64())], ["cell", "n"])


def corpus_words(df: DataFrame, text_col: str = "text") -> Words:
    """The symbol model of all words of the table; the driver gets at most 4,422 counts."""
    cells = df.select(utf8(F.col(text_col)).alias("text")).mapInArrow(symbol_rows, "cell int, n bigint")
    counts = np.zeros((len(SYMBOLS) + 1) * len(SYMBOLS), np.int64)
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    return Words(counts.reshape(-1, len(SYMBOLS)))


def judge_of(words: Words) -> Cache:
    return Cache(lambda token: bin_of(token, words), limit=50_000)


def bins_udf(words: Words):
    """Column function: text to (bin, hash) of each of its different tokens."""

    @arrow_udf("array<struct<bin: int, hash: bigint>>")
    def bins(texts: pa.Array) -> pa.Array:
        judged, out = judge_of(words), []
        for t in texts:
            text = t.as_py() or ""
            found = {text[a:b] for a, b in spans_of_tokens(text, base_spans(text))}
            out.append([{"bin": judged[x], "hash": int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True)} for x in found])
        return pa.array(out, pa.list_(pa.struct([("bin", pa.int32()), ("hash", pa.int64())])))

    return bins


@dataclass(frozen=True)
class Rule:
    """What decides about tokens: the words of the corpus and the bin from which ratios are flagged."""

    words: Words
    least: int | None


def corpus_rule(df: DataFrame, text_col: str = "text", max_false: float = 0.05) -> Rule:
    """The rule that every word and every distinct token of the table give.

    Two passes; the driver gets the symbol counts and at most ``TOP_BIN`` + 2 bins.
    """
    words = corpus_words(df, text_col)
    each = df.select(F.explode(bins_udf(words)(F.col(text_col))).alias("t")).select("t.*").distinct()
    bins = each.groupBy("bin").count().collect()
    return Rule(words, threshold({r["bin"]: r["count"] for r in bins}, max_false))


FOUND = "n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string, redacted string"
_FOUND_ARROW = pa.struct([(n, pa.int64()) for n in ("n_assign", "n_access", "n_hex", "n_random")] + [(n, pa.string()) for n in ("base_sha256", "spans", "redacted")])


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """``text`` with every union of overlapping spans replaced by ``mask``."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def scan_udf(rule: Rule, mask: str | None):
    """Column function: text to ``FOUND`` (``redacted`` null where nothing was found or no mask is given)."""

    @arrow_udf(FOUND)
    def scanned(texts: pa.Array) -> pa.Array:
        rows, judged = [], judge_of(rule.words)
        for t in texts:
            text = t.as_py() or ""
            base = base_spans(text)
            more = [(s, 3, e) for s, e in flagged(text, base, judged, rule.least)]
            spans = sorted(base + more) if more else base
            n = [0, 0, 0, 0]
            for _, kind, _ in spans:
                n[kind] += 1
            rows.append((*n, hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans), redact(text, spans, mask) if mask is not None and spans else None))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FOUND_ARROW)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW, strict=True)], fields=list(_FOUND_ARROW))

    return scanned


def secret_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_false: float = 0.05) -> DataFrame:
    """Counts and spans of every row; whole texts, a row per row.

    Spans are ``kind:start:end`` in code points, end exclusive, ordered by start
    and kind.  A null or empty text has none; texts of any length are scanned
    whole, in time linear in their length.  Of equal spans both kinds are told.
    Repeated rows and null ids are scanned as they come; other columns are not
    read; an empty table gives no rows.
    """
    rule = corpus_rule(df, text_col, max_false)
    rows = df.select(F.col(id_col), scan_udf(rule, None)(F.col(text_col)).alias("_found"))
    return rows.select(id_col, "_found.*").drop("redacted")


def redact_secrets(df: DataFrame, text_col: str = "text", mask: str = "[secret]", max_false: float = 0.05, length_col: str | None = None) -> DataFrame:
    """``df`` with every span of a text replaced by ``mask``; all rows and columns stay, names and types as they were.

    ``length_col``, where given, is set to the length of a text that changed.
    Null, empty and clean texts stay as they are; the rules of ``secret_report``
    hold, and an empty table stays empty.
    """
    rule = corpus_rule(df, text_col, max_false)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(whole.alias("_row"), scan_udf(rule, mask)(F.col(text_col)).alias("_found"))
    return replaced(rows, df, text_col, F.col("_found.redacted"), F.col("_found.redacted").isNotNull(), length_col)
