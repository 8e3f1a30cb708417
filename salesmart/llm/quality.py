"""Line-first quality rules.

Every line is judged on its own; failing lines are removed, and a document that
loses too much of its text is rejected.  A line without a word is kept.  A line
fails when it

- is *unpunctuated*: does not end in sentence punctuation (closing quotes and
  brackets may follow) and has no sentence end for every ``SENTENCE`` words;
- is *navigation*: has two or more menu separators, one per four words or more;
- is *boilerplate*: holds a notice phrase (rights, terms, cookies, licences);
- is *symbols*: has more of ``#*$%&|<>!`` than words.

Whole-document base rules run beside the line rules: too few words, or too many
words in repeated three-word windows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

SENTENCE = 30
ENDS = r"""[.!?…。！？]["'”’»)\]]*[\x20\x09-\x0D]*"""
STOPS = r"""[.!?…。！？]["'”’»)\]]*[\x20\x09-\x0D]"""
SEPARATORS = "[|»›•]"
SYMBOLS = "[#*$%&|<>!]"
NOTICES = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies"
    "|enable javascript|lorem ipsum|is licensed under|subscribe to our"
)
BASE_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeated_percent: int = 50  # of words in repeated three-word windows
    max_lost_percent: int = 40  # of characters in removed lines


_ENDS = re.compile(f"(?:{ENDS})\\Z").search
_STOPS = re.compile(STOPS).findall
_SEPARATORS = re.compile(SEPARATORS).findall
_SYMBOLS = re.compile(SYMBOLS).findall
_NOTICES = re.compile(NOTICES, re.IGNORECASE).search


def line_fails(line: str, n_words: int) -> bool:
    """Whether a line that has ``n_words`` > 0 words is removed."""
    if not _ENDS(line) and SENTENCE * len(_STOPS(line)) < n_words:
        return True
    if _NOTICES(line) or len(_SYMBOLS(line)) > n_words:
        return True
    separators = len(_SEPARATORS(line))
    return separators >= 2 and 4 * separators >= n_words


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice, each word counted once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen: set[tuple] = set(windows)
    if len(seen) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    count, covered = 0, 0  # covered: words before this position are counted
    for at, w in enumerate(windows):
        if w in twice:
            count += at + 3 - max(at, covered)
            covered = at + 3
    return count


JUDGED = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, n_removed_lines bigint, lost_chars bigint, clean_text string"
)
_JUDGED_ARROW = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_removed_lines", pa.int64()), ("lost_chars", pa.int64()), ("clean_text", pa.string())]
)


def judge(text: str | None, limits: Limits) -> tuple:
    """The fields of ``JUDGED`` for one whole text."""
    raw = (text or "").encode("utf-8")
    words = raw.split()  # ASCII white space: \x20 and \x09-\x0D
    n_symbols = len(raw) - len(raw.translate(None, BASE_SYMBOLS))
    repeats = repeated_words(words)
    lines = (text or "").split("\n")
    seen: set[str] = set()
    kept_lines, dups, removed, lost, total = [], 0, 0, 0, 0
    for line in lines:
        n = len(line.encode("utf-8").split())
        if n:
            if line in seen:
                dups += 1
            else:
                seen.add(line)
            total += len(line)
            if line_fails(line, n):
                removed += 1
                lost += len(line)
                continue
        kept_lines.append(line)
    failed = len(words) < limits.min_words or 100 * repeats > limits.max_repeated_percent * len(words)
    keep = not failed and 100 * lost <= limits.max_lost_percent * total
    chars = sum(map(len, words)) if raw.isascii() else len(b"".join(words).decode("utf-8"))
    clean = "\n".join(kept_lines) if removed else None
    return len(words), chars, n_symbols, dups, repeats, failed, keep, removed, lost, clean


def judge_udf(limits: Limits, with_text: bool):
    """Column function: text to ``JUDGED`` (``clean_text`` null unless ``with_text`` and lines were removed)."""

    @arrow_udf(JUDGED)
    def judged(texts: pa.Array) -> pa.Array:
        rows = [judge(t.as_py(), limits) for t in texts]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(_JUDGED_ARROW)
        if not with_text:
            columns[-1] = [None] * len(rows)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _JUDGED_ARROW, strict=True)], fields=list(_JUDGED_ARROW))

    return judged


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Counts and verdict of every row (``JUDGED`` without the text); a row per row, whole texts.

    A null or empty text has no words: all counts are 0, ``base_failed`` is true
    and ``kept`` false.  A text of any length is judged whole, in one task; each
    of its three-word windows costs a few dozen bytes there.  Repeated rows and
    null ids are judged as they come; other columns are not read; an empty table
    gives no rows.
    """
    rows = df.select(F.col(id_col), judge_udf(limits, with_text=False)(F.col(text_col)).alias("_judged"))
    return rows.select(id_col, "_judged.*").drop("clean_text")


def quality_filter(df: DataFrame, text_col: str = "text", limits: Limits = Limits(), length_col: str | None = None) -> DataFrame:
    """The kept rows of ``df`` with their failing lines removed; all columns, names and types as they were.

    ``length_col``, where given, is set to the length of a text that changed.
    Rows with a null or empty text go; repeated rows are kept or go alike; the
    rules of ``quality_report`` hold, and an empty table stays empty.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # Else the filter would be pushed below, and every text judged twice.
    judged = judge_udf(limits, with_text=True).asNondeterministic()
    rows = df.select(whole.alias("_row"), judged(F.col(text_col)).alias("_judged")).where("_judged.kept")
    return replaced(rows, df, text_col, F.col("_judged.clean_text"), F.col("_judged.n_removed_lines") > 0, length_col)


def replaced(rows: DataFrame, df: DataFrame, text_col: str, text, changed, length_col: str | None) -> DataFrame:
    """The columns of ``df`` from the struct ``_row``, with the new text and length where ``changed``."""
    out = []
    for f in df.schema.fields:
        old = F.col("_row").getField(f.name)
        if f.name == text_col:
            old = F.when(changed, text).otherwise(old)
        elif f.name == length_col:
            old = F.when(changed, F.char_length(text)).otherwise(old)
        out.append(old.cast(f.dataType).alias(f.name))
    return rows.select(*out)
