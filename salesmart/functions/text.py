"""Text helpers as built-in column expressions (no Python worker in the plan).

* ``iso_duration_seconds``: ISO-8601 duration text such as ``PT1H2M3S`` to
  seconds; hours, minutes and seconds are picked up wherever they occur, days
  are ignored, NULL or empty text gives 0.
* ``date_of_iso``: the calendar date written at the start of an ISO timestamp.
* ``url_from_template`` / ``load_stamp``: string templates and run stamps.
* ``clean_value`` / ``clean_header``: remove the defects seen in landed CSV
  files (footnotes such as ``[e]`` at the end, a mis-decoded en dash, stray blanks).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 duration parts, read wherever they occur in the text,
# and the seconds each unit is worth (days are not read).
DURATION_PARTS = ((r"(\d+)H", 3600), (r"(\d+)M", 60), (r"(\d+)S", 1))

# Defect patterns of the landed files.
FOOTNOTE_TAIL = r"(\[[a-z]{1,2}\][ \t\r\n]*)+\z"  # only at the end of a value
MISDECODED_EN_DASH = "â€“"  # UTF-8 bytes of an en dash read as cp1252
EN_DASH = "–"
BLANKS = r"[ \t\r\n]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(text: Column, pattern: str) -> Column:
    # Leading zeros are dropped and up to 18 digits always fit a bigint, so no
    # cast failure is raised and caught per row; longer runs are beyond the int
    # range of the total anyway and give NULL.
    digits = F.regexp_replace(F.regexp_extract(text, pattern, 1), "^0+", "")
    n = F.length(digits)
    return F.when(n == 0, F.lit(0).cast("bigint")).when(n <= 18, digits.cast("bigint"))


def iso_duration_seconds(c) -> Column:
    """``PT#H#M#S`` to whole seconds (days ignored; NULL / '' give 0; a total
    beyond the int range gives NULL)."""
    text = F.coalesce(_c(c), F.lit(""))
    total = F.lit(0).cast("decimal(30,0)")
    for pattern, unit in DURATION_PARTS:
        total = total + _part(text, pattern).cast("decimal(20,0)") * F.lit(unit)
    return total.try_cast("int")


def date_of_iso(c) -> Column:
    """Date part of ISO-8601 text, independent of the session zone; bad text gives NULL."""
    return F.substring(_c(c), 1, 10).try_cast("date")


def url_from_template(template: str, key) -> Column:
    """``template.format(id=key)`` for a template with one ``{id}`` slot."""
    head, sep, tail = template.partition("{id}")
    if not sep:
        raise ValueError("template needs an {id} slot")
    return F.concat(F.lit(head), _c(key).cast("string"), F.lit(tail))


def load_stamp(run_ts: dt.datetime) -> Column:
    """ISO-8601 text of the run time, one value for every row of a run."""
    return F.lit(run_ts.isoformat())


def clean_value(c) -> Column:
    """Repair the dash, drop footnote tails, fold blank runs and trim."""
    v = F.replace(_c(c), F.lit(MISDECODED_EN_DASH), F.lit(EN_DASH))
    v = F.regexp_replace(v, FOOTNOTE_TAIL, "")
    v = F.regexp_replace(v, BLANKS, " ")
    return F.trim(v)


# The characters that cp1252 has for the bytes 0x80 to 0x9f, and these bytes as characters; five bytes have none.
_HIGH = [(bytes([b]).decode("cp1252"), chr(b)) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_CP1252, _BYTES = ("".join(side) for side in zip(*_HIGH))


def read_as_cp1252(c) -> Column:
    """What a text becomes when its UTF-8 bytes are read as cp1252 (the damage that ``repair_decoding`` undoes)."""
    return F.translate(F.decode(F.encode(_c(c), "UTF-8"), "ISO-8859-1"), _BYTES, _CP1252)


def redecoded(c) -> Column:
    """The text whose UTF-8 bytes were read as cp1252 to give this one; NULL where there is none.

    Bytes that cp1252 leaves open are taken as the control characters of the same number.
    """
    as_bytes = F.translate(_c(c), _CP1252, _BYTES)
    single = ~as_bytes.rlike("[^\\x{00}-\\x{ff}]") & as_bytes.rlike("[\\x{80}-\\x{ff}]")
    return F.when(single, F.try_validate_utf8(F.encode(as_bytes, "ISO-8859-1").cast("string")))


def repair_decoding(c, rounds: int = 3) -> Column:
    """A value whose UTF-8 bytes were read as cp1252, up to ``rounds`` times over, as it was written.

    A value changes only where all its characters are cp1252 bytes that make
    valid UTF-8, which gives fewer characters; accented text as it should be
    does not, since a lone accented letter is no valid UTF-8.  Values of which
    only a part is broken stay.
    """
    value = _c(c)
    for _ in range(rounds):
        value = F.coalesce(redecoded(value), value)
    return value


def clean_header(name: str) -> str:
    """Column name normaliser: trim (blanks, tabs, BOM) and join words with ``_``."""
    return re.sub(r"\s+", "_", name.replace("﻿", "").strip())
