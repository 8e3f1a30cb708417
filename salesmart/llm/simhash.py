"""SimHash near-duplicates: fingerprints of word shingles, linked by a trie self-join."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from xxhash import xxh64_intdigest

from salesmart.llm.common import land, lane, shuffle_width, utf8
from salesmart.llm.components import components
from salesmart.llm.trie_join import near_edges

SEED = 42
BLOCK = 1 << 16  # shingles hashed at once
# Bit j of byte value b, for all b and j.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLANE = np.arange(8) * 256


def fingerprint(raw: bytes, shingle: int) -> int:
    """64-bit SimHash of a text: bit set where over half of the shingles' hashes have it set.

    Words are runs of non-white ASCII; A-Z are lower-cased; fewer words than a
    shingle make one shingle of all; a text without words has fingerprint 0.
    """
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n], ends[min(shingle, len(words)) - 1 :]
    ones = np.zeros((8, 8), np.int64)
    for k in range(0, n, BLOCK):
        parts = [joined[a:b] for a, b in zip(starts[k : k + BLOCK].tolist(), ends[k : k + BLOCK].tolist(), strict=True)]
        hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
        # Count byte values per byte position, then their bits.
        cells = hashes.view(np.uint8).reshape(-1, 8) + _PLANE
        ones += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * ones > n).ravel(), bitorder="little").tobytes(), "little")


def fingerprint_udf(shingle: int):
    """Column function: UTF-8 bytes to the fingerprint as a signed bigint."""

    @arrow_udf("bigint")
    def prints(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], np.uint64)
        return pa.array(values.view(np.int64))

    return prints


def print_components(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) of every fingerprint that a link connects to another; ``prints`` holds distinct ``fp``."""
    width = shuffle_width(prints.sparkSession)
    # A few subtrees for each shuffle partition.
    bits = min(16, max(4, width.bit_length() + 1))
    return components(near_edges(prints, "fp", bits, max_bits)).withColumnRenamed("vertex", "fp")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``df``: id, fp (bigint) and component_id, the smallest id that links reach.

    Fingerprints that differ in at most ``max_bits`` bits are linked, equal ones
    included; a null text counts as empty.  A null id belongs to the component
    of its text but is never its name, unless all ids there are null.  Texts of
    any length are read whole, empty ones have fingerprint 0.  Repeated rows
    stay; other columns are not read; an empty table gives an empty result.
    """
    rows = land(df.select(F.col(id_col).cast("bigint").alias("id"), fingerprint_udf(shingle)(utf8(F.col(text_col))).alias("fp")), "prints")
    return named(rows, max_bits).select("id", "fp", "component_id")


def named(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (id, fp, more) with component_id and root, the component's smallest fingerprint."""
    lanes = shuffle_width(rows.sparkSession)
    in_lane = lane(F.col("id"), lanes)
    # A fingerprint shared by many rows is one row per lane from here on.
    by_lane = rows.groupBy("fp", in_lane.alias("lane")).agg(F.min("id").alias("least"))
    prints = land(by_lane.groupBy("fp").agg(F.min("least").alias("least")), "fps")
    linked = print_components(prints, max_bits)
    rooted = prints.join(linked, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = rooted.join(names, "root").select("fp", "component_id", "root")
    return rows.withColumn("lane", in_lane).join(by_lane.select("fp", "lane").join(names, "fp"), ["fp", "lane"]).drop("lane")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``df`` with one row of each component, the one with the smallest id; all columns, names and types as they were.

    The rules of ``simhash_components`` hold; of rows that repeat the smallest
    id one stays.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("payload")
    fp = fingerprint_udf(shingle)(utf8(F.col(text_col))).alias("fp")
    # Landed with a number of their own, as ids may repeat or be null.
    rows = land(df.select(F.col(id_col).cast("bigint").alias("id"), fp, F.monotonically_increasing_id().alias("row"), whole), "texts")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    stays = named(rows.select("id", "fp", "row"), max_bits).groupBy("root").agg(first.alias("first")).select("first.row")
    return rows.join(stays, "row", "left_semi").select("payload.*")
