"""Exact deduplication by a tree-merge of sorted digest runs.

Each row becomes an entry (digest of the normalised text, best id, row count).
The entries start in lanes chosen by the row id, so copies of one text lie in
many lanes.  Lanes are numbered in a mixed radix; in round k the lanes that
differ only in digit k exchange entries, each keeping one slice of the digest
range, and every lane merges the runs it received, sorted by digest, folding
equal digests into one entry.  After the last round each lane holds a complete,
duplicate-free slice of the digests.  A group of copies that holds a third of
all rows is down to one entry per lane after the first fold and to one entry
per radix-many runs in every later one, so no task ever sees it whole.

Equal digests are verified: entries are equal only when SHA-256 and byte length
of the whole normalised text agree, the 64-bit run key just orders them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from salesmart.llm.common import land, lane, shuffle_width, utf8, values

RUN = "lane int, run_key bigint, digest binary, n_bytes bigint, keep_id bigint, n_rows bigint"
_RUN_ARROW = pa.schema([("lane", pa.int32()), ("run_key", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("keep_id", pa.int64()), ("n_rows", pa.int64())])
CHUNK = 8192  # entries per Arrow batch that leaves a merge


def digest_udf():
    """Column function: UTF-8 bytes to the SHA-256 of the text with A-Z lower-cased (``bytes.lower`` changes nothing else)."""

    @arrow_udf("run_key bigint, digest binary, n_bytes bigint")
    def digested(texts: pa.Array) -> pa.Array:
        digests, sizes = [], []
        for t in texts:
            raw = t.as_py() or b""
            digests.append(hashlib.sha256(raw.lower()).digest())
            sizes.append(len(raw))
        keys = [int.from_bytes(d[:8], "big", signed=True) for d in digests]
        return pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())], ["run_key", "digest", "n_bytes"])

    return digested


def with_digest(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, run_key, digest, n_bytes, *more) of every row."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), digest_udf()(utf8(F.col(text_col))).alias("d"), *more)
    return rows.select("id", "d.*", *[c for c in rows.columns if c not in ("id", "d")])


def radices(width: int, most: int = 3) -> list[int]:
    """Bits exchanged in each round, so that the lanes number at least ``width``; at most 2**``most`` runs meet in one merge."""
    bits = max(1, (max(2, width) - 1).bit_length())
    rounds = -(-bits // most)
    return [bits // rounds + (k < bits % rounds) for k in range(rounds)]


def merge_runs(smallest: bool):
    """Fold sorted entries: equal (digest, length) in one lane become one entry with the id that stays."""
    better = min if smallest else max

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        lane_, key, digest, size, keep, n = None, None, None, None, None, 0
        for batch in batches:
            for row in zip(*map(values, batch.columns), strict=True):
                if row[2] == digest and row[3] == size and row[0] == lane_:
                    if row[4] is not None:
                        keep = row[4] if keep is None else better(keep, row[4])
                    n += row[5]
                    continue
                if n:
                    out.append((lane_, key, digest, size, keep, n))
                    if len(out) >= CHUNK:
                        yield _batch(out)
                        out = []
                lane_, key, digest, size, keep, n = row
        if n:
            out.append((lane_, key, digest, size, keep, n))
        if out:
            yield _batch(out)

    return fold


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RUN_ARROW, strict=True)], schema=_RUN_ARROW)


def tree_merge(entries: DataFrame, bits: list[int], smallest: bool = False) -> DataFrame:
    """Complete groups (run_key, digest, n_bytes, keep_id, n_rows) from entries in 2**sum(bits) lanes.

    ``entries`` has the columns of ``RUN``.  Round k replaces the lane's k-th
    digit by the digest's, most significant first.
    """
    lanes, total = 1 << sum(bits), sum(bits)
    # The digest's own lane: the leading bits of its run key.
    home = F.shiftrightunsigned(F.col("run_key"), 64 - total).cast("int")
    fold = merge_runs(smallest)
    done = 0
    for width in bits:
        done += width
        digit = ((1 << width) - 1) << (total - done)
        moved = F.col("lane").bitwiseAND(F.lit((lanes - 1) ^ digit)).bitwiseOR(home.bitwiseAND(F.lit(digit)))
        entries = (
            entries.withColumn("lane", moved)
            .repartitionById(lanes, F.col("lane"))
            .sortWithinPartitions("run_key", "digest", "n_bytes")
            .mapInArrow(fold, RUN)
        )
    return entries.drop("lane")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", payload: Column | None = None) -> DataFrame:
    """One row per row of ``df``: id, digest, keep_id, group_size, kept (and ``payload``).

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    ``keep`` names the row of a group that stays, the ``largest`` or
    ``smallest`` id.  A null id loses to any other; a group of null ids only
    keeps one of its rows and has a null keep_id.  Rows that repeat the kept id
    within a group are kept once.  Texts of any length are digested whole, empty
    ones are a group like others.  Other columns of ``df`` are not read, unless
    in ``payload``.  An empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    smallest = keep == "smallest"
    bits = radices(shuffle_width(df.sparkSession))
    lanes = 1 << sum(bits)
    in_lane = lane(F.col("id"), lanes).alias("lane")
    # The digests are landed, so the texts are read once for all rounds.
    rows = land(with_digest(df, id_col, text_col), "digests")
    entries = rows.select(in_lane, "run_key", "digest", "n_bytes", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("n_rows"))
    runs = entries.sortWithinPartitions("run_key", "digest", "n_bytes", "lane").mapInArrow(merge_runs(smallest), RUN)
    groups = tree_merge(runs, bits, smallest)
    copied = groups.where("n_rows > 1").withColumnRenamed("n_rows", "group_size")
    # Back to the rows by lane: a hot group is joined as one row per lane first.
    key = ["run_key", "digest", "n_bytes"]
    by_lane = entries.select("lane", *key).distinct().join(copied, key)
    source = rows if payload is None else with_digest(df, id_col, text_col, payload.alias("payload"))
    joined = source.withColumn("lane", lane(F.col("id"), lanes)).join(by_lane, ["lane", *key], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    size = F.coalesce("group_size", F.lit(1).cast("bigint"))
    # Rows that repeat one id and text: the first of them stands for all.
    nth = F.row_number().over(Window.partitionBy("lane", *key, "id").orderBy("id"))
    return joined.select(
        "id",
        "digest",
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        (F.col("id").eqNullSafe(keep_id) & (nth == 1)).alias("kept"),
        *(["payload"] if payload is not None else []),
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``df`` without the rows whose text another row repeats; all columns, names and types as they were.

    The rules of ``exact_groups`` hold.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return exact_groups(df, id_col, text_col, keep, whole).where("kept").select("payload.*")
