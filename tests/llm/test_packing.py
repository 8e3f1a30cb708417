import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from salesmart.llm.packing import cut, harmonic_pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
CAP = 2048


def check(df, capacity=CAP):
    """Every id in one piece, sequences gapless; the share of padding."""
    reference = Tokenizer.from_file(PATH)
    wanted = defaultdict(int)
    documents = defaultdict(int)
    for r in df.select("doc_id", "text").collect():
        ids = np.array([*reference.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        documents[r["doc_id"]] += len(ids)
        at = 0
        for n in cut(len(ids), capacity, capacity // 64):
            wanted[(r["doc_id"], at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids))] += 1
            at += n
        assert at == len(ids)
    rows = harmonic_pack(df, PATH, public_tokenizers.PATTERN, capacity=capacity).collect()
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == wanted
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
        used += at
        padded += 0 if at & (at - 1) == 0 else capacity - at
    return padded / max(1, used + padded)


def test_documents(docs):
    assert check(docs) < 0.03


def test_edge_rows(edge):
    check(edge)


def test_added_token_in_a_text(spark):
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "x<|endoftext|>")], "doc_id bigint, text string")
    check(df)


def test_many_workers_and_small_capacity(spark, docs):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert check(docs.limit(60), 128) < 0.05
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pieces_fill_their_classes():
    for n in range(1, 5000):
        lengths = cut(n, CAP, 32)
        assert sum(lengths) == n
        for m in lengths:
            k = CAP // m
            assert CAP - k * m <= max(32, k)


def test_empty_table(empty):
    assert harmonic_pack(empty, PATH, public_tokenizers.PATTERN).collect() == []
