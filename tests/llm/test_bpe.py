import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


CODEC = bpe.codec(PATH, public_tokenizers.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "e", "th", "ing", " ", "  ", "\n", "\t", "é", "中", "😀", "0", "12", ".", "'s", "==", "\x1c", "\xa0", " ", "\x00", "²", "İ"])).map("".join) | st.text())
def test_same_ids_as_the_library(reference, text):
    ids = CODEC.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, "=" * 9000, " " * 3000, "thequickbrown" * 900])
def test_long_pieces(reference, text):
    assert CODEC.encode(text) == reference.encode_ordinary(text)


def test_multilingual_ranks(reference):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.BytePairCodec(path, public_tokenizers.PATTERN)
    for text in ("Die Straße über den Fluß, 12 345 Mal.", "naïve façade " * 50, "привет мир 你好 " * 20):
        assert own.encode(text) == other.encode_ordinary(text)


def expected(reference, text):
    ids = reference.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_digests_of_a_table(spark, docs, edge, reference):
    for df in (docs, edge):
        got = sorted(map(str, bpe.round_trip_digest(df, PATH, public_tokenizers.PATTERN).collect()))
        want = bpe.round_trip_digest(df.limit(0), PATH, public_tokenizers.PATTERN)
        rows = [(r["doc_id"], *expected(reference, r["text"])) for r in df.select("doc_id", "text").collect()]
        assert got == sorted(map(str, spark.createDataFrame(rows, want.schema).collect()))


def test_encode_and_decode_columns(docs):
    enc, dec = bpe.encode_udf(PATH, public_tokenizers.PATTERN), bpe.decode_udf(PATH, public_tokenizers.PATTERN)
    back = docs.limit(50).select("text", dec(enc("text")).cast("string").alias("again"))
    assert back.where("text <> again").count() == 0


def test_empty_table(empty):
    assert bpe.round_trip_digest(empty, PATH, public_tokenizers.PATTERN).collect() == []
