import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lexspark.llm import pfor, token_count, tokens

NASTY = [None, "", " ", "\n", "  a  b\n\n c \t  x\n ", "\x00\x01 <|endoftext|> it's 12 34 é漢字🙂 ", "a" * 3000, " " * 500 + "x", "x \n y", "Of. And,the;end", "um dois  três", "fim "]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return tokens.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def whole():
    return tokens.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(raw, kind="<u4"):
    return np.frombuffer(raw, kind).tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_both_encoders_agree_with_the_library(reference, bpe, whole, text):
    want = reference.encode_ordinary(text)
    assert _ids(next(bpe.encode([text]))) == want
    assert _ids(next(whole.encode([text])), whole.kind) == want
    assert bpe.decode(np.array(want, np.int64)) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "of", " ", "\n", ".", ",", "  ", "\t", "é", "12", "'s", " "]), max_size=30))
def test_chunked_encoding_at_every_kind_of_boundary(reference, whole, parts):
    text = "".join(parts)
    assert _ids(next(whole.encode([text])), whole.kind) == reference.encode_ordinary(text)


def test_cache_generations_keep_results(reference):
    texts = [f"palavra{k} outra{k} comum" for k in range(200)]
    own = tokens.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own.cache.limit = 10
    assert [_ids(x) for x in own.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_encode_decode_rows(spark, reference):
    rows = [(k, t, "x") for k, t in enumerate(NASTY)] + [(3, NASTY[4], "x"), (None, "sem id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokens.encode_decode(df).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert tokens.encode_decode(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=400), min_size=1, max_size=5), st.data())
def test_segments_round_trip_and_ranges(docs, data):
    ids = np.array([x for d in docs for x in d], np.uint32)
    raw = pfor.encode_segment(ids, np.arange(len(docs)), np.array([len(d) for d in docs]))
    seg = pfor.Segment(raw)
    assert seg.ids().tolist() == ids.tolist()
    a = data.draw(st.integers(0, len(ids)))
    z = data.draw(st.integers(a, len(ids)))
    assert seg.ids(a, z).tolist() == ids[a:z].tolist()
    assert [seg.doc(k).tolist() for k in range(len(docs))] == docs


def test_segments_of_small_ids_are_small():
    ids = np.random.default_rng(0).integers(0, 100, 100_000).astype(np.uint32)
    ids[::64] = 50_000  # outliers go to the exception lists
    assert len(pfor.encode_segment(ids, np.array([1]), np.array([len(ids)]))) < 1.2 * len(ids)
    with pytest.raises(ValueError):
        pfor.Segment(b"nope" + bytes(100))


def test_token_files_read_back(spark, reference, monkeypatch):
    monkeypatch.setattr(pfor, "FILE_DOCS", 4)
    rows = [(100 - k, t, 0) for k, t in enumerate(NASTY)] + [(7, "igual", 0)] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in pfor.token_files(df).orderBy("start").collect()]
    want, before = [], 0
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        ids = [*reference.encode_ordinary(t or ""), 2]
        want.append((i, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        before += len(ids)
    assert got == want
    nulls = spark.createDataFrame([(None, "a"), (1, "b"), (None, None)], "doc_id long, text string")
    assert [r.doc_id for r in pfor.token_files(nulls).orderBy("start").collect()] == [None, None, 1]
    assert pfor.token_files(df.limit(0)).count() == 0


def test_separator_counts(spark, reference):
    rows = [(k, t) for k, t in enumerate(NASTY)] + [(None, "abc def")] + [(50, "x y z")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (1, 2, 7, 1 << 18):  # separators at, before and after block edges
        got = sorted(((r.doc_id, r.n_tokens) for r in token_count.count_tokens(df, block_ids=block).collect()), key=str)
        assert got == sorted(((i, len(reference.encode_ordinary(t or ""))) for i, t in rows), key=str)
    assert token_count.count_tokens(df.limit(0)).count() == 0


def test_files_that_last_hash_extremes_and_long_texts(spark, reference, tmp_path):
    rows = [(k, "lcov)~,2") for k in range(5)] + [(5, "word and more " * 60_000), (6, "x" * 200_000), (5, "lcov)~,2")]  # the hash of the first is -2**31
    df = spark.createDataFrame(rows, "doc_id long, text string")
    at = f"file://{tmp_path}/files"
    got = sorted((r.doc_id, r.n_tokens) for r in pfor.token_files(df, destination=at).collect())
    assert got == sorted((i, len(reference.encode_ordinary(t)) + 1) for i, t in rows)
    assert sorted((r.doc_id, r.n_tokens) for r in pfor.read_index(pfor.open_files(spark, at)).collect()) == got
    counts = sorted((r.doc_id, r.n_tokens + 1) for r in token_count.count_tokens(df, block_ids=1000).collect())
    assert counts == got


def test_separator_counts_ignore_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 7, 8, 9)], "doc_id long, text string, file int, ids int, n_tokens int")
    assert [(r.doc_id, r.n_tokens) for r in token_count.count_tokens(df).collect()] == [(1, 2)]


def test_pieces_map_back(bpe):
    assert [tokens.unpiece(tokens.piece(t)) for t in bpe.whole] == list(bpe.whole) == bpe.bytes_of


def test_rows_without_id_are_spread_over_files(spark, monkeypatch):
    monkeypatch.setattr(pfor, "FILE_DOCS", 50)
    rows = [(None, "one text for all rows without id") for _ in range(600)] + [(k, f"text {k}") for k in range(200)] + [(7, "the same id") for _ in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    scratch = pfor.Scratch(spark, "test")
    files = pfor.write_ids(df, scratch, public_tokenizers.path("byte_bpe_50k.json"))
    held = {r["file"]: r["n"] for r in files.groupBy("file").agg(F.sum("n_docs").alias("n")).collect()}
    assert sum(held.values()) == 1000 and max(held.values()) < 300 and len(held) >= 12
    out = pfor.read_index(files).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None] * 600 + sorted([*range(200), *[7] * 200])
    at = 0
    for r in out:
        assert r.start == at
        at += r.n_tokens
