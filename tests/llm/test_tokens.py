import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of
from tradelens.llm import bpe, counts, token_files
from tradelens.llm._shared import PieceMemo, byte_slices

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def u4(ids):
    return np.array(ids, "<u4").tobytes()


def key(row):
    return tuple((x is not None, x) for x in row)


@settings(max_examples=300, deadline=None)
@given(st.text() | st.lists(st.sampled_from(["a", " ", "  ", "\n", "\x1c", "　", "'ll", "é", "9", "!?", "<|endoftext|>", "中", "the"])).map("".join))
def test_bpe_equals_library(text):
    text = text.encode("utf-8", "replace").decode()
    own, lib = bpe.load(BYTE), LIBRARY[BYTE]
    ids = lib.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == u4(ids)
    assert own.decode(u4(ids)) == lib.decode(ids, skip_special_tokens=False)


def test_decode_of_any_ids_equals_library():
    own, lib, rng = bpe.load(BYTE), LIBRARY[BYTE], random.Random(0)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(6))]
        assert own.decode(u4(ids)) == lib.decode(ids, skip_special_tokens=False)
    assert own.decode(u4([64, 10**9, 65])) == own.decode(u4([64, 65]))


def test_bpe_digests(docs):
    lib = LIBRARY[BYTE]
    want = []
    for r in docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(u4(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows_of(bpe.digests(docs, BYTE)) == sorted(want, key=key)


def test_encode_then_decode_keeps_columns(spark):
    df = spark.createDataFrame([(1, "two words", "x"), (2, None, "y")], "doc_id long, text string, ids string")
    out = rows_of(bpe.decode(bpe.encode(df, BYTE), BYTE))
    assert [(r[0], r[1], r[3]) for r in out] == [(1, "two words", "two words"), (2, None, "")]


def test_token_counts(docs):
    lib = LIBRARY[WORD]
    want = []
    for r in docs.collect():
        n = len(lib.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    assert rows_of(counts.token_counts(docs, WORD)) == sorted(want, key=key)


def test_counts_of_very_long_texts_and_clashing_columns(spark):
    texts = ["word, next. " * 20_000, "w" * 90_000 + ".", "x y " * 50_000 + "Z" * 7000]
    docs = spark.createDataFrame([(i, t, "s", 5) for i, t in enumerate(texts)], "doc_id long, text string, _source string, N_tokens int")
    want = [(i, len(t.encode()), n := len(LIBRARY[WORD].encode(t, add_special_tokens=False).ids), n > 2048) for i, t in enumerate(texts)]
    assert rows_of(counts.token_counts(docs, WORD)) == want


def test_counts_refuse_a_tokenizer_that_keeps_blanks():
    with pytest.raises(ValueError):
        counts.load(BYTE)


def test_token_files(docs):
    lib = LIBRARY[WORD]
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
    want, start = [], 0
    for doc, text in rows:
        ids = lib.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(u4(ids))))
        start += len(ids)
    assert rows_of(token_files.token_file_digests(docs, WORD)) == sorted(want, key=key)


def test_word_numbers_equal_library(monkeypatch):
    """Odd case, dots and white space, words of any length, and forgetting in between."""
    lib, rng = LIBRARY[WORD], random.Random(5)
    bits = ["\u00c9COLE.", "\u00c9t\u00c9, ", "a.", "A,b.", "don't.", "K\u212a.", "\u0130x.", "\u03a3\u03a3. ", "x\u0301.", "e.\u00a0f", "12.", "3,", "..", ".,", "z.\x0b", "q.\x1d", "\u00df.",
            "<|EndOfText|>.", "W" * 9000 + ".", "\n", "\t", " ", "  ", "the cat, sat.", "\ufb01.", "\u2003"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 12))) for _ in range(150)] + ["", "word " * 60_000 + "w" * 80_000]
    coded = [lib.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    for kept in (400_000, 3):
        monkeypatch.setattr(token_files, "KEPT", kept)
        words = token_files.WordIds(WORD)
        for i in range(0, len(texts), 20):
            ids, sizes = words.of(pa.array(texts[i:i + 20]), 1)
            assert sizes.tolist() == [len(c) for c in coded[i:i + 20]] and ids.tolist() == [x for c in coded[i:i + 20] for x in c]


def test_one_doc_id_in_many_files(spark):
    rows = [(7, f"text {i:04d} of the same id") for i in range(600)] + [(None, f"null {i}") for i in range(200)] + [(8, "last")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, Start string").repartition(6)
    lib, want, start = LIBRARY[WORD], [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1])):
        ids = lib.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(u4(ids))))
        start += len(ids)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(token_files.token_file_digests(docs, WORD)) == sorted(want, key=key)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_added_tokens_in_other_cases_equal_library(spark):
    lib = LIBRARY[WORD]
    texts = ["<|ENDOFTEXT|>", "x<|EndOfText|>.", "a<|STARTOFTEXT|>b", "A<|endoftext|>B.", "<|endoftext|><|ENDOFTEXT|>, Ab.", "Plain <|StartOfText|>Cd, <|startoftext|>"]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    coded = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [r[2] for r in rows_of(counts.token_counts(docs, WORD))] == [len(ids) for ids in coded]
    starts = np.cumsum([0, *(len(ids) + 1 for ids in coded)]).tolist()
    want = [(i, start, len(ids) + 1, zlib.crc32(u4(ids + [1]))) for (i, _), start, ids in zip(rows, starts, coded)]
    assert rows_of(token_files.token_file_digests(docs, WORD)) == want


def test_empty_tables(empty):
    assert bpe.digests(empty, BYTE).count() == counts.token_counts(empty, WORD).count() == token_files.token_file_digests(empty, WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), max_size=3000), st.integers(0, 3000), st.integers(0, 3000))
def test_pfor_round_trip_and_range(tmp_path_factory, ids, start, n):
    uri = f"{tmp_path_factory.mktemp('pfor')}/x.pfor"
    w = token_files.Writer(uri)
    w.add(np.array([7]), np.array([False]), np.array(ids, np.uint32), np.array([len(ids)]))
    w.close()
    r = token_files.Reader(uri)
    n = max(0, min(n, len(ids) - start))
    assert r.read(start, n).tolist() == ids[start:start + n]
    assert r.n.tolist() == [len(ids)] and r.doc_id.tolist() == [7]


def test_outliers_become_exceptions():
    ids = np.full(1024, 100, np.uint32)
    ids[::64] = 40_000
    ids[::3] = 101
    block = token_files.pack(ids)[0]
    _, n, odd, width = token_files.HEAD.unpack_from(block)
    assert (n, width) == (1024, 1) and odd == int((ids == 40_000).sum())
    assert token_files.unpack(block, np.array([0])).tolist() == ids.tolist()


def test_piece_memo_is_bounded_and_right():
    memo = PieceMemo(lambda ps: [p.upper() for p in ps], cap=10, longest=3)
    rng = random.Random(2)
    for _ in range(2000):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(6)))
        assert memo[p] == p.upper()
        assert len(memo) <= 10 and len(memo.old) <= 10
    pieces = {chr(97 + i) * (1 + i % 5) for i in range(26)}
    rest = memo.learn(pieces)
    assert all((rest.get(p) or memo[p]) == p.upper() for p in pieces)


def test_byte_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 100, "", "c"] * 20)], names=["t"])
    parts = list(byte_slices(batch, "t", 64))
    assert pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches([batch]).to_pylist()
    assert all(p.num_rows for p in parts) and len(parts) > 20
