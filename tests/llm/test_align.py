import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tradelens.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = ["▁ odd piece mark", "nul \x00 byte", "\xa0 \xa0 \xa0", "  two  blanks  ", "tab\tand\r\nline", "é é ﬁ \U0001f469‍\U0001f4bb",
        "<s> </s> <unk> <0x41> <|endoftext|>", "word " * 60_000, "x" * 150_000]


@pytest.fixture(scope="module")
def rows(spark, docs):
    odd = spark.createDataFrame([(2_000_000 + i, t) for i, t in enumerate(MORE)], "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(odd)


def plain(texts):
    """Each text's (n_a, n_b, groups, links) by comparing every end with every other."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    known = align.load(A, B)

    def spans(ids, size):
        at, out = 0, []
        for i in ids:
            at += len(size[i])
            out.append((i, at))
        return out
    for text in texts:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        raw = (" " + (text or "")).encode()
        if not text or b"".join(known.bytes_a[i] for i in ids_a) != raw or b"".join(known.bytes_b[i] for i in ids_b) != raw:
            yield 0, 0, [], []
            continue
        sa, sb = spans(ids_a, known.bytes_a), spans(ids_b, known.bytes_b)
        shared = sorted({e for _, e in sa} & {e for _, e in sb})
        last, groups, i, j = 0, [], 0, 0
        for end in shared:
            x, y = [], []
            while i < len(sa) and sa[i][1] <= end:
                x.append(sa[i][0])
                i += 1
            while j < len(sb) and sb[j][1] <= end:
                y.append(sb[j][0])
                j += 1
            groups.append((x, y))
        at = {e: t for t, e in sb}
        yield len(ids_a), len(ids_b), groups, [(t, at[e]) for t, e in sa if e in at]


def test_digests_against_brute_force(rows):
    got = rows_of(align.digests(rows, A, B))
    given = rows.collect()
    found = list(plain([r.text for r in given]))
    count = Counter(pair for f in found for pair in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    want = []
    for row, (n_a, n_b, groups, links) in zip(given, found):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want.append((row.doc_id, n_a, n_b, len(groups), len(links), hashlib.sha256(shown.encode()).hexdigest() if groups else "",
                     sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert got == sorted(want, key=key)
    assert len(count) <= align.load(A, B).most_pairs()


def test_tokens_without_bytes_link_with_all_that_end_there():
    class Small(align.Pair):
        def __init__(self):
            self.size_a, self.size_b, self.width, self.solid, self.key = np.array([1, 0, 2]), np.array([1, 0, 3]), 3, False, "<u4"
            self.name = [str(i) + mark for mark in align.MARKS for i in range(3)]

    one, two = Small().align(np.array([0, 1, 2, 0]), np.array([0, 1, 0, 0, 0, 1]), np.array([3, 1]), np.array([4, 2]))
    assert one[:4] == (3, 4, 2, "0,1|0,1;2|0,0") and two[:4] == (1, 2, 1, "0|0,1")
    assert np.frombuffer(one[4], "<u4").tolist() == [0 * 3 + 0, 0 * 3 + 1, 1 * 3 + 0, 1 * 3 + 1, 2 * 3 + 0]
    assert np.frombuffer(two[4], "<u4").tolist() == [0, 1]


def test_parts_encode_as_the_whole():
    pair = align.Pair(A, B)
    text = "It's  a  test, wéll then\n\n more 12 345 words.  " * 50
    cut = [pair.encode(p) for p in align.CUT.split(text)]
    whole = pair.encode(text)
    assert len(cut) > 200 and all(np.array_equal(whole[side], np.concatenate([c[side] for c in cut])) for side in (0, 1))


def test_parts_aligned_together_and_alone():
    pair = align.Pair(A, B)
    parts = [*dict.fromkeys([p for t in [*MORE, "plain words only", "a b\nc\td ee\xa0f g", " lead", "trail ", ""] for p in align.CUT.split(t)])]
    assert pair.aligned(parts) == [pair.alone(p) for p in parts]


def test_forgotten_parts_are_aligned_again(monkeypatch):
    monkeypatch.setattr(align, "KEPT", 3)
    texts = ["one two three", "four five one", "six seven eight nine", "one two", "▁ one", ""] * 2
    assert align.Pair(A, B).of(texts) == [align.Pair(A, B).of([t])[0] for t in texts]


def test_both_encoders_of_one_file_agree():
    pair = align.Pair(A, B)
    texts = [t for t in MORE if len(t) < 1000] + ["It's we'LL  a\u2003b \x1c\x1d x\x85y \u180e ½²٣ 'S's\u200b\ufeff  \n\n \t e\u0301", "\u3000" * 9 + "x", " " * 4000, "a" * 6000, "1" * 99]
    for text in texts:
        assert pair.fast.encode_ordinary(text) == pair.a.encode(text, add_special_tokens=False).ids, text


def test_groups_as_text_and_extra_columns(spark):
    df = spark.createDataFrame([("one two", 1, 2)], "text string, Groups int, n_a_ int")
    row = align.align(df, A, B).first().asDict()
    assert row["groups"].count(";") == row["n_groups"] - 1 and row["n_a_"] == 2 and "Groups" not in row


def test_empty_table(empty):
    assert align.digests(empty, A, B).count() == 0


def test_counts_cover_all_rows(rows):
    twice = rows.unionByName(rows)
    one = {r.doc_id: r.count_sum for r in align.digests(rows.where("doc_id < 100"), A, B).collect()}
    two = align.digests(twice.where("doc_id < 100"), A, B).groupBy("doc_id").agg(F.max("count_sum").alias("s")).collect()
    assert one and all(r.s == 2 * one[r.doc_id] for r in two)
