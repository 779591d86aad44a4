"""Token counts by a tokenizers library file, in Arrow functions that return
lengths only.

Arrow batches are cut into runs of about equal bytes. Texts are split at safe
boundaries: white space, which the tokenizers meant here drop and never join
over, and, in an ASCII word, its case and a last dot or comma after a letter.
A word that holds an added token's content in any case stays as it stands, as
the library looks for these in the raw text. The parts not seen before are encoded together in one batch call, and only
their lengths are kept. ``check_boundary`` refuses a tokenizer for which these
cuts are not safe.

Defined results: null and empty texts have no bytes and no tokens; repeated
rows are counted one by one; texts of any length are counted whole; no rows
give no rows; a column named like the count is replaced by it, others are kept.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import PieceMemo, bounded_batches, byte_slices, text_of

#: Blanks to Python's split() that the tokenizers take as text.
SEPARATORS = "\x1c\x1d\x1e\x1f"
BLANKS = re.compile(r"[ \t\n\r\f\v]+")
#: Marks that stand alone after a letter.
DOTS = (".", ",")
#: Stands between words that are encoded in one string.
MARK = "\x01"
#: Words in such a string, and strings in a batch call.
JOINED, STRINGS = 256, 16


def check_boundary(tokenizer) -> None:
    """White space must vanish, case too, and a last dot or comma stand alone:
    a text's tokens are those of its parts. Added tokens hold no white space."""
    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    for text in ("ab cd", " ab\n\tcd  ", "x's 12\r\n!?", f"a {MARK} b", "a\u2003b\xa0c"):
        if ids(text) != [i for w in text.split() for i in ids(w)]:
            raise ValueError("this tokenizer keeps white space; words can't be encoded apart")
    if ids("Ab, cD.") != ids("ab") + ids(",") + ids("cd") + ids(".") or len(ids(MARK)) != 1:
        raise ValueError("this tokenizer doesn't take words apart from case and dots")
    if any(not t or BLANKS.search(t) or MARK in t for t in added(tokenizer)):
        raise ValueError("an added token of this tokenizer reaches over words")


def added(tokenizer) -> list[str]:
    """The added tokens' contents in lower case."""
    return sorted({t.content.lower() for t in tokenizer.get_added_tokens_decoder().values()})


@lru_cache(maxsize=2)
def load(path: str):
    """The file's tokenizer without truncation and padding, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    check_boundary(tokenizer)
    return tokenizer


def words_of(text: str) -> list[str]:
    """The parts between white space (empty ones may stand at the ends)."""
    return BLANKS.split(text) if any(c in text for c in SEPARATORS) else text.split()


def encode_words(tokenizer, words: list[str]) -> list[bytes]:
    """Each word's ids as little-endian u32, by one batch call."""
    apart = [w for w in words if MARK in w]
    joined = [w for w in words if MARK not in w] if apart else words
    mark, out = tokenizer.encode(MARK, add_special_tokens=False).ids[0], {}
    groups = [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)]
    for group, found in zip(groups, tokenizer.encode_batch_fast([f" {MARK} ".join(g) for g in groups], add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        cut = np.flatnonzero(ids == mark)
        raw = ids.tobytes()
        ends = [*(4 * cut).tolist(), len(raw)]
        out.update(zip(group, (raw[a:b] for a, b in zip([0, *(4 * cut + 4).tolist()], ends))))
    out.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(apart, tokenizer.encode_batch_fast(apart, add_special_tokens=False)))
    return [out[w] for w in words]


class WordMemo:
    """word -> value for words of any case, a last dot or comma apart.

    ``values(words)`` gives a batch's values, which must add up: the value of
    a word with a dot is the sum of both. Words that hold one of ``added``
    (lower case) in any case are looked up as they stand. ``of(parts)`` is a
    lookup for the words of these texts.
    """

    def __init__(self, values, added: list[str]):
        self.cores, self.added = PieceMemo(values), added

    def of(self, parts: list[list[str]]):
        cores, plain, dotted = self.cores, {}, {}
        words = set().union(*parts)
        text = "\n".join(words).lower()
        held = [t for t in self.added if t in text]
        for w in words:
            if not w.isascii() or held and any(t in w.lower() for t in held):
                plain[w] = w
            elif w[-1:] in DOTS and w[-2:-1].isalpha():
                dotted[w] = w[:-1].lower()
            else:
                plain[w] = w.lower()
        rest = cores.learn({*plain.values(), *dotted.values(), *DOTS}, JOINED * STRINGS)
        core = cores.__getitem__ if not rest else lambda c: rest[c] if c in rest else cores[c]
        dot = {d: core(d) for d in DOTS}
        for w, c in plain.items():
            plain[w] = core(c)
        for w, c in dotted.items():
            plain[w] = core(c) + dot[w[-1]]
        return plain.__getitem__


@lru_cache(maxsize=2)
def lengths(path: str) -> WordMemo:
    tokenizer = load(path)
    return WordMemo(lambda words: [len(ids) // 4 for ids in encode_words(tokenizer, words)], added(tokenizer))


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` without ``text``, plus the number of tokens of that text (long).
    A column of ``df`` named like ``out`` is replaced."""
    bounded_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in (text, out)]
    carried = df.select(*kept, F.col(text).alias("_source"))
    schema = T.StructType([f for f in carried.schema.fields if f.name != "_source"] + [T.StructField(out, T.LongType())])

    def run(batches):
        memo = lengths(path)
        for batch in batches:
            for part in byte_slices(batch, "_source"):
                parts = [words_of(v or "") for v in part.column("_source").to_pylist()]
                known = memo.of(parts)
                n = pa.array([sum(map(known, words)) for words in parts], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), n], names=[*kept, out])

    return carried.mapInArrow(run, schema)


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether there are over ``limit``."""
    rows = docs.select("doc_id", text_of().alias("_text"), F.octet_length(text_of()).cast("long").alias("n_bytes"))
    return count_tokens(rows, path, "_text").withColumn("over_limit", F.col("n_tokens") > limit)
