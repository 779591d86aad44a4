"""Alignment of two tokenizers' ids over the same text.

Each side's token bytes are summed up to cumulative ends, kept in a dictionary
from end to index. The ends that both dictionaries hold, sorted, cut both id
lists into groups that cover the same bytes; a group's links are the pairs of
its A and B tokens that end together at its cut.

Two linked tokens end at the same byte, so the shorter is a suffix of the
longer. The distinct pairs of a corpus are therefore at most the (token,
suffix in the other vocabulary) pairs of the two vocabularies, whatever the
corpus holds (``most_pairs``); that bound lets their counts be broadcast.

Neither tokenizer has a token that reaches over a single space between other
characters, so both have an end there. Texts are cut at these spaces into parts
(words, mostly). Parts that a worker has not met lately are joined by spaces
again, encoded and aligned together; a text's groups and links are those of its
parts. The byte-level side is encoded by tiktoken with the file's own
vocabulary, which gives the ids of the tokenizers library faster; long parts go
through the tokenizers library itself.

Defined results: texts that are null, empty, or that a tokenizer does not give
back byte for byte have no tokens, groups or links; a text counts whole however
long it is; rows with a null or
repeated doc_id are aligned one by one; of equal counts all are the highest;
no rows give no rows; an input column named like a result is replaced by it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded_batches, byte_slices, free_name, materialize
from .bpe import PATTERN, byte_alphabet

#: Text bytes looked at together, characters of a part that is encoded alone.
SLICE, LONG = 1 << 20, 20_000
CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
#: Parts that may be joined by spaces.
PLAIN = re.compile(r"[^\s▁](?:.*[^\s▁])?", re.S)
#: Parts remembered (twice as many at most), and their longest.
KEPT, SHORT = 300_000, 80
#: Behind an id of a group, its last A id, its last B id.
MARKS = (",", "|", ";")
#: Fixed value: the piece character that stands for a space.
BLANK = "▁"

ALIGNED = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
           ("groups", T.StringType()), ("pairs", T.BinaryType()), ("times", T.BinaryType())]
ARROW = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        alphabet = byte_alphabet()
        vocab = {i: s for s, i in self.a.get_vocab().items()}
        self.bytes_a = [bytes(alphabet[c] for c in vocab.get(i, "") if c in alphabet) for i in range(max(vocab) + 1)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        if any(re.search(r"[^\s▁] ", t.decode(errors="replace")) for t in self.bytes_a + self.bytes_b):
            raise ValueError("a token reaches over a space; texts can't be cut there")
        self.fast = self._ranked(path_a)
        self.width = len(self.bytes_b)
        self.size_a, self.size_b = (np.array([*map(len, t)], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.solid = bool(self.size_a.all() and self.size_b.all())
        self.name = [str(i) + mark for mark in MARKS for i in range(max(len(self.bytes_a), self.width))]
        self.young, self.old = {}, {}
        self.key = "<u4" if len(self.bytes_a) * self.width <= 1 << 32 else "<u8"

    def _ranked(self, path: str):
        """tiktoken's encoding of the same vocabulary: its ranks are the ids, which
        must go up in the order of the merges."""
        from tiktoken import Encoding

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        ids = [vocab[left + right] for left, right in spec["model"]["merges"]]
        if ids != sorted(set(ids)):
            raise ValueError("ids don't follow the merges")
        return Encoding("own", pat_str=PATTERN, special_tokens={}, mergeable_ranks={self.bytes_a[i]: i for t, i in vocab.items() if t not in added})

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for the text and the space before it; None where one
        side does not give these bytes back."""
        if len(text) > LONG and not CUT.search(text):
            a = self.a.encode(" " + text, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(" " + text)
        b, raw = self.b.encode(text), (" " + text).encode()
        same = b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))
        return (np.array(a, np.int64), np.array(b, np.int64)) if same else None

    def aligned(self, parts: list[str]) -> list[tuple | None]:
        """For each part: numbers of A ids, B ids and groups, the groups' text and the
        links as bytes; None for a part that a side does not give back."""
        plain = [p for p in parts if len(p) <= LONG and PLAIN.fullmatch(p)]
        both = self.encode(" ".join(plain)) if plain else None
        found = {}
        if both is not None:
            a, b = both
            ends = np.cumsum([1 + len(p.encode()) for p in plain])
            upto = [np.searchsorted(np.cumsum(size[ids]), ends, side="right") for size, ids in ((self.size_a, a), (self.size_b, b))]
            found = dict(zip(plain, self.align(a, b, *(np.diff(u, prepend=0) for u in upto))))
        return [found[p] if p in found else self.alone(p) for p in parts]

    def alone(self, part: str) -> tuple | None:
        both = self.encode(part)
        return both and self.align(*both, *(np.array([len(ids)]) for ids in both))[0]

    def of(self, texts: list[str]) -> list[tuple]:
        """``aligned`` of whole texts; empty for a text that has no tokens."""
        cut = [CUT.split(t) if t else [] for t in texts]
        parts = set().union(*cut)
        new = [p for p in parts if p not in self.young and p not in self.old]
        found = dict(zip(new, self.aligned(new)))
        self.young.update((p, v) for p, v in found.items() if len(p) <= SHORT)
        for p in parts:
            if p not in found:
                v = self.young.get(p)
                if v is None:  # a part in use moves on to the young ones
                    v = self.young[p] = self.old.get(p)
                found[p] = v
        if len(self.young) > KEPT:
            self.young, self.old = {}, self.young
        out = []
        for parts in cut:
            each = [*map(found.__getitem__, parts)]
            if not each or None in each:
                out.append((0, 0, 0, "", b""))
            else:
                n_a, n_b, n, shown, links = zip(*each)
                out.append((sum(n_a), sum(n_b), sum(n), ";".join(shown), b"".join(links)))
        return out

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each group the A and B ids up to its end. The ids may be those of many
        texts in a row: the bytes are the same on both sides, so each text ends a group."""
        ends_a, ends_b = np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist()
        index_a, index_b = dict(zip(ends_a, range(1, len(ends_a) + 1))), dict(zip(ends_b, range(1, len(ends_b) + 1)))
        common = [*filter(index_b.__contains__, index_a)]  # ends go up, so these come sorted
        return tuple(np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (index_a, index_b))

    def links(self, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links as a * width + b, group by group, and how many each group has."""
        if self.solid:  # one token of each side ends at each place
            return a[upto_a - 1].astype(np.int64) * self.width + b[upto_b - 1], np.ones(len(upto_a), np.int64)
        found, many = [], []
        for (i, j, k, m) in zip(np.append(0, upto_a), upto_a, np.append(0, upto_b), upto_b):
            x, y = self.last(a[i:j], self.size_a), self.last(b[k:m], self.size_b)
            found += [p * self.width + q for p in x for q in y]
            many.append(len(x) * len(y))
        return np.array(found, np.int64), np.array(many, np.int64)

    @staticmethod
    def last(ids: np.ndarray, size: np.ndarray) -> list[int]:
        """The ids that end where the last one does: itself and empty ones."""
        full = np.flatnonzero(size[ids])
        return ids[full[-1] if len(full) else 0:].tolist()

    def shown(self, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> list[str]:
        """All ids in the order of ``a1,a2|b1;a3|b2;``, each with the mark behind it."""
        place_a, place_b = np.repeat(np.append(0, upto_b)[:-1], np.diff(upto_a, prepend=0)), np.repeat(upto_a, np.diff(upto_b, prepend=0))
        marked = np.zeros(len(a) + len(b), np.int64)
        marked[np.arange(len(a)) + place_a], marked[np.arange(len(b)) + place_b] = a, b
        n = len(self.name) // len(MARKS)
        marked[upto_a - 1 + place_a[upto_a - 1]] += n
        marked[upto_b - 1 + place_b[upto_b - 1]] += 2 * n
        return [*map(self.name.__getitem__, marked.tolist())]

    def align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[tuple[int, int, int, str, bytes]]:
        """``a`` and ``b`` hold the ids of texts in a row, ``n_a`` and ``n_b`` of each:
        its A ids, B ids, groups, their text, and its links as bytes."""
        upto_a, upto_b = self.cuts(a, b)
        links, many = self.links(a, b, upto_a, upto_b)
        shown, raw, wide = self.shown(a, b, upto_a, upto_b), links.astype(self.key).tobytes(), np.dtype(self.key).itemsize
        ends = np.cumsum(n_a)
        groups = np.append(0, np.searchsorted(upto_a, ends, side="right"))  # groups up to each text's end
        upto, cut = (wide * np.append(0, np.cumsum(many))[groups]).tolist(), np.append(0, ends + np.cumsum(n_b)).tolist()
        return [(x, y, g, "".join(shown[c:d])[:-1], raw[i:j]) for x, y, g, c, d, i, j in
                zip(n_a.tolist(), n_b.tolist(), np.diff(groups).tolist(), cut, cut[1:], upto, upto[1:])]

    def most_pairs(self) -> int:
        """Upper bound of distinct linked pairs: tokens that are suffixes of each other."""
        def ends(ones, others):
            known: dict[bytes, int] = {}
            for t in others:
                known[t] = known.get(t, 0) + 1
            return sum(known.get(t[i:], 0) for t in ones for i in range(len(t) + 1))
        return ends(self.bytes_a, self.bytes_b) + ends(self.bytes_b, self.bytes_a)


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", digest: bool = False) -> DataFrame:
    """``df`` without ``text``, plus n_a, n_b, n_groups, n_links, ``groups`` (their text,
    or its SHA-256 with ``digest``), and the row's distinct links: ``pairs`` (a * width + b,
    little-endian) and ``times`` (u32, how often each)."""
    bounded_batches(df.sparkSession)
    out = [n for n, _ in ALIGNED]
    kept = [c for c in df.columns if c != text and c.lower() not in out]
    read = free_name(df, "_source")
    rows = df.select(*kept, F.col(text).cast("string").alias(read))
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(n, t) for n, t in ALIGNED])

    def run(batches):
        pair = load(path_a, path_b)
        for batch in batches:
            for part in byte_slices(batch, read, SLICE):
                found = []
                for n_a, n_b, n, shown, links in pair.of([v or "" for v in part.column(read).to_pylist()]):
                    links = np.frombuffer(links, pair.key)
                    keys, times = np.unique(links, return_counts=True)
                    if digest:
                        shown = hashlib.sha256(shown.encode()).hexdigest() if n else ""
                    found.append((n_a, n_b, n, len(links), shown, keys.tobytes(), times.astype("<u4").tobytes()))
                columns = [*zip(*found)] or [()] * len(ALIGNED)
                arrays = [pa.array(c, t) for c, t in zip(columns, ARROW)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *arrays], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """How many links of all rows hold each pair: a_id, b_id, n, and whether
    none of its B id's pairs has more (``best``). Counted per task first."""
    pair = load(path_a, path_b)
    kind, width = pair.key, pair.width

    def run(batches):
        keys, total = np.empty(0, kind), np.empty(0, np.int64)

        def merged(keys, times):
            keys, at = np.unique(keys, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, at, times)
            return keys, total

        for batch in batches:
            new = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            times = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4")
            keys, total = merged(np.concatenate([keys, new]), np.concatenate([total, times.astype(np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(total)], names=["pair", "n"])

    counted = aligned.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    ids = counted.select(F.expr(f"pair DIV {width}").alias("a_id"), (F.col("pair") % width).alias("b_id"), "n")
    return ids.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))


def with_counts(aligned: DataFrame, counts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``aligned`` with n_best (links whose pair is ``best``) and count_sum (the
    pairs' counts over the links) in place of pairs and times."""
    pair = load(path_a, path_b)
    kind, width = pair.key, pair.width
    table = counts.select((F.col("a_id") * width + F.col("b_id")).alias("pair"), "n", "best").orderBy("pair").toArrow()
    if table.num_rows > pair.most_pairs():  # cannot happen: linked tokens are suffixes of each other
        raise ValueError("more pairs than the two vocabularies allow")
    shared = aligned.sparkSession.sparkContext.broadcast(
        (table.column("pair").to_numpy(), table.column("n").to_numpy(), table.column("best").to_numpy().astype(np.int64)))
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    schema = T.StructType([aligned.schema[c] for c in kept] + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches):
        keys, counts, best = shared.value
        for batch in batches:
            pairs, times = (batch.column(batch.schema.get_field_index(c)) for c in ("pairs", "times"))
            at = np.searchsorted(keys, np.frombuffer(b"".join(pairs.to_pylist()), kind).astype(np.int64))
            times = np.frombuffer(b"".join(times.to_pylist()), "<u4").astype(np.int64)
            ends = np.cumsum(pc.binary_length(pairs).to_numpy(zero_copy_only=False)) // np.dtype(kind).itemsize
            sums = []
            for values in (best, counts):
                upto = np.concatenate([[0], np.cumsum(times * values[at])])
                sums.append(pa.array(np.diff(upto[np.concatenate([[0], ends])])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sums], names=[f.name for f in schema.fields])

    return aligned.mapInArrow(run, schema)


def digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: token, group and link numbers, and the digest of its groups."""
    rows = align(docs.select("doc_id", "text"), path_a, path_b, digest=True)
    aligned = materialize(rows.withColumnRenamed("groups", "groups_sha256"), "aligned")
    counts = materialize(pair_counts(aligned, path_a, path_b), "pair-counts")
    return with_counts(aligned, counts, path_a, path_b)
