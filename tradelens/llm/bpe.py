"""Byte-level BPE encoding and decoding.

Merging keeps the symbols of a pre-token in a doubly linked list and the
possible merges in a priority queue of (rank, position). A popped entry whose
pair is no longer the one it was queued for is stale and skipped. Decoding
concatenates the vocabulary strings.

Defined results: null text counts as empty and has no ids; repeated rows are
encoded one by one; ids outside the vocabulary are skipped when decoding; an
input column named like an output column is replaced by it, others are kept;
texts of any length are encoded whole; no rows give no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import PieceMemo, bounded_batches, byte_slices, text_of

# The pre-token pattern and the byte alphabet that the
# vocabulary file of a byte-level BPE presumes.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Coarser cut at the same white space: no pre-token reaches over its ends.
CHUNK = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> dict[str, int]:
    """Vocabulary character -> byte: printable bytes stand for themselves, the
    others take the code points from 256 on in ascending order."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBPE:
    """Vocabulary, merge ranks and special tokens of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.width = max(vocab.values()) + 1
        self.byte_id = [0] * 256
        for char, byte in alphabet.items():
            self.byte_id[byte] = vocab[char]
        ranks: dict[int, int] = {}  # pair -> rank in the upper bits, where a queue entry has it
        self.merged: list[int] = []
        for left, right in spec["model"]["merges"]:
            ranks.setdefault(vocab[left] * self.width + vocab[right], len(self.merged) << 32)
            self.merged.append(vocab[left + right])
        self.rank = ranks.get
        self.string = {i: bytes(alphabet[c] for c in s) if all(c in alphabet for c in s) else s.encode()
                       for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.string |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.chunks = re.compile(CHUNK).findall
        self.pieces = regex.compile(PATTERN).findall
        self.piece_ids = PieceMemo(lambda new: [array("I", self.merge(p.encode())).tobytes() for p in new])
        known = self.piece_ids.__getitem__
        self.chunk_ids = PieceMemo(lambda new: [b"".join(map(known, self.pieces(c))) for c in new])
        self.none = max(self.string) + 1
        self.size = np.array([len(self.string.get(i, b"")) for i in range(self.none + 1)], np.int32)
        self.place = np.cumsum(self.size, dtype=np.int32) - self.size
        self.blob = np.frombuffer(b"".join(self.string.get(i, b"") for i in range(self.none)), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        rank, merged, width = self.rank, self.merged, self.width
        symbol = [*map(self.byte_id.__getitem__, piece)]
        n = len(symbol)
        if n < 2:
            return symbol
        # queued[i]: the entry that the pair starting at i waits for, or -1
        queued = [rank(a * width + b, -1) | i for i, (a, b) in enumerate(zip(symbol, symbol[1:]))]
        queue = [entry for entry in queued if entry >= 0]
        heapify(queue)
        queued.append(-1)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            if queued[i] != entry:
                continue  # stale: a neighbour was merged since
            j = after[i]
            new = symbol[i] = merged[entry >> 32]
            symbol[j] = queued[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                entry = queued[i] = rank(new * width + symbol[k], -1) | i
                if entry >= 0:
                    heappush(queue, entry)
            else:
                queued[i] = -1
            k = before[i]
            if k >= 0:
                entry = queued[k] = rank(symbol[k] * width + new, -1) | k
                if entry >= 0:
                    heappush(queue, entry)
        return [s for s in symbol if s >= 0]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        known = self.chunk_ids.__getitem__
        if not any(s in text for s in self.special):
            return b"".join(map(known, self.chunks(text)))
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += map(known, self.chunks(text[at:m.start()]))
            out.append(np.array([self.special[m[0]]], "<u4").tobytes())
            at = m.end()
        return b"".join([*out, *map(known, self.chunks(text[at:]))])

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0].as_py()

    def decode_all(self, coded: list[bytes]) -> pa.Array:
        """Concatenated vocabulary strings of each id list, gathered at once."""
        ids = np.frombuffer(b"".join(coded), "<u4")
        if len(ids) and ids.max() >= len(self.size):  # none stands there: no bytes
            ids = np.where(ids < len(self.size), ids, self.none)
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        gather = np.repeat(self.place[ids] - ends[:-1].astype(np.int32), size)
        gather += np.arange(len(gather), dtype=np.int32)
        raw = self.blob[gather]
        bounds = ends[np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)])]
        inner = bounds[bounds < len(raw)]
        whole = not np.any((raw[inner] & 0xC0) == 0x80)
        try:
            raw.tobytes().decode()
        except UnicodeDecodeError:
            whole = False
        if not whole:
            return pa.array([raw[a:b].tobytes().decode(errors="replace") for a, b in zip(bounds, bounds[1:])], pa.string())
        return pa.StringArray.from_buffers(len(coded), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw))


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    """One tokenizer per worker process and file."""
    return ByteBPE(path)


def _add(df: DataFrame, source: str, make, out: list[tuple[str, T.DataType]]) -> DataFrame:
    """``df`` plus columns computed from ``source`` by ``make() -> f(values) -> arrays``."""
    bounded_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in {n for n, _ in out}]
    read = source if source in kept else "_source"
    carried = df.select(*kept, *[F.col(source).alias(read)][:source not in kept])
    schema = T.StructType([f for f in carried.schema.fields if f.name in kept] + [T.StructField(n, t) for n, t in out])

    def run(batches):
        compute = make()
        for batch in batches:
            for part in byte_slices(batch, read):
                values = part.column(read).to_pylist()
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(columns + compute(values), names=[f.name for f in schema.fields])

    return carried.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the token ids of ``text`` as little-endian u32 binary."""
    def make():
        bpe = load(path)
        return lambda values: [pa.array([bpe.encode(v or "") for v in values], pa.binary())]

    return _add(df, text, make, [(out, T.BinaryType())])


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for."""
    def make():
        bpe = load(path)
        return lambda values: [bpe.decode_all([v or b"" for v in values])]

    return _add(df, ids, make, [(out, T.StringType())])


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass over the rows."""
    def make():
        bpe = load(path)

        def both(values):
            coded = [bpe.encode(v or "") for v in values]
            return [pa.array(coded, pa.binary()), bpe.decode_all(coded)]
        return both

    return _add(df, text, make, [(ids, T.BinaryType()), (out, T.StringType())])


def digests(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Per document: n_tokens and the SHA-256 of its ids and of the decoded
    text, after them the ids if wanted."""
    coded = round_trip(docs.select("doc_id", text_of().alias("decoded")), path, text="decoded")  # replaced by its decoding
    return coded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *["ids"][:keep_ids])
