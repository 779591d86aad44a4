"""Token-ID files in patched frame-of-reference blocks.

One file holds the ids of a run of documents: blocks of ``BLOCK`` ids, then a
footer. A block subtracts its minimum, packs the rest at the bit width that
one of ``PERCENTILES`` of its values need, and lists the others (position and whole
value) as exceptions. The footer indexes the block starts and the documents,
so a range of ids is read by seeking to its blocks.

    file    magic | blocks | zlib(index) | trailer
    block   u32 minimum, u16 ids, u16 exceptions, u8 width,
            packed bits, u16 positions, u32 values
    index   u64 block starts, then per document i64 id, u64 ids; u8 null flags
    trailer u64 index offset, u64 ids, u32 blocks, u32 documents, magic

Files go to the shared folder under a name of their own for every task
attempt; only those that the finished job lists in its manifest count, so a
repeated task leaves no trace in the result.

Defined results: null text is an empty document (its ids are the end id
alone); a document row with a repeated doc_id is stored as its own document,
ordered by text; a null doc_id comes first; texts of any length are encoded
whole; no rows give no files; columns other than doc_id and the text are not
read, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ._shared import bounded_batches, byte_slices, materialize, split_uri, text_of
from .counts import JOINED, STRINGS, added, encode_words, load, words_of

MAGIC = b"PFORIDS1"
BLOCK = 1024
#: A block takes the width of the percentile that makes it smaller.
PERCENTILES = (95, 99)
#: Blocks packed or unpacked at once.
AT_ONCE = 512
HEAD = struct.Struct("<IHHB")
TRAILER = struct.Struct("<QQII8s")
MANIFEST = "place long, path string, docs long, ids long, bytes long"
#: A last dot or comma behind an ASCII letter.
LAST_DOT = r"([a-z])([.,])([ \t\n\r\f\v]|$)"
#: Fixed value: what the vocabulary marks the last piece of a word with.
WORD_END = "</w>"
#: Words that a worker remembers, and their characters.
KEPT, KEPT_CHARS = 800_000, 32 << 20


def pack(ids: np.ndarray) -> list[bytes]:
    """Blocks of ``BLOCK`` ids each (the last may be shorter)."""
    out: list[bytes] = []
    whole = len(ids) // BLOCK * BLOCK
    for part in ([ids[:whole].reshape(-1, BLOCK)] if whole else []) + ([ids[None, whole:]] if whole < len(ids) else []):
        part = part.astype(np.uint32, copy=False)
        low = part.min(axis=1)
        rest = part - low[:, None]
        n = part.shape[1]
        places = [min(n - 1, n * p // 100) for p in PERCENTILES]
        widths = np.frexp(np.partition(rest, places, axis=1)[:, places].astype(np.float64))[1]  # bit lengths
        odd = np.stack([(rest >> w[:, None].astype(np.uint32) if w.max() < 32 else rest >> w[:, None].astype(np.uint64)).astype(bool).sum(axis=1) for w in widths.T], axis=1)
        width = np.take_along_axis(widths, np.argmin(n * widths + 48 * odd, axis=1)[:, None], axis=1)[:, 0]
        packed: dict[int, bytes] = {}
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            kind = ">u2" if w <= 16 else ">u4"
            cells = (rest[rows] & np.uint32((1 << int(w)) - 1)).astype(kind)
            if w in (16, 32):  # whole bytes
                packed |= {int(r): line.tobytes() for r, line in zip(rows, cells)}
                continue
            bits = np.unpackbits(cells.view(np.uint8).reshape(len(rows), n, -1), axis=2)[:, :, bits_from(kind, w):]
            lines = np.packbits(bits.reshape(len(rows), -1), axis=1)
            packed |= {int(r): line.tobytes() for r, line in zip(rows, lines)}
        odd_row, odd_at = np.nonzero(rest >> width[:, None].astype(np.uint64))
        bounds = np.searchsorted(odd_row, np.arange(len(part) + 1))
        odd_at, odd = odd_at.astype("<u2"), rest[odd_row, odd_at].astype("<u4")
        for r in range(len(part)):
            a, b = bounds[r], bounds[r + 1]
            out.append(HEAD.pack(int(low[r]), n, b - a, int(width[r])) + packed[r] + odd_at[a:b].tobytes() + odd[a:b].tobytes())
    return out


def bits_from(kind: str, width: int) -> int:
    return (16 if kind == ">u2" else 32) - int(width)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that start at ``starts`` in ``data``."""
    heads = [HEAD.unpack_from(data, s) for s in starts]
    out = [np.empty(0, np.uint32)] * len(starts)
    groups: dict[tuple[int, int], list[int]] = {}
    for i, (_, n, _, width) in enumerate(heads):
        groups.setdefault((n, width), []).append(i)
    for (n, width), members in groups.items():
        size = (n * width + 7) // 8
        raw = b"".join(data[starts[i] + HEAD.size: starts[i] + HEAD.size + size] for i in members)
        kind = ">u2" if width <= 16 else ">u4"
        if width in (16, 32):
            rest = np.frombuffer(raw, kind).reshape(len(members), n).astype(np.uint32)
        else:
            bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(len(members), size), axis=1)[:, :n * width]
            cells = np.zeros((len(members), n, 16 if width <= 16 else 32), np.uint8)
            cells[:, :, bits_from(kind, width):] = bits.reshape(len(members), n, width)
            rest = np.packbits(cells, axis=2).reshape(len(members), -1).view(kind).astype(np.uint32)
        for i, line in zip(members, rest):
            low, _, odd, _ = heads[i]
            at = starts[i] + HEAD.size + size
            if odd:
                line[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
            out[i] = line + np.uint32(low)
    return np.concatenate(out) if out else np.empty(0, np.uint32)


class Writer:
    """Streams documents into one file; holds a few blocks and the index."""

    def __init__(self, uri: str):
        system, path = split_uri(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.file = uri, system.open_output_stream(path, compression=None)
        self.at, self.ids, self.waiting, self.held = 0, 0, [], 0
        self.starts: list[int] = []
        self.docs: list[np.ndarray] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.docs.append(np.rec.fromarrays([doc_ids, sizes, nulls], names="doc,n,null"))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= AT_ONCE * BLOCK:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting)
        for i in range(0, n, AT_ONCE * BLOCK):
            for block in pack(ids[i:min(n, i + AT_ONCE * BLOCK)]):
                self.starts.append(self.at)
                self._put(block)
        self.waiting, self.held, self.ids = [ids[n:]], len(ids) - n, self.ids + n

    def close(self) -> dict:
        if self.held:
            self._flush(self.held)
        docs = np.concatenate(self.docs)
        offset = self.at
        self._put(zlib.compress(np.array(self.starts, "<u8").tobytes() + docs["doc"].astype("<i8").tobytes()
                                + docs["n"].astype("<u8").tobytes() + docs["null"].astype("u1").tobytes()))
        self._put(TRAILER.pack(offset, self.ids, len(self.starts), len(docs), MAGIC))
        self.file.close()
        return {"path": self.uri, "docs": len(docs), "ids": self.ids, "bytes": self.at}


class Reader:
    """One file: its document index, and the ids of any range."""

    def __init__(self, uri: str):
        system, path = split_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        offset, self.ids, blocks, docs, magic = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        index = zlib.decompress(self.file.read_at(size - TRAILER.size - offset, offset))
        self.starts = np.append(np.frombuffer(index, "<u8", blocks), np.uint64(offset)).astype(np.int64)
        self.doc_id = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.n = np.frombuffer(index, "<u8", docs, 8 * (blocks + docs)).astype(np.int64)
        self.null = np.frombuffer(index, "u1", docs, 8 * (blocks + 2 * docs)).astype(bool)

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file, from their blocks alone."""
        n = min(n, self.ids - start)
        if n <= 0:
            return np.empty(0, np.uint32)
        a, b = start // BLOCK, (start + n - 1) // BLOCK + 1
        data = self.file.read_at(int(self.starts[b] - self.starts[a]), int(self.starts[a]))
        return unpack(data, self.starts[a:b] - self.starts[a])[start - a * BLOCK: start - a * BLOCK + n]


class Numbers(dict):
    """word -> number; a word met first takes the next one and joins ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordIds:
    """Ids of texts by their words. A word's ids are kept behind its number, so a
    run of texts is numbered in one pass, its new words are encoded in batch
    calls, and all ids are gathered at once.

    ASCII letters are lowered and a last dot or comma behind an ASCII letter is
    set apart first, as the tokenizer does itself (``check_boundary``); texts
    that hold an added token in any case stay as they stand. All words are
    forgotten when there are more than ``KEPT`` of them, or of their characters.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.added = added(self.tokenizer)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("\u00c9COLE\u00c9 \u0130A", "\u00c9cole\u00c9 \u0130a")]
        if ids[0] != ids[1]:
            raise ValueError("this tokenizer doesn't take ASCII letters apart from case")
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.size, self.start, self.blob, self.chars = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32), 0

    def words(self, texts: pa.Array) -> list[list[str]]:
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), LAST_DOT, r"\1 \2\3")
        parts = [words_of(t) for t in plain.to_pylist()]
        for token in self.added:
            for row in np.flatnonzero(pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)):
                parts[row] = words_of(texts[row].as_py())
        return parts

    def of(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``; how many each has with it)."""
        parts = self.words(texts)
        n_words = np.array([len(p) for p in parts], np.int64)
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64, int(n_words.sum()))
        self.learn()
        size = self.size[at]
        ends = np.cumsum(size)
        gather = np.repeat(self.start[at] - (ends - size), size) + np.arange(int(size.sum()))
        sums = np.append(0, ends)[np.append(0, np.cumsum(n_words))]
        ids = np.insert(self.blob[gather], sums[1:], np.uint32(end_id))
        if len(self.number) > KEPT or self.chars > KEPT_CHARS:
            self.forget()
        return ids, np.diff(sums) + 1

    def learn(self) -> None:
        """Encode the new words and put their ids behind the others."""
        new, base, coded = self.number.new, len(self.blob), [self.blob]
        if not new:
            return
        size, start = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)

        def put(group: list[int], ids: np.ndarray, ends: np.ndarray) -> None:
            nonlocal base
            size[group] = np.diff(ends, prepend=0)
            start[group] = base + ends - size[group]
            coded.append(ids)
            base += len(ids)

        plain = [i for i, w in enumerate(new) if w.isalpha()]
        rest = [i for i, w in enumerate(new) if not w.isalpha()]
        for i in range(0, len(plain), JOINED * STRINGS):
            groups = [plain[j:j + JOINED] for j in range(i, min(len(plain), i + JOINED * STRINGS), JOINED)]
            found = self.tokenizer.encode_batch_fast([" ".join(map(new.__getitem__, g)) for g in groups], add_special_tokens=False)
            for group, ids in zip(groups, (np.array(e.ids, np.uint32) for e in found)):
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(group):
                    put(group, ids, ends)
                else:  # a word of several parts
                    rest += group
        for i in range(0, len(rest), JOINED * STRINGS):
            part = rest[i:i + JOINED * STRINGS]
            raw = encode_words(self.tokenizer, [new[n] for n in part])
            put(part, np.frombuffer(b"".join(raw), "<u4"), np.cumsum([len(r) // 4 for r in raw]))
        self.start, self.size, self.blob = np.append(self.start, start), np.append(self.size, size), np.concatenate(coded)
        self.chars += sum(map(len, new))
        new.clear()


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def write(docs: DataFrame, path: str, folder: str, end_id: int = 1, text: str = "text") -> DataFrame:
    """Encode ``docs`` in ascending doc_id order into token files under
    ``folder``; returns the manifest with each file's first id (``start``)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    # one file per range of (doc_id, text): files follow each other in that order,
    # and many rows of one doc_id may take several
    rows = (docs.select("doc_id", text_of(text).alias("_text")).repartitionByRange("doc_id", F.substring("_text", 1, 64))
            .sortWithinPartitions("doc_id", "_text"))
    fields = ["place", "path", "docs", "ids", "bytes"]

    def run(batches):
        known, out = word_ids(path), None
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                ids, sizes = known.of(part.column("_text"), end_id)
                out = out or Writer(f"{folder}/tokens-{uuid.uuid4().hex}.pfor")
                doc = part.column("doc_id")
                out.add(doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False), ids, sizes)
        if out:
            row = out.close() | {"place": TaskContext.get().partitionId()}
            yield pa.RecordBatch.from_arrays([pa.array([row[f]]) for f in fields], names=fields)

    manifest = materialize(rows.mapInArrow(run, MANIFEST), "token-manifest")
    # one row per file; the running sum over all files is a single small window
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens and ids_crc32 per document."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    files = manifest.select("path", "start").repartition(max(1, manifest.count()))

    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                reader = Reader(uri)
                ends = np.cumsum(reader.n)
                crc, done, ids_at = np.zeros(len(ends), np.uint32), 0, 0
                running = 0
                while ids_at < reader.ids:
                    ids = reader.read(ids_at, AT_ONCE * BLOCK).astype("<u4", copy=False)
                    data, at = memoryview(ids.tobytes()), 0
                    while at < len(ids):  # a document may go on in the next read
                        stop = min(len(ids), int(ends[done]) - ids_at)
                        running = zlib.crc32(data[4 * at:4 * stop], running)
                        at = stop
                        if ids_at + at == ends[done]:
                            crc[done], running, done = running, 0, done + 1
                    ids_at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_id, mask=reader.null), pa.array(base + ends - reader.n), pa.array(reader.n), pa.array(crc.astype(np.int64))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, schema)


def token_file_digests(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to token files and return each document as read back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read(write(docs, path, folder, end_id))
