"""Benchmark decontamination.

Every text is read through sliding windows of each item's size in words. A
window and an item become 64-bit SimHash fingerprints of their weighted word
shingles (five words; weight: how often a shingle occurs). A multi-index over
the items' fingerprints has one table for each of ``BLOCKS`` bit blocks: two
fingerprints within ``RADIUS`` bits agree in some block up to
``RADIUS // BLOCKS`` bits, so probing all such block values finds every item
within the radius. Candidates are then held against the exact weighted
similarity 2 * sum(min) / (sum + sum) of the shingles, ``SIMILARITY`` or more.

Windows whose shingles the items of that size share too few of cannot reach
the similarity; they are passed over before they are fingerprinted, without
loss. ``RADIUS`` is set where no window at the similarity was seen to lie beyond
it (README: trials and recall).

The benchmark is dealt into blocks of bounded size, a file each in the shared
folder. A task holds up to ``CHUNK`` bytes of documents and one block at a time,
however many blocks there are; the plan does not depend on their number.

Defined results: null and empty texts match nothing; items without words are
no items; an item of fewer than five words is one shingle, its words; equal
items are found together, each under its own item_id, and those without an
item_id together under a null one; rows with a null or repeated doc_id are
matched row by row; texts of any length are read whole, long ones in
overlapping parts; extra columns are kept by ``decontaminate`` and not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded_batches, byte_slices, materialize, split_uri

WORD = re.compile(r"\w+")
SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 31, 8
#: Items and text bytes of one block of the benchmark, text bytes of documents held together.
ITEMS, ITEM_BYTES, CHUNK = 10_000, 4 << 20, 64 << 20
#: Words of a text looked at together; longer texts go by overlapping parts.
PART = 200_000

MATCH = "item_id long, start_word long, n_words long, distance int, similarity double"


def shingles(words: list[str], k: int):
    return map(" ".join, zip(*(words[i:] for i in range(k))))


def hashed(items: list[str]) -> np.ndarray:
    """Bits (0 or 1) of each shingle's hash, a row each."""
    codes = np.array([xxhash.xxh64_intdigest(s) for s in items], ">u8")
    return np.unpackbits(codes.view(np.uint8)).reshape(-1, 64)


def fingerprints(ones: np.ndarray, n: int) -> np.ndarray:
    """64-bit fingerprints from the counts of set bits among ``n`` hashes."""
    return np.packbits(2 * ones > n, axis=-1).view(">u8").reshape(-1).astype(np.uint64)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted shingle similarity: shared weight over mean weight."""
    return 2 * sum(min(w, b[s]) for s, w in a.items()) / (a.total() + b.total())


class MultiIndex:
    """Items by the value of each fingerprint block."""

    def __init__(self, fps: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.fps, self.radius = fps, radius
        self.width = 64 // blocks
        masks = [sum(1 << b for b in bits) for n in range(radius // blocks + 1) for bits in combinations(range(self.width), n)]
        self.masks = np.array(masks, np.uint64)
        self.tables = []
        for shift in range(0, self.width * blocks, self.width):
            value = self.block(fps, shift).astype(np.int64)
            order = np.argsort(value, kind="stable")
            self.tables.append((shift, order, np.searchsorted(value[order], np.arange((1 << self.width) + 1))))

    def block(self, fps, shift):
        return (fps >> np.uint64(shift)) & np.uint64((1 << self.width) - 1)

    def near(self, fp: int) -> np.ndarray:
        """Items within the radius of ``fp``: all of them, and no others."""
        found = []
        for shift, order, start in self.tables:
            keys = (self.block(np.uint64(fp), shift) ^ self.masks).astype(np.int64)
            full = keys[start[keys] < start[keys + 1]]
            found += [order[start[key]:start[key + 1]] for key in full]
        at = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return at[np.bitwise_count(self.fps[at] ^ np.uint64(fp)) <= self.radius]


class Sizes:
    """The items of one size: shingles, fingerprints and their index."""

    def __init__(self, size: int, items: dict[tuple, list[int]]):
        self.size, self.k = size, min(SHINGLE, size)
        self.n = size - self.k + 1
        self.need = math.ceil(SIMILARITY * self.n - 1e-9)
        self.ids = list(items.values())
        self.weights = [Counter(shingles(list(w), self.k)) for w in items]
        self.index = MultiIndex(np.concatenate([fingerprints(hashed(list(c.elements())).sum(axis=0, dtype=np.int64), self.n) for c in self.weights]))


class Items:
    """One block of the benchmark."""

    def __init__(self, rows: list[tuple[int, str]]):
        by_size: dict[int, dict[tuple, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item, text in rows:
            words = tuple(WORD.findall((text or "").lower()))
            if words:
                by_size[len(words)][words].append(item)
        self.sizes = {n: Sizes(n, items) for n, items in sorted(by_size.items())}
        self.has: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))  # k -> shingle -> sizes
        for n, group in self.sizes.items():
            for s in set().union(*group.weights):
                self.has[group.k][s].append(n)
        self.longest = max(self.sizes, default=1)

    def matches(self, text: str | None, best: dict | None = None) -> dict[int | None, tuple[int, int, int, float]]:
        """Item -> (start_word, n_words, distance, similarity) of its best
        window (the first of equals). ``best`` holds finds of earlier blocks
        and takes the new ones."""
        best = {} if best is None else best
        for at, words in parts(text or "", self.longest):
            for k, known in self.has.items():
                if len(words) < k or known.keys().isdisjoint(shingles(words, k)):
                    continue
                own = list(shingles(words, k))
                hits: dict[int, list[int]] = defaultdict(list)
                for i, sizes in enumerate(map(known.get, own)):
                    for n in sizes or ():
                        hits[n].append(i)
                for n, places in hits.items():
                    self.look(self.sizes[n], own, places, at, best)
        return listed(best)

    def look(self, group: Sizes, own: list[str], places: list[int], at: int, best: dict) -> None:
        count = np.zeros(len(own) + 1, np.int64)
        count[np.array(places) + 1] = 1
        count = np.cumsum(count)
        if len(own) < group.n:
            return
        starts = np.flatnonzero(count[group.n:] - count[:len(count) - group.n] >= group.need)
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > group.n) + 1) if len(starts) else ():
            low = int(run[0])
            bits = np.zeros((int(run[-1]) + group.n - low + 1, 64), np.int32)
            np.cumsum(hashed(own[low:int(run[-1]) + group.n]), axis=0, out=bits[1:], dtype=np.int32)
            fps = fingerprints(bits[run - low + group.n] - bits[run - low], group.n)
            for start, fp in zip(run.tolist(), fps):
                weights = None
                for i in group.index.near(fp):
                    weights = weights or Counter(own[start:start + group.n])
                    sim = similarity(group.weights[i], weights)
                    if sim >= SIMILARITY:
                        new = (sim, at + start, group.size, int(np.bitwise_count(group.index.fps[i] ^ np.uint64(fp))))
                        for item in group.ids[i]:
                            if item not in best or better(new) > better(best[item]):
                                best[item] = new


def better(found: tuple) -> tuple:
    """Order of an item's windows: similarity, then the first, the shorter, the nearer."""
    sim, start, n, distance = found
    return sim, -start, -n, -distance


def listed(best: dict) -> dict:
    return {item: (start, n, distance, sim) for item, (sim, start, n, distance) in best.items()}


def parts(text: str, overlap: int) -> Iterator[tuple[int, list[str]]]:
    """(first word's number, words): the whole text at once, or in parts that
    share ``overlap`` words, so that each window lies whole in one of them."""
    low = text.lower()
    if len(low) <= 4 * PART:
        yield 0, WORD.findall(low)
        return
    found, at, words = (m[0] for m in WORD.finditer(low)), 0, []
    while True:
        new = list(islice(found, PART))
        words = words[len(words) - min(len(words), overlap):] + new
        if not new and at:
            return
        yield at - (len(words) - len(new)), words
        at += len(new)
        if len(new) < PART:
            return


def blocks(benchmark: DataFrame) -> list[str]:
    """Write the items with a text in blocks of about ``ITEMS`` rows and
    ``ITEM_BYTES`` bytes; returns the blocks' files."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(1, -(-size.n // ITEMS), -(-size.bytes // ITEM_BYTES))
    return sorted(materialize(rows.repartition(n), "benchmark-blocks").inputFiles())


@lru_cache(maxsize=1)
def load(path: str) -> Items:
    """One block (a worker keeps the last one)."""
    system, name = split_uri(path)
    with system.open_input_file(name) as f:
        table = pq.read_table(f)
    return Items(sorted(zip(table.column("item_id").to_pylist(), table.column("text").to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def chunks(batches, column: str):
    """Runs of record batches of about ``CHUNK`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for part in byte_slices(batch, column):
            held.append(part)
            size += part.column(column).nbytes
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document row and item found in it: doc_id, item_id and
    the best window (start_word, n_words, distance, similarity)."""
    bounded_batches(docs.sparkSession)
    schema, files = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(MATCH).fields]), blocks(benchmark)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())

    def run(batches):
        for held in chunks(batches, "text"):
            texts = [part.column("text").to_pylist() for part in held]
            best = [[{} for _ in part] for part in texts]
            for path in files:
                items = load(path)
                for part, found in zip(texts, best):
                    for text, own in zip(part, found):
                        items.matches(text, own)
            for part, found in zip(held, best):
                rows = [(row, item, *m) for row, own in enumerate(found) for item, m in sorted(listed(own).items(), key=lambda x: (x[0] is None, x[0] or 0))]
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(columns[0])), *(pa.array(c, t) for c, t in zip(columns[1:], kinds))],
                                                     names=[f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    bounded_batches(docs.sparkSession)
    files = blocks(benchmark)

    def run(batches):
        for held in chunks(batches, "text"):
            for path in files:
                items = load(path)
                held = [part.filter(pa.array([not items.matches(text) for text in part.column("text").to_pylist()], pa.bool_())) for part in held]
            yield from held

    return docs.mapInArrow(run, docs.schema)
