"""SimHash near-duplicates by vantage-point trees.

Texts become 64-bit fingerprints in Arrow functions. Distinct fingerprints are
dealt over the leaves of a vantage-point tree: a node sends those within its
radius of the vantage point left, the others right. By the triangle bound two
fingerprints at distance r or less differ by at most r in their distance to
the vantage point, so a right one within r beyond the radius also goes left
(a visitor), and every linked pair meets in some leaf. The upper tree is
fitted on a bounded sample, one node per shard; it only decides the cost,
never which links are found. Each shard goes on splitting by vantage points of
its own and compares the members of its smallest leaves exactly. A leaf
returns a spanning forest of its links, not its pairs; components follow on
Spark.

Defined results: null and empty texts and texts of blanks have fingerprint
zero and are linked like any other; repeated rows share their fingerprint, and
rows of one group that repeat a doc_id count as several rows of that group;
rows with a null doc_id get their group's component, null if all are null;
texts of any length are fingerprinted whole, from runs of their words; no rows
give no rows; ``deduplicate`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded_batches, byte_slices, free_name, materialize, text_of
from .graph import components

SEED = 42
#: Fingerprints of a shard, about, and of the sample that the upper tree is fitted on.
SHARD, SAMPLE = 5_000, 50_000
#: A leaf that is small enough to compare its members directly.
LEAF = 256
#: Shingles hashed into bits at once.
AT_ONCE = 1 << 16


def fingerprint(text: str, k: int = 3) -> int:
    """64-bit SimHash of the word k-shingles of ``text``, ASCII lower-cased."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, AT_ONCE):
        part = words[at:min(n, at + AT_ONCE) + k - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
        hashes = np.array([digest(s, SEED) for s in shingles], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 3, text: str = "text", out: str = "fp", keep_text: bool = False) -> DataFrame:
    """``docs`` plus its fingerprint as a (signed) long, with ``text`` if it is to be kept."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != out and (keep_text or c != text)]
    source = text if keep_text else "_text"
    carried = docs.select(*kept) if keep_text else docs.select(*kept, text_of(text).alias("_text"))
    schema = T.StructType([f for f in carried.schema.fields if f.name in kept] + [T.StructField(out, T.LongType())])

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, source):
                fps = np.array([fingerprint(t or "", k) for t in part.column(source).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(fps)], names=[*kept, out])

    return carried.mapInArrow(run, schema)


def distance(fps: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(point))


class Node:
    """Vantage point, radius, and two subtrees or shard numbers."""

    __slots__ = ("point", "radius", "left", "right")

    def __init__(self, point, radius, left, right):
        self.point, self.radius, self.left, self.right = point, radius, left, right


def choose(fps: np.ndarray, r: int, rng: random.Random, tries: int = 8):
    """The vantage point and radius whose halves, visitors included, cost
    least: (point, radius, share of the larger half), or None."""
    best = None
    for _ in range(tries):
        point = int(fps[rng.randrange(len(fps))])
        if rng.random() < 0.5:  # not only members: points apart from a dense group tell it apart
            point ^= rng.getrandbits(64)
        share = np.cumsum(np.bincount(distance(fps, point), minlength=66 + r)) / len(fps)
        left, right = share[r:66], 1 - share[:66 - r]
        cost = left * left + right * right
        radius = int(np.argmin(cost))
        if best is None or cost[radius] < best[0]:
            best = (cost[radius], point, radius, max(left[radius], right[radius]), left[radius] + right[radius])
    return best


def upper_tree(sample: np.ndarray, shards: int, r: int, seed: int = 7):
    """Tree with ``shards`` leaves, about, numbered from 0: the largest leaf is
    split until there are enough. Returns (tree, leaves)."""
    rng, count = random.Random(seed), [0]

    def grow(fps, wanted):
        found = choose(fps, r, rng) if wanted > 1 and len(fps) > 16 else None
        if found is None or found[3] > 0.95:
            count[0] += 1
            return count[0] - 1
        _, point, radius, _, _ = found
        d = distance(fps, point)
        near = d <= radius
        go_left = d <= radius + r
        weight = wanted * go_left.sum() / (go_left.sum() + (~near).sum())
        lower = min(wanted - 1, max(1, round(weight)))
        return Node(point, radius, grow(fps[go_left], lower), grow(fps[~near], wanted - lower))

    return grow(sample, shards), count[0]


def route(tree, fps: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of every shard that each fingerprint has to visit."""
    rows, shards, todo = [], [], [(tree, np.arange(len(fps)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, Node):
            rows.append(at)
            shards.append(np.full(len(at), node))
            continue
        d = distance(fps[at], node.point)
        todo += [(node.left, at[d <= node.radius + r]), (node.right, at[d > node.radius])]
    return np.concatenate(rows or [np.empty(0, int)]), np.concatenate(shards or [np.empty(0, int)])


def forest(fps: np.ndarray, r: int, seed: int = 11) -> list[tuple[int, int]]:
    """Spanning links (i, j) of the pairs at distance r or less."""
    parent = np.arange(len(fps))
    rng = random.Random(seed)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links: list[tuple[int, int]] = []
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) > LEAF:
            _, point, radius, larger, total = choose(fps[at[rng.randrange(1 + len(at) // 2048)::1 + len(at) // 2048]], r, rng)
            d = distance(fps[at], point)
            left, right = at[d <= radius + r], at[d > radius]
            if max(len(left), len(right)) <= 0.9 * len(at) and len(left) ** 2 + len(right) ** 2 < 0.9 * len(at) ** 2:
                todo += [left, right]
                continue
        step = max(1, (1 << 22) // max(1, len(at)))
        for a in range(0, len(at), step):
            i, j = np.nonzero(np.bitwise_count(fps[at[a:a + step], None] ^ fps[at][None, a + 1:]) <= r)
            j += 1
            later = j > i
            for x, y in zip(at[a + i[later]].tolist(), at[a + j[later]].tolist()):
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    links.append((x, y))
    return links


def links(points: DataFrame, r: int = 2) -> DataFrame:
    """``points`` (fp long, distinct; rep long) to links (a, b) between the
    ``rep`` of fingerprints within ``r`` bits: a spanning forest per leaf."""
    spark = points.sparkSession
    n = points.count()
    # at most SAMPLE fingerprints, chosen by hash, reach the driver
    share = min(1.0, 0.8 * SAMPLE / max(n, 1))
    sample = points.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(SAMPLE).select("fp").toArrow()
    fitted = sample.column("fp").to_numpy().view(np.uint64) if sample.num_rows else np.empty(0, np.uint64)
    tree, shards = upper_tree(np.sort(fitted), max(1, -(-n // SHARD)), r)
    shared = spark.sparkContext.broadcast(tree)  # a node per SHARD fingerprints

    def deal(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            row, shard = route(shared.value, fps, r)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), batch.column("fp").take(pa.array(row)), batch.column("rep").take(pa.array(row))],
                                             names=["shard", "fp", "rep"])

    def within(group: pa.Table) -> pa.Table:
        fps, rep = group.column("fp").to_numpy().view(np.uint64), group.column("rep").to_numpy()
        order = np.argsort(fps)
        found = np.array(forest(fps[order], r), int).reshape(-1, 2)
        return pa.table({"a": rep[order][found[:, 0]], "b": rep[order][found[:, 1]]})

    dealt = points.select("fp", "rep").mapInArrow(deal, "shard int, fp long, rep long")
    return dealt.groupBy("shard").applyInArrow(within, "a long, b long")


def groups(marked: DataFrame, r: int) -> tuple[DataFrame, DataFrame]:
    """``marked`` (doc_id, fp, _row: unique) to (fp, group) and, by group, its
    first document (doc_id, _row), that of the smallest doc_id, nulls last."""
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "_row")).alias("first")
    points = materialize(marked.groupBy("fp").agg(first).select("fp", "first", F.col("first._row").alias("rep")), "points")
    found = components(links(points, r))
    named = points.join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("fp", "first", F.coalesce("component", "rep").alias("group"))
    named = materialize(named, "groups")
    return named.select("fp", "group"), named.groupBy("group").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, k: int = 3, r: int = 2) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id, the
    smallest doc_id that links of ``r`` bits or less reach."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    marked = materialize(fingerprints(rows, k), "fingerprints")
    named, firsts = groups(marked, r)
    component = named.join(firsts, "group").select("fp", F.col("first.doc_id").alias("component_id"))
    return marked.join(component.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, k: int = 3, r: int = 2) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id."""
    row, fp = free_name(docs, "_row"), free_name(docs, "_fp")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    marked = materialize(fingerprints(rows, k, out=fp, keep_text=True), "fingerprints")
    _, firsts = groups(marked.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("_row")), r)
    return marked.join(firsts.select(F.col("first._row").alias(row)), row, "left_semi").select(*docs.columns)
