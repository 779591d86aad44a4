"""Exact top-k inner product search by the threshold algorithm.

Vectors become integers, floor(SCALE * x). The index holds shards of vectors,
each with one list per dimension that sorts its rows by that component; it is
written to the shared folder once. A query reads the lists of a shard in
parallel, from the top for a positive weight and from the bottom for a
negative one, scores each row it meets first exactly, and stops when the
bound, the score of a row standing at the last read place of every list, is
below its kth best score.

Queries are rows as well: blocks of ``QUERIES`` of them are packed like the
shards, and a grid of (shard, block) numbers brings each block to each shard,
one pair at a time in a task; the k best of each pair are ranked in the end.

Defined results: a vector that is null, empty, or holds null or non-finite
components takes no part; vectors are compared with those of their own length;
every row whose vec_id ``every`` divides is a query, and every other row is a
candidate, also one that repeats its vec_id; ties go to the smaller vec_id;
a row without vec_id takes no part. Components of any size count whole: one
that a 64-bit integer cannot hold after scaling stops the search, and so does
a score that is found and cannot fit one. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import bounded_batches, materialize

SCALE = 64
#: Rows of a shard, and queries of a block (a task holds one of each).
SHARD, QUERIES = 16_384, 4_096
PACKED = "dim int, rows binary, ids binary, vectors binary, lists binary"
FOUND = "query_row long, query_id long, vec_id long, score long"
#: Components and scores lie below this.
LONG = 1 << 63


def whole(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, v) of the rows that take part, components as longs, written once."""
    x = F.col("embedding")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    wide = F.raise_error(F.lit("a component does not fit a 64-bit integer after scaling")).cast("long")

    def scaled(e):
        y = F.floor(e.cast("double") * SCALE)
        return F.when(F.abs(e.cast("double") * SCALE) < float(LONG), y).otherwise(wide)

    rows = vectors.where("vec_id IS NOT NULL").where(F.size(x) > 0).where(fine)
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, scaled).alias("v"))
    return materialize(rows, "topk-rows")


def pack(rows: DataFrame, size: int, lists: bool) -> DataFrame:
    """Rows in packs of about ``size`` (of one vector length each), written once.
    Rows are dealt in turn, so no vec_id brings its copies together."""
    packs = max(1, -(-rows.count() // size))

    def run(batches):
        held: dict[int, list] = {}

        def one(dim):
            part = held.pop(dim)
            row, ids, v = (np.concatenate(c) for c in zip(*part))
            order = np.argsort(ids, kind="stable")
            row, ids, v = row[order], ids[order], v[order]
            small = v.size == 0 or np.abs(v).max() < 1 << 31
            return {"dim": dim, "rows": row.astype("<i8").tobytes(), "ids": ids.astype("<i8").tobytes(), "vectors": v.astype("<i4" if small else "<i8").tobytes(),
                    "lists": np.argsort(v, axis=0, kind="stable").T.astype("<i4").tobytes() if lists else b""}

        for batch in batches:
            v = batch.column("v")
            dims = pc.list_value_length(v).to_numpy()
            row, ids = batch.column("row").to_numpy(), batch.column("vec_id").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                flat = v.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
                held.setdefault(dim, []).append((row[at], ids[at], flat))
                if sum(len(p[0]) for p in held[dim]) >= 2 * size:
                    yield pa.RecordBatch.from_pylist([one(dim)], ARROW)
        for dim in list(held):
            yield pa.RecordBatch.from_pylist([one(dim)], ARROW)

    return materialize(rows.repartition(packs).mapInArrow(run, PACKED), "topk-packs")


ARROW = pa.schema([("dim", pa.int32()), *((c, pa.binary()) for c in ("rows", "ids", "vectors", "lists"))])


def build(rows: DataFrame) -> DataFrame:
    """Shards of ``whole`` rows with a sorted list per dimension."""
    return pack(rows, SHARD, True)


def unpacked(dim: int, ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(vectors, "<i4" if len(vectors) == 4 * dim * len(ids) else "<i8").reshape(len(ids), dim)


class Best:
    """The k best (score, vec_id) of one query."""

    __slots__ = ("k", "score", "ids")

    def __init__(self, k):
        self.k, self.score, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, score, ids):
        if len(self.score) == self.k:
            good = score >= self.score[-1]
            score, ids = score[good], ids[good]
        if len(score):
            score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
            order = np.lexsort((ids, -score))[:self.k]
            self.score, self.ids = score[order], ids[order]

    def least(self):
        return self.score[-1] if len(self.score) == self.k else None


class Shard:
    """Vectors and their sorted lists."""

    def __init__(self, dim: int, rows: bytes, ids: bytes, vectors: bytes, lists: bytes):
        self.rows = np.frombuffer(rows, "<i8")
        self.ids, self.v = unpacked(dim, ids, vectors)
        self.lists = np.frombuffer(lists, "<i4").reshape(dim, len(self.ids))
        self.sorted = np.take_along_axis(self.v.T, self.lists, axis=1)  # the lists' components
        self.largest = [max(abs(int(c[0])), abs(int(c[-1]))) for c in self.sorted]
        self.wide = self.v.astype(np.float64)

    def reach(self, q: np.ndarray) -> int:
        """No score, nor a partial sum of one, can be larger."""
        return sum(abs(int(w)) * m for w, m in zip(q, self.largest))

    def scores(self, q: np.ndarray, reach: int, rows=slice(None)) -> np.ndarray:
        if reach < 1 << 53:  # floats add such integers exactly
            return (self.wide[rows] @ q.astype(np.float64)).astype(np.int64)
        if reach < LONG:
            return self.v[rows].astype(np.int64) @ q.astype(np.int64)
        exact = self.v[rows].astype(object) @ q.astype(object)
        if any(abs(int(s)) >= LONG for s in exact):
            raise OverflowError("a score does not fit a 64-bit integer")
        return exact.astype(np.int64)

    def search(self, own: int, q: np.ndarray, best: Best) -> int:
        """Threshold algorithm for the query of row ``own``; returns the depth read."""
        n, reach = len(self.ids), self.reach(q)
        exact = np.int64 if reach < LONG else object
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        weights = np.concatenate([q[up], q[down]]).astype(exact)
        seen = self.rows == own  # the query's own row is no candidate
        unseen, depth, step = n - int(seen.sum()), 0, max(1, n // 64)
        while unseen:
            # no unread row can score more than one at place ``depth`` of all lists
            tops = np.concatenate([self.sorted[up, n - 1 - depth], self.sorted[down, depth]]).astype(exact) if depth < n else weights * 0
            least = best.least()
            if least is not None and (weights * tops).sum() < least:
                break
            end = min(n, depth + step)
            new = np.zeros(n, bool)
            new[self.lists[up, n - end:n - depth]] = True
            new[self.lists[down, depth:end]] = True
            if end == n:
                new[:] = True  # a zero query reads no list
            new &= ~seen
            rows = np.flatnonzero(new)
            if len(rows):
                score = self.scores(q, reach, rows) if 2 * len(rows) < n or reach >= LONG else self.scores(q, reach)[rows]
                best.add(score, self.ids[rows])
                seen |= new
                unseen -= len(rows)
            depth, step = end, 2 * step
        return depth


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``queries`` (row, vec_id, v) against ``index``: query_id, rank, vec_id, score."""
    bounded_batches(index.sparkSession)
    shards = index.withColumn("shard", F.monotonically_increasing_id())
    blocks = pack(queries, QUERIES, False).select("dim", F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
                                                  F.monotonically_increasing_id().alias("block"))
    shards, blocks = materialize(shards, "topk-shards"), materialize(blocks, "topk-blocks")
    # numbers only: which block meets which shard
    grid = materialize(shards.select("dim", "shard").join(blocks.select("dim", "block"), "dim").select("shard", "block"), "topk-grid")
    pairs = grid.join(shards, "shard").join(blocks.drop("dim"), "block").select(
        "dim", "rows", "ids", "vectors", "lists", "q_rows", "q_ids", "q_vectors")

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                dim, rows, ids, vectors, lists, q_rows, q_ids, q_vectors = (batch.column(c)[at].as_py() for c in range(batch.num_columns))
                shard, (q_ids, q) = Shard(dim, rows, ids, vectors, lists), unpacked(dim, q_ids, q_vectors)
                found = []
                for own, query, v in zip(np.frombuffer(q_rows, "<i8").tolist(), q_ids.tolist(), q):
                    best = Best(k)
                    shard.search(own, v, best)
                    found.append((own, query, best))
                size = [len(b.ids) for _, _, b in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat([f[0] for f in found], size)), pa.array(np.repeat([f[1] for f in found], size)),
                                                  pa.array(np.concatenate([b.ids for _, _, b in found])), pa.array(np.concatenate([b.score for _, _, b in found]))],
                                                 names=["query_row", "query_id", "vec_id", "score"])

    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    out = pairs.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def top_k(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` best other rows of each row whose vec_id ``every`` divides."""
    rows = whole(embeddings)
    return search(build(rows), rows.where(F.col("vec_id") % every == 0), k)
