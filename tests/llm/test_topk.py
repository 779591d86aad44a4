import math
import random

import numpy as np
import pytest

from tests.llm.conftest import SF, rows_of
from tradelens.llm import topk

COLS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    fine = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, q) in enumerate(fine):
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for other, (j, v) in enumerate(fine) if other != at and len(v) == len(q))[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def odd_rows():
    rng = random.Random(3)
    rows = [(10_000 + i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    rows += [(20_000 + i, [0.5] * 8) for i in range(100)] + [(20_020, [0.25] * 8), (21_000, [0.0] * 8)]
    rows += [(30_000, None), (30_020, []), (30_040, [1.0, None]), (30_060, [float("nan")] * 8), (30_080, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(40_000, [1000.0, -2000.0]), (40_001, [3.0, 4.0]), (50_000, [7.0])]
    return rows


@pytest.mark.parametrize("shard, block", [(16_384, 4_096), (60, 5)])
def test_top_k_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "QUERIES", block)
    small = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    df = small.unionByName(spark.createDataFrame([(*r, 0) for r in odd_rows()], COLS))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert rows_of(topk.top_k(df)) == want


def test_threshold_stops_early_and_stays_exact():
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, (4000, 4)).astype(np.int32)
    v[:40] *= 100
    ids = np.arange(4000, dtype="<i8").tobytes()
    shard = topk.Shard(4, ids, ids, v.astype("<i4").tobytes(), np.argsort(v, axis=0, kind="stable").T.astype("<i4").tobytes())
    depths = []
    for q in (np.array([1, 2, -1, 0]), np.array([50, -3, 1, 1]), np.array([0, 0, 0, 0])):
        best = topk.Best(20)
        depths.append(shard.search(-1, q.astype(np.int32), best))
        want = sorted((-int(s), i) for i, s in enumerate(v.astype(np.int64) @ q))[:20]
        assert [(-int(s), int(i)) for s, i in zip(best.score, best.ids)] == want
    assert depths[0] < 1000  # a quarter of the lists; steps double


def test_large_components_stay_exact(spark):
    """Components of any size a float holds, scores up to 63 bits, with an extra column."""
    rng = random.Random(7)
    rows = [(1, [1e6, 1e6]), (2, [3e5, 2e6]), (3, [2e6, 2e6]), (20, [1e6, 1e6]), (40, [-1e6, 2e6]), (60, [2.0**20, -(2.0**20)])]
    rows += [(100 + i, [rng.uniform(-1, 1) * 10 ** rng.uniform(0, 7) for _ in range(2)]) for i in range(300)]
    rows += [(1000, [2.0**50, 1.0, 0.0]), (1001, [0.0, 2.0**50, 1.0]), (1002, [1.0, -1.0, 1.0])]
    df = spark.createDataFrame([(*r, 0, 1) for r in rows], COLS + ", Score int")
    got = rows_of(topk.top_k(df))
    assert got == brute(rows)
    assert [r[2] for r in got if r[0] == 20][0] in {r[0] for r in rows if r[0] >= 3}


def test_sums_beyond_a_long(spark):
    rows = [(0, [2.0**24, 2.0**24]), (1, [2.0**27, -(2.0**27)]), (2, [2.0**26, -(2.0**26) + 8])]      # parts overflow, sums don't
    assert rows_of(topk.top_k(spark.createDataFrame([(*r, 0) for r in rows], COLS))) == brute(rows)
    for bad in ([(0, [2.0**40]), (1, [2.0**40])], [(0, [2.0**60]), (1, [0.0])]):
        with pytest.raises(Exception, match="64-bit"):
            topk.top_k(spark.createDataFrame([(*r, 0) for r in bad], COLS)).collect()


def test_rows_that_repeat_a_vec_id(spark):
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [3.0, 1.0]), (1, [1.0, 1.0])] * 3
    assert rows_of(topk.top_k(spark.createDataFrame([(*r, 0) for r in rows], COLS))) == brute(rows)


def test_empty(spark):
    assert topk.top_k(spark.createDataFrame([], COLS)).count() == 0
