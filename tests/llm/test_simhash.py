import random
import re

import numpy as np
import xxhash

from tests.llm.conftest import DOCS, rows_of
from tradelens.llm import simhash
from tradelens.llm.graph import components


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def brute(docs):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    fps = sorted({f for _, f in rows})
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    part = dict(zip(fps, brute_components(len(fps), links)))
    least = {}
    for d, f in rows:
        if d is not None:
            least[part[f]] = min(d, least.get(part[f], d))
    return sorted(((d, f"{f:016x}", least.get(part[f])) for d, f in rows), key=lambda r: tuple((x is not None, x) for x in r))


def near_copies(n, seed=3):
    """Texts of many words with a few changed, so fingerprints differ by few bits."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(600)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
        out.append(" ".join(words))
    return out


def test_fingerprint_of_long_text_in_parts(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "AT_ONCE", 100)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_near_duplicates(spark, docs, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 40)
    more = spark.createDataFrame([(2_000_000 + i, t, None, None, None) for i, t in enumerate(near_copies(120))], DOCS)
    all_docs = docs.unionByName(more)
    got = rows_of(simhash.near_duplicates(all_docs))
    assert got == brute(all_docs)
    assert len({c for d, _, c in got if d and d >= 2_000_000}) < 120


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_routing_loses_no_pair():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = np.unique(np.array([int(rng.choice(centres)) ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))}) for _ in range(3000)], np.uint64))
    close = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[:i]) <= 2)]
    assert len(close) > 1000
    want = brute_components(len(fps), close)
    assert brute_components(len(fps), simhash.forest(fps, 2)) == want
    for shards in (1, 2, 7, 60):
        tree, n = simhash.upper_tree(fps[::5], shards, 2)
        row, shard = simhash.route(tree, fps, 2)
        meet = [set() for _ in fps]
        for a, s in zip(row, shard):
            meet[a].add(s)
        assert all(meet) and all(meet[i] & meet[j] for i, j in close)
        assert max(shard) < n


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    want = brute_components(600, links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: want[i] for pair in links if pair[0] != pair[1] for i in pair}
    assert len(got) == len({r.node for r in got})


def test_stages_keep_columns_named_like_helpers(spark, monkeypatch):
    import corpus_pipeline

    rows = [(1, "a b c d", "r1", "f1", "t1"), (2, "a b c d", "r2", "f2", "t2"), (3, "some other words here", "r3", "f3", "t3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ROW string, _fp string, _toxicity string")
    assert rows_of(simhash.deduplicate(docs)) == [rows[0], rows[2]]
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert rows_of(corpus_pipeline.keep_civil(spark, docs, "")) == rows
