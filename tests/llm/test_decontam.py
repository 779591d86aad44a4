import random
import re
from collections import Counter

import numpy as np

from tests.llm.conftest import DOCS, SF, rows_of
from tradelens.llm import decontam
from tradelens.llm.simhash import distance


def brute(text, items):
    """Every window of every item's size by the exact similarity alone."""
    words, found = re.findall(r"\w+", (text or "").lower()), {}
    for item, body in items:
        own = re.findall(r"\w+", (body or "").lower())
        k = min(5, len(own))
        if not own:
            continue

        def weights(ws):
            return Counter(" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1))

        def fp(w):
            return int(decontam.fingerprints(decontam.hashed(list(w.elements())).sum(axis=0, dtype=np.int64), w.total())[0])

        a, best = weights(own), None
        for s in range(len(words) - len(own) + 1):
            b = weights(words[s:s + len(own)])
            sim = 2 * sum((a & b).values()) / (a.total() + b.total())
            if sim >= 0.8 and (best is None or sim > best[3]):
                best = (s, len(own), (fp(a) ^ fp(b)).bit_count(), sim)
        if best:
            found[item] = best
    return found


def planted(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 50)))) for i in range(25)]
    items += [(100, items[3][1].upper()), (101, ""), (102, None), (103, "rep " * 20)]
    texts = []
    for i, (_, body) in enumerate(items[:25]):
        words = body.split()
        if i % 3 == 1:
            words[len(words) // 2] = "changed"
        if i % 3 == 2:
            words.insert(len(words) // 3, "added")
        fill = [rng.choices(vocabulary, k=rng.randrange(40)) for _ in range(2)]
        texts.append(" ".join(fill[0] + words + fill[1]))
    return items, texts + [None, "", "rep " * 300, "v1", " ".join(rng.choices(vocabulary, k=2000))]


def test_windows_equal_brute_force():
    items, texts = planted()
    index = decontam.Items([(i, t) for i, t in items if t is not None])
    for text in texts:
        assert index.matches(text) == brute(text, items)


def test_long_texts_in_parts(monkeypatch):
    items, texts = planted(8)
    text = " ".join(t for t in texts if t)
    index = decontam.Items([(i, t) for i, t in items if t is not None])
    whole = index.matches(text)
    monkeypatch.setattr(decontam, "PART", 60)
    assert index.matches(text) == whole and len(whole) > 10


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
    for radius, blocks in ((19, 4), (6, 4), (3, 8)):
        index = decontam.MultiIndex(fps, radius, blocks)
        for fp in fps[:10]:
            probe = int(fp) ^ sum({1 << int(b) for b in rng.integers(0, 64, radius)})
            assert index.near(probe).tolist() == np.flatnonzero(distance(fps, probe) <= radius).tolist()


def test_no_window_at_the_similarity_lies_beyond_the_radius():
    """Items of 6 to 400 words with as many changed words as 0.8 allows."""
    rng, lost, near = random.Random(11), 0, 0
    for trial in range(1500):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((6, 10, 25, 30, 50, 100, 400)))]
        other, changes = list(words), rng.choice((1, 1, 2, 4, 16))
        for _ in range(changes):
            other[rng.randrange(len(other))] = f"c{rng.randrange(10**6)}"
        a, b = (Counter(decontam.shingles(w, 5)) for w in (words, other))
        if decontam.similarity(a, b) >= 0.8:
            fps = [int(decontam.fingerprints(decontam.hashed(list(c.elements())).sum(axis=0, dtype=np.int64), c.total())[0]) for c in (a, b)]
            near, lost = near + 1, lost + ((fps[0] ^ fps[1]).bit_count() > decontam.RADIUS)
    assert near > 500 and lost == 0


def test_items_without_an_id_are_kept(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, "en"), (2, "clean words only here", "en")], "doc_id long, text string, Item_id string")
    benchmark = spark.createDataFrame([(None, text), (7, text), (None, "not there at all in any text")], "item_id long, text string")
    assert [r[:2] for r in rows_of(decontam.contaminated(docs, benchmark))] == [(1, None), (1, 7)]
    only = benchmark.where("item_id IS NULL")
    assert rows_of(decontam.decontaminate(docs, only)) == [(2, "clean words only here", "en")]


def test_plan_does_not_grow_with_the_blocks(spark, docs, monkeypatch):
    benchmark = spark.createDataFrame([(i, f"item {i} of some words here") for i in range(60)], "item_id long, text string")
    plans = []
    for items in (100, 4):
        monkeypatch.setattr(decontam, "ITEMS", items)
        assert len(decontam.blocks(benchmark)) == (1 if items == 100 else 15)
        plans.append([f(docs, benchmark)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") for f in (decontam.contaminated, decontam.decontaminate)])
    assert plans == [[1, 1], [1, 1]]


def test_contaminated_and_decontaminate(spark, docs, empty, monkeypatch):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items, texts = planted()
    docs = docs.unionByName(spark.createDataFrame([(3_000_000 + i, t, None, None, None) for i, t in enumerate(texts)], DOCS))
    benchmark = benchmark.select("item_id", "text").unionByName(spark.createDataFrame([(i + 10_000, t) for i, t in items], "item_id long, text string"))
    all_items = [tuple(r) for r in benchmark.collect()]
    index = decontam.Items([r for r in all_items if r[1] is not None])
    rows = docs.collect()
    want = sorted((r.doc_id, item, *m) for r in rows for item, m in index.matches(r.text).items())
    assert len(want) > 20
    assert rows_of(decontam.contaminated(docs, benchmark)) == want
    monkeypatch.setattr(decontam, "ITEMS", 7)  # several blocks and chunks, same result
    monkeypatch.setattr(decontam, "CHUNK", 20_000)
    assert rows_of(decontam.contaminated(docs, benchmark)) == want
    kept = rows_of(decontam.decontaminate(docs, benchmark))
    assert kept == sorted((tuple(r) for r in rows if not index.matches(r.text)), key=lambda r: tuple((x is not None, x) for x in r))
    assert decontam.contaminated(empty, benchmark).count() == 0
    assert decontam.decontaminate(docs, benchmark.limit(0)).count() == len(rows)
