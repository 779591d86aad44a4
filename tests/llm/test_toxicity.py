import math
import random
import zlib

import numpy as np

from tests.llm.conftest import DOCS, rows_of
from tradelens.llm import toxicity


def corpus(n=500, seed=1):
    """Texts of made-up words; toxic ones hold a few words on one of two stems."""
    rng = random.Random(seed)
    parts = "ba ce di fo gu ha ji ko lu me".split()
    out = []
    for i in range(n):
        words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 150))]
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["vrax", "zonk"]) + "".join(rng.choices(parts, k=rng.randrange(3)))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_gradients_match_differences():
    net, rng = toxicity.Network(3), np.random.default_rng(0)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    feats = toxicity.features(["ab", "éa", "c", "longer"])
    ids, mask = rng.integers(0, 4, (3, 5)), np.arange(5) < np.array([[5], [3], [1]])
    label = np.array([1.0, 0, 1])

    def loss():
        p = 1 / (1 + np.exp(-net.forward(net.project(net.inputs(feats)), ids, mask)))
        return -np.mean(np.where(label > 0, np.log(p), np.log(1 - p)))

    before = {k: v.copy() for k, v in net.w.items()}
    net.learn(feats, ids, mask, label, 0.0)
    for k in ("xf", "hf", "xb", "hb", "cb", "att", "attb", "query", "out", "bias"):
        grad = net.moment[k][0] / 0.1
        at = tuple(rng.integers(0, s) for s in grad.shape)
        sides = []
        for e in (1e-2, -1e-2):
            net.w[k] = before[k].copy()
            net.w[k][at] += e
            sides.append(loss())
        net.w[k] = before[k]
        assert abs((sides[0] - sides[1]) / 2e-2 - grad[at]) < 2e-3


def test_forward_pass_as_a_plain_loop():
    """One text, number by number: gates of both directions, attention, the best window."""
    net, rng = toxicity.Network(5), random.Random(2)
    text = " ".join("".join(rng.choices("abcd\u00e9", k=rng.randrange(1, 6))) for _ in range(toxicity.WINDOW + 11))
    w, h = {k: v.astype(float) for k, v in net.w.items()}, toxicity.HIDDEN
    words, best = toxicity.words_of(text), -1.0
    dot = lambda xs, ys: sum(float(x) * float(y) for x, y in zip(xs, ys))
    sig = lambda x: 1 / (1 + math.exp(-x))
    vectors = []
    for word in words:
        buckets, grams, _ = toxicity.features([word])
        vectors.append([*w["word"][buckets[0]], *(sum(w["char"][g][d] for g in grams) / math.sqrt(len(grams)) for d in range(toxicity.WIDTH))])
    for start in toxicity.windows(len(words)):
        inside, sides = vectors[start:start + toxicity.WINDOW], {}
        for side in "fb":
            state, states = [0.0] * h, []
            for x in inside if side == "f" else inside[::-1]:
                add = [dot(x, w[f"x{side}"][:, j]) + w[f"c{side}"][j] for j in range(3 * h)]
                update = [sig(add[j] + dot(state, w[f"h{side}"][:, j])) for j in range(h)]
                reset = [sig(add[h + j] + dot(state, w[f"h{side}"][:, h + j])) for j in range(h)]
                held = [r * s for r, s in zip(reset, state)]
                new = [math.tanh(add[2 * h + j] + dot(held, w[f"h{side}"][:, 2 * h + j])) for j in range(h)]
                state = [s + u * (n - s) for s, u, n in zip(state, update, new)]
                states.append(state)
            sides[side] = states if side == "f" else states[::-1]
        both = [f + b for f, b in zip(sides["f"], sides["b"])]
        weight = [math.exp(dot([math.tanh(dot(s, w["att"][:, a]) + w["attb"][a]) for a in range(len(w["attb"]))], w["query"])) for s in both]
        pooled = [sum(q * s[j] for q, s in zip(weight, both)) / sum(weight) for j in range(2 * h)]
        best = max(best, sig(dot(pooled, w["out"]) + w["bias"][0]))
    assert len(toxicity.windows(len(words))) > 1 and abs(toxicity.Scorer(net).score([text])[0] - best) < 1e-4


def test_texts_that_share_a_doc_id_train_the_same_network(spark):
    rows = corpus(60)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(i, t + " other") for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    one, two = (toxicity.fit(d, labels) for d in (docs, docs.repartition(5).orderBy("text")))
    assert all(np.array_equal(one.w[k], two.w[k]) for k in one.w)


def test_held_out_accuracy_and_contract(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t, _ in rows] + [(9001, None, None, None, None), (9002, "", None, None, None), (None, "ba", None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows] + [(0, 1, 1), (9001, 0, 0), (None, 0, 1), (9002, 0, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    for i, r in got.items():
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert got[9001].score == got[9002].score == 0
    test = [(i, y) for i, _, y in rows if got[i].held_out]
    assert np.mean([got[i].predicted == y for i, y in test]) > 0.95


def test_windows_cover_long_texts():
    for n in (1, 31, 32, 33, 48, 49, 1000):
        seen = set()
        starts = toxicity.windows(n)
        for s in starts:
            seen |= set(range(s, min(n, s + toxicity.WINDOW)))
        assert seen == set(range(n)) and all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_score_does_not_depend_on_batch_or_memo(monkeypatch):
    texts = [t for _, t, _ in corpus(60)]
    net = toxicity.Network(5)
    whole = toxicity.Scorer(net).score(texts)
    monkeypatch.setattr(toxicity, "KEPT", 20)
    one = toxicity.Scorer(net)
    assert np.allclose(whole, [one.score([t])[0] for t in texts], atol=1e-5)


def test_no_labels_and_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r[2] for r in rows_of(toxicity.toxicity(docs, none))} == {0.0}
    assert toxicity.toxicity(empty, none).count() == 0


def test_few_labels_train_a_network(spark):
    labels_of = "doc_id long, quality int, toxic int"
    for n, least in ((1, 0), (12, 0), (400, 0.9)):
        rows = corpus(n * 4 if n < 100 else n)
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t, _ in rows], DOCS)
        got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame([(i, 0, y) for i, _, y in rows], labels_of)).collect()}
        assert len({r.score for r in got.values()}) > 1
        test = [r for r in rows if got[r[0]].held_out] if n > 1 else []
        clean, toxic = [got[i].predicted for i, _, y in test if not y], [got[i].predicted for i, _, y in test if y]
        assert sum(clean) <= 0.15 * len(clean) and sum(toxic) >= least * len(toxic)


def test_sample_is_chosen_among_usable_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 6)
    monkeypatch.setattr(toxicity, "train_calibrated", lambda spark, texts, labels: labels, raising=False)
    rows = [(i, "ba " * (10_000 if i % 3 else 5), i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows] + [(5000 + i, 0, i % 2) for i in range(100)], "doc_id long, quality int, toxic int")
    assert sorted(toxicity.fit(docs, labels)) == [0] * 6 + [1] * 6


def test_columns_of_clashing_names(spark):
    rows = corpus(60)
    docs = spark.createDataFrame([(i, t, 7.0, "x", 1) for i, t, _ in rows], "doc_id long, text string, Score double, label string, toxic int")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, Text string")
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 60 and got.where("score = 7").count() == 0
