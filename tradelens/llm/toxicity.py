"""Toxicity scores from a bidirectional gated recurrent network with attention
pooling over word and character inputs, trained in numpy.

A word's input is its hashed word embedding beside the mean embedding of its
character (UTF-8 byte) trigrams, boundaries included. Windows of ``WINDOW``
words, each overlapping the next by half, cover a whole text; a document's
score is that of its worst window. Training takes a bounded sample of labelled
documents (``SAMPLE`` of each class, chosen by hash of doc_id among those with
words and up to ``SAMPLE_BYTES``), first on all of their windows, then on each
document's worst window by the model as it stands. Slope and bias of the logit
are then calibrated on scores of training documents by networks that have not
seen them, to the sample's share of toxic documents.

Defined results: null and empty texts, and texts without words, score 0; with
no labelled document of a class, every document scores 0; repeated label rows of a document count once, toxic if one of them is; rows
whose doc_id is null take no part in training; of texts that share a labelled
doc_id the first in order is learned. Repeated documents are scored one by one;
texts of any length are scored by all their windows; no rows give no rows; a
column named like the score is replaced by it, others are kept.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded_batches, byte_slices, text_of

WORD = re.compile(r"\w+")
WINDOW, STRIDE = 32, 16
#: Training documents of each class, and the longest text among them.
SAMPLE, SAMPLE_BYTES = 1200, 20_000
#: Parts of the sample for calibration, and the slopes tried.
FOLDS, SLOPES = 3, np.geomspace(0.05, 4, 23)
#: Least draws of a class: from all windows, and from worst ones in an epoch.
DRAWS, WORST_DRAWS = 1000, 300
WORD_BUCKETS, CHAR_BUCKETS, WIDTH, HIDDEN, ATTEND = 1 << 13, 1 << 13, 8, 8, 8
#: Weight decay of the embeddings, by the learning rate.
DECAY = 0.5
#: Windows scored at once, and words whose inputs a worker keeps.
AT_ONCE, KEPT = 4096, 200_000


def sigmoid(x):
    return np.float32(1) / (np.float32(1) + np.exp(-np.clip(x, -30, 30)))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket, trigram buckets of all words, and each word's first one."""
    coded = [w.encode() for w in words]
    buckets = np.array([zlib.crc32(w) % WORD_BUCKETS for w in coded], np.int64)
    text = np.frombuffer(b"\x02" + b"\x03\x02".join(coded) + b"\x03", np.uint8).astype(np.int64)
    size = np.array([len(w) for w in coded], np.int64)  # trigrams of "\2word\3": as many as bytes
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(2 * np.arange(len(size)), size)
    grams = (text[at] * 961 + text[at + 1] * 31 + text[at + 2] + (text[at + 1] * text[at + 2]) * 7) * 2654435761 >> 8
    return buckets, grams % CHAR_BUCKETS, first


class Network:
    """Weights, forward pass, gradients and Adam steps."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)

        def init(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        d, h, a = 2 * WIDTH, HIDDEN, ATTEND
        self.w = {"word": init(WORD_BUCKETS, WIDTH, scale=0.1), "char": init(CHAR_BUCKETS, WIDTH, scale=0.3)}
        for side in "fb":
            self.w |= {f"x{side}": init(d, 3 * h, scale=d ** -0.5), f"h{side}": init(h, 3 * h, scale=h ** -0.5), f"c{side}": np.zeros(3 * h, np.float32)}
        self.w |= {"att": init(2 * h, a, scale=(2 * h) ** -0.5), "attb": np.zeros(a, np.float32), "query": init(a, scale=1.0),
                   "out": init(2 * h, scale=(2 * h) ** -0.5), "bias": np.full(1, -1.0, np.float32)}
        self.moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.w.items()}
        self.steps = 0

    def inputs(self, feats) -> np.ndarray:
        """One input vector per word."""
        buckets, grams, first = feats
        count = np.diff(np.append(first, len(grams)))
        char = np.add.reduceat(self.w["char"][grams], first, axis=0) / np.sqrt(count)[:, None]
        return np.concatenate([self.w["word"][buckets], char.astype(np.float32)], axis=1)

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What the gates of either direction add for a word."""
        return {side: inputs @ self.w[f"x{side}"] + self.w[f"c{side}"] for side in "fb"}

    def forward(self, projected: dict, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logit of each window. ids, mask: windows x positions."""
        n, steps = ids.shape
        h = HIDDEN
        states, kept = np.empty((n, steps, 2 * h), np.float32), {}
        for side in "fb":
            state, u, rows = np.zeros((n, h), np.float32), self.w[f"h{side}"], projected[side]
            kept[side] = []
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                x = rows[ids[:, t]]
                gates = sigmoid(x[:, :2 * h] + state @ u[:, :2 * h])
                update, reset = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h:] + (reset * state) @ u[:, 2 * h:])
                on = mask[:, t, None]
                after = np.where(on, state + update * (new - state), state)
                if keep:
                    kept[side].append((t, state, update, reset, new, on))
                state = after
                if side == "f":
                    states[:, t, :h] = state
                else:
                    states[:, t, h:] = state
        seen = np.tanh(states @ self.w["att"] + self.w["attb"])
        weight = np.where(mask, seen @ self.w["query"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", weight, states)
        logit = pooled @ self.w["out"] + self.w["bias"][0]
        return (logit, (states, seen, weight, pooled, kept)) if keep else logit

    def learn(self, feats, ids, mask, label, rate: float) -> float:
        """One Adam step on the windows; returns the mean loss."""
        h, w, n = HIDDEN, self.w, len(ids)
        inputs = self.inputs(feats)
        logit, (states, seen, weight, pooled, kept) = self.forward(self.project(inputs), ids, mask, keep=True)
        p = sigmoid(logit)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        d_logit = ((p - label) / n).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = np.einsum("nth,nh->nt", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["query"] = np.einsum("nta,nt->a", seen, d_score)
        d_seen = d_score[:, :, None] * w["query"] * (1 - seen * seen)
        g["att"], g["attb"] = np.einsum("nth,nta->ha", states, d_seen), d_seen.sum(axis=(0, 1))
        d_states += d_seen @ w["att"].T
        d_inputs = np.zeros_like(inputs)
        for side, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            u, carry = w[f"h{side}"], np.zeros((n, h), np.float32)
            d_rows = np.zeros((len(inputs), 3 * h), np.float32)
            for t, state, update, reset, new, on in reversed(kept[side]):
                d = carry + d_states[:, t, part]
                d_on = np.where(on, d, 0)
                d_new = d_on * update * (1 - new * new)
                d_update = d_on * (new - state) * update * (1 - update)
                d_held = d_new @ u[:, 2 * h:].T
                d_reset = d_held * state * reset * (1 - reset)
                d_gates = np.concatenate([d_update, d_reset], axis=1)
                carry = np.where(on, d * (1 - update), d) + d_held * reset + d_gates @ u[:, :2 * h].T
                g[f"h{side}"][:, :2 * h] += state.T @ d_gates
                g[f"h{side}"][:, 2 * h:] += (reset * state).T @ d_new
                np.add.at(d_rows, ids[:, t], np.concatenate([d_gates, d_new], axis=1))
            g[f"x{side}"], g[f"c{side}"] = inputs.T @ d_rows, d_rows.sum(axis=0)
            d_inputs += d_rows @ w[f"x{side}"].T
        buckets, grams, first = feats
        count = np.diff(np.append(first, len(grams)))
        np.add.at(g["word"], buckets, d_inputs[:, :WIDTH])
        np.add.at(g["char"], grams, np.repeat(d_inputs[:, WIDTH:] / np.sqrt(count)[:, None], count, axis=0).astype(np.float32))
        self.steps += 1
        for k, grad in g.items():
            m, v = self.moment[k]
            m += np.float32(0.1) * (grad - m)
            v += np.float32(0.01) * (grad * grad - v)
            if k in ("word", "char"):  # decay: rare inputs must not learn documents by heart
                w[k] *= np.float32(1 - DECAY * rate)
            w[k] -= (rate * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(v / (1 - 0.99 ** self.steps)) + 1e-8)).astype(np.float32)
        return float(-np.mean(np.where(label > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7))))


def windows(n: int) -> list[int]:
    """Starts of the windows that cover ``n`` words."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, mask, document) of all windows of documents given as word numbers."""
    flat = np.concatenate([*docs, np.zeros(WINDOW, np.int64)]) if docs else np.zeros(WINDOW, np.int64)
    base = np.cumsum([0, *map(len, docs)])
    starts = [np.array(windows(len(d))) if len(d) else np.empty(0, int) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
    start = np.concatenate(starts).astype(np.int64) if starts else np.empty(0, np.int64)
    size = np.array([len(d) for d in docs], np.int64)
    at = start[:, None] + np.arange(WINDOW)
    mask = at < size[owner][:, None]
    return np.where(mask, flat[np.minimum(at + base[owner][:, None], len(flat) - 1)], 0), mask, owner


def train(texts: list[str], labels: list[int], epochs: int = 6, seed: int = 1) -> Network:
    """Fit the network to labelled documents."""
    net, rng = Network(seed), np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
    ids, mask, owner = laid_out(docs)
    label = np.array(labels, np.float32)[owner]
    buckets, grams, first = features(list(number))
    ends = np.append(first, len(grams))

    def step(chosen, rate):
        used, local = np.unique(ids[chosen], return_inverse=True)
        count = ends[used + 1] - ends[used]
        own = np.cumsum(count) - count
        at = np.repeat(first[used] - own, count) + np.arange(count.sum())
        net.learn((buckets[used], grams[at], own), local.reshape(ids[chosen].shape), mask[chosen], label[chosen], rate)

    def logits():
        projected = net.project(net.inputs((buckets, grams, first)))
        return np.concatenate([net.forward(projected, ids[i:i + AT_ONCE], mask[i:i + AT_ONCE]) for i in range(0, len(ids), AT_ONCE)])

    def balanced(chosen, n):
        pos, neg = chosen[label[chosen] > 0], chosen[label[chosen] == 0]
        return rng.permutation(np.concatenate([rng.choice(c, n) for c in (pos, neg) if len(c)]))

    positive = len(set(owner[label > 0].tolist()))
    everything = balanced(np.arange(len(ids)), min(6000, max(DRAWS, 2 * int(label.sum()))))
    for i in range(0, len(everything), 100):
        step(everything[i:i + 100], 0.01)
    for epoch in range(epochs):
        order = np.lexsort((-logits(), owner))
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        worst = order[(place < 1) | ((label[order] == 0) & (place < 2))]  # clean documents: the two worst
        chosen = balanced(worst, min(max(1500, 3000 // (epoch + 1)), max(WORST_DRAWS, 4 * positive)))
        for i in range(0, len(chosen), 100):
            step(chosen[i:i + 100], 0.01 if epoch < epochs // 2 else 0.003)
    return net


class Scorer:
    """A worker's network and the gate inputs of the words it has met."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.rows = {side: np.zeros((1024, 3 * HIDDEN), np.float32) for side in "fb"}

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.number) > KEPT:
            self.clear()
        words = [words_of(t) for t in texts]
        before = len(self.number)
        known = self.number
        new = list({w for ws in words for w in ws if w not in known})
        known.update(zip(new, range(before, before + len(new))))
        for side, part in self.net.project(self.net.inputs(features(new))).items() if new else ():
            if len(known) > len(self.rows[side]):
                self.rows[side] = np.concatenate([self.rows[side], np.zeros((len(known) + len(known) // 2 - len(self.rows[side]), 3 * HIDDEN), np.float32)])
            self.rows[side][before:len(known)] = part
        ids, mask, owner = laid_out([np.array([*map(known.__getitem__, ws)], np.int64) for ws in words])
        out = np.zeros(len(texts))
        for i in range(0, len(ids), AT_ONCE):
            p = sigmoid(self.net.forward(self.rows, ids[i:i + AT_ONCE], mask[i:i + AT_ONCE]))
            np.maximum.at(out, owner[i:i + AT_ONCE], p.astype(np.float64))
        return out


def calibration(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope (one of ``SLOPES``) and bias of least loss at the labels' mean."""
    best = None
    for slope in SLOPES:
        low, high = -100.0, 100.0
        for _ in range(60):
            bias = (low + high) / 2
            p = 1 / (1 + np.exp(-np.clip(slope * logit + bias, -30, 30)))
            low, high = (low, bias) if p.mean() > label.mean() else (bias, high)
        loss = -np.mean(np.where(label > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7)))
        if best is None or loss < best[0]:
            best = loss, slope, bias
    return best[1:]


def train_calibrated(spark: SparkSession, texts: list[str], labels: list[int]) -> Network:
    """A network of all documents, its logits calibrated by cross-validation. The
    folds' trainings and the last one are independent: a Spark task each."""
    label, fold, logit = np.array(labels), np.empty(len(labels), int), np.zeros(len(labels))
    for kind in (0, 1):
        fold[label == kind] = (np.arange((label == kind).sum()) + kind) % FOLDS
    shared = spark.sparkContext.broadcast((texts, label, fold))  # the bounded sample
    last = FOLDS

    def run(batches):
        texts, label, fold = shared.value
        for f in (f for batch in batches for f in batch.column(0).to_pylist()):
            seen, other = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            net = train([texts[i] for i in seen], label[seen].tolist()) if f == last or len(other) else None
            p = Scorer(net).score([texts[i] for i in other]) if len(other) else np.empty(0)
            weights = pickle.dumps(net.w) if f == last else None
            yield pa.RecordBatch.from_arrays([pa.array([f]), pa.array([p.astype("<f8").tobytes()]), pa.array([weights], pa.binary())], names=["fold", "scores", "weights"])

    net = Network.__new__(Network)
    for row in spark.range(0, last + 1, 1, last + 1).mapInArrow(run, "fold long, scores binary, weights binary").collect():  # weights: under 1 MB
        p = np.frombuffer(row.scores, "<f8")
        logit[fold == row.fold] = np.log(np.clip(p, 1e-7, 1 - 1e-7) / np.clip(1 - p, 1e-7, 1))
        if row.weights is not None:
            net.w = pickle.loads(row.weights)
    slope, bias = calibration(logit, label)
    net.w["out"] = (slope * net.w["out"]).astype(np.float32)
    net.w["bias"] = (slope * net.w["bias"] + bias).astype(np.float32)
    return net


def held_out(doc_id="doc_id"):
    """crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Train on the bounded sample of labelled rows that are not held out."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = docs.select("doc_id", text_of().alias("text")) \
        .where((F.octet_length("text") <= SAMPLE_BYTES) & F.col("text").rlike(r"[\p{L}\p{N}_]"))
    marked = marked.join(usable.select("doc_id"), "doc_id", "left_semi")
    chosen = None
    for kind in (0, 1):  # ids by hash, then a join with these few
        part = marked.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    # of the texts that share a doc_id the first in order
    rows = usable.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy())
    texts, kinds = rows.column("text").take(order).to_pylist(), rows.column("toxic").take(order).to_pylist()
    used = [(t, k) for t, k in zip(texts, kinds) if WORD.search(t)]
    if len({k for _, k in used}) < 2:
        return None
    return train_calibrated(docs.sparkSession, [t for t, _ in used], [k for _, k in used])


def score(docs: DataFrame, net: Network | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus each whole text's score (a column of that name is replaced)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([f for f in docs.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])
    shared = spark.sparkContext.broadcast(None if net is None else net.w)  # weights: under 1 MB

    def run(batches):
        scorer = None
        if shared.value is not None:
            model = Network.__new__(Network)
            model.w = shared.value
            scorer = Scorer(model)
        for batch in batches:
            for part in byte_slices(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                scores = scorer.score(texts) if scorer else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(scores)], names=[*kept, out])

    return docs.select(*kept).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
