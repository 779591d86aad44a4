"""URL filter: rules first, gradient-boosted trees for the rest.

A rule (verdict, host, path) fits its host and all subdomains when the path
starts with the rule's; of those that fit, the longest (host and path
together) decides. What no rule decides goes to boosted trees over lexical
features: lengths, depth, digit and letter-case ratios, entropy, numbers of
parameters, host labels and hyphens, and suffix statistics, the share of
blocked URLs among all labelled ones with the same host suffix, file suffix or
top folder.

The trees learn from labelled URLs, by default those that a rule decides.
Suffix statistics count every labelled row; they are kept in ``BUCKETS``
buckets by the suffix's hash, so their size is fixed (suffixes that share a
bucket share its statistics). The trees are fitted in one task on the
``SAMPLE`` distinct URLs of each class with the smallest hashes.

Defined results: a null URL is empty; without ``://`` host and path are empty
and no rule fits; URLs of any length count whole; rules of equal length go by
their text; without labelled URLs, or at a score of a half, the verdict is
allow; repeated rows are judged one by one; no rows give no rows; an input
column named like a result is replaced by it.
"""

from __future__ import annotations

import json
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import bounded_batches, byte_slices, free_name, materialize

#: Buckets of suffix statistics, and distinct URLs of each class for the trees.
BUCKETS, SAMPLE = 1 << 16, 10_000
#: Trees: number, depth, bins of a feature, step, weight decay, least weight of a leaf.
TREES, DEPTH, BINS, STEP, DECAY, LEAST = 60, 4, 32, 0.2, 1.0, 5.0
#: Labelled URLs go by hash into folds; while training, a row sees the statistics of the other folds.
FOLDS = 5
#: Rows that a bucket's share is drawn to the overall share by.
PRIOR = 4.0
#: URL bytes looked at together.
SLICE = 1 << 20
SUFFIXES = ("host1", "host2", "host3", "file", "top", "site")
OUT = ("host", "path", "rule", "verdict", "score")

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def decided(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]), reverse=True):  # the last one set wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def with_rules(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``df`` plus host, path, rule and (the rule's) verdict."""
    kept = [c for c in df.columns if c.lower() not in OUT or c == url]
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    parts = df.select(*kept, host_of(u).alias("host"), path_of(u).alias("path"))
    rule, verdict = decided(rules, F.col("host"), F.col("path"))
    return parts.select("*", rule.alias("rule"), verdict.alias("verdict"))


def _suffix_buckets() -> list[Column]:
    """The bucket of each kind of suffix: the last one, two, three host labels; the path's file
    suffix; the path's top folder alone and behind the last host label."""
    top = F.regexp_extract("path", r"^/[^/]*/", 0)
    keys = [F.substring_index("host", ".", -n) for n in (1, 2, 3)] + [F.regexp_extract("path", r"(\.[^./]*|/)$", 1), top, F.concat(F.substring_index("host", ".", -1), top)]
    return [F.pmod(F.xxhash64(F.lit(kind), key), F.lit(BUCKETS)).cast("int").alias(f"_{kind}") for kind, key in zip(SUFFIXES, keys)]


def features(urls: pa.Array, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
    """Lexical features, a row for each URL."""
    def counts(column):
        column = column.cast(pa.large_binary())
        size = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
        row = np.repeat(np.arange(len(size)), size)
        return size, np.bincount(row * 256 + raw, minlength=256 * len(size)).reshape(-1, 256)

    def entropy(n, by):
        share = by / np.maximum(n, 1)[:, None]
        return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)

    def of(by, chars):
        return by[:, np.frombuffer(chars.encode(), np.uint8)].sum(axis=1)

    (n, u), (nh, h), (np_, p) = map(counts, (urls, hosts, paths))
    digits, one = of(u, string.digits), np.maximum(n, 1)
    query = of(u, "?") > 0
    columns = [np.log1p(n), np.log1p(nh), np.log1p(np_), of(p, "/"), digits / one, of(p, string.digits), of(h, string.digits), entropy(n, u),
               entropy(nh, h), entropy(np_, p), query * (1 + of(u, "&")), of(u, "="), of(u, "#") > 0, of(h, "."), of(h, "-"), of(p, "-_"), of(u, "%"),
               of(u, string.ascii_uppercase) / one, of(p, ".")]
    return np.stack([c.astype(np.float64) for c in columns], axis=1)


class Trees:
    """Boosted regression trees of fixed depth on binned features, logistic loss."""

    def __init__(self, bias: float, edges=None, splits=None, leaves=None):
        self.bias, self.edges = bias, edges or []  # bin edges of each feature
        self.splits, self.leaves = splits or [], leaves or []  # per tree: (feature, bin) by node; values of the leaves

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        share = (weight @ y) / weight.sum()
        model = Trees(float(np.log(share / (1 - share))), [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)).tolist() for c in x.T])
        bins = model.binned(x)
        n, wide = bins.shape
        margin = np.full(n, model.bias)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = weight * (p - y), weight * p * (1 - p)
            node, splits = np.zeros(n, np.int64), []
            for depth in range(DEPTH):
                nodes = 1 << depth
                cell = ((node[:, None] * wide + np.arange(wide)) * BINS + bins).ravel()
                g, h = (np.bincount(cell, np.repeat(v, wide), nodes * wide * BINS).reshape(nodes, wide, BINS).cumsum(axis=2) for v in (grad, hess))
                total_g, total_h = g[:, :, -1:], h[:, :, -1:]
                gain = g ** 2 / (h + DECAY) + (total_g - g) ** 2 / (total_h - h + DECAY)
                gain = np.where((h >= LEAST / 4) & (total_h - h >= LEAST / 4), gain, -1.0)
                best = gain.reshape(nodes, -1).argmax(axis=1)
                splits += [(int(b) // BINS, int(b) % BINS) for b in best]
                at = np.array(splits[-nodes:])[node]
                node = 2 * node + (bins[np.arange(n), at[:, 0]] > at[:, 1])
            g, h = (np.bincount(node, v, 1 << DEPTH) for v in (grad, hess))
            leaves = -STEP * g / (h + DECAY)
            margin += leaves[node]
            model.splits.append(splits)
            model.leaves.append(leaves.tolist())
        return model

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.bias)
        bins, row = self.binned(x) if self.edges else None, np.arange(len(x))
        for splits, leaves in zip(self.splits, self.leaves):
            node, base = np.zeros(len(x), np.int64), 0
            for depth in range(DEPTH):
                at = np.array(splits[base:base + (1 << depth)])[node]
                node = 2 * node + (bins[row, at[:, 0]] > at[:, 1])
                base += 1 << depth
            margin += np.array(leaves)[node]
        return 1 / (1 + np.exp(-margin))

    def dump(self) -> str:
        return json.dumps([self.bias, self.edges, self.splits, self.leaves])


class Model:
    """Trees and the suffix statistics they look at: rows and blocked rows by fold and bucket."""

    def __init__(self, trees: Trees, rows: np.ndarray, blocked: np.ndarray):
        self.trees, self.by_fold = trees, (rows, blocked)
        self.rows, self.blocked = rows.sum(axis=0), blocked.sum(axis=0)
        self.share = blocked.sum() / max(1.0, rows.sum())

    def matrix(self, part: pa.RecordBatch, fold=None) -> np.ndarray:
        """Features of the rows; those of a ``fold`` don't see its statistics."""
        columns = [features(part.column("_url"), part.column("host"), part.column("path"))]
        for kind in SUFFIXES:
            at = part.column(f"_{kind}").to_numpy(zero_copy_only=False)
            n, k = self.rows[at], self.blocked[at]
            if fold is not None:
                n, k = n - self.by_fold[0][fold, at], k - self.by_fold[1][fold, at]
            columns.append(((k + PRIOR * self.share) / (n + PRIOR))[:, None])
        return np.concatenate(columns, axis=1)


def fit(labelled: DataFrame, url: str = "url", blocked: str = "blocked") -> Model:
    """A model from labelled URLs (``blocked``: boolean; null rows are passed over).

    At most FOLDS * BUCKETS small rows and one model come to the driver."""
    spark = labelled.sparkSession
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = labelled.where(F.col(blocked).isNotNull()).select(u.alias("_url"), host_of(u).alias("host"), path_of(u).alias("path"), F.col(blocked).alias("_blocked"))
    rows = rows.select("*", *_suffix_buckets(), F.pmod(F.xxhash64(F.lit("fold"), "_url"), F.lit(FOLDS)).cast("int").alias("_fold"))
    each = rows.select("_blocked", "_fold", F.explode(F.array(*[f"_{k}" for k in SUFFIXES])).alias("bucket"))
    stats = each.groupBy("_fold", "bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("_blocked").alias("k")).toArrow()
    n, k = np.zeros((FOLDS, BUCKETS)), np.zeros((FOLDS, BUCKETS))
    at = stats.column("_fold").to_numpy(), stats.column("bucket").to_numpy()
    n[at], k[at] = stats.column("n").to_numpy(), stats.column("k").to_numpy()
    total, bad = n.sum() / len(SUFFIXES), k.sum() / len(SUFFIXES)
    if not bad or bad == total:  # one class at most: its verdict for all
        return Model(Trees(0.0 if not total else 20.0 if bad else -20.0), n, k)
    shared = spark.sparkContext.broadcast(Model(Trees(0.0), n, k))
    one = rows.distinct().withColumn("_hash", F.xxhash64("_url"))
    chosen = [one.where(f"_blocked = {c}").orderBy("_hash", "_url").limit(SAMPLE) for c in ("true", "false")]
    sample = materialize(chosen[0].unionByName(chosen[1]).drop("_hash"), "url-sample")
    weights = (bad / total, 1 - bad / total)

    def train(batches):
        table = pa.Table.from_batches(batches)
        if not table.num_rows:
            return
        table = table.combine_chunks().sort_by([("_url", "ascending"), ("_blocked", "ascending")])
        part = table.combine_chunks().to_batches()[0]
        y = part.column("_blocked").to_numpy(zero_copy_only=False).astype(np.float64)
        x = shared.value.matrix(part, part.column("_fold").to_numpy(zero_copy_only=False))
        found = np.maximum(1, [y.sum(), len(y) - y.sum()])
        weight = np.where(y > 0, weights[0] / found[0], weights[1] / found[1]) * len(y)
        # each row once more with half of its statistics unknown, as for a suffix never labelled
        again, unknown = x.copy(), np.random.default_rng(0).random((len(x), len(SUFFIXES))) < 0.5
        again[:, -len(SUFFIXES):][unknown] = shared.value.share
        trees = Trees.fit(np.concatenate([x, again]), np.concatenate([y, y]), np.concatenate([weight, weight]))
        yield pa.RecordBatch.from_arrays([pa.array([trees.dump()])], names=["model"])

    trees = sample.repartition(1).mapInArrow(train, "model string").first()
    return Model(Trees(*json.loads(trees.model)), n, k)


def score(df: DataFrame, model: Model, url: str = "url", out: str = "score") -> DataFrame:
    """``df`` plus the probability that the URL belongs to the blocked ones. Needs
    ``host`` and ``path`` (see ``with_rules``)."""
    spark = df.sparkSession
    bounded_batches(spark)
    kept = [c for c in df.columns if c != out]
    names = {c: free_name(df, c) for c in ("_url", *(f"_{k}" for k in SUFFIXES))}
    buckets = [b.alias(names[f"_{k}"]) for k, b in zip(SUFFIXES, _suffix_buckets())]
    rows = df.select(*kept, F.coalesce(F.col(url).cast("string"), F.lit("")).alias(names["_url"]), *buckets)
    schema = T.StructType([f for f in rows.schema.fields if f.name in kept] + [T.StructField(out, T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in byte_slices(batch, names["_url"], SLICE):
                looked = pa.RecordBatch.from_arrays([part.column(names.get(c, c)) for c in ("host", "path", *names)], names=["host", "path", *names])
                found = model.trees.score(model.matrix(looked))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(found)], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def judge(df: DataFrame, rules: list[Rule], url: str = "url", model: Model | None = None) -> DataFrame:
    """``df`` plus host, path, rule, verdict and the trees' score. Without a
    ``model`` the trees learn from the rows that a rule decides."""
    rows = with_rules(df, rules, url)
    if model is None:
        model = fit(rows.where(F.col("verdict").isNotNull()).select(F.col(url).alias("url"), (F.col("verdict") == "block").alias("blocked")))
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return score(rows, model, url).withColumn("verdict", F.coalesce("verdict", own))


#: The contract's rules.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def verdicts(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict and score."""
    return judge(pages.select("page_id", "url"), RULES if rules is None else rules).drop("url")
