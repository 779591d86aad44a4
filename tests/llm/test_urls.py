import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF, rows_of
from tradelens.llm import urls

ODD = [None, "", "no scheme.org/x", "http://", "://org", "://ORG", "://.org/", "HTTP://WWW.Example.ORG/es/", "http://example.org/ES/", "http://notorg/", "http://org:80/",
       "http://u@a.org/en/1", "http://a.example.org/en/19?x=1&y=2#z", "http://example.org?es/", "http://example.org#/es/", "http://com/de/x", "http://b.com/fr", "http://b.com/fr/",
       "http://x://y.org/", "a\nb://c.org/\nd?e", "http://ÄÖ.org/ü", "http://x.org/" + "a/1" * 100_000, "http://a.com/de/1", "http://a.com/de/1"]


def plain(url, rules=urls.RULES):
    """(host, path, rule, its verdict) of one URL."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0] or [len(rest)])
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[:min([i for i in map(path.find, "?#") if i >= 0] or [len(path)])]
    best = None
    for say, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, say)
    return host, path, *(best or (None, None))


def test_rules_against_brute_force(spark):
    given = [(i - 1000, u) for i, u in enumerate(ODD)] + [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    got = {r.page_id: r for r in urls.verdicts(spark.createDataFrame(given[::-1], "page_id long, url string")).collect()}
    by_id = dict(given)
    assert got.keys() == by_id.keys()
    for page, row in got.items():
        host, path, rule, verdict = plain(by_id[page])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or ("block" if row.score > 0.5 else "allow"))


def invented(n, seed=0):
    """URLs whose class follows from their looks alone."""
    pick = random.Random(seed)
    out = []
    for i in range(n):
        bad = pick.random() < 0.3
        host = f"w{pick.randint(0, 50)}.{'ads' if bad else 'news'}.example.{'net' if pick.random() < 0.5 else 'com'}" if i % 2 else f"w{pick.randint(0, 9)}.example.net"
        path = "".join(f"/{pick.randint(10**6, 10**9)}" for _ in range(5)) + "?a=1&b=2&c=3" if bad else f"/{pick.choice(['story', 'page', 'text'])}/{pick.randint(1, 9)}"
        out.append((i, f"https://{host}{path}", bad))
    return out


def test_held_out_accuracy(spark):
    df = spark.createDataFrame(invented(3000), "page_id long, url string, blocked boolean")
    held = F.crc32(F.col("url").cast("binary")) % 4 == 2
    model = urls.fit(df.where(~held))
    found = urls.score(urls.with_rules(df.where(held), []), model).collect()
    assert len(found) > 500 and sum((r.score > 0.5) == r.blocked for r in found) / len(found) > 0.97


def test_rule_labels_held_out(spark):
    """Rule-labelled pages: the trees tell the other quarter better than the larger class does."""
    rows = urls.with_rules(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url"), urls.RULES).where("verdict IS NOT NULL")
    held = F.crc32(F.col("url").cast("binary")) % 4 == 2
    model = urls.fit(rows.where(~held).select("url", (F.col("verdict") == "block").alias("blocked")))
    found = urls.score(rows.where(held), model).collect()
    right = sum((r.score > 0.5) == (r.verdict == "block") for r in found) / len(found)
    assert right > 0.9 > sum(r.verdict == "allow" for r in found) / len(found)


def test_trees_score_as_a_plain_loop():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = urls.Trees.fit(x, y, np.ones(500))
    for row, p in zip(x[:60], model.score(x[:60])):
        margin = model.bias
        for splits, leaves in zip(model.splits, model.leaves):
            node, base = 0, 0
            for depth in range(urls.DEPTH):
                feature, at = splits[base + node]
                edges = model.edges[feature]
                base, node = base + 2 ** depth, 2 * node + (at < len(edges) and row[feature] > edges[at])
            margin += leaves[node]
        assert math.isclose(p, 1 / (1 + math.exp(-margin)), rel_tol=1e-9)
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.97


def test_features_of_one_url():
    url, host, path = "http://a-b.c.org/x1/y22?p=1&q=2#f", "a-b.c.org", "/x1/y22"
    f = urls.features(*(pa.array([v]) for v in (url, host, path)))[0]
    digits = sum(c.isdigit() for c in url)
    assert f[0] == math.log1p(len(url)) and f[3] == 2 and f[4] == digits / len(url) and f[5] == 3 and f[10] == 2 and f[11] == 2 and f[12] == 1 and f[13] == 2
    share = [url.count(c) / len(url) for c in set(url)]
    assert math.isclose(f[7], -sum(p * math.log2(p) for p in share))


@pytest.mark.parametrize("rules, verdict", [([], "allow"), ([("block", "org", "/")], "block"), ([("allow", "org", "/")], "allow")])
def test_one_class_or_none(spark, rules, verdict):
    df = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.com/")], "page_id long, url string")
    assert rows_of(urls.verdicts(df, rules).select("page_id", "verdict")) == [(1, verdict if rules else "allow"), (2, verdict)]


def test_empty_table_and_clashing_names(spark):
    assert urls.verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0
    odd = spark.createDataFrame([(1, "http://a.org/x", "h", "s", 5)], "page_id long, url string, Host string, Verdict string, _url int")
    row = urls.judge(odd, urls.RULES).first().asDict()
    assert row["host"] == "a.org" and row["verdict"] == "allow" and row["_url"] == 5 and "Host" not in row


def test_same_verdicts_again(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert rows_of(urls.verdicts(df)) == rows_of(urls.verdicts(df.repartition(7)))
