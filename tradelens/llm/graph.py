"""Connected components of an edge table, by alternating stars.

Every round writes its edges to the shared folder, so a lost executor repeats
one round at most. Neighbour lists are never gathered: a node's smallest
neighbour is an aggregate, and it is handed on through ``SALTS`` shares of the
node's links, so a star's centre is no single key of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize


#: Shares that a node's links are dealt into.
SALTS = 64


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hand_on(links: DataFrame) -> DataFrame:
    """Each (node, neighbour) with the smallest of the node and its neighbours."""
    links = links.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    shares = links.groupBy("a", "s").agg(F.min("b").alias("m"))  # SALTS rows a node at most
    least = shares.groupBy("a").agg(F.least("a", F.min("m")).alias("m"))
    shares = shares.select("a", "s").join(least.hint("merge"), "a")
    return links.join(shares.hint("merge"), ["a", "s"]).drop("s")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: longs) to (node, component): the smallest node that
    each node of any edge can reach. Self links and repeats do no harm."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = materialize(pairs, "edges")
    size = None
    while True:
        # large star: larger neighbours go over to the node's smallest one
        large = _hand_on(_mirrored(pairs)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "edges")
        # small star: the smaller neighbours and the node itself do
        low = _hand_on(large)
        small = low.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        pairs = materialize(small.where("a <> b").distinct(), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == size:
            break
        size = now
    stars = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)
