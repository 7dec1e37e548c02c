"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


SALTS = 64


def _with_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every edge (a, b) with ``m``, the smallest ``b`` of its ``a``, and these minima per ``a``.

    Minima are found per (a, salt) first, the salt being a hash of ``b``, and sent back the same way: of a node that a third of
    all edges lead to, a task gets its salt's share.
    """
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    parts = salted.groupBy("a", "salt").agg(F.min("b").alias("m"))
    least = parts.groupBy("a").agg(F.min("m").alias("m"))
    back = parts.select("a", "salt").join(least, "a")
    return salted.join(back, ["a", "salt"]).select("a", "b", "m"), least


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``edges`` (two long columns ``a``, ``b``).

    Alternates the large-star and the small-star step: each round hangs every node's larger (smaller) neighbours below
    its smallest one. The edge list never grows, the number of rounds is logarithmic in practice, and each round is
    written to the shared folder, so a lost executor costs one round at most. A round that adds no edge is the last. Only
    numbers of edges reach the driver. Loops and repeated edges are allowed.
    """
    given = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    e = given.where("a <> b")
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung, _ = _with_least(both)
        large = hung.where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        hung, least = _with_least(large)
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        before, e = e, stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if e.join(before, ["a", "b"], "left_anti").isEmpty() and e.count() == before.count():
            break
    inner = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    every = given.select(F.col("a").alias("node")).unionByName(given.select(F.col("b").alias("node"))).distinct()
    return every.join(inner, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
