"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node tells its larger neighbours the smallest node it knows."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    pairs = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                                                          F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
    return pairs.select("e.a", "e.b").where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    The loop ends when a round changes nothing, told by one row (count and checksum) per round; all
    tables stay distributed and every round is written to the shared folder.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    mark = _mark(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
