"""Exact top-k search in Hamming space by incremental multi-index hashing.

A code is cut into m segments of about ``segment_bits`` bits, and every code is indexed under each of its segments.  In round r
the unfinished queries probe, in every segment, all values at distance exactly r from their own.  Two codes at
distance d share a segment at distance at most d / m, so after round r every code at distance up to m * (r + 1) - 1 has been
verified; a query is finished once its k-th verified distance is within that bound (ties included).  The radius
therefore grows only for queries that need it, and the result is exact.  The k-th distance so far also bounds what the
join of later rounds lets through.

A code found through several segments is taken once, in the first round and segment that can find it, which its segment distances
tell without a shuffle.  Of rows with one code only the k smallest ids are indexed: no other row of that code can
be among any k nearest.  So a vector with a third of all rows costs k index rows per segment.

Defined cases: rows with a null vector or id are neither indexed nor searched; a null element is bit 0 and shorter vectors are filled up with
0; ties are broken by the smaller id; repeated rows are one; with fewer than k codes a query gets all of them; a query
finds itself if it is indexed; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.common import col
from recspark.session import materialize


def sign_bits(vector: Column, width: int) -> Column:
    """A vector's signs as a string of ``width`` bits: 1 where an element is zero or more."""
    return F.rpad(F.array_join(F.transform(vector, lambda x: F.when(x >= 0, "1").otherwise("0")), ""), width, "0")


def cut_points(width: int, segment_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments, as even as possible, at most 32 bits each."""
    m = max(1, round(width / segment_bits), -(-width // 32))
    edges = [width * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segments(bits: Column, cuts) -> Column:
    return F.array(*[F.conv(F.substring(bits, a + 1, n), 2, 10).cast("long") for a, n in cuts])


def _distance(x: str, y: str, k: int) -> Column:
    return F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])).cast("int")


def _probes(queries: DataFrame, cuts, radius: int) -> DataFrame:
    """(query_id, q, bound, seg, value): all values at distance ``radius`` from each segment of each query.

    The masks grow bit by bit, each bit above the last one, so every combination comes once.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("seg"), F.lit(n).alias("bits")) for k, (_, n) in enumerate(cuts)]))
    rows = queries.withColumn("s", each).select("query_id", "q", "bound", "s.seg", "s.bits", F.lit(0).cast("long").alias("mask"), F.lit(-1).alias("top"))
    for _ in range(radius):
        rows = (rows.where("top < bits - 1").withColumn("top", F.explode(F.sequence(F.col("top") + 1, F.col("bits") - 1)))
                .withColumn("mask", F.expr("mask | shiftleft(1L, top)")))
    return rows.select("query_id", "q", "bound", "seg", F.expr("q[seg] ^ mask").alias("value"))


def top_k_hamming(codes: DataFrame, queries: DataFrame, k: int, width: int, id_col: str = "id", bits_col: str = "bits") -> DataFrame:
    """(query_id, rank, id, distance): the k nearest codes of every query, ranked by (distance, id).

    ``codes`` and ``queries`` hold ids and strings of ``width`` bits.
    """
    clean = lambda df: df.select(col(id_col).alias("id"), col(bits_col).alias("bits")).where("id IS NOT NULL AND bits IS NOT NULL").distinct()
    same = Window.partitionBy("bits").orderBy("id")
    known = clean(codes).withColumn("n", F.row_number().over(same)).where(F.col("n") <= k).select("id", "bits")
    n = known.select("bits").distinct().count()  # one number
    cuts = cut_points(width, min(32, max(16, math.ceil(math.log2(max(n, 2))))))
    segments = F.posexplode("c").alias("seg", "value")
    index = materialize(known.select("id", _segments(F.col("bits"), cuts).alias("c")).select("id", "c", segments), "mih-index")
    asked = materialize(clean(queries).select(F.col("id").alias("query_id"), _segments(F.col("bits"), cuts).alias("q")), "mih-queries")

    best = asked.select("query_id", F.lit(0).cast("long").alias("id"), F.lit(0).alias("distance")).where("false")
    active = asked.withColumn("bound", F.lit(width))
    nearest = Window.partitionBy("query_id").orderBy("distance", "id")
    m = len(cuts)
    for radius in range(max(n for _, n in cuts) + 1):
        # both sides pack well, so their shuffled size says little of what a broadcast would hold: always by exchange
        found = _probes(active, cuts, radius).join(index.hint("merge"), ["seg", "value"])
        per = F.array(*[_distance("q", "c", j) for j in range(m)])
        first = F.forall(F.transform("per", lambda d, j: F.when(j < F.col("seg"), d > radius).otherwise(d >= radius)), lambda ok: ok)
        distance = F.aggregate("per", F.lit(0), lambda a, d: a + d)
        verified = found.withColumn("per", per).where(first & (distance <= F.col("bound"))).select("query_id", "id", distance.alias("distance"))
        best = materialize(best.union(verified).withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
                           .select("query_id", "id", "distance"), "mih-best")
        covered = m * (radius + 1) - 1
        # the k-th distance so far bounds what later rounds have to keep
        state = best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("far"))
        active = materialize(asked.join(state, "query_id", "left").where(F.coalesce(F.col("far") > covered, F.lit(True)))
                             .select("query_id", "q", F.coalesce("far", F.lit(width)).alias("bound")), "mih-active")
        if active.isEmpty():
            break
    return best.select("query_id", F.row_number().over(nearest).alias("rank"), "id", "distance")


def nearest_embeddings(embeddings: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest sign codes of every row whose id is divisible by ``every``, among all rows."""
    width = embeddings.agg(F.max(F.size(col(vector_col)))).first()[0] or 1  # one number
    codes = embeddings.select(col(id_col).cast("long").alias("id"), F.when(col(vector_col).isNotNull(), sign_bits(col(vector_col), max(1, width))).alias("bits"))
    return top_k_hamming(codes, codes.where(F.col("id") % every == 0), k, max(1, width)).withColumnRenamed("id", "vec_id")


SQL = """
    WITH codes AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x >= 0 THEN '1' ELSE '0' END), '') AS bits
                   FROM embeddings),
    ranked AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(hamming(q.bits, c.bits) AS INTEGER) AS distance,
                      CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY hamming(q.bits, c.bits), c.vec_id) AS INTEGER) AS rank
               FROM codes q, codes c WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10"""
