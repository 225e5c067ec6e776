"""Recommendations from picked names over the long-form similarity table.

``sims`` here is the mirrored table with the diagonal (i, j, n, sim): an
absent pair means similarity 0.  Requests are a table (request_id, name),
so one request and a million requests run the same plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.indexing import factorize
from recspark.session import materialize


def resolve_picks(requests: DataFrame, item_map: DataFrame) -> DataFrame:
    """(request_id, iid): picked names -> items via the item map.

    Unknown names find no item; repeated names collapse.
    """
    return (requests.select("request_id", "name")
                    .join(item_map.select("name", "iid"), "name", "inner")
                    .select("request_id", "iid")
                    .distinct())


def mean_similarity(sims: DataFrame, picks: DataFrame) -> DataFrame:
    """(request_id, iid, score): mean similarity of an item to the request's picked items.

    Divisor = number of distinct picked items; a missing pair adds 0, so
    only items with at least one stored pair (or the diagonal) get a row.
    A request without a known pick has no row.
    """
    m = picks.groupBy("request_id").agg(F.count(F.lit(1)).alias("m"))
    s = sims.select(F.col("j").alias("iid_pick"), F.col("i").alias("iid"), "sim")
    total = (picks.select("request_id", F.col("iid").alias("iid_pick"))
                  .join(s, "iid_pick", "inner")
                  .groupBy("request_id", "iid")
                  .agg(F.sum("sim").alias("total")))
    return total.join(m, "request_id", "inner").select(
        "request_id", "iid", (F.col("total") / F.col("m")).alias("score"))


def _rank_window():
    return Window.partitionBy("request_id").orderBy(F.round(F.col("score"), 9).desc(), F.col("iid").asc())


def recommend(scores: DataFrame, items: DataFrame, requests: DataFrame, n: int = 3,
              mode: str = "filter_then_pick") -> DataFrame:
    """(request_id, rank, iid, name, score).

    filter_then_pick (default): drop every item whose name is one of the
    request's names (all locations of a picked chain) and every closed
    item, then take the top ``n`` by score (ties: smaller iid).

    pick_then_filter: the served variant -- take the top ``n + 2`` first,
    then drop picked names and closed items; may return fewer than ``n``
    rows (``rank`` is the position before filtering).

    All of ``items`` are ranked: one without a row in ``scores`` has score 0.
    The score table stays sparse; :func:`_zero_candidates` adds, per request
    that needs them, the first ``n`` of these items.

    Top-n per request is ``row_number() <= n``; Spark applies the limit on
    the map side (window group limit) before the shuffle.
    """
    names = items.select("iid", "name", "is_open")
    named = scores.join(names, "iid", "inner")
    picked_names = requests.select("request_id", "name").where(F.col("name").isNotNull()).distinct()
    if mode == "filter_then_pick":
        cand = named.join(picked_names, ["request_id", "name"], "left_anti").where(F.col("is_open") == 1)
        fill = _zero_candidates(named, cand, names.where(F.col("is_open") == 1), n, picked_names)
        out = (cand.unionByName(fill).withColumn("rank", F.row_number().over(_rank_window()))
               .where(F.col("rank") <= n))
    elif mode == "pick_then_filter":
        fill = _zero_candidates(named, named, names, n + 2, None)
        top = (named.unionByName(fill).withColumn("rank", F.row_number().over(_rank_window()))
               .where(F.col("rank") <= n + 2))
        out = top.join(picked_names, ["request_id", "name"], "left_anti").where(F.col("is_open") == 1)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return out.select("request_id", F.col("rank").cast("long").alias("rank"), "iid", "name", "score")


LOOKS = (4, 64)  # times n: first items that short requests are shown before their own taken items are sorted


def _zero_candidates(named: DataFrame, ranked: DataFrame, items: DataFrame, n: int, picked_names) -> DataFrame:
    """Score-0 rows (columns of ``named``) for the requests with fewer than ``n`` positive scores in ``ranked``.

    Such items tie and are ordered by iid, so a request gets the first ``n`` of ``items`` that it has neither scored nor
    barred by name.  The items are numbered once.  A picked name can bar a large share of all items, so its items are not
    listed per request: all short requests look at the first ``4 n`` places, those for whom they are not enough at the first
    ``64 n``, and only those who find most of these taken too have all their taken places sorted (:func:`_free_by_gaps`).
    """
    positive = F.sum(F.when(F.round("score", 9) > 0, 1).otherwise(0))
    have = ranked.groupBy("request_id").agg(positive.alias("good"))
    short = materialize(named.select("request_id").distinct().join(have, "request_id", "left")
                        .where(F.coalesce("good", F.lit(0)) < n).select("request_id"), "short-requests")
    numbered = materialize(items.join(factorize(items, "iid", order_by=("iid",), out="place"), "iid"), "numbered-items")
    asked = named.join(short, "request_id", "left_semi")
    scored = materialize(asked.select("request_id", "iid").join(numbered.select("iid", "place"), "iid").select("request_id", "place"), "scored-places")

    def barred(requests: DataFrame, of: DataFrame) -> DataFrame:
        return picked_names.join(requests, "request_id", "left_semi").join(of.select("name", "place"), "name").select("request_id", "place")

    by_place = Window.partitionBy("request_id").orderBy("place")
    count, found, rest = numbered.count(), [], short
    for look in LOOKS:
        head = F.broadcast(numbered.where(F.col("place") < look * n).select("name", "place"))  # the first look * n items
        taken = scored.where(F.col("place") < look * n)
        if picked_names is not None:
            taken = taken.union(barred(rest, head))
        free = rest.crossJoin(F.broadcast(head.select("place").distinct())).join(taken, ["request_id", "place"], "left_anti")
        first = materialize(free.withColumn("t", F.row_number().over(by_place)).where(F.col("t") <= n).select("request_id", "place"), "free-places")
        if count <= look * n:
            found, rest = [*found, first], None
            break
        enough = first.groupBy("request_id").agg(F.count(F.lit(1)).alias("have")).where(F.col("have") >= n)
        found.append(first.join(enough, "request_id", "left_semi"))
        rest = materialize(rest.join(enough, "request_id", "left_anti"), "short-requests")
        if rest.isEmpty():
            rest = None
            break
    if rest is not None:
        taken = scored.join(rest, "request_id", "left_semi")
        if picked_names is not None:
            taken = taken.union(barred(rest, numbered)).distinct()
        found.append(_free_by_gaps(rest, taken, n))
    rows = reduce(lambda a, b: a.union(b), found).join(numbered, "place")
    return rows.select(*[F.lit(0.0).alias("score") if c == "score" else c for c in named.columns])


def _free_by_gaps(short: DataFrame, taken: DataFrame, n: int) -> DataFrame:
    """(request_id, place): the first ``n`` places that are not among a request's ``taken`` ones.

    Sorted by place, the k-th taken item of a request (from 0) has place - k free items before it; the t-th free place is
    therefore t plus the number of taken items with at most t free ones before them.  Only taken rows are sorted.
    """
    by_place = Window.partitionBy("request_id").orderBy("place")
    ahead = taken.withColumn("free", F.col("place") - F.row_number().over(by_place) + 1).where(F.col("free") < n)
    shifts = F.array(*[F.count_if(F.col("free") <= t) for t in range(n)])
    return (short.join(ahead, "request_id", "left").groupBy("request_id").agg(shifts.alias("shift"))
            .select("request_id", F.posexplode("shift").alias("t", "taken"))
            .select("request_id", (F.col("t") + F.col("taken")).cast("long").alias("place")))


def latest_names_requests(reviews: DataFrame, items: DataFrame, per_user: int = 4) -> DataFrame:
    """(request_id, name): a user's ``per_user`` most recently reviewed distinct names.

    Collapsing to one row per (user, name) first bounds every window group
    by the number of distinct names, however many reviews a user has.
    """
    last = (reviews.join(items.select("iid", "name"), "iid", "inner")
                   .groupBy("uid", "name")
                   .agg(F.max(F.struct("date", "review_id")).alias("last")))
    w = Window.partitionBy("uid").orderBy(F.col("last").desc(), F.col("name").asc())
    return (last.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= per_user)
                .select(F.col("uid").alias("request_id"), "name"))
