"""Neighbourhood predictors (item-based KNN family) and Slope One.

All predictions are made for the distinct (user, item) targets of a test
table and joined back to its rows; every target is resolved by joins on
item-keyed neighbour lists and the composite key (user, item) -- a
user's test rows are never paired with all of that user's ratings.

KNN (k, min_k), neighbours j of target i among the items u rated, with
sim(i, j) > 0, best k by (sim, n, j, review_id):

* basic     est = sum sim * r_uj / sum sim                       (too few -> mu)
* means     est = mean_i + sum sim (r_uj - mean_j) / sum sim      (too few -> mean_i)
* zscore    est = mean_i + sd_i sum sim (r_uj - mean_j) / sd_j / sum sim
            (sd = 0 -> the global sd; too few -> mean_i)
* baseline  est = b_ui + sum sim (r_uj - b_uj) / sum sim          (too few -> b_ui)

Unknown user or item: mu (baseline: b_ui with the unknown parts 0).
Estimates are clipped to the rating scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.exprs import clip
from recspark.operators.candidates import blocked_join, candidate_rows
from recspark.operators.indexing import factorize
from recspark.operators.similarity import attach_baseline, attach_mean, top_k_neighbors
from recspark.session import materialize

KINDS = ("basic", "means", "zscore", "baseline")


def item_stats(train: DataFrame, value: str = "stars", by=()) -> DataFrame:
    v = F.col(value).cast("double")
    return train.groupBy(*by, "iid").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"))


def _known(test_t: DataFrame, train: DataFrame, by: list[str]) -> DataFrame:
    users = train.select(*by, "uid").distinct().withColumn("u_known", F.lit(True))
    items = train.select(*by, "iid").distinct().withColumn("i_known", F.lit(True))
    return (test_t.join(users, by + ["uid"], "left").join(items, by + ["iid"], "left")
                  .withColumn("known", F.coalesce("u_known", F.lit(False)) & F.coalesce("i_known", F.lit(False)))
                  .drop("u_known", "i_known"))


def known_targets(test: DataFrame, train: DataFrame, by=()) -> DataFrame:
    """The distinct targets (by.., uid, iid) of the test rows; ``known`` where the training rows have both user and item."""
    by = list(by)
    return _known(test.select(*by, "uid", "iid").distinct(), train, by)


def _swap_roles(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("uid", "_u").withColumnRenamed("iid", "uid").withColumnRenamed("_u", "iid")


def knn_predict(train: DataFrame, test: DataFrame, sims_mirrored: DataFrame, kind: str = "basic",
                k: int = 40, min_k: int = 1, baselines=None, value: str = "stars", by=(),
                lo: float = 1.0, hi: float = 5.0, user_based: bool = False, neighbors: DataFrame | None = None,
                targets: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """test rows + ``est`` (and ``actual_k``).

    ``neighbors``: the result of :func:`top_k_neighbors` for these targets where several kinds share it (``sims_mirrored`` is
    then not read); ``targets`` and ``stats`` likewise those of :func:`known_targets` and :func:`item_stats`.  ``user_based=True``: neighbours are users (``sims_mirrored`` must then be
    user-user similarities); the same plan runs with the roles swapped.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown KNN kind {kind!r}")
    if user_based:
        swapped = None
        if baselines is not None:
            mu, bu, bi = baselines
            swapped = (mu, _swap_roles(bi).withColumnRenamed("bi", "bu"), _swap_roles(bu).withColumnRenamed("bu", "bi"))
        out = knn_predict(_swap_roles(train), _swap_roles(test), sims_mirrored, kind, k, min_k, swapped, value,
                          by, lo, hi, user_based=False)
        return _swap_roles(out)
    by = list(by)
    nb = top_k_neighbors(test, sims_mirrored, train, k, value=value, by=by) if neighbors is None else neighbors.where(F.col("rank") <= k)
    if kind in ("means", "zscore"):
        stats = item_stats(train, value, by) if stats is None else stats
        nb = nb.join(stats.select(*by, F.col("iid").alias("j"), F.col("mean").alias("mean_j"),
                                  F.col("sd").alias("sd_j")), by + ["j"], "inner")
    if kind == "basic":
        adj = F.col("r_j")
    elif kind == "means":
        adj = F.col("r_j") - F.col("mean_j")
    elif kind == "zscore":
        sd_all = train.groupBy(*by).agg(F.stddev_pop(F.col(value).cast("double")).alias("sd_all"))
        nb = attach_mean(nb, sd_all, by, "sd_all")
        sd_j = F.when(F.col("sd_j") > 0, F.col("sd_j")).otherwise(F.col("sd_all"))
        adj = (F.col("r_j") - F.col("mean_j")) / sd_j
    else:
        mu, bu, bi = baselines
        nb = attach_baseline(nb.withColumnRenamed("iid", "iid_t").withColumnRenamed("j", "iid"),
                             mu, bu, bi, by=by).withColumnRenamed("iid", "j").withColumnRenamed("iid_t", "iid")
        adj = F.col("r_j") - F.col("b_ui")
    agg = nb.groupBy(*by, "uid", "iid").agg(
        F.sum("sim").alias("sum_sim"), F.sum(F.col("sim") * adj).alias("sum_w"),
        F.count(F.lit(1)).alias("actual_k"))
    t = known_targets(test, train, by) if targets is None else targets
    t = t.join(agg, by + ["uid", "iid"], "left").withColumn("actual_k", F.coalesce("actual_k", F.lit(0)))
    enough = (F.col("actual_k") >= min_k) & (F.col("sum_sim") > 0)
    dev = F.when(enough, F.col("sum_w") / F.col("sum_sim")).otherwise(F.lit(0.0))
    mu_df = train.groupBy(*by).agg(F.avg(F.col(value).cast("double")).alias("mu"))
    if kind == "baseline":
        mu, bu, bi = baselines
        t = attach_baseline(t, mu, bu, bi, by=by)
        est = F.col("b_ui") + F.when(F.col("known"), dev).otherwise(F.lit(0.0))
    else:
        t = attach_mean(t, mu_df, by)
        if kind == "basic":
            est = F.when(F.col("known") & enough, F.col("sum_w") / F.col("sum_sim")).otherwise(F.col("mu"))
        else:
            t = t.join(stats.select(*by, "iid", F.col("mean").alias("mean_i"), F.col("sd").alias("sd_i")),
                       by + ["iid"], "left")
            if kind == "means":
                est = F.when(F.col("known"), F.col("mean_i") + dev).otherwise(F.col("mu"))
            else:
                sd_all = train.groupBy(*by).agg(F.stddev_pop(F.col(value).cast("double")).alias("sd_all"))
                t = attach_mean(t, sd_all, by, "sd_all")
                sd_i = F.when(F.col("sd_i") > 0, F.col("sd_i")).otherwise(F.col("sd_all"))
                est = F.when(F.col("known"), F.col("mean_i") + sd_i * dev).otherwise(F.col("mu"))
    preds = t.select(*by, "uid", "iid", clip(est, lo, hi).alias("est"), "actual_k")
    return test.join(preds, by + ["uid", "iid"], "inner")


def slope_one_predict(train: DataFrame, test: DataFrame, sums: DataFrame, value: str = "stars",
                      by=(), lo: float = 1.0, hi: float = 5.0, targets: DataFrame | None = None) -> DataFrame:
    """Slope One (Lemire & Maclachlan 2005).

    dev(i, j) = mean over co-rating users of r_ui - r_uj, from the pair sums;
    est = mean_u + average of dev(i, j) over the rating rows (u, j) of u
    with a co-rated j (j = i counts with dev 0); none -> mean_u;
    unknown user or item -> mu.  ``targets``: the result of :func:`known_targets` where several models share it.
    """
    by = list(by)
    half = materialize(sums.where(F.col("n") > 0).select(*by, "i", "j", ((F.col("sx") - F.col("sy")) / F.col("n")).alias("dev")), "deviations")  # read twice
    dev = (half.withColumnRenamed("i", "iid")
           .unionByName(half.select(*by, F.col("j").alias("iid"), F.col("i").alias("j"), (-F.col("dev")).alias("dev"))))
    known = known_targets(test, train, by) if targets is None else targets
    t = test.select(*by, "uid", "iid").distinct() if targets is None else targets.select(*by, "uid", "iid")
    tr = train.select(*by, "uid", F.col("iid").alias("j"))
    cross = candidate_rows(t, dev, tr, by).select(*by, "uid", "iid", "dev")
    same = t.join(tr.withColumnRenamed("j", "iid"), by + ["uid", "iid"], "inner") \
            .select(*by, "uid", "iid", F.lit(0.0).alias("dev"))
    agg = cross.unionByName(same).groupBy(*by, "uid", "iid").agg(
        F.sum("dev").alias("sum_dev"), F.count(F.lit(1)).alias("n_dev"))
    v = F.col(value).cast("double")
    umean = train.groupBy(*by, "uid").agg(F.avg(v).alias("mean_u"))
    mu = train.groupBy(*by).agg(F.avg(v).alias("mu"))
    t = known.join(umean, by + ["uid"], "left").join(agg, by + ["uid", "iid"], "left")
    t = attach_mean(t, mu, by)
    est = F.when(~F.col("known"), F.col("mu")).otherwise(
        F.col("mean_u") + F.when(F.col("n_dev") > 0, F.col("sum_dev") / F.col("n_dev")).otherwise(F.lit(0.0)))
    preds = t.select(*by, "uid", "iid", clip(est, lo, hi).alias("est"))
    return test.join(preds, by + ["uid", "iid"], "inner")


def knn_recommend_for_users(train: DataFrame, sims: DataFrame, baselines, k: int = 40, min_k: int = 1,
                            n: int = 10, value: str = "stars") -> DataFrame:
    """(uid, iid, est, actual_k, rank): top-n per user over every item the user has not rated, by KNN-baseline estimate.

    The estimate is mu + b_u + (b_i + dev), where dev is 0 for an item without (enough) neighbours among the user's
    ratings.  mu + b_u is the same for all items of a user, so items are ranked by b_i + dev (ties: smaller iid) and
    estimates are clipped to the scale after ranking.  For items without a rated neighbour the order by b_i is the same for
    all users, which makes a bounded merge enough, without a user x item product:

    * scored items: every rating (u, j) meets the neighbour list of j (an item-keyed join), which yields, per unrated
      item i, exactly the neighbour rows the estimate needs; the best ``n`` of each user go on;
    * all other items: the first ``n`` of the global list that the user has neither rated nor scored
      (:func:`first_others`).

    ``sims`` holds pairs i < j.
    """
    pos = sims.where(F.col("sim") > 0)
    s = pos.select("i", "j", "n", "sim").unionByName(
        pos.select(F.col("j").alias("i"), F.col("i").alias("j"), "n", "sim"))
    mu, bu, bi = baselines
    rated = train.select("uid", "iid").distinct()
    mine = train.select("uid", F.col("iid").alias("j"), F.col(value).cast("double").alias("r_j"), F.col("review_id").alias("rid_j"))
    cand = blocked_join(mine, s, ["j"]).withColumnRenamed("i", "iid").join(rated, ["uid", "iid"], "left_anti")
    w = Window.partitionBy("uid", "iid").orderBy(
        F.round("sim", 9).desc(), F.col("n").desc(), F.col("j").asc(), F.col("rid_j").asc(), F.col("r_j").asc())
    nb = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    nb = attach_baseline(nb.withColumnRenamed("iid", "iid_t").withColumnRenamed("j", "iid"), mu, bu, bi) \
        .withColumnRenamed("iid", "j").withColumnRenamed("iid_t", "iid")
    agg = nb.groupBy("uid", "iid").agg(
        F.sum("sim").alias("sum_sim"), F.sum(F.col("sim") * (F.col("r_j") - F.col("b_ui"))).alias("sum_w"),
        F.count(F.lit(1)).alias("actual_k"))
    dev = F.when((F.col("actual_k") >= min_k) & (F.col("sum_sim") > 0), F.col("sum_w") / F.col("sum_sim")) \
           .otherwise(F.lit(0.0))
    b_i = F.coalesce("bi", F.lit(0.0))
    scored = materialize(agg.join(bi.select("iid", "bi"), "iid", "left").select("uid", "iid", (b_i + dev).alias("gain"), "actual_k"), "scored-items")
    items = train.select("iid").distinct().join(bi.select("iid", "bi"), "iid", "left").select("iid", b_i.alias("gain"))
    others = first_others(items, rated, scored.select("uid", "iid"), n).select("uid", "iid", "gain", F.lit(0).cast("long").alias("actual_k"))
    wu = Window.partitionBy("uid").orderBy(F.round("gain", 9).desc(), F.col("iid").asc())
    best = lambda df: df.withColumn("rank", F.row_number().over(wu)).where(F.col("rank") <= n)
    top = best(best(scored).drop("rank").unionByName(others))
    level = attach_mean(top.join(bu.select("uid", "bu"), "uid", "left"), mu, [])
    return level.select("uid", "iid", clip(F.col("mu") + F.coalesce("bu", F.lit(0.0)) + F.col("gain"), 1.0, 5.0).alias("est"), "actual_k",
                        F.col("rank").cast("long").alias("rank"))


def first_others(items: DataFrame, rated: DataFrame, scored: DataFrame, n: int, look: int = 4) -> DataFrame:
    """(uid, iid, gain): per user of ``rated`` the first ``n`` items by (round(gain, 9) desc, iid) in neither ``rated`` nor ``scored``.

    All users first look at the ``look * n`` best items, one row that travels as a literal.  Only users for whom these
    are not enough look further: the first n + rated + scored items always are, and the places of the list are
    joined by number.
    """
    order = [F.round("gain", 9).desc(), F.col("iid").asc()]
    head = items.orderBy(*order).limit(look * n)  # at most look * n rows
    one = head.agg(F.collect_list(F.struct("iid", "gain")).alias("head"))
    taken = rated.select("uid", "iid").unionByName(scored.select("uid", "iid")).distinct()
    per_user = Window.partitionBy("uid").orderBy(*order)

    def first_free(asked: DataFrame, barred: DataFrame) -> DataFrame:
        free = asked.join(barred, ["uid", "iid"], "left_anti")
        return free.withColumn("place", F.row_number().over(per_user)).where(F.col("place") <= n).select("uid", "iid", "gain")

    users = rated.select("uid").distinct()
    asked = users.withColumn("head", one.select("head").scalar()).select("uid", F.inline("head"))
    near = materialize(first_free(asked, taken.join(F.broadcast(head.select("iid")), "iid", "left_semi")), "first-others")
    if items.count() <= look * n:
        return near
    have = near.groupBy("uid").agg(F.count(F.lit(1)).alias("have"))
    short = users.join(have, "uid", "left").where(F.coalesce("have", F.lit(0)) < n).select("uid")
    barred = taken.join(short, "uid", "left_semi")
    need = materialize(short.join(barred.groupBy("uid").agg(F.count(F.lit(1)).alias("barred")), "uid", "left")
                       .select("uid", (F.coalesce("barred", F.lit(0)) + n).alias("first")), "short-lists")
    if need.isEmpty():
        return near
    numbered = factorize(items.withColumn("neg", -F.round("gain", 9)), "iid", ("neg",), "place").join(items, "iid")
    asked = (need.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("first") - 1)))
             .join(numbered, "place").select("uid", "iid", "gain"))
    return near.join(short, "uid", "left_anti").unionByName(first_free(asked, barred))
