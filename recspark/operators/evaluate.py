"""Error metrics, rankings of models and the KNN-baseline grid.

Folds are a column (``cv_fold``): training rows are exploded once per fold
they train, so every fold's model is fitted in the same jobs, and scores
are grouped by fold and model.  Cross-validation itself is :mod:`recspark.models.validation`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.session import materialize

from recspark.functions.exprs import clip
from recspark.operators.candidates import candidate_rows
from recspark.operators.similarity import attach_baseline, pair_sums, rank_expr, residuals, sim_expr


def _err(truth: str = "stars", est: str = "est"):
    return F.col(truth).cast("double") - F.col(est)


def rmse(preds: DataFrame, by=(), truth: str = "stars") -> DataFrame:
    return preds.groupBy(*by).agg(F.sqrt(F.avg(F.pow(_err(truth), 2))).alias("rmse"))


def mae(preds: DataFrame, by=(), truth: str = "stars") -> DataFrame:
    return preds.groupBy(*by).agg(F.avg(F.abs(_err(truth))).alias("mae"))


def fold_scores(preds: DataFrame, by=("cv_fold",), truth: str = "stars") -> DataFrame:
    return preds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(F.pow(_err(truth), 2))).alias("rmse"),
        F.avg(F.abs(_err(truth))).alias("mae"))


def metric_sums(train: DataFrame, sums: DataFrame, metric: str, baselines, by, min_support: int = 1) -> DataFrame:
    """The pair sums that a metric is made from: rating sums, or sums of baseline residuals."""
    if metric != "pearson_baseline":
        return sums
    return pair_sums(residuals(train, baselines, by=by), value="res", by=by, integer_sums=False, min_support=min_support)


def rank_models(preds: DataFrame, by=("cv_fold",)) -> DataFrame:
    """(model, rmse, mae, rmse_sd, rank): mean over folds; rank 1 = lowest mean RMSE.

    The ranking window runs over one row per model (a handful of rows).
    """
    per = preds.groupBy("model", *by).agg(
        F.sqrt(F.avg(F.pow(_err(), 2))).alias("rmse"), F.avg(F.abs(_err())).alias("mae"))
    agg = per.groupBy("model").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"),
                                   F.stddev_pop("rmse").alias("rmse_sd"))
    w = Window.orderBy(F.round(F.col("rmse"), 9), F.col("model"))
    return agg.withColumn("rank", F.row_number().over(w).cast("long"))


def similarity_variants(metrics, min_supports, shrinkages) -> list[tuple]:
    """(metric, min_support, shrinkage) settings; only pearson_baseline has a shrinkage (0.0 elsewhere)."""
    return [(m, n, float(x)) for m in metrics for n in min_supports for x in (shrinkages if m == "pearson_baseline" else (0.0,))]


def knn_baseline_grid(train: DataFrame, test: DataFrame, sums: DataFrame, baselines: dict, metrics, ks, min_ks,
                      min_supports=(1,), shrinkages=(100.0,), by=("cv_fold",)) -> DataFrame:
    """(bsl, sim_name, min_support, shrinkage, k, min_k, rmse, rank): KNN-baseline grid, mean RMSE over the ``by`` folds.

    ``baselines`` maps a name to fitted (mu, bu, bi).  No refit per setting: a metric's candidates are joined once for all its
    (min_support, shrinkage) variants, neighbours are ranked once per variant for the largest k, and each (k, min_k) is a
    conditional aggregate over the neighbour rank.  Ratings are never copied per variant.  Metrics of the ratings are ranked
    once for all baselines; only the residuals of pearson_baseline depend on the baseline.

    ``sums`` holds the training sets' pairs that a prediction can use (``similarity.fold_pair_sums``).  A pair has as many common
    residuals as ratings, so the residuals of other items take no part.
    """
    by = list(by)
    variants = list(enumerate(similarity_variants(metrics, min_supports, shrinkages)))
    plain = [(v, x) for v, x in variants if x[0] != "pearson_baseline"]
    residual = [(v, x) for v, x in variants if x[0] == "pearson_baseline"]
    ranked = [materialize(ranked_neighbors(train, test, sums, [y for y in plain if y[1][0] == m], max(ks), by), "grid-neighbors")
              for m in dict.fromkeys(x[0] for _, x in plain)]
    parts = []
    if residual:
        paired = materialize(sums.select(*by, F.col("i").alias("iid")).union(sums.select(*by, "j")).distinct(), "paired-items")
        of_pairs = train.join(paired, by + ["iid"], "left_semi")
        least = min(x[1] for _, x in residual)
    for name, model in baselines.items():
        own = []
        if residual:
            res = metric_sums(of_pairs, sums, "pearson_baseline", model, by, least)
            own = [ranked_neighbors(train, test, res, residual, max(ks), by)]
        err = _grid_errors(test, reduce(lambda a, b: a.unionByName(b), ranked + own), model, [v for v, _ in variants], ks, min_ks, by)
        parts.append(err.groupBy("variant", "k", "min_k").agg(F.avg("rmse").alias("rmse")).withColumn("bsl", F.lit(name)))
    of = lambda part: F.create_map(*[F.lit(y) for v, x in variants for y in (v, x[part])])[F.col("variant")]
    out = reduce(lambda a, b: a.unionByName(b), parts).select(
        "bsl", of(0).alias("sim_name"), of(1).alias("min_support"), of(2).alias("shrinkage"), "k", "min_k", "rmse")
    # ranking one row per setting (the grid size, a fixed small table)
    wr = Window.orderBy(F.round("rmse", 9), "bsl", "sim_name", "min_support", "shrinkage", "k", "min_k")
    return out.withColumn("rank", F.row_number().over(wr).cast("long"))


def ranked_neighbors(train: DataFrame, test: DataFrame, sums: DataFrame, variants, k: int, by, value: str = "stars") -> DataFrame:
    """(by.., variant, uid, iid, j, r_j, sim, rank) with rank <= k for every similarity variant (number, (metric, min_support, shrinkage)).

    The targets meet the pair list of their item and then the ratings of their user once; a candidate row carries the
    similarities of all variants, which fan out after the joins.
    """
    least = min(x[1] for _, x in variants)
    sim = [F.when(F.col("n") >= n, sim_expr(m, sh)).alias(f"sim_{v}") for v, (m, n, sh) in variants]
    pairs = sums.where(F.col("n") >= least).select(*by, "i", "j", "n", *sim)
    names = [f"sim_{v}" for v, _ in variants]
    same = train.select(*by, F.col("iid").alias("i")).distinct().select(
        *by, "i", F.col("i").alias("j"), F.lit(0).cast("long").alias("n"), *[F.lit(1.0).alias(c) for c in names])
    both = materialize(pairs.unionByName(pairs.select(*by, F.col("j").alias("i"), F.col("i").alias("j"), "n", *names)).unionByName(same)
            .where(F.greatest(*names, F.lit(0.0)) > 0).withColumnRenamed("i", "iid"), "variant-lists")
    rated = train.select(*by, "uid", F.col("iid").alias("j"), F.col(value).alias("r_j"), F.col("review_id").alias("rid_j"))
    cand = candidate_rows(test.select(*by, "uid", "iid").distinct(), both, rated, by)
    fan = F.array(*[F.struct(F.lit(v).alias("variant"), F.col(f"sim_{v}").alias("sim")) for v, _ in variants])
    rows = cand.select(*by, "uid", "iid", "j", "n", "r_j", "rid_j", F.inline(F.filter(fan, lambda x: x["sim"] > 0)))
    w = Window.partitionBy(*by, "variant", "uid", "iid").orderBy(
        rank_expr().desc(), F.col("n").desc(), F.col("j").asc(), F.col("rid_j").asc(), F.col("r_j").asc())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(*by, "variant", "uid", "iid", "j", "r_j", "sim", "rank")


def _grid_errors(test: DataFrame, ranked: DataFrame, baselines, variants, ks, min_ks, by) -> DataFrame:
    """(variant, k, min_k, by.., rmse) for one baseline.

    A test row without neighbours has the baseline as estimate whatever the variant, so the squared errors of the baseline are summed
    once, and the rows with neighbours add what they change.
    """
    mu, bu, bi = baselines
    nb = attach_baseline(ranked.withColumnRenamed("iid", "iid_t").withColumnRenamed("j", "iid"), mu, bu, bi, by=by) \
        .withColumnRenamed("iid", "j").withColumnRenamed("iid_t", "iid")
    w = F.col("sim") * (F.col("r_j") - F.col("b_ui"))
    aggs = []
    for k in ks:
        inside = F.col("rank") <= k
        aggs += [F.sum(F.when(inside, F.col("sim"))).alias(f"s_{k}"), F.sum(F.when(inside, w)).alias(f"w_{k}"),
                 F.sum(F.when(inside, 1).otherwise(0)).alias(f"c_{k}")]
    agg = nb.groupBy(*by, "variant", "uid", "iid").agg(*aggs)
    rows = attach_baseline(test.select(*by, "uid", "iid", F.col("stars").cast("double").alias("r")), mu, bu, bi, by=by) \
        .select(*by, "uid", "iid", "r", "b_ui")
    error = lambda est: F.pow(F.col("r") - clip(est, 1.0, 5.0), 2)
    total = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(error(F.col("b_ui"))).alias("base"))
    settings = [(k, m) for k in ks for m in min_ks]

    def change(k, m):
        dev = F.when((F.col(f"c_{k}") >= m) & (F.col(f"s_{k}") > 0), F.col(f"w_{k}") / F.col(f"s_{k}")).otherwise(F.lit(0.0))
        return F.sum(error(F.col("b_ui") + dev) - error(F.col("b_ui")))

    changed = (rows.join(agg, by + ["uid", "iid"]).groupBy(*by, "variant")
               .agg(*[change(k, m).alias(f"d_{x}") for x, (k, m) in enumerate(settings)]))
    every = total.select("*", F.explode(F.array(*[F.lit(v) for v in variants])).alias("variant"))  # folds x variants rows
    per = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).alias("min_k"), F.coalesce(f"d_{x}", F.lit(0.0)).alias("d")) for x, (k, m) in enumerate(settings)])
    return (every.join(changed, by + ["variant"], "left").select(*by, "variant", "rows", "base", F.inline(per))
            .select("variant", "k", "min_k", *by, F.sqrt((F.col("base") + F.col("d")) / F.col("rows")).alias("rmse")))
