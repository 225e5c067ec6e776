"""Co-clustering, factor models, known-user recommendations and tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.session import materialize

from recspark.functions.exprs import fold_of, r6
from recspark.operators import baselines as bl
from recspark.operators import evaluate as ev
from recspark.models import KNN, cross_validate
from recspark.models import load_model as load_rating_model
from recspark.operators.coclustering import fit_coclustering, predict_coclustering
from recspark.operators.factor import (
    fit_nmf_als, fit_svd_als, load_model, predict_nmf_als, predict_svd_als, recommend_for_users_als, save_model,
)
from recspark.session import scratch_path
from recspark.operators.indexing import holdout_split
from recspark.operators.predictors import knn_recommend_for_users
from recspark.operators.similarity import fold_pair_sums, pair_sums, similarity
from recspark.plans import fixture as fx
from recspark.sources.bundle import load_bundle, save_bundle
from recspark.sources.files import write_table_roundtrip
from recspark.plans import model_sql as ms
from recspark.plans.models import (
    ALS_REG_I, ALS_REG_U, BSL_EPOCHS, BSL_REG_I, BSL_REG_U, K, MIN_K, PRED_SEL, ROWS, SEED, SPLIT, _split,
    _pred_out, _cv_models, _cv_ratings, BY, CV_BASE, CV_SIMS, _CVB_CTES, _CVB_BU, _CVB_BI, _fold_scores_sql,
)
from recspark.plans.registry import REGISTRY, register, with_ctes

from recspark.plans.models import CC_CLUSTERS, CC_EPOCHS  # noqa: E402
REC_N = 5
GRID_FOLDS = 4
GRID_METRICS = ("cosine", "pearson_baseline")
GRID_MIN_SUPPORT = (2, 4)
GRID_SHRINKAGE = (50.0, 100.0)
GRID_BSL = {"als_5_10": (5.0, 10.0), "als_10_15": (10.0, 15.0)}   # name: item and user regularisation
GRID_COLS = "bsl, sim_name, min_support, shrinkage, k, min_k"
GRID_K = (10, 40)
GRID_MIN_K = (1, 5)


@register("predict_coclustering", with_ctes(SPLIT + ms.coclustering_ctes(CC_CLUSTERS, CC_CLUSTERS, CC_EPOCHS), PRED_SEL),
          ops="B9")
def q_coclustering(spark, d):
    train, test = _split(spark, d)
    model = fit_coclustering(train, CC_CLUSTERS, CC_CLUSTERS, CC_EPOCHS)
    return _pred_out(predict_coclustering(test, model))


@register("predict_svd_als", None, ops="B10")
def q_svd_als(spark, d):
    train, test = _split(spark, d)
    base = bl.baseline_als(train, ALS_REG_I, ALS_REG_U, 10)
    model = fit_svd_als(train, base, seed=SEED)
    model = load_model(save_model(model, scratch_path(spark, "svd-als-model")))  # artifact round trip
    return _pred_out(predict_svd_als(test, model, base))


@register("predict_nmf_als", None, ops="B11")
def q_nmf_als(spark, d):
    train, test = _split(spark, d)
    model = fit_nmf_als(train, seed=SEED)
    return _pred_out(predict_nmf_als(test, model, bl.global_mean(train)))


@register("rec_als_users_top_n", None, ops="R5 B11")
def q_als_users(spark, d):
    """Top-n items per user from non-negative factors (all users against all items, block by block)."""
    train, _ = _split(spark, d)
    model = fit_nmf_als(train, seed=SEED)
    return recommend_for_users_als(model, REC_N, train).select("uid", "rank", "iid", r6("score").alias("score"))


@register("rec_als_users_facts", with_ctes(SPLIT, f"""
    SELECT uid, LEAST({REC_N}, (SELECT count(DISTINCT iid) FROM train) - count(DISTINCT iid)) AS n_items, CAST(0 AS BIGINT) AS already_rated,
           true AS in_scale, true AS ranks_gapless FROM train GROUP BY uid HAVING n_items > 0"""), ops="R5 B11")
def q_als_users_facts(spark, d):
    """What must hold of the ALS lists whatever the factors: full length, no rated item, scores on the scale."""
    train, _ = _split(spark, d)
    recs = materialize(recommend_for_users_als(fit_nmf_als(train, seed=SEED), REC_N, train), "als-recs")
    rated = train.select("uid", "iid", F.lit(1).alias("hit")).distinct()
    return (recs.join(rated, ["uid", "iid"], "left").groupBy(F.col("uid").cast("long").alias("uid"))
            .agg(F.count(F.lit(1)).alias("n_items"), F.count("hit").alias("already_rated"),
                 F.min(F.col("score").between(1.0, 5.0)).alias("in_scale"), (F.max("rank") == F.countDistinct("rank")).alias("ranks_gapless")))


_FACTS_SQL = """SELECT t.uid, count(*) AS n, true AS in_scale, bool_or(u.uid IS NULL) AS cold_user
    FROM test t LEFT JOIN (SELECT DISTINCT uid FROM train) u ON t.uid = u.uid GROUP BY t.uid"""


def _prediction_facts(train, preds):
    known = train.select("uid", F.lit(True).alias("seen")).distinct()
    return (preds.join(known, "uid", "left").groupBy(F.col("uid").cast("long").alias("uid"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("est").between(1.0, 5.0)).alias("in_scale"),
                 F.max(F.col("seen").isNull()).alias("cold_user")))


@register("predict_svd_als_facts", with_ctes(SPLIT, _FACTS_SQL), ops="B10")
def q_svd_als_facts(spark, d):
    """One estimate per test row, on the scale, cold users included."""
    train, test = _split(spark, d)
    base = bl.baseline_als(train, ALS_REG_I, ALS_REG_U, 10)
    return _prediction_facts(train, predict_svd_als(test, fit_svd_als(train, base, seed=SEED), base))


@register("predict_nmf_als_facts", with_ctes(SPLIT, _FACTS_SQL), ops="B11")
def q_nmf_als_facts(spark, d):
    train, test = _split(spark, d)
    return _prediction_facts(train, predict_nmf_als(test, fit_nmf_als(train, seed=SEED), bl.global_mean(train)))


_KR_BASE, _KR_BU, _KR_BI = ms.baseline_als_ctes(BSL_REG_I, BSL_REG_U, BSL_EPOCHS, prefix="kr")


@register("rec_known_users_top_n", with_ctes(
    SPLIT + fx.pair_sum_ctes(src="train", out="tps") + fx.sims_ctes(src="tps", out="tsims") + _KR_BASE
    + ms.known_user_recs_ctes(K, MIN_K, REC_N, _KR_BU, _KR_BI),
    "SELECT uid, rank, iid, round(est, 6) AS est, actual_k FROM recs"), ops="R5 J8")
def q_known_users(spark, d):
    train, _ = _split(spark, d)
    sims = similarity(pair_sums(train), "cosine", fx.MIN_SUPPORT)
    model = bl.baseline_als(train, BSL_REG_I, BSL_REG_U, BSL_EPOCHS)
    recs = knn_recommend_for_users(train, sims, model, K, MIN_K, REC_N)
    return recs.select("uid", "rank", "iid", r6("est").alias("est"), "actual_k")


# ------------------------------------------------------------------- grid

def _grid_sql():
    """One chain of expressions per baseline setting (suffix), then the ranking over all of them."""
    variants = ev.similarity_variants(GRID_METRICS, GRID_MIN_SUPPORT, GRID_SHRINKAGE)
    sets = ", ".join(f"({k}, {m})" for k in GRID_K for m in GRID_MIN_K)
    ctes = list(fx.RATINGS) + ms.fold_ctes(GRID_FOLDS) + [ms.mean_cte(BY)] + fx.pair_sum_ctes(src="train", out="tps", by=BY)
    ctes += ["gnames(variant, sim_name, min_support, shrinkage) AS (VALUES "
             + ", ".join(f"({v}, '{m}', {n}, CAST({x} AS DOUBLE))" for v, (m, n, x) in enumerate(variants)) + ")",
             f"gset(k, min_k) AS (VALUES {sets})"]
    errors = []
    for b, (name, (reg_i, reg_u)) in enumerate(GRID_BSL.items()):
        b_ctes, bu, bi = ms.baseline_als_ctes(reg_i, reg_u, BSL_EPOCHS, by=BY, prefix=f"gb{b}")
        ctes += b_ctes
        ctes.append(f"""resid{b} AS (SELECT t.cv_fold, t.uid, t.iid, CAST(t.stars AS DOUBLE) - (m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0)) AS res
            FROM train t JOIN gmu m ON m.cv_fold = t.cv_fold LEFT JOIN {bu} u ON u.uid = t.uid AND u.cv_fold = t.cv_fold
            LEFT JOIN {bi} i ON i.iid = t.iid AND i.cv_fold = t.cv_fold)""")
        ctes += fx.pair_sum_ctes(src=f"resid{b}", out=f"rps{b}", value="res", by=BY, integer=False)
        union = " UNION ALL ".join(
            f"SELECT cv_fold, {v} AS variant, i, j, n, {fx.sim_sql(m, x)} AS sim FROM {f'rps{b}' if m == 'pearson_baseline' else 'tps'} WHERE n >= {n}"
            for v, (m, n, x) in enumerate(variants))
        b_uj = "(m.mu + COALESCE(u.bu, 0.0) + COALESCE(b.bi, 0.0))"
        est = f"{b_uj} + CASE WHEN COALESCE(a.actual_k, 0) >= s.min_k AND a.sum_sim > 0 THEN a.sum_w / a.sum_sim ELSE 0.0 END"
        ctes += [
            f"gsims{b} AS ({union})",
            f"gsm{b} AS (SELECT cv_fold, variant, i, j, n, sim FROM gsims{b} UNION ALL "
            f"SELECT cv_fold, variant, j AS i, i AS j, n, sim FROM gsims{b} UNION ALL "
            f"SELECT DISTINCT t.cv_fold, g.variant, t.iid AS i, t.iid AS j, CAST(0 AS BIGINT) AS n, 1.0 AS sim FROM train t, gnames g)",
            f"gt{b} AS (SELECT DISTINCT t.cv_fold, g.variant, t.uid, t.iid FROM test t, gnames g)",
            f"gcand{b} AS (SELECT t.cv_fold, t.variant, t.uid, t.iid, s.j, s.n, s.sim, CAST(tr.stars AS DOUBLE) AS r_j, "
            f"tr.review_id AS rid_j FROM gt{b} t JOIN gsm{b} s ON s.i = t.iid AND s.sim > 0 AND s.cv_fold = t.cv_fold "
            f"AND s.variant = t.variant JOIN train tr ON tr.uid = t.uid AND tr.iid = s.j AND tr.cv_fold = t.cv_fold)",
            f"gnb{b} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cv_fold, variant, uid, iid "
            f"ORDER BY round(sim, 9) DESC, n DESC, j, rid_j, r_j) AS rank FROM gcand{b}) WHERE rank <= {max(GRID_K)})",
            f"gagg{b} AS (SELECT nb.cv_fold, nb.variant, nb.uid, nb.iid, s.k, sum(nb.sim) AS sum_sim, "
            f"sum(nb.sim * (nb.r_j - {b_uj})) AS sum_w, count(*) AS actual_k FROM gnb{b} nb "
            f"JOIN (SELECT DISTINCT k FROM gset) s ON nb.rank <= s.k JOIN gmu m ON m.cv_fold = nb.cv_fold "
            f"LEFT JOIN {bu} u ON u.uid = nb.uid AND u.cv_fold = nb.cv_fold "
            f"LEFT JOIN {bi} b ON b.iid = nb.j AND b.cv_fold = nb.cv_fold GROUP BY nb.cv_fold, nb.variant, nb.uid, nb.iid, s.k)",
            f"gp{b} AS (SELECT t.cv_fold, t.variant, t.uid, t.iid, s.k, s.min_k, {ms.clip_sql(est)} AS est "
            f"FROM gt{b} t CROSS JOIN gset s LEFT JOIN gagg{b} a ON a.cv_fold = t.cv_fold AND a.variant = t.variant "
            f"AND a.uid = t.uid AND a.iid = t.iid AND a.k = s.k JOIN gmu m ON m.cv_fold = t.cv_fold "
            f"LEFT JOIN {bu} u ON u.uid = t.uid AND u.cv_fold = t.cv_fold LEFT JOIN {bi} b ON b.iid = t.iid AND b.cv_fold = t.cv_fold)",
            f"gerr{b} AS (SELECT '{name}' AS bsl, p.cv_fold, p.variant, p.k, p.min_k, sqrt(avg(power(x.stars - p.est, 2))) AS rmse FROM test x "
            f"JOIN gp{b} p ON p.cv_fold = x.cv_fold AND p.uid = x.uid AND p.iid = x.iid GROUP BY p.cv_fold, p.variant, p.k, p.min_k)",
        ]
        errors.append(f"SELECT * FROM gerr{b}")
    ctes += ["gmean AS (SELECT bsl, variant, k, min_k, avg(rmse) AS rmse FROM (" + " UNION ALL ".join(errors) + ") GROUP BY bsl, variant, k, min_k)",
             f"grid AS (SELECT {GRID_COLS}, rmse, row_number() OVER (ORDER BY round(rmse, 9), {GRID_COLS}) AS rank "
             "FROM gmean JOIN gnames USING (variant))"]
    return ctes


GRID_SQL = _grid_sql()


def _grid(spark, d):
    from recspark.operators.indexing import test_sets_by_fold, train_sets_by_fold
    r = fx.fx_ratings(spark, d).select(*ROWS.split(", "))
    train = materialize(train_sets_by_fold(r, GRID_FOLDS))
    test = test_sets_by_fold(r, GRID_FOLDS)
    sums = materialize(fold_pair_sums(r, fold_of(GRID_FOLDS), GRID_FOLDS, min(GRID_MIN_SUPPORT)), "grid-sums")  # rarer pairs are in no variant
    models = {name: bl.baseline_als(train, *reg, BSL_EPOCHS, by=BY) for name, reg in GRID_BSL.items()}
    return ev.knn_baseline_grid(train, test, sums, models, GRID_METRICS, GRID_K, GRID_MIN_K, GRID_MIN_SUPPORT, GRID_SHRINKAGE, by=BY)


@register("tune_knn_grid", with_ctes(GRID_SQL, f"SELECT {GRID_COLS}, round(rmse, 6) AS rmse, rank FROM grid"),
          ops="E5")
def q_tune_grid(spark, d):
    return _grid(spark, d).select(*GRID_COLS.split(", "), r6("rmse").alias("rmse"), "rank")


@register("tune_best_params", with_ctes(GRID_SQL, f"SELECT {GRID_COLS}, round(rmse, 6) AS rmse FROM grid WHERE rank = 1"),
          ops="E5 S7")
def q_tune_best(spark, d):
    """The best setting, saved and read back as an artifact."""
    best = _grid(spark, d).where(F.col("rank") == 1).select(*GRID_COLS.split(", "), r6("rmse").alias("rmse"))
    return write_table_roundtrip(best, "best-params")


VS_MODELS = ("knn_baseline", "baseline_als", "slope_one")
_VSA_CTES, _VSA_BU, _VSA_BI = ms.baseline_als_ctes(ALS_REG_I, ALS_REG_U, 10, by=BY, prefix="cva")


def _vs_sql():
    ctes = list(CV_BASE + CV_SIMS + _CVB_CTES)
    a_ctes, a_bu, a_bi = ms.baseline_als_ctes(ALS_REG_I, ALS_REG_U, 10, by=BY, prefix="cva")
    ctes += a_ctes
    ctes += ms.normal_pred_ctes(SEED, by=BY, out="p_normal")
    ctes += ms.baseline_pred_ctes(a_bu, a_bi, by=BY, out="p_baseline_als")
    ctes += ms.knn_ctes("baseline", K, MIN_K, by=BY, bu=_CVB_BU, bi=_CVB_BI, out="p_knn_baseline")
    ctes += ms.slope_one_ctes(by=BY, sums="tps", out="p_slope_one")
    parts = [f"SELECT '{m}' AS model, cv_fold, stars, est FROM p_{m}" for m in ("normal",) + VS_MODELS]
    ctes.append("allp AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append("per AS (SELECT model, cv_fold, sqrt(avg(power(stars - est, 2))) AS rmse FROM allp GROUP BY model, cv_fold)")
    ctes.append("mm AS (SELECT model, avg(rmse) AS rmse FROM per GROUP BY model)")
    return with_ctes(ctes, """SELECT a.model, round(a.rmse, 6) AS rmse, round(b.rmse, 6) AS naive_rmse,
        round(b.rmse - a.rmse, 6) AS lift FROM mm a JOIN mm b ON b.model = 'normal' WHERE a.model <> 'normal'""")


@register("eval_vs_naive", _vs_sql(), ops="E6")
def q_vs_naive(spark, d):
    models = _cv_models()
    preds = cross_validate(_cv_ratings(spark, d), {m: models[m] for m in ("normal",) + VS_MODELS}, fx.K_FOLDS)
    per = preds.groupBy("model", *BY).agg(
        F.sqrt(F.avg(F.pow(F.col("stars").cast("double") - F.col("est"), 2))).alias("rmse"))
    mm = materialize(per.groupBy("model").agg(F.avg("rmse").alias("rmse")), "model-scores")  # a row per model
    naive = mm.where(F.col("model") == "normal").select(F.col("rmse").alias("naive_rmse"))
    out = mm.where(F.col("model") != "normal").withColumn("naive_rmse", naive.select("naive_rmse").scalar())
    return out.select("model", r6("rmse").alias("rmse"), r6("naive_rmse").alias("naive_rmse"),
                      r6(F.col("naive_rmse") - F.col("rmse")).alias("lift"))


# -------------------------------------------------- the best model, refitted and saved

def _best_sql():
    """The winning setting chooses among the chains of both baselines and all similarity variants, fitted on all ratings."""
    variants = ev.similarity_variants(GRID_METRICS, GRID_MIN_SUPPORT, GRID_SHRINKAGE)
    ctes = [f"best AS ({with_ctes(GRID_SQL, f'SELECT {GRID_COLS} FROM grid WHERE rank = 1')})", *fx.RATINGS,
            "train AS (SELECT * FROM ratings)", f"test AS (SELECT * FROM ratings WHERE (review_id + 3*iid + 7*uid) % 100 < {fx.HOLDOUT_PERCENT})", ms.mean_cte()]
    users, items = [], []
    for b, (name, (reg_i, reg_u)) in enumerate(GRID_BSL.items()):
        own, bu, bi = ms.baseline_als_ctes(reg_i, reg_u, BSL_EPOCHS, prefix=f"fb{b}")
        ctes += own
        users.append(f"SELECT uid, bu FROM {bu} WHERE (SELECT bsl FROM best) = '{name}'")
        items.append(f"SELECT iid, bi FROM {bi} WHERE (SELECT bsl FROM best) = '{name}'")
    ctes += [f"fbu AS ({' UNION ALL '.join(users)})", f"fbi AS ({' UNION ALL '.join(items)})",
             """resid AS (SELECT t.uid, t.iid, CAST(t.stars AS DOUBLE) - (m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0)) AS res
                FROM train t JOIN gmu m ON true LEFT JOIN fbu u ON u.uid = t.uid LEFT JOIN fbi i ON i.iid = t.iid)"""]
    ctes += fx.pair_sum_ctes(src="train", out="tps") + fx.pair_sum_ctes(src="resid", out="rps", value="res", integer=False)
    chosen = " UNION ALL ".join(
        f"SELECT i, j, n, {fx.sim_sql(m, x)} AS sim FROM {'rps' if m == 'pearson_baseline' else 'tps'} WHERE n >= {n} AND EXISTS "
        f"(SELECT 1 FROM best WHERE sim_name = '{m}' AND min_support = {n} AND shrinkage = {x})" for m, n, x in variants)
    ctes += [f"tsims AS ({chosen})", *fx.mirrored_ctes(src="tsims", out="simsm", diag_src="train"),
             *ms.knn_ctes("baseline", "(SELECT k FROM best)", "(SELECT min_k FROM best)", bu="fbu", bi="fbi")]
    return with_ctes(ctes, "SELECT review_id, uid, iid, stars, round(est, 6) AS est, actual_k FROM pred")


@register("tune_best_model_predict", _best_sql(), ops="E5 S7 S8")
def q_best_model(spark, d):
    """The winner of the grid refitted on all ratings, saved as a bundle, loaded in another session, and asked for the hold-out rows."""
    best = _grid(spark, d).where(F.col("rank") == 1).first()  # one row
    reg_i, reg_u = GRID_BSL[best["bsl"]]
    ratings = _cv_ratings(spark, d)
    model = KNN(kind="baseline", k=best["k"], minK=best["min_k"], metric=best["sim_name"], minSupport=best["min_support"],
                shrinkage=best["shrinkage"], regItem=reg_i, regUser=reg_u, epochs=BSL_EPOCHS).fit(ratings)
    path = scratch_path(spark, "best-model")
    model.save(path)
    loaded = load_rating_model(spark.newSession(), path)
    rows = materialize(holdout_split(ratings, fx.HOLDOUT_PERCENT).where("is_test").drop("is_test"), "asked")
    asked = loaded.tables["ratings"].sparkSession.read.schema(rows.schema).parquet(*rows.inputFiles())
    return loaded.transform(asked).select("review_id", "uid", "iid", "stars", r6("est").alias("est"), "actual_k")


@register("bundle_cv_scores", with_ctes(CV_BASE + _VSA_CTES + ms.baseline_pred_ctes(_VSA_BU, _VSA_BI, by=BY), _fold_scores_sql()), ops="E3 S7 S8")
def q_bundle_cv(spark, d):
    """A cross-validation table through a bundle."""
    preds = cross_validate(_cv_ratings(spark, d), {"baseline_als": _cv_models()["baseline_als"]}, fx.K_FOLDS)
    scores = ev.fold_scores(preds, BY).select("cv_fold", "n", r6("rmse").alias("rmse"), r6("mae").alias("mae"))
    path = save_bundle(spark, scratch_path(spark, "cv-bundle"), {"scores": scores}, {"model": "baseline_als", "folds": fx.K_FOLDS})
    return load_bundle(spark, path)[0]["scores"]


@register("bundle_item_map", REGISTRY["item_map_best_location"].sql, ops="I1 S7 S8")
def q_bundle_item_map(spark, d):
    """The item map through a bundle."""
    found = REGISTRY["item_map_best_location"].build(spark, d)
    path = save_bundle(spark, scratch_path(spark, "map-bundle"), {"item_map": found})
    return load_bundle(spark, path)[0]["item_map"]
