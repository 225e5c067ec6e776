"""Indexing, splits, baselines, neighbourhood predictors and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.functions.exprs import r6
from recspark.models import KNN, NMF, SVD, Baseline, CoClustering, Normal, SlopeOne, cross_validate
from recspark.operators import baselines as bl
from recspark.operators import evaluate as ev
from recspark.operators.indexing import factorize, holdout_split, kfold, validate_ratings
from recspark.operators.predictors import knn_predict, slope_one_predict
from recspark.operators.similarity import (
    mirror, pair_sums, residuals, similarity, top_k_neighbors,
)
from recspark.plans import fixture as fx
from recspark.plans import model_sql as ms
from recspark.plans.registry import register, with_ctes

T = fx.RATINGS
ROWS = "review_id, uid, iid, stars, date"
K, MIN_K = 20, 2
BSL_REG_I, BSL_REG_U, BSL_EPOCHS = 5.0, 10.0, 10   # KNNBaseline's baseline settings
ALS_REG_I, ALS_REG_U = 10.0, 15.0                   # baseline-only defaults
GD_LR, GD_REG, GD_EPOCHS = 0.005, 0.02, 20
SEED = 7

SPLIT = T + ms.split_ctes() + [ms.mean_cte()]


def _split(spark, d):
    r = holdout_split(fx.fx_ratings(spark, d), fx.HOLDOUT_PERCENT)
    cols = ROWS.split(", ")
    return r.where(~F.col("is_test")).select(*cols), r.where(F.col("is_test")).select(*cols)


def _pred_out(df, with_k=False):
    cols = ["review_id", "uid", "iid", "stars", r6("est").alias("est")]
    return df.select(*cols, *(["actual_k"] if with_k else []))


PRED_SEL = "SELECT review_id, uid, iid, stars, round(est, 6) AS est FROM pred"
PRED_SEL_K = "SELECT review_id, uid, iid, stars, round(est, 6) AS est, actual_k FROM pred"


# ------------------------------------------------------------ ids and splits

@register("index_factorize", with_ctes([fx.REVIEWS, """f AS (SELECT uid, date, review_id, row_number() OVER
    (PARTITION BY uid ORDER BY date, review_id) AS rn FROM reviews WHERE uid IS NOT NULL)"""],
    "SELECT uid, CAST(row_number() OVER (ORDER BY date, review_id, uid) - 1 AS BIGINT) AS uid_code FROM f WHERE rn = 1"),
    ops="X1")
def q_factorize(spark, d):
    return factorize(fx.fx_reviews(spark, d), "uid", out="uid_code")


@register("ratings_validated", with_ctes([fx.REVIEWS], """SELECT uid, iid, CAST(stars AS DOUBLE) AS rating,
    CAST(stars AS DOUBLE) BETWEEN 1.0 AND 5.0 AS in_scale FROM reviews"""), ops="X2")
def q_validated(spark, d):
    return validate_ratings(fx.fx_reviews(spark, d))


@register("split_holdout", with_ctes([fx.REVIEWS], f"SELECT {ROWS}, (review_id + 3*iid + 7*uid) % 100 < {fx.HOLDOUT_PERCENT} AS is_test FROM reviews"),
          ops="X3")
def q_split_holdout(spark, d):
    return holdout_split(fx.fx_reviews(spark, d), fx.HOLDOUT_PERCENT)


@register("split_kfold", with_ctes([fx.REVIEWS], f"SELECT {ROWS}, CAST((review_id + 3*iid + 7*uid) % {fx.K_FOLDS} AS INT) AS fold FROM reviews"),
          ops="X4")
def q_split_kfold(spark, d):
    return kfold(fx.fx_reviews(spark, d), fx.K_FOLDS)


# ----------------------------------------------------------------- baselines

_ALS_CTES, _ALS_BU, _ALS_BI = ms.baseline_als_ctes(ALS_REG_I, ALS_REG_U, 10, prefix="a")


@register("baseline_als", with_ctes(SPLIT + _ALS_CTES + ms.baseline_pred_ctes(_ALS_BU, _ALS_BI), PRED_SEL), ops="B1")
def q_baseline_als(spark, d):
    train, test = _split(spark, d)
    model = bl.baseline_als(train, ALS_REG_I, ALS_REG_U, 10)
    return _pred_out(bl.predict_baseline(test, model))


_GD_CTES, _GD_BU, _GD_BI = ms.baseline_gd_ctes(GD_LR, GD_REG, GD_EPOCHS)


@register("baseline_gd", with_ctes(SPLIT + _GD_CTES + ms.baseline_pred_ctes(_GD_BU, _GD_BI), PRED_SEL), ops="B2")
def q_baseline_gd(spark, d):
    train, test = _split(spark, d)
    model = bl.baseline_gd(train, GD_LR, GD_REG, GD_EPOCHS)
    return _pred_out(bl.predict_baseline(test, model))


@register("predict_normal", with_ctes(SPLIT + ms.normal_pred_ctes(SEED), PRED_SEL), ops="B3")
def q_predict_normal(spark, d):
    train, test = _split(spark, d)
    return _pred_out(bl.predict_normal(test, bl.normal_params(train), SEED))


# ------------------------------------------------------------- neighbourhood

TRAIN_SIMS = fx.pair_sum_ctes(src="train", out="tps") + fx.sims_ctes(src="tps", out="tsims") + \
    fx.mirrored_ctes(src="tsims", out="simsm", diag_src="train")
_KB_CTES, _KB_BU, _KB_BI = ms.baseline_als_ctes(BSL_REG_I, BSL_REG_U, BSL_EPOCHS, prefix="kb")


def _train_sims(train, metric="cosine", min_support=fx.MIN_SUPPORT, by=()):
    return mirror(similarity(pair_sums(train, by=by), metric, min_support, fx.SHRINKAGE, by=by), train, by=by)


@register("knn_topk_neighbors", with_ctes(SPLIT + TRAIN_SIMS + ms.knn_ctes("basic", K, MIN_K)[:3],
    "SELECT uid, iid, rank, j, n, round(sim, 6) AS sim, r_j FROM pred_nb"), ops="W3")
def q_knn_topk(spark, d):
    train, test = _split(spark, d)
    nb = top_k_neighbors(test, _train_sims(train), train, K)
    return nb.select("uid", "iid", "rank", "j", "n", r6("sim").alias("sim"),
                     F.col("r_j").cast("double").alias("r_j"))


def _knn_query(kind):
    def build(spark, d):
        train, test = _split(spark, d)
        model = bl.baseline_als(train, BSL_REG_I, BSL_REG_U, BSL_EPOCHS) if kind == "baseline" else None
        p = knn_predict(train, test, _train_sims(train), kind, K, MIN_K, baselines=model)
        return _pred_out(p, with_k=True)
    return build


for _kind, _op in (("basic", "B4"), ("means", "B5"), ("zscore", "B6"), ("baseline", "B7")):
    _extra = _KB_CTES if _kind == "baseline" else []
    register(f"predict_knn_{_kind}", with_ctes(
        SPLIT + TRAIN_SIMS + _extra + ms.knn_ctes(_kind, K, MIN_K, bu=_KB_BU, bi=_KB_BI), PRED_SEL_K),
        ops=_op)(_knn_query(_kind))


SPLIT_SWAP = T + ms.split_ctes(swap=True) + [ms.mean_cte()]


@register("predict_knn_basic_users", with_ctes(
    SPLIT_SWAP + TRAIN_SIMS + ms.knn_ctes("basic", K, MIN_K),
    "SELECT review_id, iid AS uid, uid AS iid, stars, round(est, 6) AS est, actual_k FROM pred"), ops="B4 M5 Q1")
def q_knn_basic_users(spark, d):
    train, test = _split(spark, d)
    user_sims = mirror(similarity(pair_sums(train, user="iid", item="uid"), "cosine", fx.MIN_SUPPORT),
                       train.select(F.col("uid").alias("iid")))
    p = knn_predict(train, test, user_sims, "basic", K, MIN_K, user_based=True)
    return _pred_out(p, with_k=True)


@register("predict_slope_one", with_ctes(
    SPLIT + fx.pair_sum_ctes(src="train", out="tps") + ms.slope_one_ctes(), PRED_SEL), ops="B8")
def q_slope_one(spark, d):
    train, test = _split(spark, d)
    return _pred_out(slope_one_predict(train, test, pair_sums(train)))


# pearson_baseline: cosine of baseline residuals (baselines from all trimmed ratings)
_PB_CTES, _PB_BU, _PB_BI = ms.baseline_als_ctes(ALS_REG_I, ALS_REG_U, BSL_EPOCHS, src="ratings", prefix="pb")
PB_SQL = T + [ms.mean_cte(src="ratings")] + _PB_CTES + [
    f"""resid AS (SELECT t.uid, t.iid, CAST(t.stars AS DOUBLE) - (m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0)) AS res
        FROM ratings t JOIN gmu m ON true LEFT JOIN {_PB_BU} u ON u.uid = t.uid LEFT JOIN {_PB_BI} i ON i.iid = t.iid)"""
] + fx.pair_sum_ctes(src="resid", out="rps", value="res", integer=False) + \
    fx.sims_ctes("pearson_baseline", src="rps", out="pbs")


@register("sim_pearson_baseline", with_ctes(PB_SQL, "SELECT i, j, n, round(sim, 6) AS sim FROM pbs"), ops="M4")
def q_sim_pearson_baseline(spark, d):
    ratings = fx.fx_ratings(spark, d)
    model = bl.baseline_als(ratings, ALS_REG_I, ALS_REG_U, BSL_EPOCHS)
    res = residuals(ratings, model)
    sums = pair_sums(res, value="res", integer_sums=False)
    s = similarity(sums, "pearson_baseline", fx.MIN_SUPPORT, fx.SHRINKAGE)
    return s.select("i", "j", "n", r6("sim").alias("sim"))


# ----------------------------------------------------------------- evaluation

KB_PRED = SPLIT + TRAIN_SIMS + _KB_CTES + ms.knn_ctes("baseline", K, MIN_K, bu=_KB_BU, bi=_KB_BI)


def _kb_holdout(spark, d):
    train, test = _split(spark, d)
    model = bl.baseline_als(train, BSL_REG_I, BSL_REG_U, BSL_EPOCHS)
    return knn_predict(train, test, _train_sims(train), "baseline", K, MIN_K, baselines=model)


@register("eval_rmse", with_ctes(KB_PRED, "SELECT round(sqrt(avg(power(stars - est, 2))), 6) AS rmse FROM pred"), ops="E1")
def q_eval_rmse(spark, d):
    return ev.rmse(_kb_holdout(spark, d)).select(r6("rmse").alias("rmse"))


@register("eval_mae", with_ctes(KB_PRED, "SELECT round(avg(abs(stars - est)), 6) AS mae FROM pred"), ops="E2")
def q_eval_mae(spark, d):
    return ev.mae(_kb_holdout(spark, d)).select(r6("mae").alias("mae"))


BY = ("cv_fold",)
CV_BASE = T + ms.fold_ctes(fx.K_FOLDS) + [ms.mean_cte(BY)]
CV_SIMS = fx.pair_sum_ctes(src="train", out="tps", by=BY) + fx.sims_ctes(src="tps", out="tsims", by=BY) + \
    fx.mirrored_ctes(src="tsims", out="simsm", diag_src="train", by=BY)
_CVB_CTES, _CVB_BU, _CVB_BI = ms.baseline_als_ctes(BSL_REG_I, BSL_REG_U, BSL_EPOCHS, by=BY, prefix="cvb")


def _cv_ratings(spark, d):
    return fx.fx_ratings(spark, d).select(*ROWS.split(", "))


def _cv_models():
    """The ten predictors with the parameters of the fixture queries."""
    knn = lambda kind: KNN(kind=kind, k=K, minK=MIN_K, minSupport=fx.MIN_SUPPORT, regItem=BSL_REG_I, regUser=BSL_REG_U, epochs=BSL_EPOCHS)
    return {"normal": Normal(seed=SEED), "baseline_als": Baseline(regItem=ALS_REG_I, regUser=ALS_REG_U, epochs=10),
            **{f"knn_{x}": knn(x) for x in ("basic", "means", "zscore", "baseline")}, "slope_one": SlopeOne(),
            "coclustering": CoClustering(userClusters=CC_CLUSTERS, itemClusters=CC_CLUSTERS, epochs=CC_EPOCHS),
            "svd": SVD(seed=SEED, regItem=ALS_REG_I, regUser=ALS_REG_U, epochs=10), "nmf": NMF(seed=SEED)}


def _ranking(spark, d, names):
    models = _cv_models()
    out = ev.rank_models(cross_validate(_cv_ratings(spark, d), {m: models[m] for m in names}, fx.K_FOLDS), BY)
    return out.select("model", r6("rmse").alias("rmse"), r6("mae").alias("mae"), r6("rmse_sd").alias("rmse_sd"), "rank")


def _fold_scores_sql(pred="pred", model=None):
    m = f"'{model}' AS model, " if model else ""
    return (f"SELECT {m}cv_fold, count(*) AS n, round(sqrt(avg(power(stars - est, 2))), 6) AS rmse, "
            f"round(avg(abs(stars - est)), 6) AS mae FROM {pred} GROUP BY cv_fold")


@register("eval_cross_validate", with_ctes(
    CV_BASE + CV_SIMS + _CVB_CTES + ms.knn_ctes("baseline", K, MIN_K, by=BY, bu=_CVB_BU, bi=_CVB_BI),
    _fold_scores_sql()), ops="E3")
def q_cross_validate(spark, d):
    preds = cross_validate(_cv_ratings(spark, d), {"knn_baseline": _cv_models()["knn_baseline"]}, fx.K_FOLDS)
    s = ev.fold_scores(preds, BY)
    return s.select("cv_fold", "n", r6("rmse").alias("rmse"), r6("mae").alias("mae"))


COMPARE_MODELS = ("normal", "baseline_als", "knn_basic", "knn_means", "knn_zscore", "knn_baseline", "slope_one",
                  "coclustering")
CC_CLUSTERS, CC_EPOCHS = 3, 20


def _compare_sql():
    ctes = list(CV_BASE + CV_SIMS + _CVB_CTES)
    a_ctes, a_bu, a_bi = ms.baseline_als_ctes(ALS_REG_I, ALS_REG_U, 10, by=BY, prefix="cva")
    ctes += a_ctes
    ctes += ms.normal_pred_ctes(SEED, by=BY, out="p_normal")
    ctes += ms.baseline_pred_ctes(a_bu, a_bi, by=BY, out="p_baseline_als")
    for kind in ("basic", "means", "zscore", "baseline"):
        ctes += ms.knn_ctes(kind, K, MIN_K, by=BY, bu=_CVB_BU, bi=_CVB_BI, out=f"p_knn_{kind}")
    ctes += ms.slope_one_ctes(by=BY, sums="tps", out="p_slope_one")
    ctes += ms.coclustering_ctes(CC_CLUSTERS, CC_CLUSTERS, CC_EPOCHS, by=BY, out="p_coclustering")
    parts = [f"SELECT '{m}' AS model, cv_fold, stars, est FROM p_{m}" for m in COMPARE_MODELS]
    ctes.append("allp AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append("""per AS (SELECT model, cv_fold, sqrt(avg(power(stars - est, 2))) AS rmse, avg(abs(stars - est)) AS mae
                   FROM allp GROUP BY model, cv_fold)""")
    return with_ctes(ctes, """SELECT model, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae,
        round(stddev_pop(rmse), 6) AS rmse_sd,
        row_number() OVER (ORDER BY round(avg(rmse), 9), model) AS rank FROM per GROUP BY model""")


@register("eval_compare_models", _compare_sql(), ops="E4 E3 Q12")
def q_compare_models(spark, d):
    return _ranking(spark, d, COMPARE_MODELS)


@register("eval_compare_factor_models", None, ops="E4 B10 B11")
def q_compare_factor_models(spark, d):
    """The two factor models of the comparison beside the naive one (ALS has no SQL twin)."""
    return _ranking(spark, d, ("normal", "svd", "nmf"))


@register("eval_compare_ten_models", None, ops="E3 E4 B10 B11")
def q_compare_ten_models(spark, d):
    """All ten predictors through one call, in one ranking."""
    return _ranking(spark, d, tuple(_cv_models()))
