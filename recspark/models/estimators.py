"""The rating predictors: normal, baselines, the KNN family, Slope One, co-clustering, SVD and NMF.

Each class only wires the fits and predictions of ``recspark.operators`` to params and tables.  What several models need is taken
from :class:`~recspark.models.base.Shared`: pair sums, similarities, baselines, and at prediction the ranked neighbours, which
all four KNN kinds use.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from recspark.functions.exprs import clip
from recspark.models.base import RatingEstimator, RatingModel, RatingParams, Shared, number, text
from recspark.operators import baselines as bl
from recspark.operators.coclustering import fit_coclustering, predict_coclustering
from recspark.operators.evaluate import metric_sums
from recspark.operators.factor import fit_nmf_als, fit_svd_als
from recspark.operators.predictors import item_stats, knn_predict, known_targets, slope_one_predict
from recspark.operators.similarity import attach_baseline, attach_mean, mirror, pair_sums, similarity, top_k_neighbors
from recspark.session import materialize, release_shuffles

BIAS = ("method", "regItem", "regUser", "epochs", "learningRate", "penalty")


def _rows(train: DataFrame, by, shared: Shared) -> DataFrame:
    """The rating rows, written once for all models."""
    return shared.get("rows", lambda: materialize(train.select(*by, "review_id", "uid", "iid", "stars"), "model-ratings"))


def _targets(rows: DataFrame, train: DataFrame, by, shared: Shared) -> DataFrame:
    """The targets of the rows that are asked for, and which are known, written once for all models that ask for them."""
    return shared.get("targets", lambda: materialize(known_targets(rows, train, by), "targets"))


def _sums(train: DataFrame, by, shared: Shared, least: int) -> DataFrame:
    """The pair sums with n >= ``least``; several models of one job share those for the smallest (``models.validation``)."""
    make = lambda: materialize(pair_sums(_rows(train, by, shared), by=by, min_support=least).where(F.col("n") >= least), "model-sums")
    return shared.get("sums", make)


# ---- naive and baselines ----

class _NormalParams(RatingParams):
    seed = number("seed", "seed of the draws", whole=True)
    DEFAULTS = {"seed": 0}


class NormalModel(_NormalParams, RatingModel):
    def predict(self, rows, shared):
        return bl.predict_normal(rows, self.tables["params"], self["seed"], by=self["folds"])


class Normal(_NormalParams, RatingEstimator):
    """Draws from a normal distribution with the mean and spread of the training ratings."""

    MODEL = NormalModel

    def tables_of(self, train, shared):
        return {"params": materialize(bl.normal_params(train, by=self["folds"]), "normal-params")}


class _BiasParams(RatingParams):
    method = text("method", "als or gd")
    regItem = number("regItem", "regularisation of the item biases (als)")
    regUser = number("regUser", "regularisation of the user biases (als)")
    epochs = number("epochs", "rounds", whole=True)
    learningRate = number("learningRate", "step (gd)")
    penalty = number("penalty", "regularisation (gd)")
    DEFAULTS = {"method": "als", "regItem": 10.0, "regUser": 15.0, "epochs": 10, "learningRate": 0.005, "penalty": 0.02}

    def biases(self, train: DataFrame, shared: Shared) -> dict[str, DataFrame]:
        def fit():
            rows, by = _rows(train, self["folds"], shared), self["folds"]
            if self["method"] == "als":
                model = bl.baseline_als(rows, self["regItem"], self["regUser"], self["epochs"], by=by)
            elif self["method"] == "gd":
                model = bl.baseline_gd(rows, self["learningRate"], self["penalty"], self["epochs"], by=by)
            else:
                raise ValueError(f"unknown method {self['method']!r}")
            return dict(zip(("mu", "bu", "bi"), model))

        return shared.get(("bias", self.key(*BIAS)), fit)


def _bias_tables(tables) -> tuple:
    return tables["mu"], tables["bu"], tables["bi"]


class BaselineModel(_BiasParams, RatingModel):
    def predict(self, rows, shared):
        return bl.predict_baseline(rows, _bias_tables(self.tables), by=self["folds"])


class Baseline(_BiasParams, RatingEstimator):
    """mu + b_u + b_i by alternating least squares or batch gradient descent."""

    MODEL = BaselineModel

    def tables_of(self, train, shared):
        return self.biases(train, shared)


# ---- neighbourhoods ----

class _KNNParams(_BiasParams):
    kind = text("kind", "basic, means, zscore or baseline")
    k = number("k", "most neighbours", whole=True)
    minK = number("minK", "fewest neighbours", whole=True)
    metric = text("metric", "cosine, msd, pearson or pearson_baseline")
    minSupport = number("minSupport", "fewest common users of a pair", whole=True)
    shrinkage = number("shrinkage", "shrinkage of pearson_baseline")
    DEFAULTS = _BiasParams.DEFAULTS | {"kind": "baseline", "k": 40, "minK": 1, "metric": "cosine", "minSupport": 1, "shrinkage": 100.0, "regItem": 5.0, "regUser": 10.0}

    def sims_key(self) -> tuple:
        return self.key("metric", "minSupport", "shrinkage", *(BIAS if self["metric"] == "pearson_baseline" else ()))


class KNNModel(_KNNParams, RatingModel):
    def predict(self, rows, shared):
        by, train = self["folds"], self.tables["ratings"]
        targets = _targets(rows, train, by, shared)

        def rank():
            sims = mirror(self.tables["sims"], train, by=by)
            return materialize(top_k_neighbors(targets, sims, train, self["k"], by=by), "neighbors")

        nb = shared.get(("neighbors", self.sims_key(), self["k"]), rank)
        biases = _bias_tables(self.tables) if self["kind"] == "baseline" else None
        stats = shared.get("item-stats", lambda: materialize(item_stats(train, by=by), "item-stats")) if self["kind"] in ("means", "zscore") else None
        return knn_predict(train, rows, None, self["kind"], self["k"], self["minK"], baselines=biases, by=by, neighbors=nb, targets=targets, stats=stats)


class KNN(_KNNParams, RatingEstimator):
    """The item-based KNN family."""

    MODEL = KNNModel

    def least_support(self):
        return max(1, self["minSupport"]) if self["metric"] != "pearson_baseline" else None

    def tables_of(self, train, shared):
        by, rows = self["folds"], _rows(train, self["folds"], shared)
        own = self.biases(train, shared) if "baseline" in (self["kind"], self["metric"].rpartition("_")[2]) else {}

        def sims():
            sums = metric_sums(rows, _sums(train, by, shared, self.least_support()) if self.least_support() else None, self["metric"],
                               _bias_tables(own) if own else None, by, self["minSupport"])
            return materialize(similarity(sums, self["metric"], self["minSupport"], self["shrinkage"], by=by), "model-sims")

        return own | {"ratings": rows, "sims": shared.get(("sims", self.sims_key()), sims)}


class SlopeOneModel(RatingModel):
    def predict(self, rows, shared):
        by, train = self["folds"], self.tables["ratings"]
        return slope_one_predict(train, rows, self.tables["sums"], by=by, targets=_targets(rows, train, by, shared))


class SlopeOne(RatingEstimator):
    MODEL = SlopeOneModel

    def least_support(self):
        return 1

    def tables_of(self, train, shared):
        by = self["folds"]
        return {"ratings": _rows(train, by, shared), "sums": _sums(train, by, shared, 1)}


# ---- clusters and factors ----

class _CoClusteringParams(RatingParams):
    userClusters = number("userClusters", "clusters of users", whole=True)
    itemClusters = number("itemClusters", "clusters of items", whole=True)
    epochs = number("epochs", "rounds", whole=True)
    DEFAULTS = {"userClusters": 3, "itemClusters": 3, "epochs": 20}


class CoClusteringModel(_CoClusteringParams, RatingModel):
    def predict(self, rows, shared):
        return predict_coclustering(rows, self.tables, by=self["folds"])


class CoClustering(_CoClusteringParams, RatingEstimator):
    MODEL = CoClusteringModel

    def tables_of(self, train, shared):
        return fit_coclustering(_rows(train, self["folds"], shared), self["userClusters"], self["itemClusters"], self["epochs"], by=self["folds"])


class _FactorParams(_BiasParams):
    rank = number("rank", "number of factors", whole=True)
    iterations = number("iterations", "ALS rounds", whole=True)
    reg = number("reg", "regularisation of the factors")
    seed = number("seed", "seed of the start", whole=True)


RATINGS_AT_ONCE = 4_000_000


def _per_fold(train: DataFrame, by, fit) -> dict[str, DataFrame]:
    """Factor tables of one ALS fit per fold (the folds are a handful; ALS has no notion of them).

    The fits of small folds run beside each other, as many as ``RATINGS_AT_ONCE`` allow: their rounds leave cores idle.  A fold's
    factors are written and its model is dropped before the next fit, so that the files of few ratings are on disk at a time.
    """
    names = ("user_factors", "item_factors")
    folds = [r.asDict() for r in train.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).collect()] if by else [{"_n": RATINGS_AT_ONCE}]
    at_once = max(1, min(len(folds), RATINGS_AT_ONCE // max([f["_n"] for f in folds] or [1])))
    for fold in folds:
        fold.pop("_n")
    spark = train.sparkSession

    def one(fold: dict) -> list[DataFrame]:
        model = fit(lambda df: reduce(lambda d, kv: d.where(F.col(kv[0]) == kv[1]), fold.items(), df).drop(*fold))
        tables = [materialize(factors.select(*[F.lit(v).alias(c) for c, v in fold.items()], "id", "features"), name)
                  for name, factors in zip(names, (model.userFactors, model.itemFactors))]
        del model
        release_shuffles(spark)
        return tables

    if at_once == 1:
        parts = [one(fold) for fold in folds]
    else:
        with ThreadPoolExecutor(at_once) as pool:
            parts = list(pool.map(inheritable_thread_target(spark)(one), folds))
    return {name: reduce(lambda a, b: a.unionByName(b), dfs) for name, dfs in zip(names, zip(*parts))}


def _dot(rows: DataFrame, tables, by) -> DataFrame:
    """Adds ``dot`` = p_u . q_i, null where the user or the item has no factors."""
    side = lambda name, key, out: tables[name].select(*by, F.col("id").cast("long").alias(key), F.col("features").alias(out))
    both = rows.join(side("user_factors", "uid", "_p"), [*by, "uid"], "left").join(side("item_factors", "iid", "_q"), [*by, "iid"], "left")
    products = F.zip_with("_p", "_q", lambda a, b: a.cast("double") * b.cast("double"))
    return both.withColumn("dot", F.aggregate(products, F.lit(0.0), lambda s, x: s + x)).drop("_p", "_q")


class SVDModel(_FactorParams, RatingModel):
    DEFAULTS = _BiasParams.DEFAULTS | {"rank": 20, "iterations": 10, "reg": 0.05, "seed": 0}

    def predict(self, rows, shared):
        by = self["folds"]
        t = attach_baseline(_dot(rows, self.tables, by), *_bias_tables(self.tables), by=by)
        return t.withColumn("est", clip(F.col("b_ui") + F.coalesce("dot", F.lit(0.0)), 1.0, 5.0)).drop("dot", "mu", "bu", "bi", "b_ui")


class SVD(_FactorParams, RatingEstimator):
    """mu + b_u + b_i + q_i . p_u, the factors by ALS on the residuals."""

    MODEL, DEFAULTS = SVDModel, SVDModel.DEFAULTS

    def tables_of(self, train, shared):
        by, rows, own = self["folds"], _rows(train, self["folds"], shared), self.biases(train, shared)
        fit = lambda of: fit_svd_als(of(rows), tuple(of(b) for b in _bias_tables(own)), self["rank"], self["iterations"], self["reg"], self["seed"])
        return own | _per_fold(rows, by, fit)


class NMFModel(_FactorParams, RatingModel):
    DEFAULTS = _BiasParams.DEFAULTS | {"rank": 15, "iterations": 10, "reg": 0.06, "seed": 0}

    def predict(self, rows, shared):
        by = self["folds"]
        t = attach_mean(_dot(rows, self.tables, by), self.tables["mean"], by)
        return t.withColumn("est", clip(F.coalesce("dot", "mu"), 1.0, 5.0)).drop("dot", "mu")


class NMF(_FactorParams, RatingEstimator):
    """Non-negative factors; the mean for unknown users and items."""

    MODEL, DEFAULTS = NMFModel, NMFModel.DEFAULTS

    def tables_of(self, train, shared):
        by, rows = self["folds"], _rows(train, self["folds"], shared)
        fit = lambda of: fit_nmf_als(of(rows), self["rank"], self["iterations"], self["reg"], self["seed"])
        return {"mean": materialize(bl.global_mean(rows, by=by), "mean")} | _per_fold(rows, by, fit)
