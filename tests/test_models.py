"""Estimators, models and bundles: ten predictors through one call, saved and loaded in another session."""

import random
import threading
import time
import types

import pytest
from pyspark.sql import functions as F

from recspark import models as m
from recspark.models import estimators
from recspark.operators.evaluate import rank_models
from recspark.session import scratch_path
from recspark.sources.bundle import load_bundle, save_bundle


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    rows = []
    for u in range(60):
        for i in range(30):
            if rng.random() < 0.5:
                rows.append((len(rows), u, i, 5 if u % 3 == i % 3 else rng.choice((1, 2))))
    return spark.createDataFrame(rows, "review_id long, uid long, iid long, stars int")




def test_ten_models_in_one_ranking(spark, planted, monkeypatch):
    ranked, top_k = [], estimators.top_k_neighbors
    monkeypatch.setattr(estimators, "top_k_neighbors", lambda *a, **k: ranked.append(1) or top_k(*a, **k))
    models = m.default_models(k=15, metric="pearson", min_support=3, seed=3)
    models["svd"]._set(rank=4)
    models["nmf"]._set(rank=4)
    models["coclustering"]._set(epochs=5)
    preds = m.cross_validate(planted, models, 3)
    facts = preds.groupBy("model").agg(F.count("est").alias("n"), F.min(F.col("est").between(1, 5)).alias("ok"), F.countDistinct("cv_fold").alias("folds"))
    assert {tuple(r) for r in facts.collect()} == {(name, planted.count(), True, 3) for name in models}
    assert ranked == [1]  # once for the four KNN kinds
    ranking = {r.model: (r["rank"], r.rmse) for r in rank_models(preds).collect()}
    assert sorted(x[0] for x in ranking.values()) == list(range(1, 11)) and ranking["normal"][0] == 10
    assert all(ranking[x][1] < 0.7 * ranking["normal"][1] for x in ("knn_baseline", "knn_means", "slope_one", "coclustering", "svd"))


def test_factor_fits_leave_no_shuffle_files_of_earlier_folds(spark, planted, monkeypatch):
    """When a fold's fit begins, the shuffle files of the fits before are deleted."""
    seen, fit = [], estimators.fit_nmf_als

    def files():
        time.sleep(2)  # they are deleted in the background
        return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()

    monkeypatch.setattr(estimators, "fit_nmf_als", lambda *a, **k: seen.append(files()) or fit(*a, **k))
    model = m.default_models()["nmf"]
    model._set(rank=2)
    assert m.cross_validate(planted, {"nmf": model}, 3).count() == planted.count()
    assert len(seen) == 3 and max(seen) < seen[0] + 100, seen


@pytest.mark.parametrize("name", sorted(m.default_models()))
def test_a_saved_model_predicts_the_same_in_another_session(spark, planted, name):
    estimator = m.default_models(k=9, min_k=2, min_support=2, seed=1)[name]
    estimator._set(**{p: 3 for p in ("epochs", "iterations", "rank") if estimator.hasParam(p)})  # quick fits: nothing here depends on quality
    model = estimator.fit(planted.where("review_id % 5 <> 0"))
    test = planted.where("review_id % 5 = 0").unionByName(spark.createDataFrame([(-1, 999, 1, 3), (-2, 1, 999, 3)], planted.schema))
    path = scratch_path(spark, f"model-{name}")
    model.save(path)
    other = spark.newSession()
    loaded = m.load_model(other, path)
    assert type(loaded) is type(model) and {p.name: loaded[p.name] for p in loaded.params} == {p.name: model[p.name] for p in model.params}
    copy = scratch_path(spark, "test-rows")
    test.write.parquet(copy)
    rows = lambda df: {r.review_id: round(r.est, 9) for r in df.collect()}
    got = rows(loaded.transform(other.read.parquet(copy)))
    assert got == rows(model.transform(test)) and len(got) == test.count() and all(1 <= x <= 5 for x in got.values())
    with pytest.raises(ValueError, match="holds a bundle already"):
        model.save(path)
    model.write().overwrite().save(path)
    assert rows(type(model).load(path).transform(test)) == got
    with pytest.raises(ValueError, match="not a"):
        (m.NormalModel if name != "normal" else m.KNNModel).load(path)


def test_estimator_params_and_copies(spark):
    path = scratch_path(spark, "estimator")
    knn = m.KNN(kind="zscore", k=7, folds=["cv_fold"])
    knn.save(path)
    again = m.KNN.load(path)
    assert (again["kind"], again["k"], again["folds"], again["metric"]) == ("zscore", 7, ["cv_fold"], "cosine")
    assert knn.copy({knn.k: 3})["k"] == 3 and knn["k"] == 7
    with pytest.raises((TypeError, AttributeError)):
        m.KNN(neighbours=3)
    with pytest.raises(ValueError):
        m.Baseline(method="sgd").fit(spark.createDataFrame([(1, 1, 1, 3)], "review_id long, uid long, iid long, stars int"))


def test_bundles_appear_whole_or_not_at_all(spark):
    path = scratch_path(spark, "bundle")
    with pytest.raises(ValueError, match="no bundle"):
        load_bundle(spark, path)
    one, two = spark.range(3), spark.createDataFrame([], "a string, b array<double>")
    save_bundle(spark, path, {"one": one, "two": two}, {"k": [1, 2]})
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        save_bundle(spark, path, {"one": spark.range(9), "two": broken}, overwrite=True)
    tables, settings = load_bundle(spark, path)
    assert tables["one"].count() == 3 and tables["two"].schema == two.schema and tables["two"].count() == 0 and settings == {"k": [1, 2]}
    save_bundle(spark, path, {"three": spark.range(4)}, overwrite=True)
    assert list(load_bundle(spark, path)[0]) == ["three"]


def test_fits_of_small_folds_run_beside_each_other(spark, monkeypatch):
    rows = spark.createDataFrame([(f, u, u % 3) for f in range(2) for u in range(6)], "cv_fold int, uid long, iid long")
    for at_once in (2, 1):
        monkeypatch.setattr(estimators, "RATINGS_AT_ONCE", 6 * at_once)
        meet, running, most = threading.Barrier(at_once), [], []

        def fit(of):
            running.append(1)
            meet.wait(60)
            most.append(len(running))
            meet.wait(60)
            running.pop()
            factors = of(rows).groupBy(F.col("uid").alias("id")).agg(F.collect_list("iid").alias("features"))
            return types.SimpleNamespace(userFactors=factors, itemFactors=factors)

        found = estimators._per_fold(rows, ["cv_fold"], fit)
        assert most == [at_once] * 2
        for table in found.values():
            assert sorted((r.cv_fold, r.id) for r in table.collect()) == [(f, u) for f in range(2) for u in range(6)]


def test_targets_are_looked_up_once_for_all_models(spark, monkeypatch):
    calls, real = [], estimators.known_targets
    monkeypatch.setattr(estimators, "known_targets", lambda *a: calls.append(1) or real(*a))
    rows = spark.createDataFrame([(n, n % 9, n * n % 7, 1 + n % 5) for n in range(120)], "review_id long, uid long, iid long, stars int")
    models = {"basic": m.KNN(kind="basic"), "means": m.KNN(kind="means"), "slope": m.SlopeOne()}
    found = m.cross_validate(rows, models, 3).groupBy("model").count().collect()
    assert sorted((r["model"], r["count"]) for r in found) == [("basic", 120), ("means", 120), ("slope", 120)] and len(calls) == 1
