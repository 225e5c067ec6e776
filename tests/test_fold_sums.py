"""Pair sums of all training sets in one pass, and the sizing of the tasks that make pair sums."""

import random

import pytest
from pyspark.sql import functions as F

from recspark.functions.exprs import fold_of
from recspark.models import KNN, SlopeOne, cross_validate
from recspark.operators import indexing
from recspark.operators.predictors import slope_one_predict
from recspark.operators.similarity import WORK_PER_TASK, fold_pair_sums, pair_sums, plan_tasks, plan_user_blocks

K = 3
COLS = ("cv_fold", "i", "j", "n", "sx", "sy", "sxx", "syy", "sxy")


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(5)
    rows = [(n, rng.randrange(14), rng.randrange(9) - 2, rng.randrange(1, 6)) for n in range(150)]
    rows += [(200, None, 3, 4), (201, 4, None, 4), (202, 5, 3, None), (203, 6, 1, None), (None, 7, 2, 5)]
    return spark.createDataFrame(rows, "review_id long, uid long, iid long, stars int").repartition(3)


def _usable(ratings, least):
    """Brute force: the pairs of a training set that some target of its test set can use."""
    sums = pair_sums(indexing.train_sets_by_fold(ratings, K), by=["cv_fold"]).where(F.col("n") >= least)
    asked = (indexing.test_sets_by_fold(ratings, K).select("cv_fold", "uid", F.col("iid").alias("a"))
             .join(indexing.train_sets_by_fold(ratings, K).select("cv_fold", "uid", F.col("iid").alias("b")), ["cv_fold", "uid"]).where("a <> b")
             .select("cv_fold", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).distinct())
    return {tuple(r) for r in sums.select(*COLS).collect()}, {tuple(r) for r in sums.join(asked, ["cv_fold", "i", "j"]).select(*COLS).collect()}


@pytest.mark.parametrize("least", [1, 2, 4])
@pytest.mark.parametrize("heavy", [2048, 3])
def test_fold_sums_hold_all_usable_pairs(ratings, least, heavy):
    every, usable = _usable(ratings, least)
    got = [tuple(r) for r in fold_pair_sums(ratings, fold_of(K), K, least, heavy_cells=heavy).select(*COLS).collect()]
    assert len(got) == len(set(got)) and usable and usable <= set(got) <= every


def test_fold_sums_drop_pairs_that_no_target_uses(spark):
    """Items 1 and 2 are rated together by one user, so each fold that trains the pair has no target for it."""
    rows = [(n, u, i, 3) for n, (u, i) in enumerate([(1, 1), (1, 2), (2, 3), (2, 4), (3, 3), (3, 4), (4, 3), (4, 4)])]
    got = fold_pair_sums(spark.createDataFrame(rows, "review_id long, uid long, iid long, stars int"), F.col("review_id") % K, K)
    assert {(r.i, r.j) for r in got.collect()} == {(3, 4)}


def test_cross_validation_equals_fits_per_fold(ratings):
    """Slope One and KNN of one call against sums of each training set."""
    train, test = indexing.train_sets_by_fold(ratings, K), indexing.test_sets_by_fold(ratings, K)
    got = cross_validate(ratings, {"slope_one": SlopeOne(), "knn": KNN(kind="basic", k=3, minSupport=2)}, K)
    rows = lambda df: sorted((r.cv_fold, r.stars or 0, round(r.est, 9)) for r in df.collect())
    by = ["cv_fold"]
    assert rows(got.where("model = 'slope_one'")) == rows(slope_one_predict(train, test, pair_sums(train, by=by), by=by))
    alone = KNN(kind="basic", k=3, minSupport=2, folds=by).fit(train).transform(test)
    assert rows(got.where("model = 'knn'")) == rows(alone)


def test_tasks_grow_with_the_products(spark):
    """Groups and tasks were bounded by 50 million products each, whatever the cluster: a task's aggregate held all of them."""
    users = spark.range(1000).select(F.lit(500).cast("long").alias("deg"))  # 250 million
    blocks, tasks = plan_user_blocks(users)
    assert tasks == -(-1000 * 500 ** 2 // WORK_PER_TASK) and blocks >= 2 * tasks
    assert plan_tasks(0, 8) == plan_tasks(None, 8) == 1 and plan_tasks(WORK_PER_TASK, 8) == 8


def test_groups_keep_their_tasks(spark):
    """The cells are small, but adaptive execution does not put the groups of many tasks in one."""
    rows = spark.range(300 * 200).select((F.col("id") % 300).alias("uid"), F.floor(F.col("id") / 300).alias("iid"), F.lit(3).alias("stars"))
    plan = pair_sums(rows)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
