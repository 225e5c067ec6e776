"""Planted taste groups (FIXTURES §D): neighbour and factor models must beat the
normal predictor clearly on held-out pairs.  The fixture ratings are random,
so model quality is only judged here."""

import random

import pytest
from pyspark.sql import functions as F

from recspark.operators import baselines as bl
from recspark.operators.evaluate import rmse
from recspark.operators.factor import fit_nmf_als, fit_svd_als, predict_nmf_als, predict_svd_als
from recspark.operators.predictors import knn_predict, slope_one_predict
from recspark.operators.coclustering import fit_coclustering, predict_coclustering
from recspark.operators.similarity import mirror, pair_sums, similarity


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    g, users, items = 3, 90, 45
    rows, rid = [], 0
    for u in range(users):
        for i in range(items):
            if rng.random() < 0.45:
                same = (u % g) == (i % g)
                star = 5 if same else rng.choice((1, 2))
                if rng.random() < 0.05:
                    star = rng.randint(1, 5)
                rid += 1
                rows.append((rid, u, i, star))
    df = spark.createDataFrame(rows, "review_id long, uid long, iid long, stars int")
    test = df.where(F.col("review_id") % 10 == 0)
    train = df.where(F.col("review_id") % 10 != 0)
    return train, test


def _rmse(p):
    return rmse(p).first().rmse


def test_models_beat_normal(planted):
    train, test = planted
    naive = _rmse(bl.predict_normal(test, bl.normal_params(train), seed=3))
    base = bl.baseline_als(train, 5, 10, 10)
    sims = mirror(similarity(pair_sums(train), "pearson", 3), train)
    knn = _rmse(knn_predict(train, test, sims, "baseline", 20, 1, baselines=base))
    means = _rmse(knn_predict(train, test, sims, "means", 20, 1))
    slope = _rmse(slope_one_predict(train, test, pair_sums(train)))
    svd = _rmse(predict_svd_als(test, fit_svd_als(train, base, rank=5, max_iter=10, reg=0.05, seed=1), base))
    nmf = _rmse(predict_nmf_als(test, fit_nmf_als(train, rank=5, max_iter=15, reg=0.05, seed=1),
                                bl.global_mean(train)))
    cocl = _rmse(predict_coclustering(test, fit_coclustering(train, 3, 3, 10)))
    for name, v in (("knn_baseline", knn), ("knn_means", means), ("slope_one", slope), ("svd_als", svd),
                    ("nmf_als", nmf), ("coclustering", cocl)):
        assert v < 0.6 * naive, (name, v, naive)


def test_als_recommendations_follow_taste_groups(planted):
    from recspark.operators.factor import recommend_for_users_als
    train, _ = planted
    model = fit_nmf_als(train, rank=5, max_iter=15, reg=0.05, seed=1)
    recs = recommend_for_users_als(model, 3)
    rows = recs.collect()
    assert {r.rank for r in rows} == {1, 2, 3}
    in_group = sum((r.uid % 3) == (r.iid % 3) for r in rows) / len(rows)
    assert in_group > 0.9, in_group


def test_als_lists_equal_brute_force_over_blocks(spark, planted):
    """Many small blocks, users with every number of rated items, one that has rated all: the lists of a plain product."""
    import numpy as np
    from recspark.operators import factor
    train, _ = planted
    model = factor.fit_nmf_als(train, rank=5, max_iter=4, reg=0.05, seed=1)
    users, items = ({r.id: np.array(r.features, np.float32) for r in df.collect()} for df in (model.userFactors, model.itemFactors))
    full = min(users)
    rated = train.select("uid", "iid").unionByName(spark.createDataFrame([(full, i) for i in items], "uid long, iid long"))
    seen = {}
    for r in rated.collect():
        seen.setdefault(r.uid, set()).add(r.iid)
    for own, barred in ((rated, seen), (None, {})):
        got = {}
        for r in factor.recommend_for_users_als(model, 4, own, lo=-99.0, hi=99.0, users_per_block=7, items_per_block=5).collect():
            got.setdefault(r.uid, []).append((r.rank, r.iid, r.score))
        want = {}
        for u, p in users.items():
            free = [i for i in sorted(items) if i not in barred.get(u, ())]
            raw = factor._dots(np.tile(p, (len(free), 1)), np.array([items[i] for i in free], np.float32).reshape(len(free), -1)) if free else []
            best = sorted(zip([-float(x) for x in raw], free))[:4]
            if best:
                want[u] = [(k + 1, i, -x) for k, (x, i) in enumerate(best)]
        assert {u: sorted(v) for u, v in got.items()} == want
        assert (full in got) == (own is None)
    listed = {(r.id, x.iid): x.rating for r in model.recommendForAllUsers(4).withColumnRenamed("uid", "id").collect() for x in r.recommendations}
    mine = {(u, i): s for u, v in got.items() for _, i, s in v}
    assert np.allclose([mine[k] for k in listed if k in mine], [v for k, v in listed.items() if k in mine], rtol=1e-6) and len(mine.keys() & listed.keys()) > 0.99 * len(mine)


def test_als_lists_send_few_rows_per_user():
    """Rated items drop out before the best are taken, so the rows a task sends on do not grow with the ratings."""
    import numpy as np
    from recspark.operators.factor import _BestItems
    rng = np.random.default_rng(3)
    items, users = rng.random((3000, 6), np.float32), rng.random((2, 6), np.float32)
    best = _BestItems(np.array([4, 9], np.int32), users, np.arange(10, 3000, dtype=np.int32), np.array([2990, 0]), 3)
    for lo in range(0, 3000, 700):
        best.meet(np.arange(lo, min(lo + 700, 3000), dtype=np.int32), items[lo:lo + 700])
    rows = best.batch().to_pydict()
    assert rows["uid"] == [4] * 3 + [9] * 3
    assert rows["iid"][:3] == np.argsort(-(items[:10] @ users[0]))[:3].tolist()
    assert rows["iid"][3:] == np.argsort(-(items @ users[1]))[:3].tolist()
