"""Hand-computed 4 users x 4 items (FIXTURES §E).

u1: i1=5 i2=3 i3=4          item i3 has zero variance (all 4)
u2: i1=3 i1=4 i2=1 i3=4     (u2, i1) is repeated
u3: i2=2 i3=4 i4=5          (i2, i4), (i3, i4) have one common user; (i1, i4) none
null user rates i1=2; u4 has no ratings.
"""

import math

import pytest
from pyspark.sql import functions as F

from recspark.operators import baselines as bl
from recspark.operators.coclustering import fit_coclustering, predict_coclustering
from recspark.operators.predictors import knn_predict, slope_one_predict
from recspark.operators.recommend import mean_similarity, recommend
from recspark.operators.similarity import mirror, pair_sums, residuals, similarity

ROWS = [(1, 1, 1, 5), (2, 1, 2, 3), (3, 1, 3, 4),
        (4, 2, 1, 3), (5, 2, 1, 4), (6, 2, 2, 1), (7, 2, 3, 4),
        (8, 3, 2, 2), (9, 3, 3, 4), (10, 3, 4, 5),
        (11, None, 1, 2)]

SUMS = {  # (i, j): n, sx, sy, sxx, syy, sxy
    (1, 2): (3, 12, 5, 50, 11, 22),
    (1, 3): (3, 12, 12, 50, 48, 48),
    (2, 3): (3, 6, 12, 14, 48, 24),
    (2, 4): (1, 2, 5, 4, 25, 10),
    (3, 4): (1, 4, 5, 16, 25, 20),
}


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame(ROWS, "review_id long, uid long, iid long, stars int")


def _sums(grid, **kw):
    out = {}
    for r in pair_sums(grid, **kw).collect():
        out[(r.i, r.j)] = (r.n, r.sx, r.sy, r.sxx, r.syy, r.sxy)
    return out


def test_pair_sums_by_hand(grid):
    assert _sums(grid) == SUMS


@pytest.mark.parametrize("users,heavy", [(1, 2048), (3, 2048), (2, 2), (5, 1)])
def test_pair_sums_independent_of_blocking(grid, users, heavy):
    # heavy=1 or 2: every user is "heavy" and split into per-user item blocks
    assert _sums(grid, n_user_blocks=users, heavy_cells=heavy) == SUMS


def test_pair_sums_small_chunks(grid):
    assert _sums(grid, n_user_blocks=1, max_pairs_per_chunk=1) == SUMS
    assert _sums(grid, n_user_blocks=1, heavy_cells=2, max_pairs_per_chunk=1) == SUMS


def _sim(grid, metric, min_support=1):
    return {(r.i, r.j): r.sim for r in similarity(pair_sums(grid), metric, min_support).collect()}


def test_cosine(grid):
    s = _sim(grid, "cosine")
    assert s[(1, 2)] == pytest.approx(22 / math.sqrt(50 * 11))
    assert s[(2, 4)] == pytest.approx(1.0)          # n = 1: cosine is always 1
    assert (1, 4) not in s                          # no common user: absent == 0
    assert _sim(grid, "cosine", 2).keys() == {(1, 2), (1, 3), (2, 3)}


def test_msd(grid):
    assert _sim(grid, "msd")[(1, 2)] == pytest.approx(1 / ((50 + 11 - 44) / 3 + 1))


def test_pearson(grid):
    s = _sim(grid, "pearson")
    assert s[(1, 2)] == pytest.approx((3 * 22 - 12 * 5) / math.sqrt((150 - 144) * (33 - 25)))
    assert s[(1, 3)] == 0.0                          # zero-variance item


def test_baseline_als_one_epoch(grid):
    mu, bu, bi = bl.baseline_als(grid, reg_i=1, reg_u=2, n_epochs=1)
    assert mu.first().mu == pytest.approx(3.5)       # null user row left out
    b_i = {r.iid: r.bi for r in bi.collect()}
    b_u = {r.uid: r.bu for r in bu.collect()}
    assert b_i == pytest.approx({1: 0.375, 2: -1.125, 3: 0.375, 4: 0.75})
    assert b_u == pytest.approx({1: 0.375, 2: -2.0 / 6, 3: 0.1})


def test_knn_basic(grid, spark):
    train = grid.where(F.col("uid").isNotNull())
    test = spark.createDataFrame([(99, 3, 1, 3), (98, 4, 1, 3)], "review_id long, uid long, iid long, stars int")
    sims = mirror(similarity(pair_sums(train), "cosine", 1), train)
    got = {r.uid: (r.est, r.actual_k) for r in knn_predict(train, test, sims, "basic", k=2).collect()}
    a, b = 48 / math.sqrt(50 * 48), 22 / math.sqrt(50 * 11)
    assert got[3][0] == pytest.approx((a * 4 + b * 2) / (a + b))
    assert got[3][1] == 2
    assert got[4][0] == pytest.approx(35 / 10)       # unknown user -> global mean


def _asked(spark):
    return spark.createDataFrame([(99, 2, 4, 3)], "review_id long, uid long, iid long, stars int")


def test_baseline_gd_two_epochs(grid):
    mu, bu, bi = bl.baseline_gd(grid, lr=0.1, reg=0.5, n_epochs=2)
    assert {r.uid: r.bu for r in bu.collect()} == pytest.approx({1: 0.2475, 2: -0.28, 3: 0.0925})
    assert {r.iid: r.bi for r in bi.collect()} == pytest.approx({1: 0.2575, 2: -0.6975, 3: 0.2325, 4: 0.2725})


def test_knn_means_zscore_and_baseline(grid, spark):
    """User 2 and item 4: neighbours i2 (rated 1) and i3 (rated 4), both with similarity 1."""
    train = grid.where(F.col("uid").isNotNull())
    sims = mirror(similarity(pair_sums(train), "cosine", 1), train)
    model = bl.baseline_als(train, reg_i=1, reg_u=2, n_epochs=1)
    est = lambda kind: knn_predict(train, _asked(spark), sims, kind, k=5, baselines=model).first().est
    assert est("means") == pytest.approx(5 + ((1 - 2) + (4 - 4)) / 2)
    # i2 has the spread sqrt(2/3); those of i3 and i4 are 0, so the global one stands in
    assert est("zscore") == pytest.approx(5 + math.sqrt(1.45) * (-1 / math.sqrt(2 / 3) + 0) / 2)
    b = lambda i: 3.5 - 1 / 3 + {2: -1.125, 3: 0.375, 4: 0.75}[i]
    assert est("baseline") == pytest.approx(b(4) + ((1 - b(2)) + (4 - b(3))) / 2) == pytest.approx(3.625)


def test_pearson_baseline(grid):
    train = grid.where(F.col("uid").isNotNull())
    res = residuals(train, bl.baseline_als(train, reg_i=1, reg_u=2, n_epochs=1))
    got = {(r.i, r.j): r.sim for r in similarity(pair_sums(res, value="res", integer_sums=False), "pearson_baseline", 1, 100).collect()}
    x, y = (0.75, -13 / 24, 11 / 24), (0.25, -25 / 24, -25 / 24)  # items 1 and 2: user 1, user 2 twice
    cos = sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))
    assert got[(1, 2)] == pytest.approx(cos * 2 / 102)
    assert got[(2, 4)] == 0.0  # one common user: shrunk to nothing


def test_coclustering_by_hand(grid, spark):
    train = grid.where(F.col("uid").isNotNull())
    one = fit_coclustering(train, 1, 1, 2)
    assert predict_coclustering(_asked(spark), one).first().est == pytest.approx(3 + 5 - 3.5)
    two = fit_coclustering(train, 2, 2, 0)  # clusters are id mod 2: user 2 with items 2 and 4 has the one rating 1
    assert predict_coclustering(_asked(spark), two).first().est == pytest.approx(1 + (3 - 3) + (5 - 11 / 4))


def test_slope_one(grid, spark):
    train = grid.where(F.col("uid").isNotNull())
    test = spark.createDataFrame([(99, 3, 1, 3)], "review_id long, uid long, iid long, stars int")
    est = slope_one_predict(train, test, pair_sums(train)).first().est
    assert est == pytest.approx(min(5.0, 11 / 3 + (7 / 3 + 0) / 2))


def test_mean_similarity_and_recommend(grid, spark):
    train = grid.where(F.col("uid").isNotNull())
    sims = mirror(similarity(pair_sums(train), "cosine", 1), train)
    picks = spark.createDataFrame([(1, 1)], "request_id long, iid long")
    scores = {r.iid: r.score for r in mean_similarity(sims, picks).collect()}
    assert scores[1] == 1.0 and 4 not in scores
    items = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 0), (4, "d", 1)],
                                  "iid long, name string, is_open int")
    reqs = spark.createDataFrame([(1, "a")], "request_id long, name string")
    top = recommend(mean_similarity(sims, picks), items, reqs, n=3).orderBy("rank").collect()
    # picked name and closed item left out; item 4 has no stored pair and fills up with score 0
    assert [(r.iid, r.score > 0) for r in top] == [(2, True), (4, False)]
    served = recommend(mean_similarity(sims, picks), items, reqs, n=3, mode="pick_then_filter").orderBy("rank").collect()
    assert [r.iid for r in served] == [2, 4]


def test_recommend_fills_with_unscored_items(spark):
    """Fewer positive scores than n, negative scores below the unscored items, several items of one picked name."""
    items = spark.createDataFrame([(k, f"n{k % 7}", int(k % 5 != 0)) for k in range(30)], "iid long, name string, is_open int")
    scores = spark.createDataFrame([(1, 3, 0.5), (1, 4, -0.2), (1, 6, 0.0), (2, 29, 0.9), (2, 28, 0.8), (2, 27, 0.7)],
                                   "request_id long, iid long, score double")
    reqs = spark.createDataFrame([(1, "n1"), (1, "n2"), (2, "n0")], "request_id long, name string")
    have = {(r.request_id, r.iid): r.score for r in scores.collect()}
    for n in (3, 8, 40):
        got = {}
        for r in recommend(scores, items, reqs, n).orderBy("request_id", "rank").collect():
            got.setdefault(r.request_id, []).append((r.iid, r.score))
        for q, barred in ((1, ("n1", "n2")), (2, ("n0",))):
            ranked = sorted((-have.get((q, k), 0.0), k) for k in range(30) if k % 5 and f"n{k % 7}" not in barred)[:n]
            assert got[q] == [(k, -s) for s, k in ranked]
