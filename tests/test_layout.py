"""Fits without moving the ratings, candidate joins sized by their yield, exact known-user lists."""

import collections
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from recspark.operators import baselines as bl
from recspark.operators import candidates
from recspark.operators.candidates import blocked_join, candidate_rows
from recspark.operators.coclustering import fit_coclustering
from recspark.operators.predictors import first_others, knn_recommend_for_users
from recspark.operators.sides import RatingSides
from recspark.operators.similarity import pair_sums, similarity

RATINGS = "review_id long, uid long, iid long, stars int"


def table(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], RATINGS)


def hot_rows(seed=1, n=500):
    """A user and an item that hold a third of the rows each."""
    rng = random.Random(seed)
    return [(0 if rng.random() < 0.33 else rng.randrange(1, 40), 0 if rng.random() < 0.33 else rng.randrange(1, 30), rng.randint(1, 5)) for _ in range(n)]


def near(a, b, cols):
    key = lambda df: {tuple(r[c] for c in cols[:-1]): r[cols[-1]] for r in df.collect()}
    x, y = key(a), key(b)
    assert x.keys() == y.keys() and all(abs(x[k] - y[k]) < 1e-9 for k in x)


BIG = {"broadcast_bytes": 0, "heavy_rows": 20}  # as if the bias tables were too large to broadcast


@pytest.mark.parametrize("fit", [lambda r, **k: bl.baseline_als(r, 5.0, 10.0, 4, **k), lambda r, **k: bl.baseline_gd(r, n_epochs=4, **k)])
def test_bucketed_fits_equal_broadcast_fits(spark, fit):
    ratings = table(spark, hot_rows())
    small, big = fit(ratings), fit(ratings, **BIG)
    near(small[1], big[1], ("uid", "bu"))
    near(small[2], big[2], ("iid", "bi"))


def test_bucketed_clusters_equal_broadcast_clusters(spark):
    ratings = table(spark, hot_rows(2))
    small, big = fit_coclustering(ratings, 3, 3, 4), fit_coclustering(ratings, 3, 3, 4, **BIG)
    for name, cols in (("cu", ("uid", "cu")), ("ci", ("iid", "ci")), ("avgs", ("cu", "ci", "ac"))):
        near(small[name], big[name], cols)


def test_no_epoch_exchanges_rating_rows(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ratings = table(spark, hot_rows(3)).withColumn("r", F.col("stars").cast("double"))
        sides = RatingSides(ratings, **BIG)
        assert not sides.small and sides.parts["uid"].agg(F.max("parts")).first()[0] > 3
        for side, key in ((sides.with_users, "uid"), (sides.with_items, "iid")):
            bias = ratings.select(key).distinct().withColumn("b", F.lit(1.0))
            df = side(bias)
            assert df.count() == ratings.count()
            plan = df._jdf.queryExecution().executedPlan().toString()
            plan = plan.split("== Initial Plan ==")[0]
            scan = [k for k, line in enumerate(plan.splitlines()) if f"ratings_by_{key}" in line]
            lines = plan.splitlines()
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            assert scan
            level, above = depth(lines[scan[0]]), []
            for line in reversed(lines[:scan[0]]):  # the scan's ancestors
                if depth(line) < level:
                    above.append(line)
                    level = depth(line)
            assert any("SortMergeJoin" in x for x in above)
            joined = next(k for k, x in enumerate(above) if "SortMergeJoin" in x)
            assert not any("Exchange" in x for x in above[:joined]), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rounds_take_as_many_tasks_as_the_ratings_ask_for(spark):
    """A round's tasks follow the ratings, not the session's partitions, and a lookup meets one row per key and part."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        rows = hot_rows(5)
        sides = RatingSides(table(spark, rows).withColumn("r", F.col("stars").cast("double")), **BIG)
        for side, key, at in ((sides.with_users, "uid", 0), (sides.with_items, "iid", 1)):
            bias = sides.rows.select(key).distinct().withColumn("b", F.col(key) * 2.0)
            df = side(bias)
            assert df.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
            got = collections.Counter((r.review_id, r.uid, r.iid, r.stars, r.r, r.b) for r in df.collect())
            assert got == collections.Counter((k, *x, float(x[2]), x[at] * 2.0) for k, x in enumerate(rows))
            sizes = collections.Counter(x[at] for x in rows)
            assert len(sizes) < sides.copies[key].count() <= sum(-(-n // BIG["heavy_rows"]) for n in sizes.values()) < len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


# ---- candidate joins ----

def test_blocked_join_equals_plain_join_and_splits_the_hot_key(spark):
    rng = random.Random(4)
    left = [(0 if rng.random() < 0.4 else rng.randrange(1, 20), k) for k in range(300)] + [(None, -1), (5, 7), (5, 7)]
    right = [(0 if rng.random() < 0.4 else rng.randrange(1, 25), k) for k in range(300)]
    a, b = spark.createDataFrame(left, "key long, x long"), spark.createDataFrame(right, "key long, y long")
    rows = lambda df: collections.Counter(tuple(r) for r in df.select("key", "x", "y").collect())
    plain = rows(a.join(b, ["key"]))
    for side in (8, 4096):
        got = blocked_join(a, b, ["key"], side=side)
        assert set(got.columns) == {"key", "x", "y"} and rows(got) == plain
    # the most that one pair of blocks yields
    keyed = blocked_join(a, b, ["key"], side=8)._jdf.queryExecution().optimizedPlan().toString()
    assert "_nl_at" in keyed and "_nr_at" in keyed


@pytest.mark.parametrize("side", [4, 2048])
def test_candidates_take_the_shorter_way(spark, monkeypatch, side):
    rng = random.Random(6)
    lists = {(i, j) for i in range(30) for j in range(30) if i != j and (i == 0 or rng.random() < 0.2)}  # item 0: a long list
    rated = {(u, j) for u in range(40) for j in range(30) if u == 0 or rng.random() < 0.1}  # user 0 has rated everything
    targets = {(u, i) for u in range(45) for i in range(35) if i == 0 or rng.random() < 0.15}
    dfs = [spark.createDataFrame(sorted(x), c) for x, c in ((targets, "uid long, iid long"), (lists, "iid long, j long"), (rated, "uid long, j long"))]
    dfs[1], dfs[2] = dfs[1].withColumn("sim", F.lit(0.5)), dfs[2].withColumn("r_j", F.lit(3))
    made, plain = [], candidates.blocked_join

    def counted(left, right, keys, side_):
        made.append(left.join(right, keys).count())
        return plain(left, right, keys, side_)

    monkeypatch.setattr(candidates, "blocked_join", counted)
    got = sorted((r.uid, r.iid, r.j) for r in candidate_rows(*dfs, side=side).collect())
    assert got == sorted((u, i, j) for u, i in targets for i2, j in lists if i == i2 and (u, j) in rated)
    length, degree = collections.Counter(i for i, _ in lists), collections.Counter(u for u, _ in rated)
    least = sum(min(length[i], degree[u]) for u, i in targets if length[i] and degree[u])
    assert len(made) == 2 and sum(made) == least < sum(length[i] for u, i in targets if degree[u])


# ---- known users ----

def brute_top(rows, k, min_k, n, mu, bu, bi, sims):
    items, rated = sorted({i for _, i, _ in rows}), collections.defaultdict(list)
    for rid, (u, i, r) in enumerate(rows):
        rated[u].append((i, r, rid))
    out = []
    for u, mine in rated.items():
        have, scores = {i for i, *_ in mine}, []
        for i in items:
            if i in have:
                continue
            nb = sorted((-round(sims[i, j][0], 9), -sims[i, j][1], j, rid, r) for j, r, rid in mine if sims.get((i, j), (0,))[0] > 0)[:k]
            s = sum(sims[i, x[2]][0] for x in nb)
            dev = sum(sims[i, x[2]][0] * (x[4] - (mu + bu[u] + bi[x[2]])) for x in nb) / s if len(nb) >= min_k and s > 0 else 0.0
            scores.append((-round(bi[i] + dev, 9), i, min(5.0, max(1.0, mu + bu[u] + bi[i] + dev)), len(nb)))
        out += [(u, i, round(e, 7), a, p + 1) for p, (_, i, e, a) in enumerate(sorted(scores)[:n])]
    return sorted(out)


@pytest.mark.parametrize("items, n", [(30, 3), (80, 2), (6, 4)])
def test_known_user_lists_rank_every_unrated_item(spark, items, n):
    rng = random.Random(items)
    rows = [(u, i, rng.randint(1, 5)) for u in range(14) for i in range(items) if rng.random() < (0.9 if u == 0 else 0.12)]
    rows += [(u, 0, 5) for u in range(5)]
    ratings = table(spark, rows)
    model = bl.baseline_als(ratings, 5.0, 10.0, 5)
    sims = similarity(pair_sums(ratings), "pearson", 3)
    mu, bu, bi = model[0].first().mu, {r.uid: r.bu for r in model[1].collect()}, {r.iid: r.bi for r in model[2].collect()}
    known = {}
    for r in sims.collect():
        known[r.i, r.j] = known[r.j, r.i] = (r.sim, r.n)
    got = knn_recommend_for_users(ratings, sims, model, 4, 2, n)
    got = sorted((r.uid, r.iid, round(r.est, 7), r.actual_k, r["rank"]) for r in got.collect())
    assert got == brute_top(rows, 4, 2, n, mu, bu, bi, known)
    assert collections.Counter(r[0] for r in got) == {u: min(n, len({x[1] for x in rows}) - len({x[1] for x in rows if x[0] == u}))
                                                      for u in {x[0] for x in rows} if len({x[1] for x in rows}) > len({x[1] for x in rows if x[0] == u})}


def test_others_beyond_the_head_of_the_list(spark):
    """A user who has rated the whole head of the list still gets the next items."""
    items = spark.createDataFrame([(i, 1.0 - (i // 3) / 100) for i in range(200)], "iid long, gain double")
    rated = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 5)], "uid long, iid long")
    scored = spark.createDataFrame([(1, i) for i in range(100, 150)] + [(2, 0), (2, 1)], "uid long, iid long")
    got = sorted((r.uid, r.iid) for r in first_others(items, rated, scored, 3).collect())
    assert got == [(1, 150), (1, 151), (1, 152), (2, 2), (2, 3), (2, 4)]


@pytest.mark.parametrize("fit", ["coclustering", "als", "gd"])
def test_rounds_that_shuffle_leave_no_shuffle_files(spark, monkeypatch, fit):
    """When a round begins, the shuffle files of the rounds before are deleted."""
    seen, real = [], RatingSides.with_items

    def files():
        time.sleep(2)  # they are deleted in the background
        return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()

    monkeypatch.setattr(RatingSides, "with_items", lambda self, *a: seen.append(files()) or real(self, *a))
    rows = spark.createDataFrame([(u, (u * 7 + k) % 40, 1 + (u + k) % 5) for u in range(60) for k in range(8)], "uid long, iid long, stars int")
    run = {"coclustering": lambda: fit_coclustering(rows, n_epochs=5, broadcast_bytes=0),
           "als": lambda: bl.baseline_als(rows, n_epochs=5, broadcast_bytes=0),
           "gd": lambda: bl.baseline_gd(rows, n_epochs=5, broadcast_bytes=0)}[fit]
    run()
    assert len(seen) >= 4 and seen[-1] <= seen[1] + 20, seen
