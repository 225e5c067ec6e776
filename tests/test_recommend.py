"""Request tables with few, negative and zero scores against a ranking of every item."""

import random

import pytest

from recspark.operators.recommend import recommend


def brute(scores, items, requests, n, mode):
    out = []
    for q in sorted({q for q, _, _ in scores}):
        names = {name for r, name in requests if r == q and name is not None}
        mine = {i: s for r, i, s in scores if r == q}
        ranked = sorted((-round(mine.get(i, 0.0), 9), i, name, is_open) for i, name, is_open in items)
        wanted = [x for x in ranked if x[2] not in names and x[3] == 1]
        if mode == "filter_then_pick":
            got = list(enumerate(wanted[:n], 1))
        else:
            got = [(k, x) for k, x in enumerate(ranked[:n + 2], 1) if x in wanted]
        out += [(q, k, i, name, -s) for k, (s, i, name, _) in got]
    return out


@pytest.mark.parametrize("mode", ["filter_then_pick", "pick_then_filter"])
@pytest.mark.parametrize("n", [1, 3, 7])
def test_every_item_is_ranked(spark, mode, n):
    rng = random.Random(n)
    items = [(i, rng.choice([None, "a", "b", "c", "d", f"own {i}"]), rng.choice([0, 1, 1])) for i in rng.sample(range(1000), 30)]
    requests = [(q, rng.choice(["a", "b", "c", None, "nowhere"])) for q in range(40) for _ in range(rng.randint(1, 3))]
    scores = []
    for q in range(40):  # some requests score nothing, some everything, some the smallest ids
        some = sorted(items)[:rng.randint(1, 12)] if q % 3 == 0 else rng.sample(items, [0, 2, 29, 30][q % 4])
        scores += [(q, i, rng.choice([-0.5, -0.25, 0.0, 1e-12, 0.25, 0.5])) for i, _, _ in some]
    got = recommend(spark.createDataFrame(scores, "request_id long, iid long, score double"),
                    spark.createDataFrame(items, "iid long, name string, is_open int"),
                    spark.createDataFrame(requests, "request_id long, name string"), n, mode)
    rows = sorted((r.request_id, r.rank, r.iid, r.name, round(r.score, 9)) for r in got.collect())
    assert rows == sorted(brute(scores, items, requests, n, mode))


def test_requests_longer_than_the_items(spark):
    items = [(1, "a", 1), (2, "b", 1)]
    got = recommend(spark.createDataFrame([(7, 1, 0.5)], "request_id long, iid long, score double"),
                    spark.createDataFrame(items, "iid long, name string, is_open int"),
                    spark.createDataFrame([(7, "a")], "request_id long, name string"), 5)
    assert [(r.rank, r.iid, r.score) for r in got.collect()] == [(1, 2, 0.0)]
