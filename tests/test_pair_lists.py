"""Packed partial sums: exact in every layout, a few bytes per product, and the pairs of an item with much work in several tasks."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recspark.operators import similarity
from recspark.operators.pair_lists import SUMS, PairAdder, pack_lists
from recspark.operators.similarity import _make_kernel, cross_pair_sums, pair_sums, pair_sum_updates, rating_cells

COLS = ("i", "j", "n", "sx", "sy", "sxx", "syy", "sxy")


@pytest.mark.parametrize("values", ["stars", "bytes", "numbers", "counts", "mixed"])
@pytest.mark.parametrize("span", [50, 1 << 40, 1 << 62])
def test_every_layout_is_exact(values, span):
    rng = np.random.default_rng(3)
    m = 2000
    i = rng.integers(0, 90, m) * (span // 50) - span // 2
    sums = {"i": i, "j": i + rng.integers(1, span, m), "n": np.ones(m)}
    x, y = rng.normal(size=(2, m)) if values == "numbers" else rng.integers(1, 6 if values != "bytes" else 200, (2, m)).astype(float)
    sums |= {"sx": x, "sy": y, "sxx": x * x, "syy": y * y, "sxy": x * y}
    if values in ("counts", "mixed"):
        sums["n"] = 1 + (rng.random(m) < 0.3) * (1000.0 if values == "counts" else 1e9)
    pairs = pd.DataFrame(sums).drop_duplicates(["i", "j"])
    hot = np.unique(i)[:5]
    adder = PairAdder()
    lists = pack_lists({c: pairs[c].to_numpy() for c in pairs}, (hot, np.full(5, 3)))
    assert set(lists.loc[lists["i"].isin(hot), "part"]) == {0, 1, 2} and not lists.loc[~lists["i"].isin(hot), "part"].any()
    adder.add([(v,) for v in lists["i"].tolist()], lists["data"].tolist())
    key, j, _, six = adder.result()
    got = pd.DataFrame({"i": np.array([k[0] for k in adder.keys])[key], "j": j, **dict(zip(SUMS, six))})
    order = ["i", "j"]
    pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), pairs[list(COLS)].sort_values(order, ignore_index=True))


def test_a_product_leaves_its_group_in_a_few_bytes():
    """Sixty items per user, nearly every product the only one of its pair: rows of eight numbers took 64 bytes each."""
    rng = np.random.default_rng(0)
    users, items = 200, 60
    cells = pd.DataFrame({"lo": 0, "hi": 0, "blk": 0, "u": np.repeat(np.arange(users), items), "salt": 1,
                          "it": np.concatenate([rng.choice(1_000_000, items, replace=False) for _ in range(users)]), "c": 1})
    cells["s"] = rng.integers(1, 6, len(cells)).astype(float)
    cells["q"] = cells["s"] ** 2
    rows = pd.concat(_make_kernel([], 500_000, packed=True)(iter([cells])))
    products = users * items * (items - 1) // 2
    assert len(rows) <= users * items and rows["data"].map(len).sum() < 6 * products


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(8)
    rows = [(u, rng.randrange(30) if k else 0, rng.randrange(1, 6)) for u in range(60) for k in range(rng.randrange(1, 9))]
    return spark.createDataFrame([*rows, (3, 0, 2), (3, 0, 5), (None, 1, 1), (4, None, 1), (5, 1, None)], "uid long, iid long, stars int")


def _self_join(a, b):
    a, b = (rating_cells(x).toPandas() for x in (a, b))
    m = a.merge(b, on="uid", suffixes=("", "_b")).query("iid < iid_b")
    m = m.assign(n=m.c * m.c_b, sx=m.s * m.c_b, sy=m.c * m.s_b, sxx=m.q * m.c_b, syy=m.c * m.q_b, sxy=m.s * m.s_b)
    return m.groupby(["iid", "iid_b"])[list(COLS[2:])].sum().astype(int)


def _rows(sums):
    got = [tuple(r) for r in sums.select(*COLS).collect()]
    assert len(got) == len({r[:2] for r in got})
    return {r[:2]: r[2:] for r in got}


def test_items_with_much_work_are_dealt_to_several_tasks(spark, ratings, monkeypatch):
    monkeypatch.setattr(similarity, "WORK_PER_TASK", 60)  # item 0 is in every user's list
    hot = []
    real = similarity.hot_items
    monkeypatch.setattr(similarity, "hot_items", lambda *a: hot.append(real(*a)) or hot[-1])
    want = _self_join(ratings, ratings)
    assert _rows(pair_sums(ratings)) == {k: tuple(r) for k, r in zip(want.index, want.itertuples(index=False))}
    assert {r["it"]: r["salt"] > 1 for r in hot[0].collect()}[0]


def test_updates_are_the_new_products_and_those_with_old_cells(ratings, monkeypatch):
    monkeypatch.setattr(similarity, "WORK_PER_TASK", 60)
    part = F.pmod(F.xxhash64("uid", "iid"), F.lit(3)) == 0
    old, new = ratings.where(~part), ratings.where(part)
    whole, before = _rows(pair_sums(ratings)), _rows(pair_sums(old))
    delta = _rows(pair_sum_updates(rating_cells(new), rating_cells(old)))
    # repeated ratings of a cell are in one part, so the sums add up
    add = lambda a, b: tuple(x + y for x, y in zip(a, b))
    assert whole == {k: add(before.get(k, (0,) * 6), delta.get(k, (0,) * 6)) for k in before.keys() | delta.keys()}
    assert _rows(cross_pair_sums(rating_cells(new), rating_cells(old))).keys() <= delta.keys()
