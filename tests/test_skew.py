"""A hot key holding a third of all rows: exact results, work split across groups."""

import os
import random

import pandas as pd
from pyspark.sql import functions as F

from recspark.operators.similarity import pair_sums
from recspark.operators.trim import trim_users


def _brute_force(pdf: pd.DataFrame) -> dict:
    """Self-join on the user in pandas (the relational definition of the sums)."""
    m = pdf.merge(pdf, on="uid", suffixes=("_a", "_b"))
    m = m[m.iid_a < m.iid_b]
    g = m.assign(xy=m.stars_a * m.stars_b, xx=m.stars_a ** 2, yy=m.stars_b ** 2).groupby(["iid_a", "iid_b"])
    out = g.agg(n=("xy", "size"), sx=("stars_a", "sum"), sy=("stars_b", "sum"), sxx=("xx", "sum"),
                syy=("yy", "sum"), sxy=("xy", "sum"))
    return {k: tuple(int(v) for v in row) for k, row in zip(out.index, out.itertuples(index=False))}


def test_hot_user_pair_sums_exact(spark):
    rng = random.Random(11)
    rows, rid = [], 0
    for i in range(300):                 # the hot user rates every item, some twice
        for _ in range(1 + (i % 7 == 0)):
            rid += 1
            rows.append((rid, 0, i, rng.randint(1, 5)))
    for u in range(1, 120):              # light users
        for i in rng.sample(range(300), 5):
            rid += 1
            rows.append((rid, u, i, rng.randint(1, 5)))
    pdf = pd.DataFrame(rows, columns=["review_id", "uid", "iid", "stars"])
    assert (pdf.uid == 0).mean() > 0.3
    df = spark.createDataFrame(pdf)
    # heavy_cells=64: the hot user (300 cells) is split into 5 item blocks -> 15 groups
    got = {(r.i, r.j): (r.n, r.sx, r.sy, r.sxx, r.syy, r.sxy)
           for r in pair_sums(df, heavy_cells=64, max_pairs_per_chunk=5000).collect()}
    assert got == _brute_force(pdf)


def test_hot_user_trim_keeps_all_rows(spark):
    rows = [(k, 0, k % 50, 3) for k in range(3000)] + [(10000 + k, 1 + k // 3, k % 50, 4) for k in range(3000)]
    df = spark.createDataFrame(rows, "review_id long, uid long, iid long, stars int")
    kept = trim_users(df, 3)
    assert kept.count() == 6000
    assert kept.where(F.col("uid") == 0).count() == 3000


def test_pair_kernel_streams_in_bounded_memory():
    """20 users of 2,048 items (41 thousand cells, 42 million pairs) in one group: the worker holds a chunk, not the sums."""
    import subprocess
    import sys

    script = """
import resource, sys
sys.path.insert(0, {root!r})
import numpy as np, pandas as pd
from recspark.operators.similarity import _make_kernel
users, items = 20, 2048
rng = np.random.default_rng(0)
cells = pd.DataFrame({{"lo": 0, "hi": 0, "blk": 0, "u": np.repeat(np.arange(users), items),
                      "it": np.concatenate([rng.choice(20_000, items, replace=False) for _ in range(users)]),
                      "c": 1, "s": 3.0, "q": 9.0}})
n = sum(f["n"].sum() for f in _make_kernel([], 500_000)(iter([cells])))
print(int(n), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", script.format(root=root)], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    pairs, mb = map(int, out.stdout.split())
    assert pairs == 20 * 2048 * 2047 // 2 and mb < 1500


def test_rare_items_are_pruned_without_loss(spark):
    import random
    rng = random.Random(4)
    rows = [(k, rng.randrange(12), rng.randrange(40), rng.randint(1, 5)) for k in range(220)]
    rows += [(900 + k, 3, 77, 4) for k in range(3)] + [(950, 3, 78, 2)]  # one user, repeated ratings: n = 3 from a single rater
    df = spark.createDataFrame(rows, "review_id long, uid long, iid long, stars int")
    for least in (2, 3):
        full = {tuple(r) for r in pair_sums(df).where(F.col("n") >= least).collect()}
        pruned = {tuple(r) for r in pair_sums(df, min_support=least).where(F.col("n") >= least).collect()}
        assert full == pruned and any(r[0] == 77 for r in full)
