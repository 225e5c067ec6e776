"""Fits inside tasks against the DataFrame rounds, on rows of their own."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recspark.operators import baselines as bl
from recspark.operators import rating_blocks as rb
from recspark.operators.coclustering import fit_coclustering
from recspark.operators.sides import RatingSides

ROUNDS = {"broadcast_bytes": 1 << 25}  # asks for the rounds
FITS = {"als": lambda rows, by, **x: dict(zip(("mu", "bu", "bi"), bl.baseline_als(rows, 5.0, 10.0, 6, by=by, **x))),
        "coclustering": lambda rows, by, **x: fit_coclustering(rows, 3, 4, 5, by=by, **x)}


def ratings(spark):
    rows = [(f, u, (u * 7 + k * k) % 40 - 3, 1 + (u * u + k + f) % 5) for f in range(3) for u in range(40) for k in range(2 + u % 9) if (u + k) % 3 != f]
    return spark.createDataFrame(rows + rows[:30], "f int, uid int, iid long, stars int")  # some ratings come twice


def table_of(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("by", [(), ("f",)])
@pytest.mark.parametrize("fit", FITS)
def test_a_fit_in_a_task_is_the_fit_by_rounds(spark, monkeypatch, fit, by):
    rows = ratings(spark)
    expected = FITS[fit](rows, by, **ROUNDS)
    monkeypatch.setattr(RatingSides, "__init__", lambda *a, **k: pytest.fail("models that fit into a task need no rounds"))
    found = FITS[fit](rows, by)
    for name, table in expected.items():
        assert sorted(found[name].dtypes) == sorted(table.dtypes), name
        got, want = table_of(found[name]), table_of(table)
        assert len(got) == len(want) and np.allclose(np.array(got, float), np.array(want, float), rtol=0, atol=1e-10), name


@pytest.mark.parametrize("fit", FITS)
def test_rounds_for_large_models_and_missing_values(spark, monkeypatch, fit):
    calls, real = [], RatingSides.__init__
    monkeypatch.setattr(RatingSides, "__init__", lambda self, *a, **k: calls.append(1) or real(self, *a, **k))
    rows = ratings(spark)
    FITS[fit](rows.where("f = 0"), ())
    assert not calls
    monkeypatch.setattr(rb, "BLOCK_ROWS", 20)
    FITS[fit](rows.where("f = 0"), ())
    assert len(calls) == 1
    monkeypatch.setattr(rb, "BLOCK_ROWS", 1000)
    nameless = rows.where("f = 0").withColumn("f", F.when(F.col("uid") > 3, F.col("f")))
    FITS[fit](nameless, ("f",))
    assert len(calls) == 2


@pytest.mark.parametrize("values", [5, 1000])
def test_blocks_keep_every_rating(monkeypatch, values):
    """Users and new items that cross chunks, and values that outgrow a byte."""
    monkeypatch.setattr(rb, "CHUNK", 64)
    rng = np.random.default_rng(values)
    uid = np.sort(rng.integers(0, 30, 1000)) * 11 - 7
    iid, r = rng.integers(-50, 50, 1000) * 3, np.sort(rng.integers(0, values, 1000)) / 8
    pdf = pd.DataFrame({"uid": uid, "iid": iid, "r": r})
    b = rb._Block(iter([pdf[:10], pdf[10:10], pdf[10:400], pdf[400:]]))
    back = [(u, b.iids[i], x) for users, n, idx, rated in b.chunks() for u, i, x in zip(np.repeat(b.uids[users], n), idx, rated)]
    assert back == list(zip(uid, iid, r))
    assert dict(zip(b.uids, b.n_u)) == pdf.groupby("uid").size().to_dict()
    assert dict(zip(b.iids, b.n_i)) == pdf.groupby("iid").size().to_dict()
    assert (b.values is None) == (values > 256)


def test_no_task_fits_two_of_a_few_models(spark):
    rows = spark.createDataFrame([(f, u, u % 3, 1.0) for f in range(5) for u in range(4)], "f int, uid long, iid long, r double")
    tasks = rb.block_plan(rows, ["f"], "r")
    dealt = rows.repartition(tasks, "f").select("f", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(dealt) == len({r["task"] for r in dealt}) == 5 and tasks <= 40
    assert rb.block_plan(rows, [], "r") == 1
