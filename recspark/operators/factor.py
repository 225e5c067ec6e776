"""Matrix factorization predictors on Spark ML's block ALS.

* ``svd_als``: the biased factor model mu + b_u + b_i + q_i . p_u
  (Koren, Bell, Volinsky 2009).  The biases come from the baseline
  ALS; the factors are fitted by ``ml.recommendation.ALS`` on the
  residuals r - b_ui.  Same model as SGD-trained SVD, different solver:
  numbers are not expected to equal an SGD fit.
* ``nmf_als``: non-negative factors q_i . p_u >= 0 (``nonnegative=True``).

ALS needs user and item ids in the 32-bit integer range; factorize ids
first (``indexing.factorize``) when they are not.  ALS checkpoints its
factor lineage into the session's checkpoint folder in every round: that
is also when it deletes the shuffle files of the round, which hold every
factor once per block that needs it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.functions.exprs import clip
from recspark.operators.similarity import attach_baseline, residuals
from recspark.session import checkpoint_dir, materialize


def _als(rating_col: str, rank: int, max_iter: int, reg: float, nonnegative: bool, seed: int,
         blocks: int | None, spark: SparkSession) -> ALS:
    als = ALS(userCol="uid", itemCol="iid", ratingCol=rating_col, rank=rank, maxIter=max_iter,
              regParam=reg, nonnegative=nonnegative, implicitPrefs=False, coldStartStrategy="nan",
              seed=seed, checkpointInterval=1)
    # as many blocks as the cluster has tasks at a time, not Spark's fixed ten
    blocks = blocks or max(10, spark.sparkContext.defaultParallelism)
    return als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)


def fit_svd_als(train: DataFrame, baselines, rank: int = 20, max_iter: int = 10, reg: float = 0.05,
                seed: int = 0, blocks: int | None = None, value: str = "stars"):
    checkpoint_dir(train.sparkSession)
    res = residuals(train, baselines, value=value).select(
        F.col("uid").cast("int").alias("uid"), F.col("iid").cast("int").alias("iid"), "res")
    return _als("res", rank, max_iter, reg, False, seed, blocks, train.sparkSession).fit(res)


def predict_svd_als(test: DataFrame, model, baselines) -> DataFrame:
    mu, bu, bi = baselines
    t = attach_baseline(test, mu, bu, bi)
    scored = model.transform(t.withColumn("uid", F.col("uid").cast("int")).withColumn("iid", F.col("iid").cast("int")))
    dot = F.when(F.isnan("prediction"), F.lit(0.0)).otherwise(F.col("prediction"))
    return scored.withColumn("est", clip(F.col("b_ui") + dot, 1.0, 5.0)) \
                 .drop("prediction", "mu", "bu", "bi", "b_ui")


def fit_nmf_als(train: DataFrame, rank: int = 15, max_iter: int = 10, reg: float = 0.06, seed: int = 0,
                blocks: int | None = None, value: str = "stars"):
    checkpoint_dir(train.sparkSession)
    r = train.select(F.col("uid").cast("int").alias("uid"), F.col("iid").cast("int").alias("iid"),
                     F.col(value).cast("float").alias("r"))
    return _als("r", rank, max_iter, reg, True, seed, blocks, train.sparkSession).fit(r)


def predict_nmf_als(test: DataFrame, model, fallback: DataFrame) -> DataFrame:
    """est = q_i . p_u; unknown user or item -> the global mean in ``fallback`` (one row, column mu)."""
    scored = model.transform(test.withColumn("uid", F.col("uid").cast("int")).withColumn("iid", F.col("iid").cast("int")))
    mu = fallback.select("mu").scalar()
    est = F.when(F.isnan("prediction"), mu).otherwise(F.col("prediction").cast("double"))
    return scored.withColumn("est", clip(est, 1.0, 5.0)).drop("prediction")


def recommend_for_users_als(model, n: int = 10, rated: DataFrame | None = None, lo: float = 1.0, hi: float = 5.0,
                            users_per_block: int = 2048, items_per_block: int = 8192) -> DataFrame:
    """(uid, rank, iid, score) top n items per user that the user has not rated, from a fitted ALS model.

    Every user is scored against every item, block by block as in ``recommendForAllUsers``: blocks of users meet blocks of items
    in a cross join, and a task multiplies their factors.  Here a block of users carries its rated items, which drop out before
    the n best are taken, and keeps the n best so far from one block of items to the next, so that a task sends on n rows per
    user instead of n and the number of rated items per pair of blocks.
    Scores are ranked as predicted (ties: smaller iid) and then clipped to the scale.
    """
    users, items = (materialize(df.select("id", "features"), "als-factors") for df in (model.userFactors, model.itemFactors))
    if rated is None:
        users = users.withColumn("rated", F.array().cast("array<int>"))
    else:
        mine = (rated.where(F.col("uid").isNotNull() & F.col("iid").isNotNull()).groupBy(F.col("uid").cast("int").alias("id"))
                .agg(F.collect_set(F.col("iid").cast("int")).alias("rated")))
        users = users.join(mine, "id", "left").withColumn("rated", F.coalesce("rated", F.array().cast("array<int>")))
    n_users, n_items = model.userFactors.count(), model.itemFactors.count()
    spread = min(4 * users.sparkSession.sparkContext.defaultParallelism, math.ceil(n_users / 64))  # small tables: a block for every core
    user_blocks = materialize(_factor_blocks(users, max(1, spread, math.ceil(n_users / users_per_block)), "u", "rated"), "als-users")
    item_blocks = materialize(_factor_blocks(items, max(1, math.ceil(n_items / items_per_block)), "i"), "als-items")
    pairs = user_blocks.hint("shuffle_replicate_nl").crossJoin(item_blocks)  # a block of users meets its blocks of items in a row
    found = pairs.mapInArrow(_best_kernel(n), "uid int, iid int, raw double")
    order = Window.partitionBy("uid").orderBy(F.col("raw").desc(), F.col("iid"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            .select("uid", "rank", F.col("iid").cast("long").alias("iid"), clip(F.col("raw"), lo, hi).alias("score")))


def _factor_blocks(factors: DataFrame, blocks: int, name: str, listed: str | None = None) -> DataFrame:
    """One row per block of ids: its ids and factors in flat lists, with a list column its entries and their numbers per id."""
    cols = ["id", "features", *([listed] if listed else [])]
    rows = (factors.repartition(blocks, F.pmod(F.xxhash64("id"), F.lit(blocks))).groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
            .agg(F.collect_list(F.struct(*cols)).alias("rows")))
    flat = [F.col("rows.id").alias(f"{name}_ids"), F.flatten("rows.features").alias(f"{name}_factors")]
    if listed:
        flat += [F.flatten(f"rows.{listed}").alias(f"{name}_listed"), F.transform(f"rows.{listed}", F.size).alias(f"{name}_sizes")]
    return rows.select(F.col("block").alias(f"{name}_block"), *flat)


def _dots(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise dot products, added factor by factor in single precision, as those of ALS's own lists are."""
    total = np.zeros(len(p), np.float32)
    for f in range(p.shape[1]):
        total += p[:, f] * q[:, f]
    return total


class _BestItems:
    """The n best items so far of a block of users."""

    def __init__(self, ids, factors, rated, sizes, n: int):
        self.n, self.ids, self.factors = n, ids, factors
        self.norms = np.sqrt((factors.astype(np.float64) ** 2).sum(axis=1))
        self.rated_row, self.rated = np.repeat(np.arange(len(ids)), sizes), rated
        self.least = np.full(len(ids), -np.inf)  # the n-th best score so far
        self.row, self.iid, self.raw = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)

    def meet(self, iids: np.ndarray, factors: np.ndarray, step: int = 2048) -> None:
        norms = np.sqrt((factors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-norms, kind="stable")
        iids, factors, norms = iids[order], factors[order], norms[order]
        by_id = np.argsort(iids)
        at = np.minimum(np.searchsorted(iids, self.rated, sorter=by_id), len(iids) - 1)
        hit = iids[by_id[at]] == self.rated
        barred_row, barred_at = self.rated_row[hit], by_id[at[hit]]
        for lo in range(0, len(iids), step):
            # no score is above the product of the norms; products in single precision are off by less than a hundred thousandth of it
            bound = self.norms * norms[lo]
            live = np.flatnonzero(bound * 1.00001 >= self.least)
            if not len(live):
                return  # the norms fall
            part = factors[lo:lo + step]
            scores = self.factors[live] @ part.T
            place = np.full(len(self.ids), -1)
            place[live] = np.arange(len(live))
            inside = (barred_at >= lo) & (barred_at < lo + step) & (place[barred_row] >= 0)
            scores[place[barred_row[inside]], barred_at[inside] - lo] = -np.inf
            least, slack = self.least[live], 1e-5 * bound[live]
            if len(part) > self.n and np.isneginf(least).any():
                least = np.maximum(least, np.partition(scores, -self.n, axis=1)[:, -self.n] - slack)
            enough = scores >= np.maximum(least - slack, np.finfo(np.float32).min).astype(np.float32)[:, None]
            r, c = np.divmod(np.flatnonzero(enough), len(part))
            self._keep(live[r], iids[lo + c], _dots(self.factors[live[r]], part[c]))

    def _keep(self, row, iid, raw) -> None:
        row, iid, raw = np.concatenate([self.row, row]), np.concatenate([self.iid, iid]), np.concatenate([self.raw, raw])
        order = np.lexsort((iid, -raw, row))
        row, iid, raw = row[order], iid[order], raw[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        self.least[row[rank == self.n - 1]] = raw[rank == self.n - 1]
        keep = rank < self.n
        self.row, self.iid, self.raw = row[keep], iid[keep], raw[keep]

    def batch(self):
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row], pa.int32()), pa.array(self.iid, pa.int32()), pa.array(self.raw, pa.float64())],
                                          names=["uid", "iid", "raw"])


def _best_kernel(n: int):
    def kernel(batches):
        flat = lambda batch, name, at: batch.column(name)[at].values.to_numpy(zero_copy_only=False)
        last, best = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                iids = flat(batch, "i_ids", at)
                block = batch.column("u_block")[at].as_py()
                if block != last:
                    if best is not None:
                        yield best.batch()
                    ids = flat(batch, "u_ids", at)
                    best = _BestItems(ids, flat(batch, "u_factors", at).reshape(len(ids), -1), flat(batch, "u_listed", at), flat(batch, "u_sizes", at), n)
                    last = block
                best.meet(iids, flat(batch, "i_factors", at).reshape(len(iids), -1))
        if best is not None:
            yield best.batch()

    return kernel


def save_model(model, path: str) -> str:
    """Persist a fitted ALS model (factor tables as parquet) to shared storage."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


from recspark.functions.shipping import ship_by_value  # noqa: E402

ship_by_value(__name__)  # the kernel of the lists runs on executors
