"""Baseline estimates b_ui = mu + b_u + b_i and the normal predictor.

Iterations are DataFrame rounds: each half step looks up the other side's
biases at the ratings and takes a grouped sum (partial aggregation map-side).
The ratings are laid out once (``operators.sides``) and stay where they are in
every epoch.  Bias tables (one row per user / item) are cut from their lineage
every few epochs by writing them into the shared checkpoint folder
(``session.materialize``; every epoch where the rounds shuffle, whose files are then released), so the plan size stays constant and a lost executor
costs a few epochs at most.

``by`` columns (e.g. a cross-validation fold) fit independent models in
the same job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize

from recspark.functions.exprs import clip, std_normal
from recspark.operators.rating_blocks import als_in_blocks, block_plan
from recspark.operators.sides import RatingSides
from recspark.operators.similarity import attach_mean


def _prep(ratings: DataFrame, value: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    r = ratings.select(*by, "uid", "iid", F.col(value).cast("double").alias("r")) \
               .where(F.col("r").isNotNull() & F.col("uid").isNotNull() & F.col("iid").isNotNull())
    mu = r.groupBy(*by).agg(F.avg("r").alias("mu"))
    return r, mu


def global_mean(ratings: DataFrame, value: str = "stars", by=()) -> DataFrame:
    return _prep(ratings, value, list(by))[1]


def baseline_als(ratings: DataFrame, reg_i: float = 10.0, reg_u: float = 15.0, n_epochs: int = 10,
                 value: str = "stars", by=(), checkpoint_every: int = 5, **layout):
    """Alternating least squares for the biases: items first, then users.

    b_i = sum(r - mu - b_u) / (reg_i + n_i);  b_u = sum(r - mu - b_i) / (reg_u + n_u)
    Returns (mu, bu, bi) DataFrames: (by.., mu), (by.., uid, bu), (by.., iid, bi).
    A model of few enough ratings is fitted by one task (``operators.rating_blocks``); ``layout`` asks for the rounds.
    """
    by = list(by)
    r, mu = _prep(ratings, value, by)
    mu = materialize(mu)
    tasks = block_plan(r, by, "r") if n_epochs and not layout else None
    if tasks:
        centred = attach_mean(r, mu, by).select(*by, "uid", "iid", (F.col("r") - F.col("mu")).alias("r"))
        return mu, *als_in_blocks(centred, by, tasks, reg_i, reg_u, n_epochs)
    sides = RatingSides(attach_mean(r, mu, by), by, **layout)
    bu = bi = None
    for epoch in range(1, n_epochs + 1):
        x = sides.rows.withColumn("bu", F.lit(0.0)) if bu is None else sides.with_users(bu)
        bi = x.groupBy(*by, "iid").agg(
            (F.sum(F.col("r") - F.col("mu") - F.col("bu")) / (F.lit(float(reg_i)) + F.count(F.lit(1)))).alias("bi"))
        if epoch == n_epochs:
            bi = materialize(bi)  # before b_u is built on it, so the item side runs once
            sides.end_round()
        bu = sides.with_items(bi).groupBy(*by, "uid").agg(
            (F.sum(F.col("r") - F.col("mu") - F.col("bi")) / (F.lit(float(reg_u)) + F.count(F.lit(1)))).alias("bu"))
        if epoch == n_epochs or not sides.small or checkpoint_every and epoch % checkpoint_every == 0:
            bu = materialize(bu)  # the next epoch needs only b_u
            sides.end_round()
    if bu is None:  # zero epochs: all biases 0
        bu = r.select(*by, "uid").distinct().withColumn("bu", F.lit(0.0))
        bi = r.select(*by, "iid").distinct().withColumn("bi", F.lit(0.0))
    return mu, bu, bi


def baseline_gd(ratings: DataFrame, lr: float = 0.005, reg: float = 0.02, n_epochs: int = 20,
                value: str = "stars", by=(), **layout):
    """Batch gradient descent on the regularised squared error of mu + b_u + b_i.

    One epoch adds, for every user, lr * (sum of errors - reg * n_u * b_u)
    (and the same for items) with all errors taken from the previous
    epoch: the order-free counterpart of one sequential SGD sweep.  A user's sum of errors is
    sum(r - mu - b_i) - n_u * b_u, so each gradient needs the other side's biases at the ratings and no more.
    """
    by = list(by)
    r, mu = _prep(ratings, value, by)
    mu = materialize(mu)
    sides = RatingSides(attach_mean(r, mu, by), by, **layout)
    bu = r.select(*by, "uid").distinct().withColumn("bu", F.lit(0.0))
    bi = r.select(*by, "iid").distinct().withColumn("bi", F.lit(0.0))

    def step(x: DataFrame, theirs: str, own: DataFrame, key: str, mine: str) -> DataFrame:
        g = x.groupBy(*by, key).agg(F.sum(F.col("r") - F.col("mu") - F.col(theirs)).alias("g"), F.count(F.lit(1)).alias("n")).join(own, by + [key])
        error = F.col("g") - F.col("n") * F.col(mine)
        return g.select(*by, key, (F.col(mine) + F.lit(lr) * (error - F.lit(reg) * F.col("n") * F.col(mine))).alias(mine))

    for epoch in range(n_epochs):
        users = sides.with_items(bi) if epoch else sides.rows.withColumn("bi", F.lit(0.0))
        items = sides.with_users(bu) if epoch else sides.rows.withColumn("bu", F.lit(0.0))
        bu, bi = (materialize(step(users, "bi", bu, "uid", "bu"), "bu"), materialize(step(items, "bu", bi, "iid", "bi"), "bi"))
        sides.end_round()
    return mu, bu, bi


def predict_baseline(test: DataFrame, model, by=(), lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """test rows + est = clip(mu + b_u + b_i); unknown user/item contributes 0."""
    from recspark.operators.similarity import attach_baseline
    mu, bu, bi = model
    out = attach_baseline(test, mu, bu, bi, by=list(by))
    return out.withColumn("est", clip(F.col("b_ui"), lo, hi)).drop("mu", "bu", "bi", "b_ui")


def normal_params(train: DataFrame, value: str = "stars", by=()) -> DataFrame:
    """(by.., mu, sigma): mean and population standard deviation of the training ratings."""
    v = F.col(value).cast("double")
    return train.groupBy(*by).agg(F.avg(v).alias("mu"), F.stddev_pop(v).alias("sigma"))


def predict_normal(test: DataFrame, params: DataFrame, seed: int = 0, key: str = "review_id", by=(),
                   lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """est = clip(mu + sigma * z), z standard normal from a seeded, portable hash of ``key``."""
    by = list(by)
    p = params.select(*by, "mu", "sigma")
    if by:
        out = test.join(F.broadcast(p), by, "inner")
    else:
        out = test.withColumn("mu", p.select("mu").scalar()).withColumn("sigma", p.select("sigma").scalar())
    est = F.col("mu") + F.col("sigma") * std_normal(F.col(key), seed)
    return out.withColumn("est", clip(est, lo, hi)).drop("mu", "sigma")
