"""Bias and cluster fits inside tasks that hold a model's ratings as numpy arrays.

A fit by DataFrame rounds (``operators.sides``) pays several Spark stages per round and a hash lookup per rating and half round.
Here the ratings of a model (a value of the ``by`` columns) go once to the task that fits it, in order of their users, which keeps them
in chunks: counts of the users, 32-bit numbers of the items, a byte per rating where there are no more than 256 different ones.
A half round is then a gather and a sum over arrays.  That is done while a model has at most ``BLOCK_ROWS`` ratings (counted), a third of
it with more different ones, which bounds a task's memory: 5 bytes a rating (12 with more different ones) and some 40 a user and an
item.  :func:`block_plan` says None beyond that, for ids that are no integers and for missing keys or values; the caller then
takes its DataFrame rounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize

BLOCK_ROWS, BYTE_VALUES = 64_000_000, 256
CHUNK, FEW_MODELS = 1 << 20, 64
WHOLE = ("tinyint", "smallint", "int", "bigint")


def block_plan(rows: DataFrame, by, value: str) -> int | None:
    """The number of tasks to deal the models to if each model can be fitted by one task, else None."""
    by, kinds = list(by), dict(rows.dtypes)
    if any(kinds[c] not in WHOLE for c in ("uid", "iid")):
        return None
    odd = F.max(F.greatest(*[F.col(c).isNull().cast("int") for c in (*by, "uid", "iid", value)], F.isnan(value).cast("int")))
    users = rows.groupBy(*by, "uid").agg(F.count(F.lit(1)).alias("n"), odd.alias("odd"))
    place = F.hash(*by) if by else F.lit(0)
    models = materialize(users.groupBy(*by).agg(F.sum("n").alias("n"), F.max("odd").alias("odd")).select("n", "odd", place.alias("place")), "model-sizes")
    seen = models.agg(F.max("n").alias("n"), F.max("odd").alias("odd"), F.count(F.lit(1)).alias("models")).first()  # one row
    if not seen["n"] or seen["odd"] or seen["n"] > BLOCK_ROWS:
        return None
    if seen["n"] > BLOCK_ROWS // 3 and rows.select(*by, value).distinct().groupBy(*by).count().where(F.col("count") > BYTE_VALUES).count():
        return None
    return _tasks([r["place"] for r in models.collect()]) if seen["models"] <= FEW_MODELS else 4 * FEW_MODELS


def _tasks(places: list[int]) -> int:
    """The number of tasks, up to eight a model, at which hash partitioning puts the fewest models into one."""
    most = lambda n: max(Counter(x % n for x in places).values())
    return min(range(len(places), 8 * len(places) + 1), key=lambda n: (most(n), n))


class _Chunk(NamedTuple):
    """Ratings of the users from number ``start`` on, some of each (``counts``): items' numbers and values (or their bytes)."""

    start: int
    counts: np.ndarray
    idx: np.ndarray
    r: np.ndarray


class _Codes:
    """Numbers of ids in order of appearance."""

    def __init__(self):
        self.known, self.number = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def of(self, ids: np.ndarray) -> np.ndarray:
        distinct = np.unique(ids)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = distinct[self.known[at] != distinct] if len(self.known) else distinct
        if len(new):
            both = np.concatenate([self.known, new])
            order = np.argsort(both, kind="stable")
            self.number = np.concatenate([self.number, np.arange(len(self.known), len(both), dtype=np.int32)])[order]
            self.known = both[order]
        return self.number[np.searchsorted(self.known, ids)]

    def ids(self) -> np.ndarray:
        """The ids by number."""
        out = np.empty_like(self.known)
        out[self.number] = self.known
        return out


class _Block:
    """The ratings of a model: ``uids``, ``iids`` by number, how many ratings each has (``n_u``, ``n_i``) and the ratings in chunks."""

    def __init__(self, batches: Iterator[pd.DataFrame]):
        self.key, self._chunks, self._items, self.values = None, [], _Codes(), np.zeros(0)
        uids, held, rows, users, last = [], [], 0, 0, None
        for pdf in batches:
            if len(pdf):
                self.key = pdf.iloc[:1] if self.key is None else self.key
                held.append([pdf[c].to_numpy(t) for c, t in (("uid", np.int64), ("iid", np.int64), ("r", np.float64))])
                rows += len(pdf)
            if rows >= CHUNK:
                last, users = self._add(held, uids, last, users)
                held, rows = [], 0
        if rows:
            self._add(held, uids, last, users)
        self.uids, self.iids = (np.concatenate(uids), self._items.ids()) if uids else (np.zeros(0, np.int64),) * 2
        self._items = None
        self.n_u, self.n_i = np.zeros(len(self.uids), np.int32), np.zeros(len(self.iids), np.int32)
        for c in self._chunks:
            self.n_u[c.start:c.start + len(c.counts)] += c.counts
            self.n_i += np.bincount(c.idx, minlength=len(self.iids)).astype(np.int32)

    def _add(self, held: list, uids: list, last, users: int):
        u, i, r = (np.concatenate(x) for x in zip(*held))
        first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        own = u[first]
        if (own[1:] < own[:-1]).any() or last is not None and own[0] < last:
            raise ValueError("the ratings of a model are not in order of their users")
        goes_on = last is not None and own[0] == last
        uids.append(own[1:] if goes_on else own)
        counts = np.diff(np.append(first, len(u))).astype(np.int32)
        self._chunks.append(_Chunk(users - goes_on, counts, self._items.of(i), self._packed(r)))
        return own[-1], users + len(uids[-1])

    def _packed(self, r: np.ndarray) -> np.ndarray:
        if self.values is None:
            return r
        distinct = np.union1d(self.values, r)
        if len(distinct) > BYTE_VALUES or np.isnan(distinct).any():
            for at, c in enumerate(self._chunks):
                self._chunks[at] = c._replace(r=self.values[c.r])
            self.values = None
            return r
        if len(distinct) > len(self.values):
            place = np.searchsorted(distinct, self.values).astype(np.uint8)
            for at, c in enumerate(self._chunks):
                self._chunks[at] = c._replace(r=place[c.r])
            self.values = distinct
        return np.searchsorted(self.values, r).astype(np.uint8)

    def chunks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(users, their counts, items' numbers, ratings) of every chunk; a user may go on in the next one."""
        for c in self._chunks:
            yield slice(c.start, c.start + len(c.counts)), c.counts, c.idx, c.r if self.values is None else self.values[c.r]


def _item_sums(b: _Block, bu: np.ndarray) -> np.ndarray:
    """Per item the sum of r - b_u."""
    total = np.zeros(len(b.iids))
    for users, counts, idx, r in b.chunks():
        total += np.bincount(idx, r - np.repeat(bu[users], counts), len(total))
    return total


def _per_user(counts: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, np.cumsum(counts) - counts)


def _user_sums(b: _Block, bi: np.ndarray) -> np.ndarray:
    """Per user the sum of r - b_i."""
    total = np.zeros(len(b.uids))
    for users, counts, idx, r in b.chunks():
        total[users] += _per_user(counts, r - bi[idx])
    return total


def _frames(b: _Block, by, parts: list[dict]) -> Iterator[pd.DataFrame]:
    for columns in parts:
        size = max(len(x) for x in columns.values() if isinstance(x, np.ndarray))
        for lo in range(0, size, CHUNK):
            out = pd.DataFrame({c: x[lo:lo + CHUNK] if isinstance(x, np.ndarray) else x for c, x in columns.items()})
            for c in reversed(by):
                out.insert(0, c, b.key[c].iat[0])
            yield out


def _als_kernel(by, reg_i: float, reg_u: float, epochs: int):
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = _Block(batches)
        bu = np.zeros(len(b.uids))
        for _ in range(epochs):
            bi = _item_sums(b, bu) / (reg_i + b.n_i)
            bu = _user_sums(b, bi) / (reg_u + b.n_u)
        yield from _frames(b, by, [{"side": 0, "id": b.uids, "bias": bu}, {"side": 1, "id": b.iids, "bias": bi}])

    kernel.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return kernel


def _by_schema(df: DataFrame, by) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in by)


def _per_model(rows: DataFrame, by, tasks: int, kernel, schema: str) -> DataFrame:
    """``kernel`` over every model's rows in order of the users."""
    schema = _by_schema(rows, by) + schema
    if not by:
        return rows.repartition(1).sortWithinPartitions("uid").mapInPandas(kernel, schema)
    return rows.repartition(tasks, *by).sortWithinPartitions(*by, "uid").groupBy(*by).applyInPandas(kernel, schema)


def als_in_blocks(rows: DataFrame, by, tasks: int, reg_i: float, reg_u: float, epochs: int) -> tuple[DataFrame, DataFrame]:
    """(bu, bi) of ``baselines.baseline_als`` from rows (by.., uid, iid, r) with r less the mean."""
    by = list(by)
    kernel = _als_kernel(by, reg_i, reg_u, epochs)
    found = materialize(_per_model(rows, by, tasks, kernel, "side int, id bigint, bias double"), "biases")
    side = lambda at, key, name: found.where(F.col("side") == at).select(*by, F.col("id").cast(rows.schema[key].dataType).alias(key), F.col("bias").alias(name))
    return side(0, "uid", "bu"), side(1, "iid", "bi")


# ---- co-clustering ----

def _stats(keys: np.ndarray, size: int, r, y) -> np.ndarray:
    return np.stack([np.bincount(keys, minlength=size).astype(np.float64), *(np.bincount(keys, w, size) for w in (r, y, y * y))])


def _nearest(stats: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The cluster of least squared error per row of ``stats`` (n, sr, s, q per key and other cluster); ``d``: cluster x other cluster."""
    n, _, s, q = stats
    error = q.sum(axis=1)[:, None] - 2 * s @ d.T + n @ (d * d).T
    return np.round(error, 9).argmin(axis=1)  # the first of equal ones


class _Clusters:
    """Co-clustering of a block (see ``operators.coclustering``)."""

    def __init__(self, b: _Block, n_u: int, n_i: int):
        self.b, self.n_u, self.n_i = b, n_u, n_i
        per_user, per_item = _user_sums(b, np.zeros(len(b.iids))), _item_sums(b, np.zeros(len(b.uids)))
        self.mean_u, self.mean_i, self.mu = per_user / b.n_u, per_item / b.n_i, per_user.sum() / b.n_u.sum()
        self.cu, self.ci = b.uids % n_u, b.iids % n_i

    def _sums(self, of_users: bool) -> np.ndarray:
        """(4, users, item clusters) or (4, items, user clusters)."""
        b = self.b
        own, other = (len(b.uids), self.n_i) if of_users else (len(b.iids), self.n_u)
        total = np.zeros((4, own * other))
        for users, n, idx, r in b.chunks():
            y = r - np.repeat(self.mean_u[users], n) - self.mean_i[idx]
            if of_users:
                size = (users.stop - users.start) * other
                keys = np.repeat(np.arange(users.stop - users.start) * other, n) + self.ci[idx]
                total[:, users.start * other:users.start * other + size] += _stats(keys, size, r, y)
            else:
                total += _stats(idx.astype(np.int64) * other + np.repeat(self.cu[users], n), own * other, r, y)
        return total.reshape(4, own, other)

    def _averages(self, stats: np.ndarray):
        n, s = (np.stack([np.bincount(self.cu, x[:, c], self.n_u) for c in range(self.n_i)], axis=1) for x in stats[:2])
        mean = lambda s, n: np.where(n > 0, s / np.maximum(n, 1), self.mu)
        return mean(s, n), mean(s.sum(axis=1), n.sum(axis=1)), mean(s.sum(axis=0), n.sum(axis=0))

    def fit(self, epochs: int):
        for _ in range(epochs):
            stats = self._sums(True)
            ac, au, ai = self._averages(stats)
            d = ac - au[:, None] - ai[None, :]
            self.cu = _nearest(stats, d)
            self.ci = _nearest(self._sums(False), d.T)
        return self._averages(self._sums(True))


def _cluster_kernel(by, n_u: int, n_i: int, epochs: int):
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = _Block(batches)
        c = _Clusters(b, n_u, n_i)
        ac, au, ai = c.fit(epochs)
        cu, ci = (x.reshape(-1) for x in np.mgrid[:n_u, :n_i])
        empty = {"ac": 0.0, "au": 0.0, "ai": 0.0}
        yield from _frames(b, by, [{"side": 0, "id": b.uids, "cluster": c.cu, **empty}, {"side": 1, "id": b.iids, "cluster": c.ci, **empty},
                                   {"side": 2, "id": cu, "cluster": ci, "ac": ac[cu, ci], "au": au[cu], "ai": ai[ci]}])

    kernel.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return kernel


def clusters_in_blocks(rows: DataFrame, by, tasks: int, n_u: int, n_i: int, epochs: int) -> dict[str, DataFrame]:
    """cu, ci and avgs of ``coclustering.fit_coclustering`` from rows (by.., uid, iid, r)."""
    by = list(by)
    schema = "side int, id bigint, cluster int, ac double, au double, ai double"
    found = materialize(_per_model(rows, by, tasks, _cluster_kernel(by, n_u, n_i, epochs), schema), "clusters")
    side = lambda at, key, name: found.where(F.col("side") == at).select(*by, F.col("id").cast(rows.schema[key].dataType).alias(key), F.col("cluster").alias(name))
    avgs = found.where("side = 2").select(*by, F.col("id").cast("int").alias("cu"), F.col("cluster").alias("ci"), "ac", "au", "ai")
    return {"cu": side(0, "uid", "cu"), "ci": side(1, "iid", "ci"), "avgs": avgs}


from recspark.functions.shipping import ship_by_value  # noqa: E402

ship_by_value(__name__)  # the fits run on executors
