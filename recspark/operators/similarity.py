"""Co-rating sums and item-item / user-user similarities.

Pair sums
---------
For every item pair i < j the sums over users who rated both are

    n = #pairs, sx = sum x, sy = sum y, sxx = sum x^2, syy = sum y^2, sxy = sum x*y

(with repeated (user, item) ratings, every rating row of i pairs with every
rating row of j, as a relational self-join would count them).

A user self-join would emit every item pair inside each user's group (a
user with a third of all rows would make one task emit a third squared).
Instead the rating matrix is multiplied by blocks, the way a distributed
block matrix product works:

1. pre-aggregate ratings to cells (user, item) -> (c, sum, sum of squares)
   and count the cells of every user;
2. light users (<= h cells) are hashed into ``U`` user blocks and go whole
   into their block's group; a heavy user's items are hashed into
   ceil(cells / h) blocks of its own and every cell is sent to the block
   pairs (lo, hi) it takes part in (``explode`` of a sequence, no join);
3. each group is reduced inside its task with numpy, chunk by chunk: the
   products of a chunk are summed per item pair and these partial sums leave
   the task as a stream of packed lists, one per item (``operators.pair_lists``), so a worker
   holds one chunk, whatever the group yields;
4. the lists are dealt to tasks by their item, which add the partial sums of all groups.

A hot user is split over its own item blocks (pair work per group <= h^2),
a hot item over the user blocks, and its pairs over several adding tasks; light users are never replicated.
Group size and pair work are bounded by the choice of ``U`` from the users' degrees, and the groups are dealt to as
many tasks as their products ask for: the cells are small, so adaptive execution would put the work of many tasks in one.

:func:`fold_pair_sums` makes the sums of all cross-validation training sets in one such pass: cells carry their fold,
and a pair's products are dealt to the folds after the shuffle.

Similarities
------------
From the sums, with ``n >= min_support`` (absent pair == similarity 0):

* cosine  sxy / sqrt(sxx * syy)
* msd     1 / ((sxx + syy - 2 sxy) / n + 1)
* pearson (n sxy - sx sy) / sqrt((n sxx - sx^2)(n syy - sy^2)), 0 if the root is 0
* pearson_baseline: cosine of baseline residuals r - b_ui, shrunk by
  (n - 1) / (n - 1 + shrinkage)  (Koren, TKDD 2010)
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.pair_lists import LISTS, added_lists, pack_lists
from recspark.session import materialize

SUM_COLS = ("sx", "sy", "sxx", "syy", "sxy")
METRICS = ("cosine", "msd", "pearson", "pearson_baseline")
WORK_PER_TASK = 4_000_000  # sum of squared degrees: about two million products of cells


# ---------------------------------------------------------------- pair sums

def _block_pair_sums(a: pd.DataFrame, b: pd.DataFrame, same: bool, max_pairs: int, cross: bool = False, tags: int = 0):
    """Per-item-pair sums of one group, a frame per chunk of at most about ``max_pairs`` products.

    ``a``/``b`` hold cells (u, it, c, s, q), with a ``tag`` (0 to ``tags`` - 1) if there are any: then sums are made per pair
    and tags of both cells.  Nothing is kept between chunks: an item pair may come in
    several frames, the aggregate over all groups adds them.  ``same``: a is b, every pair counts once; ``cross``: a and b
    are two sets of cells that may share items.
    """
    if len(a) == 0 or len(b) == 0:
        return
    order = ["u", "it"] if same else ["u"]
    a = a.sort_values(order, kind="stable")
    b = a if same else b.sort_values(order, kind="stable")
    ua = a["u"].to_numpy(np.int64)
    ub = b["u"].to_numpy(np.int64)
    b_users, b_start, b_count = np.unique(ub, return_index=True, return_counts=True)
    pos = np.searchsorted(b_users, ua)
    pos_c = np.minimum(pos, len(b_users) - 1)
    hit = b_users[pos_c] == ua
    if not hit.any():
        return
    a_item_all, a_loc_all = np.unique(a["it"].to_numpy(np.int64), return_inverse=True)
    b_items, b_loc = np.unique(b["it"].to_numpy(np.int64), return_inverse=True)
    a_it = a_item_all[a_loc_all[hit]]
    b_it = b_items[b_loc]
    if tags:
        a_loc_all, b_loc = a_loc_all * tags + a["tag"].to_numpy(np.int64), b_loc * tags + b["tag"].to_numpy(np.int64)
    nb = len(b_items) * max(tags, 1)
    a_loc = a_loc_all[hit]
    ac = a["c"].to_numpy(np.float64)[hit]
    as_ = a["s"].to_numpy(np.float64)[hit]
    aq = a["q"].to_numpy(np.float64)[hit]
    bc = b["c"].to_numpy(np.float64)
    bs = b["s"].to_numpy(np.float64)
    bq = b["q"].to_numpy(np.float64)
    start = b_start[pos_c[hit]]
    cnt = b_count[pos_c[hit]]
    if same:  # a cell meets the later ones of its user only
        later = np.arange(len(ua)) + 1
        start, cnt = later, start + cnt - later

    cs = np.cumsum(cnt)
    m = len(cnt)
    lo = 0
    while lo < m:
        base = cs[lo - 1] if lo > 0 else 0
        hi = int(np.searchsorted(cs, base + max_pairs, side="right"))
        hi = min(max(hi, lo + 1), m)
        cnt_c = cnt[lo:hi]
        total = int(cnt_c.sum())
        rep = np.repeat(np.arange(lo, hi), cnt_c)
        first = np.cumsum(cnt_c) - cnt_c
        bidx = np.repeat(start[lo:hi], cnt_c) + (np.arange(total) - np.repeat(first, cnt_c))
        if same or cross:
            keep = a_it[rep] != b_it[bidx]  # a cell may come in several rows
            rep, bidx = rep[keep], bidx[keep]
        if len(rep):
            code = a_loc[rep].astype(np.int64) * nb + b_loc[bidx]
            uniq, inv = np.unique(code, return_inverse=True)
            k = len(uniq)
            w = {
                "n": ac[rep] * bc[bidx],
                "sx": as_[rep] * bc[bidx],
                "sy": ac[rep] * bs[bidx],
                "sxx": aq[rep] * bc[bidx],
                "syy": ac[rep] * bq[bidx],
                "sxy": as_[rep] * bs[bidx],
            }
            sums = {key: np.bincount(inv, weights=val, minlength=k) for key, val in w.items()}
            at, bt = uniq // nb, uniq % nb
            i, j = a_item_all[at // max(tags, 1)], b_items[bt // max(tags, 1)]
            swap = i > j
            tagged = {"ti": np.where(swap, bt % tags, at % tags), "tj": np.where(swap, at % tags, bt % tags)} if tags else {}
            yield {"i": np.where(swap, j, i), "j": np.where(swap, i, j), **tagged, "n": sums["n"],
                   "sx": np.where(swap, sums["sy"], sums["sx"]), "sy": np.where(swap, sums["sx"], sums["sy"]),
                   "sxx": np.where(swap, sums["syy"], sums["sxx"]), "syy": np.where(swap, sums["sxx"], sums["syy"]),
                   "sxy": sums["sxy"]}
        lo = hi


def _salts(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The group's items whose pairs go to several tasks, sorted, and to how many."""
    hot = pdf.loc[pdf["salt"] > 1, ["it", "salt"]].drop_duplicates("it").sort_values("it")
    return hot["it"].to_numpy(np.int64), hot["salt"].to_numpy(np.int64)


def _make_kernel(by: list[str], max_pairs: int, tags: int = 0, packed: bool = False):
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)  # the cells of a group, bounded by the planning
        lo = int(pdf["lo"].iat[0])
        hi = int(pdf["hi"].iat[0])
        if lo == hi:
            a = b = pdf
        else:
            blk = pdf["blk"].to_numpy()
            a, b = pdf[blk == lo], pdf[blk == hi]
        salts = _salts(pdf) if packed else None
        for res in _block_pair_sums(a, b, lo == hi, max_pairs, tags=tags):
            out = pack_lists(res, salts, tags) if packed else pd.DataFrame(res)
            for k in reversed(by):
                out.insert(0, k, pdf[k].iat[0])
            yield out

    # the types themselves, not their names: they select the streaming form of applyInPandas
    kernel.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return kernel


def plan_user_blocks(degrees: DataFrame, rows_per_group: int = 400_000, pairs_per_group: int = WORK_PER_TASK // 4,
                     heavy_cells: int = 2048) -> tuple[int, int]:
    """Number of light-user blocks and of tasks, from one aggregate row over the users' cell counts (column ``deg``).

    A group's work is the sum of deg^2 over its users, its memory the sum of deg: both are bounded on average.
    """
    d, light = F.col("deg").cast("double"), F.col("deg") <= heavy_cells
    seen = degrees.agg(F.sum(F.when(light, d)).alias("cells"), F.sum(F.when(light, d * d)).alias("pairs"), F.sum(d * d).alias("work")).first()
    par = degrees.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, 2 * par, math.ceil((seen["cells"] or 0) / rows_per_group), math.ceil((seen["pairs"] or 0) / pairs_per_group))
    return blocks, plan_tasks(seen["work"], par)


def plan_tasks(work: float | None, par: int) -> int:
    """Tasks of at most about ``WORK_PER_TASK`` each; small work is spread over the cluster's cores."""
    work = work or 0
    return max(1, math.ceil(work / WORK_PER_TASK), min(par, math.ceil(16 * work / WORK_PER_TASK)))


def prune_rare_items(cells: DataFrame, min_support: int, by: list[str], user: str, item: str) -> DataFrame:
    """Cells without the items that cannot be in a pair with n >= ``min_support`` (lossless).

    n of a pair is the sum over users of c_i * c_j, so it is at most the sum over i's users of
    c_i * (the user's largest c); items below that bound drop out before any pairing.
    """
    return cells.join(items_with_support(cells, min_support, by, user, item), by + [item], "left_semi")


def items_with_support(cells: DataFrame, min_support: int, by: list[str], user: str, item: str) -> DataFrame:
    """(by.., item): the items that can be in a pair with n >= ``min_support``, from one row per cell."""
    most = cells.groupBy(*by, user).agg(F.max("c").alias("_most"))
    return (cells.join(most, by + [user]).groupBy(*by, item).agg(F.sum(F.col("c") * F.col("_most")).alias("_bound"))
            .where(F.col("_bound") >= min_support).drop("_bound"))


def pair_sums(ratings: DataFrame, user: str = "uid", item: str = "iid", value: str = "stars",
              by=(), n_user_blocks: int | None = None, heavy_cells: int = 2048,
              rows_per_group: int = 400_000, max_pairs_per_chunk: int = 500_000,
              integer_sums: bool = True, min_support: int = 1) -> DataFrame:
    """(by..., i, j, n, sx, sy, sxx, syy, sxy) for item pairs i < j rated by a common user.

    Cells (user, item) are grouped for the in-task block product:

    * a light user (at most ``heavy_cells`` distinct items) goes whole into
      one of ``n_user_blocks`` hashed user blocks -- no replication;
    * a heavy user's items are hashed into ceil(cells / heavy_cells) blocks
      of its own, and each cell is sent to every (lo, hi) block pair it
      takes part in -- replication is paid by heavy users only, and every
      group holds at most about 2 * heavy_cells cells of one heavy user.

    With ``min_support`` above 1, items that cannot reach it are dropped before pairing (pairs
    with n >= min_support are unchanged, rarer ones may be missing).

    ``by`` columns (e.g. a cross-validation fold) are carried as extra keys:
    sums are computed independently per ``by`` value in the same job.
    Swap ``user`` and ``item`` for user-user sums.
    """
    by = list(by)
    cells = rating_cells(ratings, user, item, value, by)
    if min_support > 1:
        cells = prune_rare_items(cells, min_support, by, user, item)
    if n_user_blocks is None:  # planning reads the users' degrees: write the cells once instead of making them twice
        cells = materialize(cells, "rating-cells")
    return pair_sums_of_cells(cells, user, item, by, n_user_blocks, heavy_cells, rows_per_group, max_pairs_per_chunk, integer_sums)


def rating_cells(ratings: DataFrame, user: str = "uid", item: str = "iid", value: str = "stars", by=()) -> DataFrame:
    """(by..., user, item, c, s, q): count, sum and sum of squares of the ratings of every rated cell."""
    v = F.col(value).cast("double")
    return (ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(value).isNotNull())
            .groupBy(*by, user, item)
            .agg(F.count(F.lit(1)).alias("c"), F.sum(v).alias("s"), F.sum(v * v).alias("q")))


def hot_items(load: DataFrame, by=()) -> DataFrame | None:
    """(by.., it, salt): the items whose pairs are dealt to several adding tasks; None if there are none.

    ``load``: (by.., it, load) with parts of the number of products that an item takes part in.  All loads add up to the sum of squared
    degrees, so there are no more hot items than tasks of ``WORK_PER_TASK``.
    """
    whole = load.groupBy(*by, "it").agg(F.sum("load").alias("load")).where(F.col("load") > WORK_PER_TASK)
    hot = materialize(whole.select(*by, "it", F.ceil(F.col("load") / WORK_PER_TASK).cast("int").alias("salt")), "hot-items")
    return None if hot.isEmpty() else hot


def _with_salt(x: DataFrame, hot: DataFrame | None, by=()) -> DataFrame:
    if hot is None:
        return x.withColumn("salt", F.lit(1))
    return x.join(F.broadcast(hot), [*by, "it"], "left").withColumn("salt", F.coalesce("salt", F.lit(1)))


def _by_schema(cells: DataFrame, by) -> str:
    return "".join(f"{k} {cells.schema[k].dataType.simpleString()}, " for k in by)


def pair_sums_of_cells(cells: DataFrame, user: str = "uid", item: str = "iid", by=(), n_user_blocks: int | None = None,
                       heavy_cells: int = 2048, rows_per_group: int = 400_000, max_pairs_per_chunk: int = 500_000,
                       integer_sums: bool = True) -> DataFrame:
    """:func:`pair_sums` from written cells (they are read twice); a cell may come in several rows."""
    by = list(by)
    groups, tasks = _cell_groups(cells, user, item, by, n_user_blocks, heavy_cells, rows_per_group)
    hot = hot_items(groups.load, by) if tasks > cells.sparkSession.sparkContext.defaultParallelism else None
    return added_lists(groups.lists(hot, max_pairs_per_chunk), tasks, _by_schema(cells, by), by, integer_sums)


class _Groups(NamedTuple):
    """Cells dealt to groups, and what their pairs cost."""

    rows: DataFrame
    keys: list[str]
    by: list[str]
    tasks: int
    load: DataFrame  # (by.., it, load)
    cross: bool = False

    def lists(self, hot: DataFrame | None, max_pairs: int, tags: int = 0) -> DataFrame:
        """The packed partial sums of all groups (per tags of the cells if there are any)."""
        kernel = _cross_kernel(max_pairs) if self.cross else _make_kernel(self.by, max_pairs, tags, packed=True)
        dealt = _with_salt(self.rows, hot, self.by).repartition(self.tasks, *self.keys).groupBy(*self.keys)
        return dealt.applyInPandas(kernel, _by_schema(self.rows, self.by) + LISTS)


def _cell_groups(cells: DataFrame, user: str, item: str, by: list[str], n_user_blocks: int | None = None, heavy_cells: int = 2048,
                 rows_per_group: int = 400_000, tags: int = 0) -> tuple[_Groups, int]:
    """The cells in groups whose products are made together, and the number of tasks that make them."""
    deg = cells.groupBy(*by, user).agg(F.count(F.lit(1)).alias("deg"))
    blocks, tasks = plan_user_blocks(deg, rows_per_group, heavy_cells=heavy_cells)
    n_user_blocks = int(n_user_blocks or blocks)
    heavy = F.col("deg") > heavy_cells
    nblk = F.when(heavy, F.ceil(F.col("deg") / F.lit(heavy_cells))).otherwise(F.lit(1)).cast("int")
    sized = cells.join(deg, by + [user], "inner")
    x = (sized
         .select(*by, F.col(user).cast("long").alias("u"), F.col(item).cast("long").alias("it"), "c", "s", "q", *(["tag"] if tags else []),
                 heavy.alias("g_heavy"),
                 F.when(heavy, F.col(user).cast("long"))
                  .otherwise(F.pmod(F.xxhash64(F.col(user)), F.lit(n_user_blocks))).alias("g_id"),
                 F.pmod(F.xxhash64(F.col(item)), nblk).cast("int").alias("blk"),
                 nblk.alias("nblk"))
         .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nblk") - 1)))
         .withColumn("lo", F.least("blk", "other"))
         .withColumn("hi", F.greatest("blk", "other"))
         .drop("other", "nblk"))
    load = sized.groupBy(*by, F.col(item).cast("long").alias("it")).agg(F.sum(F.col("deg").cast("double")).alias("load"))
    return _Groups(x, [*by, "g_heavy", "g_id", "lo", "hi"], by, tasks, load), tasks


def fold_pair_sums(ratings: DataFrame, fold, k: int, min_support: int = 1, user: str = "uid", item: str = "iid",
                   value: str = "stars", integer_sums: bool = True, out: str = "cv_fold", heavy_cells: int = 2048) -> DataFrame:
    """(cv_fold, i, j, n, sx, sy, sxx, syy, sxy) of the k training sets: the pairs that a prediction of their test set can use.

    ``fold`` is the fold (0 to k - 1) that a row tests; it trains all others.  The cells of all ratings, kept apart by fold, are
    multiplied once, and after the shuffle the product of cells of folds a and b goes to every training set but those of a and b.

    A prediction for (u, i) in fold f uses the pair (i, j) if u has rated i in f and j outside of f, and if the pair has at least
    ``min_support`` common ratings in the training set.  The first product is not one of the latter, so over all ratings such a pair has
    more than ``min_support``: the others are dropped before the products are dealt to the folds.  Rows without a value count
    for this bound (they may be asked for) and for no sum.
    """
    v = F.col(value).cast("double")
    rows = ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull()).withColumn("tag", fold.cast("int")).where(F.col("tag").isNotNull())
    # tag k: no value; tag k + 1: no fold from 0 to k - 1, so it trains all of them
    cells = (rows.withColumn("tag", F.when(v.isNull(), F.lit(k)).when(F.col("tag").between(0, k - 1), F.col("tag")).otherwise(F.lit(k + 1)))
             .groupBy(user, item, "tag").agg(F.count(F.lit(1)).alias("c"), F.coalesce(F.sum(v), F.lit(0.0)).alias("s"), F.coalesce(F.sum(v * v), F.lit(0.0)).alias("q")))
    whole = cells.groupBy(user, item).agg(F.sum("c").alias("c"))
    cells = materialize(cells.join(items_with_support(whole, min_support + 1, [], user, item), item, "left_semi"), "fold-cells")
    groups, tasks = _cell_groups(cells, user, item, [], heavy_cells=heavy_cells, tags=k + 2)
    hot = hot_items(groups.load) if tasks > cells.sparkSession.sparkContext.defaultParallelism else None
    return added_lists(groups.lists(hot, 500_000, k + 2), 2 * tasks, integer_sums=integer_sums, tags=k + 2, out=out, min_support=min_support)


def _cross_kernel(max_pairs: int):
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)  # the cells of a group, bounded by the planning
        left = pdf["left"].to_numpy(bool)
        salts = _salts(pdf)
        for res in _block_pair_sums(pdf[left], pdf[~left], False, max_pairs, cross=True):
            yield pack_lists(res, salts)

    kernel.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return kernel


def cross_pair_sums(left: DataFrame, right: DataFrame, user: str = "uid", item: str = "iid", heavy_cells: int = 2048,
                    rows_per_group: int = 400_000, pairs_per_group: int = WORK_PER_TASK // 8, max_pairs_per_chunk: int = 500_000,
                    integer_sums: bool = True) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy): pair sums between two written sets of cells of the same users.

    Adds, over the users of both, the products of every cell of ``left`` with every cell of ``right`` of another item.
    Only users of both sides go on.  One with more than ``heavy_cells`` on a side is cut into item blocks of its own on both
    sides, a group per pair of blocks; the others go whole into hashed user blocks, sized by cells and products.
    """
    groups = _cross_groups(left, right, user, item, heavy_cells, rows_per_group, pairs_per_group)
    return _sums_of_groups([groups], max_pairs_per_chunk, integer_sums)


def pair_sum_updates(new: DataFrame, old: DataFrame) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy): what written cells ``new`` add to the pair sums of written cells ``old``.

    The products among the new cells and those with the old cells of their users are added in one exchange.
    """
    return _sums_of_groups([_cell_groups(new, "uid", "iid", [])[0], _cross_groups(new, old, "uid", "iid")], 500_000, True)


def _sums_of_groups(parts: list[_Groups], max_pairs: int, integer_sums: bool) -> DataFrame:
    both = lambda dfs: reduce(lambda a, b: a.unionByName(b), dfs)
    tasks = sum(p.tasks for p in parts)
    hot = hot_items(both([p.load for p in parts])) if tasks > parts[0].rows.sparkSession.sparkContext.defaultParallelism else None
    return added_lists(both([p.lists(hot, max_pairs) for p in parts]), tasks, integer_sums=integer_sums)


def _cross_groups(left: DataFrame, right: DataFrame, user: str, item: str, heavy_cells: int = 2048, rows_per_group: int = 400_000,
                  pairs_per_group: int = WORK_PER_TASK // 8) -> _Groups:
    degree = lambda df, name: df.groupBy(user).agg(F.count(F.lit(1)).alias(name))
    both = materialize(degree(left, "dl").join(degree(right, "dr"), user), "cross-degrees")
    light = (F.col("dl") <= heavy_cells) & (F.col("dr") <= heavy_cells)
    d = lambda c: F.col(c).cast("double")
    products = d("dl") * d("dr")
    seen = both.agg(F.sum(F.when(light, d("dl") + d("dr"))).alias("cells"), F.sum(F.when(light, products)).alias("pairs"),
                    F.sum(products).alias("work")).first()  # one row
    par = left.sparkSession.sparkContext.defaultParallelism
    tasks = plan_tasks(2 * (seen["work"] or 0), par)
    blocks = max(1, 2 * par, math.ceil((seen["cells"] or 0) / rows_per_group),
                 math.ceil((seen["pairs"] or 0) / pairs_per_group))
    cut = lambda c: F.when(light, F.lit(1)).otherwise(F.ceil(F.col(c) / F.lit(heavy_cells))).cast("int")

    def side(df: DataFrame, own: str, other: str, is_left: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64(F.col(item)), cut(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), cut(other) - 1))
        return df.join(both, user).select(
            F.lit(is_left).alias("left"), F.col(user).cast("long").alias("u"), F.col(item).cast("long").alias("it"), "c", "s", "q", (~light).alias("g_heavy"),
            F.when(light, F.pmod(F.xxhash64(F.col(user)), F.lit(blocks))).otherwise(F.col(user).cast("long")).alias("g_id"),
            mine.alias("mine"), theirs.alias("theirs")).withColumns({"lo": F.col("mine" if is_left else "theirs"), "hi": F.col("theirs" if is_left else "mine")}) \
            .drop("mine", "theirs")

    group = ["g_heavy", "g_id", "lo", "hi"]
    load = lambda df, other: df.join(both, user).select(F.col(item).cast("long").alias("it"), d(other).alias("load"))
    return _Groups(side(left, "dl", "dr", True).unionByName(side(right, "dr", "dl", False)), group, [], tasks,
                   load(left, "dr").unionByName(load(right, "dl")), cross=True)


# ------------------------------------------------------------- similarities

def sim_expr(metric: str, shrinkage: float = 100.0):
    n = F.col("n").cast("double")
    sx, sy, sxx, syy, sxy = (F.col(c).cast("double") for c in SUM_COLS)
    if metric == "cosine":
        den = F.sqrt(sxx * syy)
        return F.when(den > 0, sxy / den).otherwise(F.lit(0.0))
    if metric == "msd":
        return F.lit(1.0) / ((sxx + syy - F.lit(2.0) * sxy) / n + F.lit(1.0))
    if metric == "pearson":
        den = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
        return F.when(den > 0, (n * sxy - sx * sy) / den).otherwise(F.lit(0.0))
    if metric == "pearson_baseline":
        den = F.sqrt(sxx * syy)
        shrink = (n - 1) / (n - 1 + F.lit(float(shrinkage)))
        return F.when(den > 0, sxy / den * shrink).otherwise(F.lit(0.0))
    raise ValueError(f"unknown similarity {metric!r}; choose from {METRICS}")


def similarity(sums: DataFrame, metric: str = "cosine", min_support: int = 1,
               shrinkage: float = 100.0, by=()) -> DataFrame:
    """(by..., i, j, n, sim) for i < j with n >= min_support."""
    return (sums.where(F.col("n") >= min_support)
                .select(*by, "i", "j", "n", sim_expr(metric, shrinkage).alias("sim")))


def residuals(ratings: DataFrame, baselines: DataFrame, value: str = "stars",
              user: str = "uid", item: str = "iid", by=()) -> DataFrame:
    """ratings with ``res = r - b_ui``.

    ``baselines`` is the (mu, bu, bi) tuple returned by
    :func:`recspark.operators.baselines.baseline_als`.
    """
    mu, bu, bi = baselines
    r = attach_baseline(ratings, mu, bu, bi, user, item, list(by))
    return r.withColumn("res", F.col(value).cast("double") - F.col("b_ui"))


def attach_mean(df: DataFrame, mu: DataFrame, by: list[str], name: str = "mu") -> DataFrame:
    """Add the global mean column: a scalar subquery, or an equi-join on the ``by`` keys
    (one row per key value, e.g. per fold: a fixed-size table, broadcast)."""
    if by:
        return df.join(F.broadcast(mu.select(*by, name)), by, "inner")
    return df.withColumn(name, mu.select(name).scalar())


def attach_baseline(df: DataFrame, mu: DataFrame, bu: DataFrame, bi: DataFrame,
                    user: str = "uid", item: str = "iid", by=()) -> DataFrame:
    """Add b_ui = mu + b_u + b_i (unknown side -> 0) to df."""
    by = list(by)
    out = attach_mean(df, mu, by)
    out = out.join(bu.select(*by, user, "bu"), by + [user], "left") \
             .join(bi.select(*by, item, "bi"), by + [item], "left")
    return out.withColumn("b_ui", F.col("mu") + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0)))


def mirror(sims: DataFrame, diagonal_items: DataFrame | None = None, by=(),
           item: str = "iid") -> DataFrame:
    """Both directions of every stored pair, plus (i, i, 0, 1.0) for the given items."""
    by = list(by)
    fwd = sims.select(*by, "i", "j", "n", "sim")
    back = sims.select(*by, F.col("j").alias("i"), F.col("i").alias("j"), "n", "sim")
    out = fwd.unionByName(back)
    if diagonal_items is not None:
        diag = (diagonal_items.select(*by, F.col(item).alias("i")).distinct()
                .select(*by, "i", F.col("i").alias("j"), F.lit(0).cast("bigint").alias("n"),
                        F.lit(1.0).alias("sim")))
        out = out.unionByName(diag)
    return out


def rank_expr(sim_col: str = "sim"):
    """Engine-stable ranking key for similarities (float noise cannot flip ties)."""
    return F.round(F.col(sim_col), 9)


def top_k_neighbors(targets: DataFrame, sims_mirrored: DataFrame, train: DataFrame, k: int,
                    value: str = "stars", user: str = "uid", item: str = "iid", by=(),
                    extra_cols=()) -> DataFrame:
    """For each target (u, i): the <= k rated items j of u with the largest sim(i, j) > 0.

    A target meets the shorter of its item's neighbour list and its user's ratings
    first, hot keys in blocks (``operators.candidates``).  Top-k is a row number limit,
    applied per task before the shuffle.  Ties: sim desc, n desc, j, review_id, rating.
    """
    from recspark.operators.candidates import candidate_rows

    by = list(by)
    t = targets.select(*by, user, item).distinct()
    s = materialize(sims_mirrored.where(F.col("sim") > 0).select(*by, F.col("i").alias(item), "j", "n", "sim"), "neighbor-lists")  # read twice
    tr = train.select(*by, F.col(user), F.col(item).alias("j"), F.col(value).alias("r_j"),
                      F.col("review_id").alias("rid_j"), *extra_cols)
    cand = candidate_rows(t, s, tr, by, user, item)
    w = Window.partitionBy(*by, user, item).orderBy(
        rank_expr().desc(), F.col("n").desc(), F.col("j").asc(), F.col("rid_j").asc(), F.col("r_j").asc())
    return (cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                .withColumn("rank", F.col("rank").cast("long")))


from recspark.functions.shipping import ship_by_value  # noqa: E402

ship_by_value(__name__)  # the block kernel runs on executors
