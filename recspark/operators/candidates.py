"""Joins of targets with neighbour lists and ratings, sized by what they will yield.

A target (user, item) needs the entries (item, j) of its item's list for which the user has rated j.  Joining the list first
yields the list's length per target, joining the user's ratings first their number; both end in the same rows.
:func:`candidate_rows` measures the two and takes the shorter way target by target.

The yield of a join on one key is the product of its rows on both sides, which neither side's size shows and adaptive
execution does not see.  :func:`blocked_join` counts it and cuts the keys whose product is large into blocks on both
sides, so that every pair of blocks is a task's share of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize

SIDE = 2048  # rows of a hot key per block and side


def blocked_join(left: DataFrame, right: DataFrame, keys: list[str], side: int = SIDE) -> DataFrame:
    """Inner join on ``keys``; keys that yield more than ``side`` x ``side`` rows are cut into blocks of about ``side`` rows."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    hot = materialize(count(left, "_nl").join(count(right, "_nr"), keys).where(F.col("_nl") * F.col("_nr") > side * side), "hot-keys")
    if hot.isEmpty():
        return left.join(right, keys)
    blocks = hot.select(*keys, *[F.ceil(F.col(n) / side).cast("int").alias(n) for n in ("_nl", "_nr")])

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce(own, F.lit(1))).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return df.join(blocks, keys, "left").withColumn(own + "_at", mine).withColumn(other + "_at", theirs).drop("_nl", "_nr")

    return cut(left, "_nl", "_nr").join(cut(right, "_nr", "_nl"), [*keys, "_nl_at", "_nr_at"]).drop("_nl_at", "_nr_at")


def candidate_rows(targets: DataFrame, lists: DataFrame, rated: DataFrame, by=(), user: str = "uid", item: str = "iid",
                   side: int = SIDE) -> DataFrame:
    """targets (by.., user, item) x lists (by.., item, j, ..) x rated (by.., user, j, ..), matched on item, user and j.

    ``lists`` should hold one row per (item, j).
    """
    by = list(by)
    length = lists.groupBy(*by, item).agg(F.count(F.lit(1)).alias("_length"))
    degree = rated.groupBy(*by, user).agg(F.count(F.lit(1)).alias("_degree"))
    sized = materialize(targets.join(length, by + [item]).join(degree, by + [user]), "sized-targets")
    by_list = F.col("_length") <= F.col("_degree")
    seen = sized.agg(F.count_if(by_list).alias("lists"), F.count_if(~by_list).alias("users")).first()  # one row
    first = lambda df: df.drop("_length", "_degree")
    parts = []
    if seen["users"]:
        parts.append(blocked_join(first(sized.where(~by_list)), rated, by + [user], side).join(lists, by + [item, "j"]))
    if seen["lists"] or not parts:
        parts.append(blocked_join(first(sized.where(by_list)), lists, by + [item], side).join(rated, by + [user, "j"]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
