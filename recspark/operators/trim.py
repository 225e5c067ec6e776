"""Density trimming: keep active users and popular items, in a given order.

A user's activity is its number of distinct reviews; an item's popularity
its number of distinct users.  Distinct counts are computed as
``distinct(key, counted)`` (hash-partitioned on both columns, so one hot
key is spread over many tasks) followed by a count per key with map-side
partial aggregation.  The filter back onto the rating rows is a
``left_semi`` join; a key that holds a large share of the rows is split
at run time by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize as write_stage

from recspark.functions.exprs import year_start

USER, ITEM = "uid", "iid"


def distinct_count_per(df: DataFrame, key: str, counted: str, name: str = "n") -> DataFrame:
    """(key, n): exact number of distinct non-null ``counted`` values per non-null key."""
    return (df.select(key, counted)
              .where(F.col(key).isNotNull() & F.col(counted).isNotNull())
              .distinct()
              .groupBy(key)
              .agg(F.count(F.lit(1)).alias(name)))


def keys_with_at_least(df: DataFrame, key: str, counted: str, threshold: int) -> DataFrame:
    return distinct_count_per(df, key, counted).where(F.col("n") >= threshold).select(key)


def trim_users(ratings: DataFrame, threshold: int = 4, user: str = USER,
               counted: str = "review_id") -> DataFrame:
    """Rows of users with at least ``threshold`` distinct reviews."""
    return ratings.join(keys_with_at_least(ratings, user, counted, threshold), user, "left_semi")


def trim_items(ratings: DataFrame, threshold: int = 50, item: str = ITEM,
               counted: str = USER) -> DataFrame:
    """Rows of items with at least ``threshold`` distinct users."""
    return ratings.join(keys_with_at_least(ratings, item, counted, threshold), item, "left_semi")


def since_year(ratings: DataFrame, year: int, date_col: str = "date") -> DataFrame:
    """Rows on or after Jan 1 of ``year`` (inclusive)."""
    return ratings.where(F.col(date_col) >= year_start(year))


def trim(ratings: DataFrame, steps=(("user", 4), ("item", 40), ("user", 4)),
         materialize: str | None = None) -> DataFrame:
    """Apply trimming steps in order; order matters (a user cut changes item counts).

    ``materialize='checkpoint'`` writes the incoming rows once (each step reads them, and they are often a join),
    the qualifying keys of each step (small) and the trimmed rows; ``None`` leaves one lazy plan (Spark reuses the
    repeated exchanges of the shared sub-plans).
    """
    if materialize not in (None, "checkpoint"):
        raise ValueError(f"unknown materialize {materialize!r}")
    out = write_stage(ratings, "untrimmed") if materialize and steps else ratings
    for kind, t in steps:
        if kind not in ("user", "item"):
            raise ValueError(f"unknown trim step {kind!r}")
        key, counted = (USER, "review_id") if kind == "user" else (ITEM, USER)
        keys = keys_with_at_least(out, key, counted, t)
        if materialize:
            keys = write_stage(keys, f"trim-{kind}-{t}")
        out = out.join(keys, key, "left_semi")
    return write_stage(out, "trimmed") if materialize else out
