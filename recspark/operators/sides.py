"""Ratings laid out for iterative fits, so that no round moves them.

Every round of a bias or cluster fit looks up something per user (or per item) for each rating and sums it per item (or per
user).  Only these small tables and the partial sums should travel:

* while the users' and the items' tables are small (counted once, to a few percent; ``BROADCAST_BYTES``), they are broadcast to one written copy of the ratings;
* beyond that the ratings are written twice, bucketed by user and bucketed by item, the ratings of a key as one row with a list.  A
  lookup per user reads the first copy: the small table is shuffled to the buckets and meets one row per user instead of one per
  rating, and the lists are unrolled behind the join.  Heavy keys are split before: a user with more than ``heavy_rows`` ratings has
  them dealt to several parts (an extra bucket key), which bounds a list, and its row of the small table is repeated for every part.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize, release_shuffles, scratch_path

BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64
HEAVY_ROWS = 100_000
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 100_000


class RatingSides:
    """``ratings`` with user and item keys (and ``by`` columns), readable with per-user or per-item columns joined on."""

    def __init__(self, ratings: DataFrame, by=(), broadcast_bytes: int = BROADCAST_BYTES, heavy_rows: int = HEAVY_ROWS):
        self.by = list(by)
        self.rows = materialize(ratings, "ratings")
        distinct = lambda key: F.approx_count_distinct(F.struct(*self.by, key))
        users, items, total = self.rows.agg(distinct("uid"), distinct("iid"), F.count(F.lit(1))).first()  # one row
        self.small = max(users, items) * ROW_BYTES <= broadcast_bytes
        if not self.small:
            # sized by the ratings: every task of a round writes a piece for every task of the next one, so their number must stay small
            self.buckets = min(MOST_BUCKETS, max(ratings.sparkSession.sparkContext.defaultParallelism, math.ceil(total / BUCKET_ROWS)))
            self.parts, self.copies = {}, {}
            for key in ("uid", "iid"):
                self.parts[key] = materialize(self._sizes(key).withColumn("parts", F.ceil(F.col("n") / F.lit(heavy_rows)).cast("int")).drop("n"), "rating-parts")
                self.copies[key] = self._bucketed(key)

    def _sizes(self, key: str) -> DataFrame:
        return self.rows.groupBy(*self.by, key).agg(F.count(F.lit(1)).alias("n"))

    def _bucketed(self, key: str) -> DataFrame:
        """A copy of the ratings in buckets of (by.., key, part), a row with the list of its ratings for each."""
        spark = self.rows.sparkSession
        other = "iid" if key == "uid" else "uid"
        heavy = self.parts[key].where("parts > 1")  # few: each has more than heavy_rows ratings
        dealt = self.rows.join(heavy, [*self.by, key], "left").withColumn(
            "part", F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        keys = [*self.by, key, "part"]
        listed = dealt.groupBy(*keys).agg(F.collect_list(F.struct(*[c for c in self.rows.columns if c not in keys])).alias("rated"))
        name = f"ratings_by_{key}_{uuid.uuid4().hex}"
        (listed.repartition(self.buckets, *keys).write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys)
         .option("path", scratch_path(spark, name)).saveAsTable(name))
        return spark.table(name)

    def _with(self, key: str, table: DataFrame, how: str) -> DataFrame:
        if self.small:
            return self.rows.join(F.broadcast(table), [*self.by, key], how)
        spread = table.join(self.parts[key], [*self.by, key]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        spread = spread.repartition(self.buckets, *self.by, key, "part")  # to the buckets, whatever the session's number of partitions
        met = self.copies[key].join(spread, [*self.by, key, "part"], how)
        return met.select(*self.by, key, *[c for c in table.columns if c not in (*self.by, key)], F.inline("rated"))

    def end_round(self) -> None:
        """Let the shuffle files of finished rounds go where rounds shuffle the small tables; call it when what they made is written."""
        if not self.small:
            release_shuffles(self.rows.sparkSession)

    def with_users(self, table: DataFrame, how: str = "inner") -> DataFrame:
        """The ratings with the columns of a table of one row per (by.., uid)."""
        return self._with("uid", table, how)

    def with_items(self, table: DataFrame, how: str = "inner") -> DataFrame:
        """The ratings with the columns of a table of one row per (by.., iid)."""
        return self._with("iid", table, how)
