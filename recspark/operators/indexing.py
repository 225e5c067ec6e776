"""Id factorization, train/test splits, k folds and the item map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.exprs import fold_of, mix_key
from recspark.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index in the upper 31 bits


def factorize(df: DataFrame, col: str, order_by=("date", "review_id"), out: str | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """(col, out): dense 0-based codes in order of first appearance.

    First appearance of a value = its smallest ``order_by`` tuple; ties go
    to the smaller value.  The distinct values are range-partitioned and
    sorted (a distributed sort), numbered inside each partition, and
    shifted by the row counts of the earlier partitions (one row per
    partition, so a small broadcast).  The only window without a partition
    runs over these partition rows.
    """
    out = out or f"{col}_code"
    first = (df.where(F.col(col).isNotNull())
               .groupBy(col)
               .agg(F.min(F.struct(*[F.col(c) for c in order_by])).alias("_first")))
    keys = [F.col("_first")[c] for c in order_by] + [F.col(col)]
    spark = df.sparkSession
    num_partitions = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                           spark.sparkContext.defaultParallelism)
    ordered = first.repartitionByRange(num_partitions, *keys) \
                   .sortWithinPartitions(*keys)
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()) \
                    .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)) \
                    .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS)) \
                    .select(col, "_pid", "_local")
    # range bounds are sampled per exchange, so offsets and codes must come from one written table
    tagged = materialize(tagged, "factorize")
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = sizes.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .select(col, (F.col("_off") + F.col("_local")).alias(out)))


def validate_ratings(df: DataFrame, lo: float = 1.0, hi: float = 5.0, value: str = "stars") -> DataFrame:
    """Rating triples with the scale bounds checked (rows outside are flagged, not dropped)."""
    r = F.col(value).cast("double")
    return df.select("uid", "iid", r.alias("rating"),
                     (r.between(F.lit(lo), F.lit(hi))).alias("in_scale"))


def holdout_split(df: DataFrame, test_percent: int = 10) -> DataFrame:
    """Adds ``is_test``: deterministic, portable hash split (test share = percent/100)."""
    return df.withColumn("is_test", (mix_key() % 100) < test_percent)


def kfold(df: DataFrame, k: int = 5) -> DataFrame:
    """Adds ``fold`` in [0, k)."""
    return df.withColumn("fold", fold_of(k))


def train_sets_by_fold(df: DataFrame, k: int) -> DataFrame:
    """Every row once per fold it trains: (cv_fold, row...), cv_fold != own fold.

    The folds become a column, so one plan fits all k models at once.
    """
    f = fold_of(k)
    return (df.withColumn("_own", f)
              .withColumn("cv_fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
              .where(F.col("cv_fold") != F.col("_own"))
              .drop("_own"))


def test_sets_by_fold(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn("cv_fold", fold_of(k))


# ------------------------------------------------------------------ item map

def review_counts(reviews: DataFrame, item: str = "iid") -> DataFrame:
    """(iid, n_reviews): rating rows per item (map-side partial count)."""
    return reviews.where(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("n_reviews"))


def _argmax_item(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the item with most reviews; tie -> smallest iid (min over a struct,
    aggregated map-side, so a large key group never sits in one task)."""
    best = df.groupBy(*keys).agg(F.min(F.struct((-F.col("n_reviews")).alias("neg"), "iid", "name")).alias("b"))
    return best.select(*keys, F.col("b.iid").alias("iid"), F.col("b.name").alias("name"),
                       (-F.col("b.neg")).alias("n_reviews"))


def item_map(reviews: DataFrame, items: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, match, iid, name, n_reviews): per name pattern the most-reviewed item.

    ``patterns`` (pattern string, match boolean).  ``match`` = regex anchored at the start of the name (a
    prefix match), else a regex search anywhere in the name.  A pattern that
    matches no reviewed item yields no row.  Patterns meet the distinct names through an index of their
    literals (``operators.patterns``).
    """
    from recspark.operators.patterns import pattern_names

    cand = materialize(items.select("iid", "name").join(review_counts(reviews), "iid", "inner"), "reviewed-items")
    joined = cand.join(pattern_names(cand, patterns), "name")
    return _argmax_item(joined, ["pattern", "match"])


def item_map_by_name(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """(name, iid, n_reviews): the most-reviewed item of every name (one per chain)."""
    cand = (items.select("iid", "name").where(F.col("name").isNotNull())
                 .join(review_counts(reviews), "iid", "inner"))
    best = cand.groupBy("name").agg(F.min(F.struct((-F.col("n_reviews")).alias("neg"), "iid")).alias("b"))
    return best.select("name", F.col("b.iid").alias("iid"), (-F.col("b.neg")).alias("n_reviews"))
