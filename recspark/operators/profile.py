"""Profiling, density and retention sweeps.

Every profile is one aggregate job over the input (no driver loop over
groups or thresholds): thresholds and cut-offs become rows of a small
exploded list, per-key counts are aggregated map-side first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import materialize

from recspark.functions.exprs import day_number, hist_bin, safe_div, year_start
from recspark.operators.trim import distinct_count_per, trim_items, trim_users


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_profile(df: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """One row: number of distinct non-null values of every column (one pass)."""
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    return df.agg(*[f(c).alias(f"n_{c}") for c in df.columns])


def users_per_item(ratings: DataFrame) -> DataFrame:
    return distinct_count_per(ratings, "iid", "uid", "n_users")


def reviews_per_user(ratings: DataFrame) -> DataFrame:
    return distinct_count_per(ratings, "uid", "review_id", "n_reviews")


def mean_of(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.agg(F.avg(col).alias(name))


def share_at_least(per_key: DataFrame, col: str, threshold: int) -> DataFrame:
    """Count and share of keys whose ``col`` >= threshold."""
    return per_key.agg(
        F.sum(F.when(F.col(col) >= threshold, 1).otherwise(0)).cast("bigint").alias("n_over"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("share", safe_div(F.col("n_over"), F.col("n_total")))


def heavy_users(ratings: DataFrame, threshold: int) -> DataFrame:
    return reviews_per_user(ratings).where(F.col("n_reviews") > threshold)


def review_span(ratings: DataFrame, date_col: str = "date") -> DataFrame:
    return ratings.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last")).select(
        "first", "last", (F.year("last") - F.year("first")).cast("int").alias("years"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """(bin, lo, n): equal-width bins over [min, max], last bin closed.

    Bin edges come from one scalar aggregate (a scalar subquery); empty
    bins have no row.
    """
    x = F.col(col).cast("double")
    stats = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    b = df.where(F.col(col).isNotNull()).select(hist_bin(x, lo, hi, bins).alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return (b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
             .select("bin", (lo + F.col("bin") * width).alias("lo"), "n"))


def date_histogram(ratings: DataFrame, bins: int = 100, date_col: str = "date") -> DataFrame:
    return histogram(ratings.select(day_number(date_col).alias("day")), "day", bins)


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Non-null count of every other column per key."""
    return df.groupBy(key).agg(*[F.count(c).alias(f"n_{c}") for c in df.columns if c != key])


def density(ratings: DataFrame) -> DataFrame:
    """(rows, users, items, density): rows / (distinct users * distinct items)."""
    return ratings.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("uid").alias("users"),
        F.countDistinct("iid").alias("items"),
    ).withColumn("density", safe_div(F.col("rows"), F.col("users") * F.col("items")))


def density_by_group(reviews: DataFrame, items: DataFrame, group: str = "state",
                     category: str | None = None) -> DataFrame:
    """Per group: reviews per item of the category; one job for all groups."""
    sel = items
    if category is not None:
        sel = sel.where(F.col("categories").isNotNull() & F.col("categories").like(f"%{category}%"))
    n_items = sel.groupBy(group).agg(F.count(F.lit(1)).alias("n_items"))
    n_rev = (reviews.select("iid").join(sel.select("iid", group), "iid", "inner")
                    .groupBy(group).agg(F.count(F.lit(1)).alias("n_reviews")))
    return (n_items.join(n_rev, group, "left")
                   .select(group, "n_items", F.coalesce("n_reviews", F.lit(0)).alias("n_reviews"))
                   .withColumn("density", safe_div(F.col("n_reviews"), F.col("n_items"))))


def best_group(densities: DataFrame, group: str = "state") -> DataFrame:
    """Arg-max density; ties go to the smallest group name."""
    return densities.orderBy(F.col("density").desc(), F.col(group).asc()).limit(1)


def retention_sweep(ratings: DataFrame, key: str, counted: str, thresholds) -> DataFrame:
    """(threshold, rows_kept, keys_kept, pct_rows): rows kept when keys need >= t distinct ``counted``."""
    pairs = ratings.groupBy(key, counted).agg(F.count(F.lit(1)).alias("rows"))  # one read of the ratings
    per = pairs.groupBy(key).agg(F.sum("rows").alias("rows"), F.count(counted).alias("n"))
    total = per.agg(F.sum("rows").alias("total")).select("total").scalar()
    per_key = per.where(F.col(key).isNotNull() & (F.col("n") > 0))
    ts = F.array(*[F.lit(int(t)) for t in thresholds])
    swept = (per_key.select("rows", "n", F.explode(ts).alias("threshold"))
                    .groupBy("threshold")
                    .agg(F.sum(F.when(F.col("n") >= F.col("threshold"), F.col("rows")).otherwise(0))
                         .cast("bigint").alias("rows_kept"),
                         F.sum(F.when(F.col("n") >= F.col("threshold"), 1).otherwise(0))
                         .cast("bigint").alias("keys_kept")))
    return swept.withColumn("pct_rows", F.lit(100.0) * F.col("rows_kept") / total)


def density_progression(ratings: DataFrame, year: int | None, steps) -> DataFrame:
    """Density after each stage: raw, date cut, then each trimming step."""
    stages = [("raw", ratings)]
    cur = ratings
    if year is not None:
        cur = cur.where(F.col("date") >= year_start(year))
        stages.append((f"since {year}", cur))
    for kind, t in steps:  # a stage is written once, as the columns that later stages count
        cur = materialize(cur.select("review_id", "uid", "iid"), "stage")
        cur = trim_users(cur, t) if kind == "user" else trim_items(cur, t)
        stages.append((f"{kind}>={t}", cur))
    parts = [density(df).select(F.lit(k).alias("stage"), F.lit(label).alias("label"), "*")
             for k, (label, df) in enumerate(stages)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def density_by_year_cutoff(ratings: DataFrame, years) -> DataFrame:
    """Density of the rows on/after Jan 1 of each year, from three small aggregates.

    A user is in the cut if its latest review year >= y; same for items;
    the rows of the cut are a suffix sum of rows per year.
    """
    yr = ratings.select("uid", "iid", F.year("date").alias("y"))
    cut = F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("cutoff")
    users = (yr.groupBy("uid").agg(F.max("y").alias("last")).select("last", cut)
               .where(F.col("last") >= F.col("cutoff")).groupBy("cutoff").agg(F.count(F.lit(1)).alias("users")))
    items = (yr.groupBy("iid").agg(F.max("y").alias("last")).select("last", cut)
               .where(F.col("last") >= F.col("cutoff")).groupBy("cutoff").agg(F.count(F.lit(1)).alias("items")))
    rows = (yr.groupBy("y").agg(F.count(F.lit(1)).alias("n")).select("y", "n", cut)
              .where(F.col("y") >= F.col("cutoff")).groupBy("cutoff").agg(F.sum("n").cast("bigint").alias("rows")))
    return (rows.join(users, "cutoff").join(items, "cutoff")
                .withColumn("density", safe_div(F.col("rows"), F.col("users") * F.col("items"))))
