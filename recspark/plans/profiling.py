"""Profiles, histograms, densities and retention sweeps."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recspark.functions.exprs import day_number, r6
from recspark.operators import profile as pr
from recspark.operators.trim import since_year
from recspark.plans import fixture as fx
from recspark.plans.registry import register, with_ctes

R, I, T = fx.REVIEWS, fx.ITEMS, fx.RATINGS
HEAVY = 55
SHARE_T = 20
USER_SWEEP = (5, 10, 15, 20, 25, 30)
ITEM_SWEEP = (5, 10, 15, 20, 25, 30, 35, 40, 45, 50)
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)


def hist_sql(src: str, x: str, bins: int) -> str:
    return f"""SELECT bin, round(lo + bin * ((hi - lo) / {float(bins)}), 6) AS lo, count(*) AS n FROM (
      SELECT CASE WHEN s.hi > s.lo THEN least(CAST(floor((CAST({x} AS DOUBLE) - s.lo) * {bins} / (s.hi - s.lo)) AS INT), {bins - 1})
                  ELSE 0 END AS bin, s.lo, s.hi
      FROM {src}, (SELECT min(CAST({x} AS DOUBLE)) AS lo, max(CAST({x} AS DOUBLE)) AS hi FROM {src}) s
      WHERE {x} IS NOT NULL) GROUP BY bin, lo, hi"""


def _hist(df, col, bins):
    h = pr.histogram(df, col, bins)
    return h.select("bin", r6("lo").alias("lo"), "n")


UPI = "upi AS (SELECT iid, count(*) AS n_users FROM (SELECT DISTINCT iid, uid FROM reviews WHERE iid IS NOT NULL AND uid IS NOT NULL) GROUP BY iid)"
RPU = "rpu AS (SELECT uid, count(*) AS n_reviews FROM (SELECT DISTINCT uid, review_id FROM reviews WHERE uid IS NOT NULL AND review_id IS NOT NULL) GROUP BY uid)"


@register("agg_count_filtered", with_ctes([R, I], f"""
    SELECT count(*) AS n FROM reviews r JOIN items i ON r.iid = i.iid
    WHERE i.categories LIKE '%{fx.DEMO_CATEGORY}%' AND i.state = '{fx.DEMO_STATE}'"""), ops="A1 P4 P5")
def q_agg_count_filtered(spark, d):
    from recspark.sources.loader import load_reviews
    return pr.count_rows(load_reviews(fx.fx_reviews(spark, d), fx.fx_items(spark, d),
                                      category=fx.DEMO_CATEGORY, state=fx.DEMO_STATE))


@register("profile_distinct_items", with_ctes([I], """
    SELECT count(DISTINCT iid) AS n_iid, count(DISTINCT name) AS n_name, count(DISTINCT brand) AS n_brand,
           count(DISTINCT categories) AS n_categories, count(DISTINCT state) AS n_state,
           count(DISTINCT is_open) AS n_is_open FROM items"""), ops="A2")
def q_profile_items(spark, d):
    return pr.distinct_profile(fx.fx_items(spark, d))


@register("profile_distinct_reviews", with_ctes([R], """
    SELECT count(DISTINCT review_id) AS n_review_id, count(DISTINCT uid) AS n_uid, count(DISTINCT iid) AS n_iid,
           count(DISTINCT stars) AS n_stars, count(DISTINCT date) AS n_date FROM reviews"""), ops="A2")
def q_profile_reviews(spark, d):
    return pr.distinct_profile(fx.fx_reviews(spark, d))


@register("profile_distinct_reviews_approx", None, ops="A2")
def q_profile_reviews_approx(spark, d):
    """HyperLogLog++ distinct counts of every column (approx=True): one pass, no Expand of the rows."""
    return pr.distinct_profile(fx.fx_reviews(spark, d), approx=True, rsd=0.02)


@register("profile_distinct_approx_error", with_ctes([R], """
    SELECT true AS review_id, true AS uid, true AS iid, true AS stars, true AS date FROM reviews LIMIT 1"""), ops="A2")
def q_profile_approx_error(spark, d):
    """Whether each approximate distinct count is within three standard errors (plus one) of the exact one."""
    rv = fx.fx_reviews(spark, d)
    cols = ("review_id", "uid", "iid", "stars", "date")
    near, exact = pr.distinct_profile(rv, approx=True, rsd=0.02), pr.distinct_profile(rv)
    near = near.toDF(*[f"a_{c}" for c in near.columns])
    one = near.join(exact, F.lit(True))  # one row each
    return one.select(*[(F.abs(F.col(f"a_n_{c}") - F.col(f"n_{c}")) <= 3 * 0.02 * F.col(f"n_{c}") + 1).alias(c) for c in cols])


@register("agg_users_per_item", with_ctes([R, UPI], "SELECT iid, n_users FROM upi"), ops="A3")
def q_users_per_item(spark, d):
    return pr.users_per_item(fx.fx_reviews(spark, d))


@register("agg_reviews_per_user", with_ctes([R, RPU], "SELECT uid, n_reviews FROM rpu"), ops="A4")
def q_reviews_per_user(spark, d):
    return pr.reviews_per_user(fx.fx_reviews(spark, d))


@register("agg_mean_users_per_item", with_ctes([R, UPI], "SELECT round(avg(n_users), 6) AS mean_users FROM upi"),
          ops="A5")
def q_mean_users_per_item(spark, d):
    return pr.mean_of(pr.users_per_item(fx.fx_reviews(spark, d)), "n_users", "m").select(r6("m").alias("mean_users"))


@register("agg_mean_reviews_per_item", with_ctes([R], """
    SELECT round(avg(n), 6) AS mean_reviews FROM (SELECT iid, count(*) AS n FROM
      (SELECT DISTINCT iid, review_id FROM reviews WHERE iid IS NOT NULL AND review_id IS NOT NULL) GROUP BY iid)"""),
          ops="A5")
def q_mean_reviews_per_item(spark, d):
    from recspark.operators.trim import distinct_count_per
    per = distinct_count_per(fx.fx_reviews(spark, d), "iid", "review_id")
    return per.agg(F.avg("n").alias("m")).select(r6("m").alias("mean_reviews"))


@register("agg_share_items_over_threshold", with_ctes([R, UPI], f"""
    SELECT CAST(sum(CASE WHEN n_users >= {SHARE_T} THEN 1 ELSE 0 END) AS BIGINT) AS n_over, count(*) AS n_total,
           round(sum(CASE WHEN n_users >= {SHARE_T} THEN 1 ELSE 0 END) / count(*), 6) AS share FROM upi"""),
          ops="A6 Q15")
def q_share_items(spark, d):
    s = pr.share_at_least(pr.users_per_item(fx.fx_reviews(spark, d)), "n_users", SHARE_T)
    return s.select("n_over", "n_total", r6("share").alias("share"))


@register("agg_heavy_users", with_ctes([R, RPU], f"SELECT uid, n_reviews FROM rpu WHERE n_reviews > {HEAVY}"),
          ops="A7")
def q_heavy_users(spark, d):
    return pr.heavy_users(fx.fx_reviews(spark, d), HEAVY)


@register("agg_review_span", with_ctes([R], """
    SELECT min(date) AS first, max(date) AS last, CAST(year(max(date)) - year(min(date)) AS INT) AS years
    FROM reviews"""), ops="A8")
def q_review_span(spark, d):
    return pr.review_span(fx.fx_reviews(spark, d))


DAYS = "days AS (SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(date AS DATE)) AS INT) AS day FROM reviews)"


@register("hist_review_dates", with_ctes([R, DAYS], hist_sql("days", "day", 100)), ops="A9")
def q_hist_dates(spark, d):
    return _hist(fx.fx_reviews(spark, d).select(day_number("date").alias("day")), "day", 100)


@register("hist_users_per_item", with_ctes([R, UPI], hist_sql("upi", "n_users", 30)), ops="A9")
def q_hist_upi(spark, d):
    return _hist(pr.users_per_item(fx.fx_reviews(spark, d)), "n_users", 30)


@register("hist_reviews_per_user", with_ctes([R, RPU], hist_sql("rpu", "n_reviews", 30)), ops="A9")
def q_hist_rpu(spark, d):
    return _hist(pr.reviews_per_user(fx.fx_reviews(spark, d)), "n_reviews", 30)


SMALL = "small AS (SELECT iid, count(*) AS n FROM ratings GROUP BY iid HAVING count(*) < 100)"


@register("hist_small_items", with_ctes(T + [SMALL], hist_sql("small", "n", 30)), ops="A10")
def q_hist_small(spark, d):
    per = fx.fx_ratings(spark, d).groupBy("iid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < 100)
    return _hist(per, "n", 30)


@register("agg_group_counts_all_columns", with_ctes([R, I], """
    SELECT i.state, count(r.review_id) AS n_review_id, count(r.uid) AS n_uid, count(r.iid) AS n_iid,
           count(r.stars) AS n_stars, count(r.date) AS n_date, count(i.name) AS n_name, count(i.brand) AS n_brand,
           count(i.categories) AS n_categories, count(i.is_open) AS n_is_open
    FROM reviews r JOIN items i ON r.iid = i.iid GROUP BY i.state"""), ops="A11")
def q_group_counts(spark, d):
    j = fx.fx_reviews(spark, d).join(fx.fx_items(spark, d), "iid", "inner")
    return pr.group_counts(j.select("state", "review_id", "uid", "iid", "stars", "date", "name", "brand",
                                    "categories", "is_open"), "state")


def density_sql(src: str) -> str:
    return (f"SELECT count(*) AS rows, count(DISTINCT uid) AS users, count(DISTINCT iid) AS items, "
            f"round(count(*) / (count(DISTINCT uid) * count(DISTINCT iid)), 6) AS density FROM {src}")


def _dens(df):
    return df.select("rows", "users", "items", r6("density").alias("density"))


@register("density_matrix", with_ctes([R], density_sql("reviews")), ops="A12")
def q_density(spark, d):
    return _dens(pr.density(fx.fx_reviews(spark, d)))


REGION = [R, I, f"""regions AS (
    SELECT i.state, count(*) AS n_items, COALESCE(max(rv.n_reviews), 0) AS n_reviews
    FROM items i LEFT JOIN (SELECT i2.state, count(*) AS n_reviews FROM reviews r JOIN items i2 ON r.iid = i2.iid
                            WHERE i2.categories IS NOT NULL AND i2.categories LIKE '%{fx.DEMO_CATEGORY}%'
                            GROUP BY i2.state) rv ON rv.state = i.state
    WHERE i.categories IS NOT NULL AND i.categories LIKE '%{fx.DEMO_CATEGORY}%' GROUP BY i.state)"""]


def _regions(spark, d):
    return pr.density_by_group(fx.fx_reviews(spark, d), fx.fx_items(spark, d), "state", fx.DEMO_CATEGORY)


@register("density_by_region", with_ctes(REGION, """
    SELECT state, n_items, n_reviews, round(n_reviews / n_items, 6) AS density,
           row_number() OVER (ORDER BY n_reviews / n_items DESC, state) AS rank FROM regions"""), ops="A13 W1 Q8")
def q_density_by_region(spark, d):
    g = _regions(spark, d)
    # ranking a handful of groups (one row per state): a single-partition window is fine here
    w = Window.orderBy(F.col("density").desc(), F.col("state").asc())
    return g.select("state", "n_items", "n_reviews", r6("density").alias("density"),
                    F.row_number().over(w).cast("long").alias("rank"))


@register("density_best_region", with_ctes(REGION, """
    SELECT state, n_items, n_reviews, round(n_reviews / n_items, 6) AS density FROM regions
    ORDER BY n_reviews / n_items DESC, state LIMIT 1"""), ops="A14")
def q_best_region(spark, d):
    b = pr.best_group(_regions(spark, d))
    return b.select("state", "n_items", "n_reviews", r6("density").alias("density"))


def sweep_sql(key, counted, ts):
    arr = ", ".join(str(t) for t in ts)
    return f"""SELECT t.threshold, CAST(sum(CASE WHEN p.n >= t.threshold THEN p.rows ELSE 0 END) AS BIGINT) AS rows_kept,
      CAST(sum(CASE WHEN p.n >= t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS keys_kept,
      round(100.0 * sum(CASE WHEN p.n >= t.threshold THEN p.rows ELSE 0 END) / max(tot.total), 6) AS pct_rows
    FROM (SELECT a.{key}, a.rows, b.n FROM (SELECT {key}, count(*) AS rows FROM s0 GROUP BY {key}) a
          JOIN (SELECT {key}, count(*) AS n FROM (SELECT DISTINCT {key}, {counted} FROM s0
                WHERE {key} IS NOT NULL AND {counted} IS NOT NULL) GROUP BY {key}) b ON a.{key} = b.{key}) p,
         (SELECT unnest([{arr}]) AS threshold) t, (SELECT count(*) AS total FROM s0) tot
    GROUP BY t.threshold"""


S0 = f"s0 AS (SELECT * FROM reviews WHERE date >= TIMESTAMP '{fx.SINCE_YEAR}-01-01')"


def _sweep(spark, d, key, counted, ts):
    s = pr.retention_sweep(since_year(fx.fx_reviews(spark, d), fx.SINCE_YEAR), key, counted, ts)
    return s.select("threshold", "rows_kept", "keys_kept", r6("pct_rows").alias("pct_rows"))


@register("sweep_user_threshold", with_ctes([R, S0], sweep_sql("uid", "review_id", USER_SWEEP)), ops="A15")
def q_sweep_users(spark, d):
    return _sweep(spark, d, "uid", "review_id", USER_SWEEP)


@register("sweep_item_threshold", with_ctes([R, S0], sweep_sql("iid", "uid", ITEM_SWEEP)), ops="A16")
def q_sweep_items(spark, d):
    return _sweep(spark, d, "iid", "uid", ITEM_SWEEP)


def _progression_sql():
    stages = ["reviews", "t0", "t1", "t2", "ratings"]
    labels = ["raw", f"since {fx.SINCE_YEAR}"] + [f"{k}>={t}" for k, t in fx.TRIM_STEPS]
    parts = [f"SELECT {k} AS stage, '{lab}' AS label, count(*) AS rows, count(DISTINCT uid) AS users, "
             f"count(DISTINCT iid) AS items, round(count(*) / (count(DISTINCT uid) * count(DISTINCT iid)), 6) "
             f"AS density FROM {src}" for k, (src, lab) in enumerate(zip(stages, labels))]
    return with_ctes(T, " UNION ALL ".join(parts))


@register("density_progression", _progression_sql(), ops="A17")
def q_density_progression(spark, d):
    p = pr.density_progression(fx.fx_reviews(spark, d), fx.SINCE_YEAR, fx.TRIM_STEPS)
    return p.select("stage", "label", "rows", "users", "items", r6("density").alias("density"))


@register("density_by_year_cutoff", with_ctes([R], f"""
    SELECT c.cutoff, count(*) AS rows, count(DISTINCT r.uid) AS users, count(DISTINCT r.iid) AS items,
           round(count(*) / (count(DISTINCT r.uid) * count(DISTINCT r.iid)), 6) AS density
    FROM reviews r JOIN (SELECT unnest([{', '.join(str(y) for y in YEARS)}]) AS cutoff) c
      ON CAST(year(r.date) AS INT) >= c.cutoff
    GROUP BY c.cutoff"""), ops="A18")
def q_density_by_year(spark, d):
    p = pr.density_by_year_cutoff(fx.fx_reviews(spark, d), YEARS)
    return p.select("cutoff", "rows", "users", "items", r6("density").alias("density"))
