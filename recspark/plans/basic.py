"""Sources and sinks, projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.functions.exprs import r6, year_start
from recspark.operators.similarity import similarity
from recspark.sources.files import REVIEW_SCHEMA, read_json_lines, write_json_lines, write_table_roundtrip
from recspark.sources.json_tables import read_named_tables
from recspark.sources.loader import load_reviews, union_chunks
from recspark.session import scratch_path
from recspark.plans import fixture as fx
from recspark.plans.registry import register, with_ctes

R, I, T = fx.REVIEWS, fx.ITEMS, fx.RATINGS
ROWS = "review_id, uid, iid, stars, date"
ITEM_COLS = "iid, name, brand, categories, state, is_open"
ST = fx.DEMO_STATE
SELS = ", ".join(fx.sql_str(s) for s in fx.DEMO_SELECTIONS)
CHUNK_SPLIT = "1998-01-01"


# ------------------------------------------------------------ sources/sinks

@register("src_json_lines", with_ctes([R], """
    SELECT stars, count(*) AS n, CAST(sum(review_id) AS BIGINT) AS sum_review_id,
           min(date) AS first, max(date) AS last FROM reviews GROUP BY stars"""), ops="S1 S6")
def q_src_json_lines(spark, d):
    path = write_json_lines(fx.fx_reviews(spark, d), scratch_path(spark, "reviews-json"))
    back = read_json_lines(spark, path, REVIEW_SCHEMA)
    return back.groupBy("stars").agg(F.count(F.lit(1)).alias("n"), F.sum("review_id").alias("sum_review_id"),
                                     F.min("date").alias("first"), F.max("date").alias("last"))


@register("src_json_array", with_ctes([R], f"SELECT {ROWS} FROM reviews"), ops="S5 S2")
def q_src_json_array(spark, d):
    return write_table_roundtrip(fx.fx_reviews(spark, d).select(*ROWS.split(", ")), "ratings-array", fmt="json_records")


@register("sink_json_roundtrip", with_ctes([R], f"SELECT {ROWS} FROM reviews"), ops="S6")
def q_sink_json_roundtrip(spark, d):
    return write_table_roundtrip(fx.fx_reviews(spark, d).select(*ROWS.split(", ")), "ratings", fmt="json")


@register("sink_similarity_parquet", with_ctes(
    T + fx.pair_sum_ctes() + fx.sims_ctes(), "SELECT i, j, n, round(sim, 6) AS sim FROM sims"), ops="S7 S8")
def q_sink_similarity_parquet(spark, d):
    sims = similarity(fx.fx_sums(spark, d), "cosine", fx.MIN_SUPPORT)
    back = write_table_roundtrip(sims, "sims", fmt="parquet")
    return back.select("i", "j", "n", r6("sim").alias("sim"))


@register("src_tables_by_name", with_ctes([R, I], """
    SELECT i.state, count(*) AS n_reviews, count(DISTINCT r.uid) AS n_users, count(DISTINCT r.iid) AS n_items,
           min(r.date) AS first, CAST(sum(r.stars) AS DOUBLE) AS stars
    FROM reviews r JOIN items i ON r.iid = i.iid WHERE i.categories LIKE '%ECONOMY%' GROUP BY i.state"""), ops="S1 S2 S4")
def q_tables_by_name(spark, d):
    """The fixture as the five JSON tables with string ids, read back by table name and filtered."""
    folder = scratch_path(spark, "json-tables")
    rv, it = fx.fx_reviews(spark, d), fx.fx_items(spark, d)
    text = lambda c, kind: F.concat(F.lit(kind), F.col(c).cast("string"))
    it.select(text("iid", "b").alias("business_id"), "name", "state", "categories", "is_open") \
        .write.json(f"{folder}/business.json")
    rv.select(text("review_id", "r").alias("review_id"), text("uid", "u").alias("user_id"), text("iid", "b").alias("business_id"),
              F.col("stars").cast("double").alias("stars"), F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date")) \
        .write.json(f"{folder}/review.json")
    t = read_named_tables(spark, folder, ("business", "review"), category="ECONOMY")
    j = t["review"].join(t["business"].select("business_id", "state"), "business_id")
    return j.groupBy("state").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("business_id").alias("n_items"),
        F.min("date").alias("first"), F.sum("stars").alias("stars"))


@register("src_filtered_reviews", with_ctes([R, I], f"""
    SELECT r.review_id, r.uid, r.iid, r.stars, r.date, i.name, i.brand, i.categories, i.state, i.is_open
    FROM reviews r JOIN items i ON r.iid = i.iid
    WHERE i.state = '{ST}' AND i.categories IS NOT NULL AND i.categories LIKE '%{fx.DEMO_CATEGORY}%'
      AND r.date >= TIMESTAMP '{fx.SINCE_YEAR}-01-01'"""), ops="S3 S4 J2")
def q_src_filtered_reviews(spark, d):
    return load_reviews(fx.fx_reviews(spark, d), fx.fx_items(spark, d), category=fx.DEMO_CATEGORY,
                        state=ST, since_year=fx.SINCE_YEAR)


@register("set_union_all_chunks", with_ctes([R, I], f"""
    SELECT r.iid, r.review_id, r.uid, r.stars, r.date, i.name, i.brand, i.categories, i.state, i.is_open
    FROM reviews r JOIN items i ON r.iid = i.iid WHERE r.date < TIMESTAMP '{CHUNK_SPLIT}'
    UNION ALL
    SELECT r.iid, r.review_id, r.uid, r.stars, r.date, i.name, i.brand, i.categories, i.state, i.is_open
    FROM reviews r JOIN items i ON r.iid = i.iid WHERE r.date >= TIMESTAMP '{CHUNK_SPLIT}'"""), ops="S9")
def q_union_chunks(spark, d):
    rv, it = fx.fx_reviews(spark, d), fx.fx_items(spark, d)
    cut = F.lit(f"{CHUNK_SPLIT} 00:00:00").cast("timestamp_ntz")
    return union_chunks([load_reviews(rv.where(F.col("date") < cut), it),
                         load_reviews(rv.where(F.col("date") >= cut), it)])


# ------------------------------------------------------------- projections

@register("proj_rename", with_ctes([R], "SELECT review_id, uid, iid AS business_id, stars AS review_stars, date FROM reviews"),
          ops="P1")
def q_proj_rename(spark, d):
    return fx.fx_reviews(spark, d).withColumnsRenamed({"stars": "review_stars", "iid": "business_id"})


@register("proj_drop_columns", with_ctes([R, I], """
    SELECT r.iid, r.review_id, r.uid, r.stars, r.date, i.name, i.state, i.is_open
    FROM reviews r JOIN items i ON r.iid = i.iid"""), ops="P2")
def q_proj_drop(spark, d):
    return fx.fx_reviews(spark, d).join(fx.fx_items(spark, d), "iid").drop("brand", "categories")


@register("proj_rating_triples", with_ctes([R], "SELECT uid, iid, stars FROM reviews"), ops="P3")
def q_proj_triples(spark, d):
    return fx.fx_reviews(spark, d).select("uid", "iid", "stars")


# ----------------------------------------------------------------- filters

@register("filter_state", with_ctes([I], f"SELECT {ITEM_COLS} FROM items WHERE state = '{ST}'"), ops="P4")
def q_filter_state(spark, d):
    return fx.fx_items(spark, d).where(F.col("state") == ST)


@register("filter_category_like", with_ctes([I], f"""
    SELECT {ITEM_COLS} FROM items WHERE categories LIKE '%{fx.DEMO_CATEGORY}%' AND state = '{ST}'"""), ops="P5")
def q_filter_like(spark, d):
    return fx.fx_items(spark, d).where(F.col("categories").like(f"%{fx.DEMO_CATEGORY}%") & (F.col("state") == ST))


@register("filter_regex_contains", with_ctes([I], f"SELECT {ITEM_COLS} FROM items WHERE regexp_matches(name, 'ring|gear')"),
          ops="P6")
def q_filter_regex(spark, d):
    return fx.fx_items(spark, d).where(F.col("name").rlike("ring|gear"))


@register("filter_regex_prefix", with_ctes([I], f"SELECT {ITEM_COLS} FROM items WHERE regexp_matches(name, '^(?:red)')"),
          ops="P7 Q14")
def q_filter_prefix(spark, d):
    return fx.fx_items(spark, d).where(F.col("name").rlike("^(?:red)"))


@register("filter_not_null", with_ctes([R, I], f"""
    SELECT r.review_id, r.uid, r.iid, i.name, i.categories FROM reviews r
    LEFT JOIN (SELECT * FROM items WHERE state = '{ST}') i ON r.iid = i.iid
    WHERE i.categories IS NOT NULL"""), ops="P8")
def q_filter_not_null(spark, d):
    j = fx.fx_reviews(spark, d).join(fx.fx_items(spark, d).where(F.col("state") == ST), "iid", "left")
    return j.na.drop(subset=["categories"]).select("review_id", "uid", "iid", "name", "categories")


@register("filter_since_year", with_ctes([R], f"SELECT {ROWS} FROM reviews WHERE date >= TIMESTAMP '{fx.SINCE_YEAR}-01-01'"),
          ops="P9")
def q_filter_since(spark, d):
    return fx.fx_reviews(spark, d).where(F.col("date") >= year_start(fx.SINCE_YEAR))


@register("filter_open_items", with_ctes([I], f"SELECT {ITEM_COLS} FROM items WHERE is_open = 1"), ops="P10")
def q_filter_open(spark, d):
    return fx.fx_items(spark, d).where(F.col("is_open") == 1)


DEV_N = 10000


@register("limit_dev_sample", with_ctes([R], f"SELECT {ROWS} FROM reviews ORDER BY {ROWS} LIMIT {DEV_N}"), ops="P11")
def q_limit_dev(spark, d):
    # the dev sample is the feature: first N rows in a total order (TakeOrderedAndProject)
    return fx.fx_reviews(spark, d).orderBy(*ROWS.split(", ")).limit(DEV_N)


@register("distinct_names", with_ctes([I], "SELECT DISTINCT name FROM items"), ops="P12")
def q_distinct_names(spark, d):
    return fx.fx_items(spark, d).select("name").distinct()


@register("dedupe_first_per_item", with_ctes([R, I], """
    SELECT iid, name, review_id, uid, date FROM (
      SELECT r.iid, i.name, r.review_id, r.uid, r.date, r.stars,
             row_number() OVER (PARTITION BY r.iid ORDER BY r.date, r.review_id, r.uid, r.stars) AS rn
      FROM reviews r JOIN items i ON r.iid = i.iid) WHERE rn = 1"""), ops="P13")
def q_dedupe_first(spark, d):
    j = fx.fx_reviews(spark, d).join(fx.fx_items(spark, d).select("iid", "name"), "iid")
    # arg-min by a total order as an aggregate: partial (map-side) per item, no large window group
    first = j.groupBy("iid").agg(F.min(F.struct("date", "review_id", "uid", "stars", "name")).alias("f"))
    return first.select("iid", F.col("f.name").alias("name"), F.col("f.review_id").alias("review_id"),
                        F.col("f.uid").alias("uid"), F.col("f.date").alias("date"))


@register("filter_name_not_in", with_ctes([I], f"SELECT {ITEM_COLS} FROM items WHERE name NOT IN ({SELS})"),
          ops="P14")
def q_name_not_in(spark, d):
    return fx.fx_items(spark, d).where(~F.col("name").isin(list(fx.DEMO_SELECTIONS)))


NTH = 3


@register("nth_review_of_user", with_ctes([R], f"""
    SELECT {ROWS} FROM reviews WHERE uid = (SELECT uid FROM reviews WHERE uid IS NOT NULL GROUP BY uid
                                            ORDER BY count(*) DESC, uid LIMIT 1)
    ORDER BY date, review_id, iid, stars LIMIT 1 OFFSET {NTH - 1}"""), ops="P15")
def q_nth_review(spark, d):
    rv = fx.fx_reviews(spark, d)
    heavy = (rv.where(F.col("uid").isNotNull()).groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), F.col("uid").asc()).limit(1).select("uid"))
    # one user's rows, globally sorted; offset/limit keep n rows in the final task
    return (rv.join(F.broadcast(heavy), "uid", "left_semi")
              .orderBy("date", "review_id", "iid", "stars").offset(NTH - 1).limit(1)
              .select(*ROWS.split(", ")))


# ------------------------------------------------------------------- joins

@register("join_left_reviews_items", with_ctes([R, I], f"""
    SELECT r.iid, r.review_id, r.uid, r.stars, r.date, i.name, i.state, i.is_open
    FROM reviews r LEFT JOIN (SELECT * FROM items WHERE state = '{ST}') i ON r.iid = i.iid"""), ops="J1 Q11")
def q_join_left(spark, d):
    return load_reviews(fx.fx_reviews(spark, d), fx.fx_items(spark, d), state=ST, how="left") \
        .select("iid", "review_id", "uid", "stars", "date", "name", "state", "is_open")


@register("join_inner_reviews_items", with_ctes([R, I], f"""
    SELECT r.iid, r.review_id, r.uid, r.stars, r.date, i.name, i.state, i.is_open
    FROM reviews r JOIN items i ON r.iid = i.iid WHERE i.state = '{ST}'"""), ops="J2")
def q_join_inner(spark, d):
    return load_reviews(fx.fx_reviews(spark, d), fx.fx_items(spark, d), state=ST) \
        .select("iid", "review_id", "uid", "stars", "date", "name", "state", "is_open")


@register("join_semi_active_users", with_ctes([R], f"""
    SELECT {ROWS} FROM reviews WHERE date >= TIMESTAMP '{fx.SINCE_YEAR}-01-01' AND uid IN (
      SELECT uid FROM reviews WHERE date >= TIMESTAMP '{fx.SINCE_YEAR}-01-01' AND uid IS NOT NULL
      AND review_id IS NOT NULL GROUP BY uid HAVING count(DISTINCT review_id) >= 15)"""), ops="J3")
def q_join_semi(spark, d):
    from recspark.operators.trim import since_year, trim_users
    return trim_users(since_year(fx.fx_reviews(spark, d), fx.SINCE_YEAR), 15)


@register("join_anti_selected_names", with_ctes([R, I, fx.requests_cte()], """
    SELECT r.review_id, r.uid, r.iid, i.name FROM reviews r JOIN items i ON r.iid = i.iid
    WHERE NOT EXISTS (SELECT 1 FROM requests q WHERE q.name = i.name)"""), ops="J4")
def q_join_anti(spark, d):
    j = fx.fx_reviews(spark, d).join(fx.fx_items(spark, d).select("iid", "name"), "iid")
    picked = F.broadcast(fx.fx_requests(spark).select("name").distinct())  # fixed-size argument table
    return j.join(picked, "name", "left_anti").select("review_id", "uid", "iid", "name")
