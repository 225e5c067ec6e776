"""Trimming, co-rating sums, similarities, item map and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.functions.exprs import r6
from recspark.operators.indexing import item_map, item_map_by_name
from recspark.operators.patterns import pattern_names
from recspark.operators.recommend import latest_names_requests, mean_similarity, recommend, resolve_picks
from recspark.operators.similarity import mirror, pair_sums, similarity
from recspark.operators.trim import since_year, trim, trim_items, trim_users
from recspark.plans import fixture as fx
from recspark.plans.registry import register, with_ctes
from recspark.session import materialize

ROW_COLS = "review_id, uid, iid, stars, date"

# ------------------------------------------------------------------ trimming


@register("trim_users", with_ctes(
    [fx.REVIEWS],
    f"SELECT {ROW_COLS} FROM reviews WHERE uid IN (SELECT uid FROM reviews WHERE uid IS NOT NULL "
    f"AND review_id IS NOT NULL GROUP BY uid HAVING count(DISTINCT review_id) >= 15)"), ops="K1 J3")
def q_trim_users(spark, d):
    return trim_users(fx.fx_reviews(spark, d), 15)


@register("trim_items", with_ctes(
    [fx.REVIEWS],
    f"SELECT {ROW_COLS} FROM reviews WHERE iid IN (SELECT iid FROM reviews WHERE iid IS NOT NULL "
    f"AND uid IS NOT NULL GROUP BY iid HAVING count(DISTINCT uid) >= 20)"), ops="K2")
def q_trim_items(spark, d):
    return trim_items(fx.fx_reviews(spark, d), 20)


@register("trim_user_item_user", with_ctes(fx.RATINGS, f"SELECT {ROW_COLS} FROM ratings"), ops="K3 P9")
def q_trim_user_item_user(spark, d):
    return fx.fx_ratings(spark, d)


@register("trim_user_item", with_ctes(
    fx.trim_ctes(out="r2", steps=(("user", 15), ("item", 20)), prefix="k"),
    f"SELECT {ROW_COLS} FROM r2"), ops="K4")
def q_trim_user_item(spark, d):
    return trim(since_year(fx.fx_reviews(spark, d), fx.SINCE_YEAR), (("user", 15), ("item", 20)))


# ---------------------------------------------------------- co-rating sums

@register("join_corated_pairs", with_ctes(
    fx.RATINGS + fx.pair_sum_ctes(), "SELECT i, j, n, sx, sy, sxx, syy, sxy FROM pairsums"), ops="J6")
def q_join_corated_pairs(spark, d):
    return fx.fx_sums(spark, d)


@register("join_corated_pairs_full", with_ctes(
    [fx.REVIEWS] + fx.pair_sum_ctes(src="reviews"),
    "SELECT i, count(*) AS pairs, CAST(sum(n) AS BIGINT) AS n, CAST(sum(sx) AS BIGINT) AS sx, CAST(sum(sy) AS BIGINT) AS sy, "
    "CAST(sum(sxy) AS BIGINT) AS sxy, max(j) AS last_j FROM pairsums GROUP BY i"), ops="J6")
def q_join_corated_pairs_full(spark, d):
    """All reviews, untrimmed: every co-rated pair is made, then totalled per first item."""
    pairs = pair_sums(fx.fx_reviews(spark, d))
    return pairs.groupBy("i").agg(F.count(F.lit(1)).alias("pairs"), *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy")],
                                  F.max("j").alias("last_j"))


def _sim_query(metric):
    def build(spark, d):
        s = fx.fx_sims(spark, d, metric)
        return s.select("i", "j", "n", r6("sim").alias("sim"))
    return build


for _m, _ops in (("cosine", "M1"), ("msd", "M2"), ("pearson", "M3")):
    register(f"sim_{_m}", with_ctes(
        fx.RATINGS + fx.pair_sum_ctes() + fx.sims_ctes(_m),
        "SELECT i, j, n, round(sim, 6) AS sim FROM sims"), ops=_ops)(_sim_query(_m))


@register("sim_cosine_users", with_ctes(
    fx.RATINGS + fx.pair_sum_ctes(user="iid", item="uid", out="upairs")
    + fx.sims_ctes("cosine", src="upairs", out="usims"),
    "SELECT i, j, n, round(sim, 6) AS sim FROM usims"), ops="M5 Q1")
def q_sim_cosine_users(spark, d):
    sums = pair_sums(fx.fx_ratings(spark, d), user="iid", item="uid", min_support=fx.MIN_SUPPORT)
    s = similarity(sums, "cosine", fx.MIN_SUPPORT)
    return s.select("i", "j", "n", r6("sim").alias("sim"))


@register("sim_matrix_long", with_ctes(
    fx.RATINGS + fx.pair_sum_ctes() + fx.sims_ctes() + fx.mirrored_ctes(),
    "SELECT i, j, n, round(sim, 6) AS sim FROM simsm"), ops="M6")
def q_sim_matrix_long(spark, d):
    ratings = fx.fx_ratings(spark, d)
    s = mirror(similarity(pair_sums(ratings, min_support=fx.MIN_SUPPORT), "cosine", fx.MIN_SUPPORT), ratings)
    return s.select("i", "j", "n", r6("sim").alias("sim"))


# ------------------------------------------------------------------ item map

ITEM_MAP_SQL = [
    fx.ITEMS, fx.patterns_cte(),
    """counts AS (SELECT iid, count(*) AS n_reviews FROM ratings WHERE iid IS NOT NULL GROUP BY iid)""",
    """cand AS (SELECT p.pattern, p.match, i.iid, i.name, c.n_reviews
       FROM items i JOIN counts c ON i.iid = c.iid JOIN patterns p
       ON CASE WHEN p.match THEN regexp_matches(i.name, '^(?:' || p.pattern || ')')
               ELSE regexp_matches(i.name, p.pattern) END)""",
    """itemmap AS (SELECT pattern, match, iid, name, n_reviews FROM (
         SELECT *, row_number() OVER (PARTITION BY pattern, match ORDER BY n_reviews DESC, iid) AS rn
         FROM cand) WHERE rn = 1)""",
]


@register("item_map_best_location", with_ctes(
    fx.RATINGS + ITEM_MAP_SQL, "SELECT pattern, match, iid, name, n_reviews FROM itemmap"),
    ops="I1 J5 J7 W4 P6 P7")
def q_item_map(spark, d):
    return item_map(fx.fx_ratings(spark, d), fx.fx_items(spark, d), fx.fx_patterns(spark))


@register("join_pattern_items", with_ctes(
    [fx.ITEMS, fx.patterns_cte()],
    """SELECT p.pattern, p.match, i.iid, i.name FROM items i JOIN patterns p
       ON CASE WHEN p.match THEN regexp_matches(i.name, '^(?:' || p.pattern || ')')
               ELSE regexp_matches(i.name, p.pattern) END"""), ops="J5")
def q_join_pattern_items(spark, d):
    items = fx.fx_items(spark, d).select("iid", "name")
    return items.join(pattern_names(items, fx.fx_patterns(spark)), "name").select("pattern", "match", "iid", "name")


# ------------------------------------------------------------ recommendation

REC_SQL = fx.RATINGS + fx.pair_sum_ctes() + fx.sims_ctes() + fx.mirrored_ctes() + ITEM_MAP_SQL + [
    fx.requests_cte(),
    """picks AS (SELECT DISTINCT r.request_id, m.iid FROM requests r JOIN itemmap m ON r.name = m.name)""",
    """npicks AS (SELECT request_id, count(*) AS m FROM picks GROUP BY request_id)""",
    """scores AS (SELECT p.request_id, s.i AS iid, sum(s.sim) / max(np.m) AS score
       FROM picks p JOIN simsm s ON s.j = p.iid JOIN npicks np ON np.request_id = p.request_id
       GROUP BY p.request_id, s.i)""",
]


def _rated_items(items, ratings):
    """The items of the rating matrix: all of them are ranked for a request."""
    return items.join(ratings.select("iid").distinct(), "iid", "left_semi")


def _demo_scores(spark, d):
    ratings = fx.fx_ratings(spark, d)
    items = _rated_items(fx.fx_items(spark, d), ratings)
    sims = mirror(similarity(pair_sums(ratings, min_support=fx.MIN_SUPPORT), "cosine", fx.MIN_SUPPORT), ratings)
    imap = item_map(ratings, items, fx.fx_patterns(spark))
    reqs = fx.fx_requests(spark)
    return materialize(mean_similarity(sims, resolve_picks(reqs, imap)), "scores"), items, reqs


@register("rec_mean_similarity", with_ctes(
    REC_SQL, "SELECT request_id, iid, round(score, 6) AS score FROM scores"), ops="R1 R2")
def q_rec_mean_similarity(spark, d):
    scores, _, _ = _demo_scores(spark, d)
    return scores.select("request_id", "iid", r6("score").alias("score"))


REC_TOP_SQL = REC_SQL + [
    """named AS (SELECT p.request_id, i.iid, i.name, i.is_open, COALESCE(s.score, 0.0) AS score
       FROM npicks p CROSS JOIN (SELECT * FROM items WHERE iid IN (SELECT iid FROM ratings)) i
       LEFT JOIN scores s ON s.request_id = p.request_id AND s.iid = i.iid)""",
]


@register("rec_top_n", with_ctes(REC_TOP_SQL, f"""
    SELECT request_id, rank, iid, name, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(score, 9) DESC, iid) AS rank
      FROM named n WHERE is_open = 1
        AND NOT EXISTS (SELECT 1 FROM requests r WHERE r.request_id = n.request_id AND r.name = n.name))
    WHERE rank <= {fx.TOP_N}"""), ops="R3 W2 J4 P10 P14")
def q_rec_top_n(spark, d):
    scores, items, reqs = _demo_scores(spark, d)
    out = recommend(scores, items, reqs, fx.TOP_N, "filter_then_pick")
    return out.withColumn("score", r6("score"))


@register("rec_pick_then_filter", with_ctes(REC_TOP_SQL, f"""
    SELECT request_id, rank, iid, name, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(score, 9) DESC, iid) AS rank
      FROM named) n
    WHERE rank <= {fx.TOP_N + 2} AND is_open = 1
      AND NOT EXISTS (SELECT 1 FROM requests r WHERE r.request_id = n.request_id AND r.name = n.name)"""),
    ops="R4 Q7")
def q_rec_pick_then_filter(spark, d):
    scores, items, reqs = _demo_scores(spark, d)
    out = recommend(scores, items, reqs, fx.TOP_N, "pick_then_filter")
    return out.withColumn("score", r6("score"))


BATCH_SQL = fx.RATINGS + fx.pair_sum_ctes() + fx.sims_ctes() + fx.mirrored_ctes() + [
    fx.ITEMS,
    """bcounts AS (SELECT iid, count(*) AS n_reviews FROM ratings GROUP BY iid)""",
    """bymap AS (SELECT name, iid FROM (
         SELECT i.name, i.iid, row_number() OVER (PARTITION BY i.name ORDER BY c.n_reviews DESC, i.iid) AS rn
         FROM items i JOIN bcounts c ON i.iid = c.iid WHERE i.name IS NOT NULL) WHERE rn = 1)""",
    """lastn AS (SELECT r.uid, i.name, max(r.date) AS d,
         max_by(r.review_id, struct_pack(d := r.date, r := r.review_id)) AS rid
       FROM ratings r JOIN items i ON r.iid = i.iid GROUP BY r.uid, i.name)""",
    """breq AS (SELECT uid AS request_id, name FROM (
         SELECT *, row_number() OVER (PARTITION BY uid ORDER BY d DESC, rid DESC, name) AS pos FROM lastn)
       WHERE pos <= 4)""",
    """bpicks AS (SELECT DISTINCT q.request_id, m.iid FROM breq q JOIN bymap m ON q.name = m.name)""",
    """bnp AS (SELECT request_id, count(*) AS m FROM bpicks GROUP BY request_id)""",
    """bscores AS (SELECT p.request_id, s.i AS iid, sum(s.sim) / max(np.m) AS score
       FROM bpicks p JOIN simsm s ON s.j = p.iid JOIN bnp np ON np.request_id = p.request_id
       GROUP BY p.request_id, s.i)""",
    """bnamed AS (SELECT p.request_id, i.iid, i.name, i.is_open, COALESCE(s.score, 0.0) AS score
       FROM bnp p CROSS JOIN (SELECT * FROM items WHERE iid IN (SELECT iid FROM ratings)) i
       LEFT JOIN bscores s ON s.request_id = p.request_id AND s.iid = i.iid)""",
]


@register("rec_batch_requests", with_ctes(BATCH_SQL, f"""
    SELECT request_id, rank, iid, name, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(score, 9) DESC, iid) AS rank
      FROM bnamed n WHERE is_open = 1
        AND NOT EXISTS (SELECT 1 FROM breq r WHERE r.request_id = n.request_id AND r.name = n.name))
    WHERE rank <= {fx.TOP_N}"""), ops="R6 R1 R3")
def q_rec_batch_requests(spark, d):
    ratings = fx.fx_ratings(spark, d)
    items = materialize(_rated_items(fx.fx_items(spark, d), ratings), "rated-items")
    sims = mirror(similarity(pair_sums(ratings, min_support=fx.MIN_SUPPORT), "cosine", fx.MIN_SUPPORT), ratings)
    reqs = materialize(latest_names_requests(ratings, items, 4), "requests")
    picks = materialize(resolve_picks(reqs, item_map_by_name(ratings, items)), "picks")
    # only the lists of picked items take part; they are few, so the join below can go by their measured size
    picked = sims.join(picks.select(F.col("iid").alias("j")).distinct(), "j", "left_semi")
    scores = materialize(mean_similarity(picked, picks), "scores")
    out = recommend(scores, items, reqs, fx.TOP_N, "filter_then_pick")
    return out.withColumn("score", r6("score"))


def flagship(spark, d):
    """Minimum slice: trimmed ratings -> cosine (n>=2) -> item map -> top 3 open items."""
    return q_rec_top_n(spark, d)

