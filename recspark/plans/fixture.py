"""Fixture views and parameters shared by the registered queries, in both
engines: Spark builders and the equal DuckDB SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recspark.operators.similarity import pair_sums, similarity
from recspark.operators.trim import since_year, trim
from recspark.sources.tables import items as items_view
from recspark.sources.tables import reviews as reviews_view

# Fixture parameters (chosen for the generated tables, see SURVEY "Fixture mapping").
SINCE_YEAR = 1997
TRIM_STEPS = (("user", 15), ("item", 20), ("user", 15))
MIN_SUPPORT = 2
SHRINKAGE = 100
DEMO_STATE = "NATION_7"
DEMO_CATEGORY = "ECONOMY"
DEMO_SELECTIONS = ("small ring", "red widget", "blue bolt", "hot gear")
DEMO_PATTERNS = (
    ("small ring", False), ("red widget", False), ("blue bolt", False), ("hot gear", False),
    ("ring", False), ("red", True), ("cold anvil", False), ("plate$", False),
    ("^new", False), ("purple", False),
)
HOLDOUT_PERCENT = 10
K_FOLDS = 5
TOP_N = 3


# ------------------------------------------------------------------ Spark side

def fx_reviews(spark: SparkSession, d: str) -> DataFrame:
    return reviews_view(spark, d)


def fx_items(spark: SparkSession, d: str) -> DataFrame:
    return items_view(spark, d)


def fx_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Reviews since 1997, trimmed users>=15, items>=20, users>=15.

    Each stage is checkpointed: a lazy chain of semi-joins would re-run the
    upstream scan and join once per branch (2^steps times).
    """
    return trim(since_year(fx_reviews(spark, d), SINCE_YEAR), TRIM_STEPS, materialize="checkpoint")


def fx_sums(spark: SparkSession, d: str) -> DataFrame:
    return pair_sums(fx_ratings(spark, d))


def fx_sims(spark: SparkSession, d: str, metric: str = "cosine", min_support: int = MIN_SUPPORT) -> DataFrame:
    return similarity(pair_sums(fx_ratings(spark, d), min_support=min_support), metric, min_support, SHRINKAGE)


def fx_requests(spark: SparkSession) -> DataFrame:
    rows = [(1, n) for n in DEMO_SELECTIONS]
    return spark.createDataFrame(rows, "request_id long, name string")


def fx_patterns(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEMO_PATTERNS), "pattern string, match boolean")


# -------------------------------------------------------------------- SQL side

REVIEWS = """reviews AS (
  SELECT l_orderkey*8 + l_linenumber AS review_id, o_custkey AS uid, l_partkey AS iid,
         CAST(1 + floor((l_quantity-1)/10) AS INT) AS stars, l_shipdate AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ITEMS = """items AS (
  SELECT p_partkey AS iid, p_name AS name, p_brand AS brand, p_type AS categories, n_name AS state,
         CASE WHEN p_size % 5 <> 0 THEN 1 ELSE 0 END AS is_open
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey)"""


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_ctes(src: str = "reviews", out: str = "ratings", year: int | None = SINCE_YEAR,
              steps=TRIM_STEPS, prefix: str = "t") -> list[str]:
    ctes = [REVIEWS] if src == "reviews" else []
    cur = f"{prefix}0"
    where = f"WHERE date >= TIMESTAMP '{year:04d}-01-01'" if year is not None else ""
    ctes.append(f"{cur} AS (SELECT * FROM {src} {where})")
    for n, (kind, t) in enumerate(steps, start=1):
        key, counted = ("uid", "review_id") if kind == "user" else ("iid", "uid")
        nxt = f"{prefix}{n}" if n < len(steps) else out
        ctes.append(
            f"{nxt} AS (SELECT * FROM {cur} WHERE {key} IN (SELECT {key} FROM {cur} "
            f"WHERE {key} IS NOT NULL AND {counted} IS NOT NULL GROUP BY {key} "
            f"HAVING count(DISTINCT {counted}) >= {t}))")
        cur = nxt
    if not steps:
        ctes.append(f"{out} AS (SELECT * FROM {cur})")
    return ctes


RATINGS = trim_ctes()


def pair_sum_ctes(src: str = "ratings", out: str = "pairsums", user: str = "uid", item: str = "iid",
                  value: str = "stars", by: tuple = (), integer: bool = True) -> list[str]:
    byc = "".join(f"{b}, " for b in by)
    on_by = "".join(f" AND a.{b} = b.{b}" for b in by)
    sel_by = "".join(f"a.{b} AS {b}, " for b in by)
    t = "BIGINT" if integer else "DOUBLE"
    v = f"CAST({value} AS DOUBLE)" if not integer else value
    cells = (f"{out}_cells AS (SELECT {byc}{user} AS u, {item} AS it, count(*) AS c, sum({v}) AS s, "
             f"sum({v}*{v}) AS q FROM {src} WHERE {user} IS NOT NULL AND {item} IS NOT NULL "
             f"AND {value} IS NOT NULL GROUP BY {byc}{user}, {item})")
    sums = (f"{out} AS (SELECT {sel_by}a.it AS i, b.it AS j, CAST(sum(a.c*b.c) AS BIGINT) AS n, "
            f"CAST(sum(a.s*b.c) AS {t}) AS sx, CAST(sum(a.c*b.s) AS {t}) AS sy, "
            f"CAST(sum(a.q*b.c) AS {t}) AS sxx, CAST(sum(a.c*b.q) AS {t}) AS syy, "
            f"CAST(sum(a.s*b.s) AS {t}) AS sxy "
            f"FROM {out}_cells a JOIN {out}_cells b ON a.u = b.u AND a.it < b.it{on_by} "
            f"GROUP BY {''.join(f'a.{b}, ' for b in by)}a.it, b.it)")
    return [cells, sums]


def sim_sql(metric: str, shrinkage: float = SHRINKAGE) -> str:
    n = "CAST(n AS DOUBLE)"
    sx, sy, sxx, syy, sxy = (f"CAST({c} AS DOUBLE)" for c in ("sx", "sy", "sxx", "syy", "sxy"))
    if metric == "cosine":
        return f"CASE WHEN sqrt({sxx}*{syy}) > 0 THEN {sxy}/sqrt({sxx}*{syy}) ELSE 0.0 END"
    if metric == "msd":
        return f"1.0/(({sxx} + {syy} - 2.0*{sxy})/{n} + 1.0)"
    if metric == "pearson":
        den = f"sqrt(({n}*{sxx} - {sx}*{sx})*({n}*{syy} - {sy}*{sy}))"
        return f"CASE WHEN {den} > 0 THEN ({n}*{sxy} - {sx}*{sy})/{den} ELSE 0.0 END"
    if metric == "pearson_baseline":
        den = f"sqrt({sxx}*{syy})"
        return (f"CASE WHEN {den} > 0 THEN {sxy}/{den}*(({n} - 1)/({n} - 1 + {float(shrinkage)})) "
                f"ELSE 0.0 END")
    raise ValueError(metric)


def sims_ctes(metric: str = "cosine", min_support: int = MIN_SUPPORT, src: str = "pairsums",
              out: str = "sims", by: tuple = ()) -> list[str]:
    byc = "".join(f"{b}, " for b in by)
    return [f"{out} AS (SELECT {byc}i, j, n, {sim_sql(metric)} AS sim FROM {src} WHERE n >= {min_support})"]


def mirrored_ctes(src: str = "sims", out: str = "simsm", diag_src: str | None = "ratings",
                  by: tuple = ()) -> list[str]:
    byc = "".join(f"{b}, " for b in by)
    body = (f"SELECT {byc}i, j, n, sim FROM {src} UNION ALL SELECT {byc}j AS i, i AS j, n, sim FROM {src}")
    if diag_src:
        body += (f" UNION ALL SELECT DISTINCT {byc}iid AS i, iid AS j, CAST(0 AS BIGINT) AS n, 1.0 AS sim "
                 f"FROM {diag_src}")
    return [f"{out} AS ({body})"]


def requests_cte(name: str = "requests") -> str:
    vals = ", ".join(f"(CAST(1 AS BIGINT), {sql_str(n)})" for n in DEMO_SELECTIONS)
    return f"{name}(request_id, name) AS (VALUES {vals})"


def patterns_cte(name: str = "patterns") -> str:
    vals = ", ".join(f"({sql_str(p)}, {'true' if m else 'false'})" for p, m in DEMO_PATTERNS)
    return f"{name}(pattern, match) AS (VALUES {vals})"
