"""DuckDB twins of the model queries: CTE builders with optional ``by`` keys
(cross-validation folds).  This is the brute-force oracle side only."""

from __future__ import annotations

import math

from recspark.functions.exprs import LEHMER_MOD, LEHMER_MUL_A, LEHMER_MUL_B
from recspark.plans import fixture as fx


def _s(by, a=None):
    """select prefix: 'a.cv_fold, '"""
    return "".join(f"{a + '.' if a else ''}{b}, " for b in by)


def _j(by, a, b):
    """join condition suffix: ' AND a.cv_fold = b.cv_fold'"""
    return "".join(f" AND {a}.{c} = {b}.{c}" for c in by)


def _g(by, a=None):
    return ", ".join(f"{a + '.' if a else ''}{b}" for b in by)


def split_ctes(src="ratings", pct=fx.HOLDOUT_PERCENT, swap: bool = False) -> list[str]:
    """train/test hold-out; ``swap`` exchanges the user and item columns (user-based models)."""
    cols = "review_id, iid AS uid, uid AS iid, stars, date" if swap else "review_id, uid, iid, stars, date"
    return [f"split AS (SELECT *, (review_id + 3*iid + 7*uid) % 100 < {pct} AS is_test FROM {src})",
            f"train AS (SELECT {cols} FROM split WHERE NOT is_test)",
            f"test AS (SELECT {cols} FROM split WHERE is_test)"]


def fold_ctes(k: int, src="ratings") -> list[str]:
    mix = "(r.review_id + 3*r.iid + 7*r.uid)"
    return [f"folds AS (SELECT CAST(unnest(range({k})) AS INT) AS cv_fold)",
            f"train AS (SELECT f.cv_fold, r.review_id, r.uid, r.iid, r.stars, r.date FROM {src} r, folds f "
            f"WHERE CAST({mix} % {k} AS INT) <> f.cv_fold)",
            f"test AS (SELECT CAST({mix} % {k} AS INT) AS cv_fold, r.review_id, r.uid, r.iid, r.stars, r.date "
            f"FROM {src} r)"]


def mean_cte(by=(), src="train", out="gmu") -> str:
    grp = f" GROUP BY {_g(by)}" if by else ""
    return f"{out} AS (SELECT {_s(by)}avg(CAST(stars AS DOUBLE)) AS mu, stddev_pop(CAST(stars AS DOUBLE)) AS sd_all FROM {src}{grp})"


def _mu_join(by, alias="t", m="gmu"):
    return f"JOIN {m} m ON true{_j(by, alias, 'm')}"


def baseline_als_ctes(reg_i, reg_u, epochs, by=(), src="train", prefix="b") -> tuple[list[str], str, str]:
    """Returns (ctes, final bu name, final bi name); needs gmu."""
    ctes = []
    bu = None
    for e in range(1, epochs + 1):
        bu_term = "0.0" if bu is None else "COALESCE(u.bu, 0.0)"
        bu_join = "" if bu is None else f" LEFT JOIN {bu} u ON u.uid = t.uid{_j(by, 't', 'u')}"
        bi = f"{prefix}i{e}"
        ctes.append(f"{bi} AS (SELECT {_s(by, 't')}t.iid, sum(t.stars - m.mu - {bu_term}) / ({float(reg_i)} + count(*)) AS bi "
                    f"FROM {src} t {_mu_join(by)}{bu_join} GROUP BY {_s(by, 't')}t.iid)")
        bu = f"{prefix}u{e}"
        ctes.append(f"{bu} AS (SELECT {_s(by, 't')}t.uid, sum(t.stars - m.mu - COALESCE(i.bi, 0.0)) / ({float(reg_u)} + count(*)) AS bu "
                    f"FROM {src} t {_mu_join(by)} LEFT JOIN {bi} i ON i.iid = t.iid{_j(by, 't', 'i')} "
                    f"GROUP BY {_s(by, 't')}t.uid)")
    return ctes, bu, f"{prefix}i{epochs}"


def baseline_gd_ctes(lr, reg, epochs, by=(), src="train", prefix="g") -> tuple[list[str], str, str]:
    ctes = [f"{prefix}u0 AS (SELECT DISTINCT {_s(by)}uid, 0.0 AS bu FROM {src})",
            f"{prefix}i0 AS (SELECT DISTINCT {_s(by)}iid, 0.0 AS bi FROM {src})"]
    for e in range(1, epochs + 1):
        pu, pi = f"{prefix}u{e - 1}", f"{prefix}i{e - 1}"
        err = f"{prefix}e{e}"
        ctes.append(f"{err} AS (SELECT {_s(by, 't')}t.uid, t.iid, u.bu, i.bi, t.stars - m.mu - u.bu - i.bi AS err "
                    f"FROM {src} t {_mu_join(by)} JOIN {pu} u ON u.uid = t.uid{_j(by, 't', 'u')} "
                    f"JOIN {pi} i ON i.iid = t.iid{_j(by, 't', 'i')})")
        ctes.append(f"{prefix}u{e} AS (SELECT {_s(by)}uid, first(bu) + {lr} * (sum(err) - {reg} * count(*) * first(bu)) AS bu "
                    f"FROM {err} GROUP BY {_s(by)}uid)")
        ctes.append(f"{prefix}i{e} AS (SELECT {_s(by)}iid, first(bi) + {lr} * (sum(err) - {reg} * count(*) * first(bi)) AS bi "
                    f"FROM {err} GROUP BY {_s(by)}iid)")
    return ctes, f"{prefix}u{epochs}", f"{prefix}i{epochs}"


def clip_sql(x: str) -> str:
    return f"least(greatest({x}, 1.0), 5.0)"


def std_normal_sql(key: str, seed: int) -> str:
    def uni(s, mul):
        state = f"(({key}) % {LEHMER_MOD - 1} + {s % (LEHMER_MOD - 1)} + 1) % {LEHMER_MOD}"
        return f"((({state}) * {mul}) % {LEHMER_MOD} + 0.5) / {float(LEHMER_MOD)}"
    return f"(sqrt(-2.0 * ln({uni(seed, LEHMER_MUL_A)})) * cos({repr(2.0 * math.pi)} * {uni(seed + 1, LEHMER_MUL_B)}))"


def knn_ctes(kind: str, k: int, min_k: int, by=(), sims="simsm", bu=None, bi=None,
             out="pred") -> list[str]:
    """Prediction per test row -> CTE ``out`` (by.., review_id, uid, iid, stars, est, actual_k).

    Needs train, test, gmu, the mirrored similarity table, and for
    'baseline' the final bias CTEs bu/bi.
    """
    c = []
    c.append(f"{out}_t AS (SELECT DISTINCT {_s(by)}uid, iid FROM test)")
    c.append(f"{out}_cand AS (SELECT {_s(by, 't')}t.uid, t.iid, s.j, s.n, s.sim, CAST(tr.stars AS DOUBLE) AS r_j, "
             f"tr.review_id AS rid_j FROM {out}_t t JOIN {sims} s ON s.i = t.iid AND s.sim > 0{_j(by, 't', 's')} "
             f"JOIN train tr ON tr.uid = t.uid AND tr.iid = s.j{_j(by, 't', 'tr')})")
    c.append(f"{out}_nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_s(by)}uid, iid "
             f"ORDER BY round(sim, 9) DESC, n DESC, j, rid_j, r_j) AS rank FROM {out}_cand) WHERE rank <= {k})")
    if kind in ("means", "zscore"):
        c.append(f"{out}_is AS (SELECT {_s(by)}iid, avg(CAST(stars AS DOUBLE)) AS mean, "
                 f"stddev_pop(CAST(stars AS DOUBLE)) AS sd FROM train GROUP BY {_s(by)}iid)")
    if kind == "basic":
        adj, src = "nb.r_j", f"{out}_nb nb"
    elif kind == "means":
        adj = "(nb.r_j - st.mean)"
        src = f"{out}_nb nb JOIN {out}_is st ON st.iid = nb.j{_j(by, 'nb', 'st')}"
    elif kind == "zscore":
        adj = "(nb.r_j - st.mean) / (CASE WHEN st.sd > 0 THEN st.sd ELSE m.sd_all END)"
        src = (f"{out}_nb nb JOIN {out}_is st ON st.iid = nb.j{_j(by, 'nb', 'st')} "
               f"JOIN gmu m ON true{_j(by, 'nb', 'm')}")
    else:
        adj = "(nb.r_j - (m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0)))"
        src = (f"{out}_nb nb JOIN gmu m ON true{_j(by, 'nb', 'm')} "
               f"LEFT JOIN {bu} u ON u.uid = nb.uid{_j(by, 'nb', 'u')} LEFT JOIN {bi} i ON i.iid = nb.j{_j(by, 'nb', 'i')}")
    c.append(f"{out}_agg AS (SELECT {_s(by, 'nb')}nb.uid, nb.iid, sum(nb.sim) AS sum_sim, sum(nb.sim * {adj}) AS sum_w, "
             f"count(*) AS actual_k FROM {src} GROUP BY {_s(by, 'nb')}nb.uid, nb.iid)")
    c.append(f"{out}_ku AS (SELECT DISTINCT {_s(by)}uid FROM train)")
    c.append(f"{out}_ki AS (SELECT DISTINCT {_s(by)}iid FROM train)")
    known = (f"(EXISTS (SELECT 1 FROM {out}_ku x WHERE x.uid = t.uid{_j(by, 'x', 't')}) AND "
             f"EXISTS (SELECT 1 FROM {out}_ki y WHERE y.iid = t.iid{_j(by, 'y', 't')}))")
    enough = f"(COALESCE(a.actual_k, 0) >= {min_k} AND a.sum_sim > 0)"
    dev = f"(CASE WHEN {enough} THEN a.sum_w / a.sum_sim ELSE 0.0 END)"
    joins = (f"FROM {out}_t t LEFT JOIN {out}_agg a ON a.uid = t.uid AND a.iid = t.iid{_j(by, 't', 'a')} "
             f"JOIN gmu m ON true{_j(by, 't', 'm')}")
    if kind == "basic":
        est = f"CASE WHEN {known} AND {enough} THEN a.sum_w / a.sum_sim ELSE m.mu END"
    elif kind in ("means", "zscore"):
        joins += f" LEFT JOIN {out}_is st ON st.iid = t.iid{_j(by, 't', 'st')}"
        if kind == "means":
            est = f"CASE WHEN {known} THEN st.mean + {dev} ELSE m.mu END"
        else:
            est = (f"CASE WHEN {known} THEN st.mean + (CASE WHEN st.sd > 0 THEN st.sd ELSE m.sd_all END) * {dev} "
                   f"ELSE m.mu END")
    else:
        joins += (f" LEFT JOIN {bu} u ON u.uid = t.uid{_j(by, 't', 'u')} "
                  f"LEFT JOIN {bi} i ON i.iid = t.iid{_j(by, 't', 'i')}")
        est = f"m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0) + CASE WHEN {known} THEN {dev} ELSE 0.0 END"
    c.append(f"{out}_p AS (SELECT {_s(by, 't')}t.uid, t.iid, {clip_sql(est)} AS est, "
             f"COALESCE(a.actual_k, 0) AS actual_k {joins})")
    c.append(f"{out} AS (SELECT {_s(by, 'x')}x.review_id, x.uid, x.iid, x.stars, p.est, p.actual_k FROM test x "
             f"JOIN {out}_p p ON p.uid = x.uid AND p.iid = x.iid{_j(by, 'x', 'p')})")
    return c


def slope_one_ctes(by=(), sums="tps", out="pred") -> list[str]:
    c = [f"{out}_dev AS (SELECT {_s(by)}i AS iid, j, (sx - sy) / n AS dev FROM {sums} WHERE n > 0 "
         f"UNION ALL SELECT {_s(by)}j AS iid, i AS j, (sy - sx) / n AS dev FROM {sums} WHERE n > 0)",
         f"{out}_t AS (SELECT DISTINCT {_s(by)}uid, iid FROM test)",
         f"{out}_rows AS (SELECT {_s(by, 't')}t.uid, t.iid, d.dev FROM {out}_t t JOIN {out}_dev d ON d.iid = t.iid{_j(by, 't', 'd')} "
         f"JOIN train tr ON tr.uid = t.uid AND tr.iid = d.j{_j(by, 't', 'tr')} "
         f"UNION ALL SELECT {_s(by, 't')}t.uid, t.iid, 0.0 AS dev FROM {out}_t t JOIN train tr "
         f"ON tr.uid = t.uid AND tr.iid = t.iid{_j(by, 't', 'tr')})",
         f"{out}_agg AS (SELECT {_s(by)}uid, iid, sum(dev) AS sum_dev, count(*) AS n_dev FROM {out}_rows GROUP BY {_s(by)}uid, iid)",
         f"{out}_um AS (SELECT {_s(by)}uid, avg(CAST(stars AS DOUBLE)) AS mean_u FROM train GROUP BY {_s(by)}uid)",
         f"{out}_ki AS (SELECT DISTINCT {_s(by)}iid FROM train)"]
    known = (f"(um.mean_u IS NOT NULL AND EXISTS (SELECT 1 FROM {out}_ki y WHERE y.iid = t.iid{_j(by, 'y', 't')}))")
    est = (f"CASE WHEN {known} THEN um.mean_u + CASE WHEN a.n_dev > 0 THEN a.sum_dev / a.n_dev ELSE 0.0 END "
           f"ELSE m.mu END")
    c.append(f"{out}_p AS (SELECT {_s(by, 't')}t.uid, t.iid, {clip_sql(est)} AS est FROM {out}_t t "
             f"LEFT JOIN {out}_um um ON um.uid = t.uid{_j(by, 't', 'um')} "
             f"LEFT JOIN {out}_agg a ON a.uid = t.uid AND a.iid = t.iid{_j(by, 't', 'a')} "
             f"JOIN gmu m ON true{_j(by, 't', 'm')})")
    c.append(f"{out} AS (SELECT {_s(by, 'x')}x.review_id, x.uid, x.iid, x.stars, p.est FROM test x "
             f"JOIN {out}_p p ON p.uid = x.uid AND p.iid = x.iid{_j(by, 'x', 'p')})")
    return c


def baseline_pred_ctes(bu, bi, by=(), out="pred") -> list[str]:
    est = "m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0)"
    return [f"{out} AS (SELECT {_s(by, 'x')}x.review_id, x.uid, x.iid, x.stars, {clip_sql(est)} AS est FROM test x "
            f"JOIN gmu m ON true{_j(by, 'x', 'm')} LEFT JOIN {bu} u ON u.uid = x.uid{_j(by, 'x', 'u')} "
            f"LEFT JOIN {bi} i ON i.iid = x.iid{_j(by, 'x', 'i')})"]


def normal_pred_ctes(seed: int, by=(), out="pred") -> list[str]:
    est = f"m.mu + m.sd_all * {std_normal_sql('x.review_id', seed)}"
    return [f"{out} AS (SELECT {_s(by, 'x')}x.review_id, x.uid, x.iid, x.stars, {clip_sql(est)} AS est FROM test x "
            f"JOIN gmu m ON true{_j(by, 'x', 'm')})"]


def coclustering_ctes(n_u: int, n_i: int, epochs: int, by=(), out="pred") -> list[str]:
    """Co-clustering with ``epochs`` rounds unrolled; needs train, test, gmu."""
    s, g = _s(by), _s(by)
    c = [f"cc_um AS (SELECT {s}uid, avg(CAST(stars AS DOUBLE)) AS mean_u FROM train GROUP BY {g}uid)",
         f"cc_im AS (SELECT {s}iid, avg(CAST(stars AS DOUBLE)) AS mean_i FROM train GROUP BY {g}iid)",
         f"cc_rm AS (SELECT {_s(by, 't')}t.uid, t.iid, CAST(t.stars AS DOUBLE) AS r, u.mean_u, i.mean_i FROM train t "
         f"JOIN cc_um u ON u.uid = t.uid{_j(by, 't', 'u')} JOIN cc_im i ON i.iid = t.iid{_j(by, 't', 'i')})",
         f"cc_cu0 AS (SELECT {s}uid, CAST(uid % {n_u} AS INT) AS cu FROM cc_um)",
         f"cc_ci0 AS (SELECT {s}iid, CAST(iid % {n_i} AS INT) AS ci FROM cc_im)",
         f"cc_grid AS (SELECT {_s(by, 'm')}m.mu, a.cu, b.ci FROM gmu m, (SELECT CAST(unnest(range({n_u})) AS INT) AS cu) a, "
         f"(SELECT CAST(unnest(range({n_i})) AS INT) AS ci) b)"]

    def x_cte(name, cu, ci):
        return (f"{name} AS (SELECT {_s(by, 'rm')}rm.uid, rm.iid, rm.r, rm.mean_u, rm.mean_i, u.cu, i.ci FROM cc_rm rm "
                f"JOIN {cu} u ON u.uid = rm.uid{_j(by, 'rm', 'u')} JOIN {ci} i ON i.iid = rm.iid{_j(by, 'rm', 'i')})")

    def avg_cte(name, x):
        gb = f"GROUP BY {_s(by)}"
        return (f"{name} AS (SELECT {_s(by, 'g')}g.cu, g.ci, COALESCE(ac.ac, g.mu) AS ac, COALESCE(au.au, g.mu) AS au, "
                f"COALESCE(ai.ai, g.mu) AS ai FROM cc_grid g "
                f"LEFT JOIN (SELECT {_s(by)}cu, ci, avg(r) AS ac FROM {x} {gb}cu, ci) ac ON ac.cu = g.cu AND ac.ci = g.ci{_j(by, 'g', 'ac')} "
                f"LEFT JOIN (SELECT {_s(by)}cu, avg(r) AS au FROM {x} {gb}cu) au ON au.cu = g.cu{_j(by, 'g', 'au')} "
                f"LEFT JOIN (SELECT {_s(by)}ci, avg(r) AS ai FROM {x} {gb}ci) ai ON ai.ci = g.ci{_j(by, 'g', 'ai')})")

    def reassign(name, x, avgs, side):
        key, cl, other, n = ("uid", "cu", "ci", n_u) if side == "u" else ("iid", "ci", "cu", n_i)
        pred = "(a.ac + x.mean_u - a.au + x.mean_i - a.ai)"
        return [
            f"{name}_e AS (SELECT {_s(by, 'x')}x.{key}, c.{cl}, sum(power(x.r - {pred}, 2)) AS e FROM {x} x "
            f"CROSS JOIN (SELECT CAST(unnest(range({n})) AS INT) AS {cl}) c JOIN {avgs} a ON a.{cl} = c.{cl} "
            f"AND a.{other} = x.{other}{_j(by, 'x', 'a')} GROUP BY {_s(by, 'x')}x.{key}, c.{cl})",
            f"{name} AS (SELECT {_s(by)}{key}, {cl} FROM (SELECT *, row_number() OVER (PARTITION BY {_s(by)}{key} "
            f"ORDER BY round(e, 9), {cl}) AS rn FROM {name}_e) WHERE rn = 1)"]

    for e in range(1, epochs + 1):
        c.append(x_cte(f"cc_x{e}", f"cc_cu{e - 1}", f"cc_ci{e - 1}"))
        c.append(avg_cte(f"cc_a{e}", f"cc_x{e}"))
        c += reassign(f"cc_cu{e}", f"cc_x{e}", f"cc_a{e}", "u")
        c.append(x_cte(f"cc_y{e}", f"cc_cu{e}", f"cc_ci{e - 1}"))
        c += reassign(f"cc_ci{e}", f"cc_y{e}", f"cc_a{e}", "i")
    c.append(x_cte("cc_xf", f"cc_cu{epochs}", f"cc_ci{epochs}"))
    c.append(avg_cte("cc_af", "cc_xf"))
    est = ("CASE WHEN um.mean_u IS NOT NULL AND im.mean_i IS NOT NULL "
           "THEN a.ac + um.mean_u - a.au + im.mean_i - a.ai ELSE m.mu END")
    c.append(f"{out} AS (SELECT {_s(by, 'x')}x.review_id, x.uid, x.iid, x.stars, {clip_sql(est)} AS est FROM test x "
             f"LEFT JOIN cc_um um ON um.uid = x.uid{_j(by, 'x', 'um')} LEFT JOIN cc_im im ON im.iid = x.iid{_j(by, 'x', 'im')} "
             f"LEFT JOIN cc_cu{epochs} cu ON cu.uid = x.uid{_j(by, 'x', 'cu')} "
             f"LEFT JOIN cc_ci{epochs} ci ON ci.iid = x.iid{_j(by, 'x', 'ci')} "
             f"LEFT JOIN cc_af a ON a.cu = cu.cu AND a.ci = ci.ci{_j(by, 'x', 'a')} JOIN gmu m ON true{_j(by, 'x', 'm')})")
    return c


def known_user_recs_ctes(k: int, min_k: int, n: int, bu: str, bi: str, sims="tsims") -> list[str]:
    """Top-n per user over every unrated item by KNN-baseline estimate (ranked before clipping).  Needs train, gmu, bu/bi, sims (i<j)."""
    return [
        f"kr_s AS (SELECT i, j, n, sim FROM {sims} WHERE sim > 0 UNION ALL SELECT j AS i, i AS j, n, sim FROM {sims} WHERE sim > 0)",
        "kr_c AS (SELECT tr.uid, s.i AS iid, s.j, s.n, s.sim, CAST(tr.stars AS DOUBLE) AS r_j, tr.review_id AS rid_j "
        "FROM train tr JOIN kr_s s ON s.j = tr.iid "
        "WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.uid = tr.uid AND x.iid = s.i))",
        f"kr_nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, iid ORDER BY round(sim, 9) DESC, "
        f"n DESC, j, rid_j, r_j) AS rank FROM kr_c) WHERE rank <= {k})",
        f"kr_agg AS (SELECT nb.uid, nb.iid, sum(nb.sim) AS sum_sim, "
        f"sum(nb.sim * (nb.r_j - (m.mu + COALESCE(u.bu, 0.0) + COALESCE(i.bi, 0.0)))) AS sum_w, count(*) AS actual_k "
        f"FROM kr_nb nb JOIN gmu m ON true LEFT JOIN {bu} u ON u.uid = nb.uid LEFT JOIN {bi} i ON i.iid = nb.j "
        f"GROUP BY nb.uid, nb.iid)",
        "kr_all AS (SELECT u.uid, i.iid FROM (SELECT DISTINCT uid FROM train) u CROSS JOIN (SELECT DISTINCT iid FROM train) i "
        "WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.uid = u.uid AND x.iid = i.iid))",
        f"kr_p AS (SELECT t.uid, t.iid, m.mu + COALESCE(u.bu, 0.0) AS level, COALESCE(i.bi, 0.0) + CASE WHEN a.actual_k >= {min_k} AND a.sum_sim > 0 "
        f"THEN a.sum_w / a.sum_sim ELSE 0.0 END AS gain, COALESCE(a.actual_k, 0) AS actual_k FROM kr_all t JOIN gmu m ON true "
        f"LEFT JOIN kr_agg a ON a.uid = t.uid AND a.iid = t.iid LEFT JOIN {bu} u ON u.uid = t.uid LEFT JOIN {bi} i ON i.iid = t.iid)",
        f"recs AS (SELECT uid, iid, {clip_sql('level + gain')} AS est, actual_k, rank FROM (SELECT *, row_number() OVER (PARTITION BY uid "
        f"ORDER BY round(gain, 9) DESC, iid) AS rank FROM kr_p) WHERE rank <= {n})",
    ]
