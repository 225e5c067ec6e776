"""Column expressions shared by the operators.

All are built-in Spark expressions (whole-stage codegen, no Python UDF).
Arithmetic is written so an ANSI-SQL engine computes the same values:
integer sums stay integers, ratios guard their denominators (Spark 4 runs
in ANSI mode, where division by zero raises), and pseudo-random numbers
come from portable integer arithmetic instead of engine-specific hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# MINSTD (Lehmer) generator modulus and two multipliers.
LEHMER_MOD = 2147483647
LEHMER_MUL_A = 48271
LEHMER_MUL_B = 16807


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_start(year: int) -> Column:
    """Jan 1, 00:00 of ``year`` as timestamp_ntz (inclusive lower bound)."""
    return F.lit(f"{int(year):04d}-01-01 00:00:00").cast("timestamp_ntz")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    d = col_(den)
    return F.when(d != 0, col_(num) / d)


def r6(c) -> Column:
    return F.round(col_(c).cast("double"), 6)


def clip(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col_(c), F.lit(float(lo))), F.lit(float(hi)))


def day_number(c) -> Column:
    """Days since 1970-01-01 of a timestamp/date column (time zone free)."""
    return F.unix_date(col_(c).cast("date"))


def hist_bin(x, lo, hi, bins: int) -> Column:
    """Equal-width bin in [0, bins-1] over [lo, hi], last bin closed.

    Returns 0 when the range is empty (all values equal).
    """
    x, lo, hi = col_(x), col_(lo), col_(hi)
    width = (hi - lo).cast("double")
    raw = F.floor((x - lo).cast("double") * bins / width).cast("int")
    return F.when(width > 0, F.least(raw, F.lit(bins - 1))).otherwise(F.lit(0))


def mix_key(review_id="review_id", iid="iid", uid="uid") -> Column:
    """Deterministic, engine-portable row key for splits: review_id + 3*iid + 7*uid."""
    return col_(review_id) + F.lit(3) * col_(iid) + F.lit(7) * col_(uid)


def fold_of(k: int, review_id="review_id", iid="iid", uid="uid") -> Column:
    """k-fold assignment in [0, k).  All ids are non-negative."""
    return (mix_key(review_id, iid, uid) % F.lit(k)).cast("int")


def lehmer_uniform(key, seed: int, mul: int) -> Column:
    """Uniform in (0, 1) from a non-negative integer key (MINSTD step)."""
    state = (col_(key) % F.lit(LEHMER_MOD - 1) + F.lit(seed % (LEHMER_MOD - 1)) + 1) % F.lit(LEHMER_MOD)
    nxt = (state * F.lit(mul)) % F.lit(LEHMER_MOD)
    return (nxt.cast("double") + 0.5) / F.lit(float(LEHMER_MOD))


def std_normal(key, seed: int = 0) -> Column:
    """Box-Muller standard normal from a non-negative integer key."""
    u1 = lehmer_uniform(key, seed, LEHMER_MUL_A)
    u2 = lehmer_uniform(key, seed + 1, LEHMER_MUL_B)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
