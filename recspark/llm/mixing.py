"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.  DataFrame operations only.

1. Token totals T_i per source give shares p_i; the weights are w_i = p_i^a / sum p^a.
2. The exponent a is bisected on [0, 1]: to the smallest one at which no source is repeated more than ``most_epochs``
   times, or to the largest at which the entropy of the weights still reaches ``entropy`` (nats).  Either
   criterion is monotone in a.  One aggregate over the sources evaluates the 63 inner points of six bisection steps at once.
3. The budget (in tokens; by default the size of the input) is dealt out: source i gets floor(w_i * budget)
   tokens, as whole epochs and the beginning of one more.  An epoch is a block permutation: a source's documents are dealt to blocks
   of about ``block_tokens`` tokens by hash, the blocks are ordered by a hash of seed, epoch and block, and the
   documents of a block by a hash of seed, epoch and id.  The last epoch ends before the first document that would exceed the budget.
   ``budget="cover"`` is the smallest one at which every source is seen at least once in whole.

Prefix sums are taken over blocks first and over documents only inside a block, so no task sorts a source.  Joins on the source are
salted (a source may hold a third of all rows).

Defined cases: a null text has 0 tokens; null is a source of its own; sources without tokens get weight 0 and no rows; a null id takes part
like any other id; rows with equal id and source are drawn together; one source alone gets weight 1; an empty table gives an empty result; extra
columns are ignored by :func:`mix_sources` and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from recspark.llm.common import col, fresh, salted_left_join
from recspark.session import materialize

POINTS = 64  # parts of the interval per round: six bisection steps
ROUNDS = 5
WORDS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _column(part) -> Column:
    return F.col(part) if isinstance(part, str) else part


def order_key(*parts) -> Column:
    """A number below 2^32 from the MD5 of the parts: the place of a block or document in a permutation."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in map(_column, parts)])), 1, 8), 16, 10).cast("long")


def bisect_exponent(sources: DataFrame, most_epochs: float | None, entropy: float | None, budget_share: float | None) -> float:
    """The exponent in [0, 1], to 2^-30; ``sources`` has p, the share of each source.

    ``budget_share`` is budget / total tokens, None for a covering budget.
    """
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (hi - lo) / POINTS
        grid = sources.select("p", F.explode(F.array(*[F.lit(lo + step * j) for j in range(0 if lo == 0.0 else 1, POINTS)])).alias("a"))
        power = F.pow("p", "a")
        by_a = grid.groupBy("a").agg(F.sum(power).alias("z"), F.max(power / F.col("p")).alias("most"), F.min(power / F.col("p")).alias("least"),
                                     F.sum(power * F.log(power)).alias("plogp"))
        if most_epochs is not None:
            epochs = F.col("most") / F.col("least") if budget_share is None else F.col("most") / F.col("z") * budget_share
            first = by_a.where(epochs <= most_epochs).agg(F.min("a")).first()[0]  # one number
            found = hi if first is None else first
            lo, hi = (found, found) if found == 0.0 else (found - step, found)
        else:
            reached = F.log("z") - F.col("plogp") / F.col("z")
            last = by_a.where(reached >= entropy).agg(F.max("a")).first()[0]
            found = lo if last is None else last
            lo, hi = found, found + step
        if lo == hi:
            break
    return round(hi if most_epochs is not None else lo, 6)


def mixing_weights(sources: DataFrame, exponent: float, budget) -> DataFrame:
    """key, tokens, weight, target (tokens), epochs (whole ones) and rest (tokens of the last one)."""
    power = F.pow("p", F.lit(exponent))
    seen = sources.agg(F.sum(power).alias("z"), F.max(F.col("p") / power).alias("thin"), F.sum("tokens").alias("total")).first()  # one row
    z, thin, total = (F.lit(x) for x in (seen["z"], seen["thin"], seen["total"]))
    weight = power / z
    if budget == "cover":  # the source that is repeated least is seen once
        target = F.greatest(F.col("tokens"), F.floor(power * thin * total))
    else:
        target = F.floor(weight * (total if budget is None else F.lit(budget)))
    return (sources.select("key", "tokens", weight.alias("weight"), target.cast("long").alias("target"))
            .withColumn("epochs", F.floor(F.col("target") / F.col("tokens")).cast("long"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("tokens")))


def mix_sources(docs: DataFrame, most_epochs: float | None = 1.25, entropy: float | None = None, budget=None, block_tokens: int = 100_000, seed: int = 1,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per drawn document and epoch: doc_id, source, tokens, epoch, block, weight.

    Within a source the order of the mixture is epoch, then order_key(seed, epoch, block), then order_key(seed, epoch, id).
    """
    if (most_epochs is None) == (entropy is None):
        raise ValueError("give either most_epochs or entropy")
    if not (budget is None or budget == "cover" or budget > 0):
        raise ValueError("budget must be a positive number of tokens, 'cover' or None")
    base = materialize(docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"), words(col(text_col)).alias("tokens"))
                       .withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))), "mix-base")
    totals = materialize(base.groupBy("key").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "mix-totals")
    total = totals.agg(F.sum("tokens")).first()[0]  # one number
    sources = totals.withColumn("p", F.col("tokens") / F.lit(total or 1))
    share = None if budget == "cover" else 1.0 if budget is None or not total else budget / total
    exponent = bisect_exponent(sources, most_epochs, entropy, share) if total else 1.0
    plan = materialize(mixing_weights(sources, exponent, budget).select("key", F.round("weight", 9).alias("weight"), "epochs", "rest", F.ceil(F.col("tokens") / block_tokens).cast("int").alias("blocks")), "mix-plan")
    dealt = materialize(salted_left_join(base, plan, ["key"], F.col("doc_id")).where("weight IS NOT NULL")
                        .withColumn("block", F.pmod(order_key(F.lit("block"), F.lit(seed), "doc_id"), F.col("blocks")).cast("int")), "mix-dealt")
    out = ["doc_id", "source", "tokens", "epoch", "block", "weight"]
    in_full = (dealt.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1))).select(*out))
    # the begun epoch: blocks up to the one in which the rest runs out, and of that one the first documents
    begun = dealt.where("rest > 0").withColumn("epoch", F.col("epochs"))
    ahead = Window.partitionBy("key").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (begun.groupBy("key", "block", "epoch", "rest").agg(F.sum("tokens").alias("size"))
              .withColumn("place", order_key(F.lit(seed), "epoch", "block"))
              .withColumn("before", F.coalesce(F.sum("size").over(ahead), F.lit(0).cast("long")))
              .where("before < rest").select("key", "block", "before"))
    inside = Window.partitionBy("key", "block").orderBy(order_key(F.lit(seed), F.col("epoch"), F.col("doc_id")), "doc_id")
    partly = (begun.join(blocks, ["key", "block"]).withColumn("until", F.col("before") + F.sum("tokens").over(inside))
              .where("until <= rest").select(*out))
    return in_full.union(partly)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` as the mixture draws them: each row as often as it is drawn, with all its columns.

    Rows are found by id, so ids should be unique.
    """
    copies, key = fresh("copies", docs.columns), fresh("mix_id", docs.columns)
    drawn = (mix_sources(docs, id_col=id_col, **options).groupBy(F.col("doc_id").alias(key))
             .agg(F.countDistinct("epoch").cast("int").alias(copies)))
    joined = docs.join(drawn, col(id_col).eqNullSafe(F.col(key))).drop(key)
    return joined.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)


SQL = """
    WITH RECURSIVE base AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents),
    src AS (SELECT source, sum(tokens)::BIGINT AS tokens, sum(tokens) / (SELECT sum(tokens) FROM base) AS p FROM base GROUP BY source HAVING sum(tokens) > 0),
    bis(step, lo, hi) AS (
        SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
        UNION ALL
        SELECT step + 1, CASE WHEN most / z <= 1.25 THEN lo ELSE mid END, CASE WHEN most / z <= 1.25 THEN mid ELSE hi END
        FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid, (SELECT max(pow(p, (lo + hi) / 2) / p) FROM src) AS most,
                     (SELECT sum(pow(p, (lo + hi) / 2)) FROM src) AS z FROM bis WHERE step < 30)),
    alpha AS (SELECT CASE WHEN (SELECT max(1 / p) / count(*) FROM src) <= 1.25 THEN 0.0 ELSE round(hi, 6) END AS a FROM bis WHERE step = 30),
    plan0 AS (SELECT source, tokens, pow(p, a) / (SELECT sum(pow(p, (SELECT a FROM alpha))) FROM src) AS weight FROM src, alpha),
    plan1 AS (SELECT *, CAST(floor(weight * (SELECT sum(tokens) FROM base)) AS BIGINT) AS target FROM plan0),
    plan AS (SELECT *, target // tokens AS epochs, target % tokens AS rest, CAST(ceil(tokens / 100000) AS BIGINT) AS blocks FROM plan1),
    dealt AS (SELECT b.doc_id, b.source, b.tokens, weight, epochs, rest, CAST(('0x' || md5('block/1/' || doc_id)[1:8])::BIGINT % blocks AS INTEGER) AS block
              FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source),
    blk AS (SELECT source, block, sum(tokens) AS size, ('0x' || md5('1/' || epochs || '/' || block)[1:8])::BIGINT AS place
            FROM dealt WHERE rest > 0 GROUP BY source, block, epochs),
    ahead AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM blk),
    partly AS (SELECT d.*, before + sum(d.tokens) OVER (PARTITION BY d.source, d.block ORDER BY ('0x' || md5('1/' || epochs || '/' || doc_id)[1:8])::BIGINT, doc_id
                                                        ROWS UNBOUNDED PRECEDING) AS until
               FROM dealt d JOIN ahead a ON d.source IS NOT DISTINCT FROM a.source AND d.block = a.block)
    SELECT doc_id, source, tokens, unnest(range(epochs)) AS epoch, block, round(weight, 9) AS weight FROM dealt
    UNION ALL SELECT doc_id, source, tokens, epochs AS epoch, block, round(weight, 9) AS weight FROM partly WHERE until <= rest"""
