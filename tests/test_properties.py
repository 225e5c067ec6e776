"""Properties on the sf0.001 fixture."""

import pytest
from pyspark.sql import functions as F

from recspark.operators.indexing import factorize, kfold, train_sets_by_fold
from recspark.operators.similarity import pair_sums, similarity
from recspark.operators.trim import trim
from recspark.plans import fixture as fx

from conftest import SMOKE


@pytest.fixture(scope="module")
def ratings(spark):
    return fx.fx_ratings(spark, SMOKE)


def test_trimming_only_removes_rows(spark, ratings):
    rv = fx.fx_reviews(spark, SMOKE)
    assert ratings.join(rv, list(ratings.columns), "left_anti").count() == 0
    assert ratings.count() <= rv.count()


def test_trim_order_matters(spark):
    """User 3 loses item 3 to the item cut: users first keeps their other rating, items first drops the user, too."""
    rows = [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 2), (5, 3, 1), (6, 3, 3)]
    rv = spark.createDataFrame(rows, "review_id long, uid long, iid long")
    kept = lambda *steps: sorted(r.review_id for r in trim(rv, steps).collect())
    assert kept(("user", 2), ("item", 2)) == [1, 2, 3, 4, 5]
    assert kept(("item", 2), ("user", 2)) == [1, 2, 3, 4]


def test_similarities_symmetric_ranges(ratings):
    sums = pair_sums(ratings)
    assert sums.where(F.col("i") >= F.col("j")).count() == 0
    cos = similarity(sums, "cosine", 2)
    assert cos.where((F.col("sim") < 0) | (F.col("sim") > 1 + 1e-12)).count() == 0
    pear = similarity(sums, "pearson", 2)
    assert pear.where((F.col("sim") < -1 - 1e-12) | (F.col("sim") > 1 + 1e-12)).count() == 0
    msd = similarity(sums, "msd", 2)
    assert msd.where((F.col("sim") <= 0) | (F.col("sim") > 1)).count() == 0


def test_pair_sums_independent_of_partitioning(ratings):
    a = pair_sums(ratings, n_user_blocks=1)
    b = pair_sums(ratings.repartition(7), n_user_blocks=5, heavy_cells=3)  # most users split
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_user_user_sums_are_item_item_with_roles_swapped(ratings):
    uu = pair_sums(ratings, user="iid", item="uid")
    swapped = ratings.select(F.col("uid").alias("iid"), F.col("iid").alias("uid"), "stars")
    assert uu.exceptAll(pair_sums(swapped)).count() == 0


def test_factorize_dense_and_bijective(ratings):
    codes = factorize(ratings, "uid", out="code")
    n = ratings.select("uid").distinct().count()
    st = codes.agg(F.count("*").alias("c"), F.countDistinct("code").alias("d"), F.min("code").alias("lo"),
                   F.max("code").alias("hi")).first()
    assert (st.c, st.d, st.lo, st.hi) == (n, n, 0, n - 1)


def test_folds_partition_rows(ratings):
    k = 5
    f = kfold(ratings, k)
    assert f.where((F.col("fold") < 0) | (F.col("fold") >= k)).count() == 0
    assert f.count() == ratings.count()
    assert train_sets_by_fold(ratings, k).count() == (k - 1) * ratings.count()


def test_approx_profile_close_to_exact(spark):
    from recspark.operators.profile import distinct_profile
    rv = fx.fx_reviews(spark, SMOKE)
    a = distinct_profile(rv, approx=True, rsd=0.02).first().asDict()
    e = distinct_profile(rv).first().asDict()
    assert a.keys() == e.keys()
    for k in e:
        assert abs(a[k] - e[k]) <= 0.06 * e[k] + 1, (k, a[k], e[k])


def test_factorize_without_exchange_reuse(spark):
    """Codes stay dense and unique when Spark plans every exchange on its own (bounds are sampled per exchange)."""
    from recspark.operators.indexing import factorize

    rows = spark.range(60_000).selectExpr("id AS review_id", "CAST(pmod(xxhash64(id), 9000) AS LONG) AS uid",
                                          "CAST(timestamp_seconds(pmod(xxhash64(id, 1), 100000)) AS TIMESTAMP_NTZ) AS date")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        codes = [r[0] for r in factorize(rows, "uid").select("uid_code").collect()]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert sorted(codes) == list(range(len(codes))) and len(codes) == rows.select("uid").distinct().count()
