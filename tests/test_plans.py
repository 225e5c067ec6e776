"""Plan checks: no Cartesian products, intended broadcasts, pushed filters."""

from recspark.plans import REGISTRY

from conftest import SMOKE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_in_core_queries(spark):
    for name in ("rec_top_n", "sim_cosine", "predict_knn_baseline", "rec_batch_requests",
                 "predict_slope_one", "eval_rmse"):
        plan = _plan(REGISTRY[name].build(spark, SMOKE))
        assert "CartesianProduct" not in plan, name


def test_date_filter_pushed_to_scan(spark):
    plan = _plan(REGISTRY["filter_since_year"].build(spark, SMOKE))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(REGISTRY["proj_rating_triples"].build(spark, SMOKE))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_pattern_join_goes_by_literals(spark):
    plan = _plan(REGISTRY["join_pattern_items"].build(spark, SMOKE))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
