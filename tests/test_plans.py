"""Plan checks: no Python UDFs, filters reach the scan, bounded exchanges."""

from pyspark.sql import functions as F

from kindred.operators import enrich as en
from kindred.operators import features as fe
from kindred.operators.metrics import histogram
from kindred.operators.sample import dedupe
from kindred.plans.catalog import DATE_END, DATE_START, fixtures
from kindred.sources.fixtures import Fixtures
from kindred.sources.session import materialize
from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_plan_has_no_python_udf(spark):
    wide = fe.build_wide(Fixtures(spark, SF001).pageviews)
    plan = _plan(wide)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _views(spark, n=60):
    from test_units import VIEW_SCHEMA, view
    return spark.createDataFrame([view(i, i % 3, 100 + i % 2, f"/p{i % 4}", 1, 1.0) for i in range(n)], VIEW_SCHEMA)


def _cleaned(spark):
    from kindred.operators.clean import clean_views
    return clean_views(_views(spark))


def test_sums_names_and_pivot_share_one_exchange(spark):
    """Rows a category and a feature are made after the exchange by visitor, and meet where they are."""
    cleaned = _cleaned(spark)
    wide = fe.pivot_long(fe.long_features(fe.prepare(cleaned, fe.Vocabulary.build(cleaned))), [(0, "rf_a")])
    plan = _plan(wide)
    assert "Generate" in plan and "Exchange" not in plan[:plan.rindex("Generate")]


def test_features_use_hash_aggregates_and_no_raw_shuffle(spark):
    cleaned = _cleaned(spark)
    long = fe.long_features(fe.prepare(cleaned, fe.Vocabulary.build(cleaned)))
    plan = _plan(long)
    assert "SortAggregate" not in plan and "RepartitionByExpression" not in plan
    assert "partial_sum(page_views" in plan  # combined before the first shuffle


def test_newest_content_and_dedupe_use_no_sort_aggregate(spark):
    cleaned = _cleaned(spark)
    assert "SortAggregate" not in _plan(fe.page_content_map(cleaned))
    assert "SortAggregate" not in _plan(dedupe(cleaned, ["visitor_id"], ["event_id"]))


def test_histogram_bins_need_no_pass_over_the_rows(spark):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    plan = _plan(histogram(df, "value"))
    assert plan.count("FileScan parquet") == 1


def test_hot_content_join_can_be_split(spark):
    """Without broadcast: one plain exchange on each side of a sort-merge
    join (which adaptive execution can split), rows without an id apart."""
    fx = fixtures(spark, SF001)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = en.raw_rows(fx.pageviews, fx.content, fx.content_category, fx.sentiment)
        plan = _plan(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "IsNotNull(content_id)" in plan and "IsNull(content_id)" in plan


def test_hot_content_join_splits_at_run_time(spark):
    """A content id with a third of the rows, broadcast off, small thresholds:
    the join that ran is a skew join and the rows are all there."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    views = spark.range(0, 60000, 1, 8).selectExpr("id AS event_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 997) END "
                                                   "AS content_id", "md5(string(id)) AS rest")
    dim = materialize(spark.range(997).selectExpr("concat('c', id) AS fact_key", "id AS d")
                      .union(spark.sql("SELECT 'hot', 1L")), "dim")
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = en.left_join_on_id(views, dim, "fact_key")
        got = out.groupBy().agg(F.count("*"), F.count("d"))
        assert tuple(got.first()) == (60000, 60000)
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString() or got.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_date_filter_and_columns_reach_the_scan(spark):
    fx = fixtures(spark, SF001)
    rows = en.raw_rows(fx.pageviews, fx.content, fx.content_category, fx.sentiment, DATE_START, DATE_END) \
        .select("event_id", "tier1")
    plan = _plan(rows)
    assert f"GreaterThanOrEqual(view_date,{DATE_START})" in plan
    scans = [x for x in plan.split("FileScan parquet")[1:] if "view_date" in x.split("\n")[0]]
    assert scans and all("page_path" not in x.split("\n")[0] for x in scans)
