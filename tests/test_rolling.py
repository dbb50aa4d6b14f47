"""Moving windows against features built anew, and merged sketches."""

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from kindred.operators import features as fe
from kindred.operators import quantiles as qt
from kindred.operators import rolling as ro
from kindred.plans.catalog import CFG, unpivoted
from kindred.sources.fixtures import Fixtures
from kindred.sources.session import materialize
from conftest import SF001

DAY = dt.date(2024, 1, 1)


def span(a, b):
    return DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=b)


@pytest.fixture(scope="module")
def views(spark):
    """Fixture rows, with sessions over midnight, rows without date, visitor,
    session, path, content or country, a path whose newest content leaves the
    window, and repeated rows."""
    pv = Fixtures(spark, SF001).pageviews
    k = F.col("event_id")
    odd = pv.where(k % 5 == 0).withColumn("view_date", F.date_add("view_date", 1)) \
        .withColumn("visitor_id", F.when(k % 3 == 0, F.col("visitor_id"))) \
        .withColumn("visit_start", F.when(k % 7 != 0, F.col("visit_start"))) \
        .withColumn("page_path", F.when(k % 11 != 0, F.col("page_path"))) \
        .withColumn("country", F.when(k % 4 != 0, F.col("country"))) \
        .withColumn("view_date", F.when(k % 25 != 0, F.col("view_date"))) \
        .withColumn("publish_date", F.date_add("publish_date", 400))
    late = pv.where(k % 6 == 0).withColumn("view_date", F.date_add("view_date", 1)).withColumn("page_views", F.col("page_views") + 7)
    return materialize(pv.unionByName(odd).unionByName(late).unionByName(pv.where(k % 50 == 0)), "rolling-test")


@pytest.fixture(scope="module")
def root(spark, views):
    path = tempfile.mkdtemp(prefix="kindred-rolling-")
    ro.write_days(views, path, CFG)
    return path


def differs(spark, root, views, window, cfg):
    want = fe.build_wide(views.where(F.col("view_date").between(F.lit(window[0]), F.lit(window[1]))), cfg)
    got = ro.window_features(spark, root, *window, cfg)
    assert got.columns == want.columns and got.count() > 0
    a, b = unpivoted(got, ["visitor_id"]), unpivoted(want, ["visitor_id"])
    return a.exceptAll(b).count() + b.exceptAll(a).count()


def test_day_partials_move_combinations(spark, views):
    """Categories are taken apart after the last exchange, by day and part of the visitors."""
    plan = ro.day_states(views, CFG)["cats"]._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[:plan.index("Generate")]


def test_moves_equal_features_built_anew(spark, views, root):
    steps = [span(2, 9), span(5, 12), span(0, 12), span(3, 6)]  # forwards, longer backwards, shorter
    ro.open_window(spark, root, *steps[0])
    for old, new in zip(steps, steps[1:]):
        ro.move_window(spark, root, old, new)
    # few top categories: the home country falls among the others
    few = fe.FeatureConfig(home_country=CFG.home_country, top_n=2)
    assert differs(spark, root, views, steps[1], CFG) == 0
    assert differs(spark, root, views, steps[3], few) == 0
    # the same state as one built at once, and a repeated write changes nothing
    moved = {n: t.collect() for n, t in ro.window_state(spark, root, *steps[3]).items()}
    ro.write_days(views, root, CFG)
    ro.open_window(spark, root, *steps[3])
    for n, t in ro.window_state(spark, root, *steps[3]).items():
        assert sorted(map(str, t.collect())) == sorted(map(str, moved[n])), n


def test_reads_only_the_changed_days(spark, root):
    old, new = span(1, 10), span(3, 11)
    changed = ro.outside(new, old) + ro.outside(old, new)
    days = {DAY + dt.timedelta(days=i) for i in (1, 2, 11)}
    for name in ro.KEYS:
        df = ro.days_of(spark, root, name, changed)
        filters = re.search(r"PartitionFilters: (.*)", df._jdf.queryExecution().explainString(
            df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))[1]
        assert "day" in filters
        assert {r[0] for r in df.select("day").distinct().collect()} <= days
        read = {re.search(r"day=([0-9-]+)", f)[1] for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
        assert read <= set(map(str, days))
    assert ro.outside(new, new) == [] and ro.outside(span(1, 2), span(5, 6)) == [span(1, 2)]


def test_unfinished_and_empty_windows(spark, root):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ro.move_window(spark, root, span(100, 101), span(100, 102))
    ro.open_window(spark, root, *span(200, 201))
    assert ro.window_features(spark, root, *span(200, 201), CFG).collect() == []
    assert os.path.exists(os.path.join(root, "windows", f"{span(200, 201)[0]}_{span(200, 201)[1]}", "complete"))


def test_sketch_states_stay_small_and_merge(spark):
    rows = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").cast("double").alias("v"),
                                       (F.col("id") % 20).alias("part")) \
        .unionByName(spark.createDataFrame([(3, None, 0), (4, float("nan"), 0), (5, 7.5, 0)], "g long, v double, part long"))
    parts = materialize(qt.states(rows, ["g", "part"], "v", 100), "kll")
    assert parts.agg(F.max(F.octet_length("state"))).first()[0] < 8000
    whole = qt.merge(parts, ["g"], 100)
    bound = 2 * qt.rank_error(100)
    both = whole.join(qt.exact_bounds(rows, ["g"], "v", 0.5 - bound, 0.5 + bound), "g").withColumn("m", qt.quantile("state", 0.5))
    got = {r.g: r for r in both.collect()}
    assert set(got) == {0, 1, 5} and got[0].n == 100_000 and got[5].m == 7.5
    assert all(r.low <= r.m <= r.high for r in got.values())
