"""Bucketed tables: joins without an exchange, equal results, whole or refused."""

import uuid

import pytest
from pyspark.sql import functions as F

from kindred.operators.compare import class_from_label, class_from_prediction, class_mix, mix_of_views, visitor_views
from kindred.operators.features import quoted
from kindred.plans import stages as st
from kindred.plans.catalog import fixtures
from kindred.sources.buckets import SPEC, read_bucketed, read_spec, write_bucketed
from kindred.sources.session import scratch_path
from kindred.sources.sinks import _files
from conftest import SF001


def _path(spark):
    return scratch_path(spark, f"buckets-{uuid.uuid4().hex}")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.select(*[quoted(c) for c in sorted(df.columns)]).collect()))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_label_and_prediction_joins_have_no_exchange(spark, no_broadcast):
    fx = fixtures(spark, SF001)
    pv = fx.pageviews
    feats = pv.where("visitor_id IS NOT NULL").groupBy("visitor_id").agg(F.sum("page_views").alias("Views of `a` b"))
    labels, scores, views = st.label_rows(fx.seed_labels), fx.predictions, visitor_views(pv)
    plain = [st.training_set(feats, labels), st.labelled_views(views, labels), st.scored_views(views, scores)]
    feats, labels, scores, views = (write_bucketed(df, _path(spark), "visitor_id") for df in (feats, labels, scores, views))
    joins = [st.training_set(feats, labels), st.labelled_views(views, labels), st.scored_views(views, scores)]
    for got, want in zip(joins, plain):
        assert "Exchange" in _plan(want) and "Exchange" not in _plan(got) and "SortMergeJoin" in _plan(got)
        assert _rows(got) == _rows(want) and got.count() > 0


def test_training_set_from_label_rows_is_that_of_the_labels(spark):
    rows = [(1, "C-Level", "a"), (1, "C-Level", "a"), (1, None, "b"), (1, "Manager", "c"), (2, "Manager", None), (None, "C-Level", "x")]
    labels = spark.createDataFrame(rows, "visitor_id long, management_level string, user_name string")
    feats = spark.createDataFrame([(1, 1.5), (2, 2.5), (3, 3.5)], "visitor_id long, v double")
    assert _rows(st.training_set(feats, st.label_rows(labels))) == _rows(st.training_set(feats, labels))


def test_class_mix_from_visitor_sums(spark):
    """Repeated labels of a visitor count its views again; null views,
    categories and visitors as in the join of rows."""
    views = spark.createDataFrame(
        [(1, "a", "x", 2), (1, "a", None, 3), (1, "b", "x", None), (2, "a", "y", 5), (None, "a", "y", 7), (3, "c", "z", 1), (4, "d", "z", None)],
        "visitor_id long, tier1 string, channel string, page_views long")
    labels = spark.createDataFrame([(1, "C-Level", "u"), (1, "C-Level", "v"), (1, "Manager", "u"), (2, None, "u"), (4, "Manager", "u"), (None, "C-Level", "u")],
                                   "visitor_id long, management_level string, user_name string")
    scores = spark.createDataFrame([(1, 1), (3, 0)], "visitor_id long, predicted int")
    dims = ["tier1", "channel"]
    sums = visitor_views(views, dims)
    seen = views.join(labels, "visitor_id").withColumn("c_level", class_from_label())
    found = views.join(scores, "visitor_id").withColumn("c_level", class_from_prediction())
    assert _rows(mix_of_views(st.labelled_views(sums, st.label_rows(labels)))) == _rows(class_mix(seen, dims))
    assert _rows(mix_of_views(st.scored_views(sums, scores))) == _rows(class_mix(found, dims))


def test_read_in_a_session_that_does_not_know_the_table(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS `Odd, name`", "cast(id AS decimal(38,12)) AS d", "array(named_struct('a', id)) AS s") \
        .unionAll(spark.sql("SELECT CAST(NULL AS LONG), 1L, CAST(1 AS decimal(38,12)), array(named_struct('a', 1L))"))
    path = _path(spark)
    write_bucketed(df, path, "k", 4)
    other = spark.newSession()
    name = read_spec(spark, path)["name"]
    spark.sql(f"DROP TABLE {name}")
    got = read_bucketed(other, path)
    assert _rows(got) == _rows(df) == _rows(spark.read.parquet(path)) and got.schema.simpleString() == df.schema.simpleString()
    assert "Bucketed: true" in _plan(got.groupBy("k").count()) and "Exchange" not in _plan(got.groupBy("k").count())


def test_replaced_tables_and_stopped_writes(spark):
    path = _path(spark)
    write_bucketed(spark.range(10).selectExpr("id AS k", "1 AS a"), path, "k", 4)
    first = read_spec(spark, path)["name"]
    write_bucketed(spark.range(3).selectExpr("id AS k", "'x' AS b"), path, "k", 2)
    assert not spark.catalog.tableExists(first)
    assert _rows(read_bucketed(spark, path)) == [f"Row(b='x', k={i})" for i in range(3)]
    empty = write_bucketed(spark.range(0).selectExpr("id AS k"), _path(spark), "k", 2)
    assert empty.collect() == []
    fs, root = _files(spark, path)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, SPEC), False)   # as a write that stopped before its end
    with pytest.raises(ValueError):
        read_bucketed(spark, path)
    write_bucketed(spark.range(5).selectExpr("id AS k"), path, "k", 2)
    assert read_bucketed(spark, path).count() == 5
