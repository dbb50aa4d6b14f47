"""Overlap sketches, heavy-hitter states and loads that count once."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from kindred.operators import heavy
from kindred.operators import overlap as ov
from kindred.operators.clean import top_categories
from kindred.plans.stages import append_report
from kindred.sources import sinks


def folder(name):
    return tempfile.mkdtemp(prefix="kindred-runs-") + "/" + name


def ids(df):
    return sorted(r.id for r in df.collect())


# ---- runs --------------------------------------------------------------------

def test_a_run_counts_once_and_a_replacement_stands_alone(spark):
    path = folder("t")
    a, b = spark.range(5).toDF("id"), spark.range(10, 13).toDF("id")
    with pytest.raises(ValueError):
        sinks.read_runs(spark, path)
    assert sinks.append_run(a, path, "one") and not sinks.append_run(a, path, "one") and not sinks.append_run(b, path, "one")
    assert ids(sinks.read_runs(spark, path)) == [0, 1, 2, 3, 4]
    assert sinks.append_run(b, path, "two é/..") and ids(sinks.read_runs(spark, path)) == [0, 1, 2, 3, 4, 10, 11, 12]
    assert sinks.append_run(b, path, "three", replace=True) and not sinks.append_run(b, path, "three", replace=True)
    assert ids(sinks.read_runs(spark, path)) == [10, 11, 12]
    assert not sinks.append_run(a, path, "one") and sinks.append_run(a.limit(0), path, "none")
    assert ids(sinks.read_runs(spark, path)) == [10, 11, 12]


def test_a_run_stopped_before_its_commit_changes_nothing(spark, monkeypatch):
    path = folder("t")
    sinks.append_run(spark.range(3).toDF("id"), path, "one")

    def stop(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(sinks, "_publish", stop)
        for replace in (False, True):
            with pytest.raises(KeyboardInterrupt):
                sinks.append_run(spark.range(7, 9).toDF("id"), path, "two", replace=replace)
    assert ids(sinks.read_runs(spark, path)) == [0, 1, 2]
    assert sinks.append_run(spark.range(7, 9).toDF("id"), path, "two") and ids(sinks.read_runs(spark, path)) == [0, 1, 2, 7, 8]


def test_of_two_attempts_at_once_one_counts(spark, monkeypatch):
    """Both look before either commits."""
    path, frame = folder("t"), spark.range(4).toDF("id")
    sinks.append_run(spark.range(20, 21).toDF("id"), path, "base")
    real = sinks._publish

    def after_another(*args):
        monkeypatch.setattr(sinks, "_publish", real)
        assert sinks.append_run(frame, path, "same", replace=replace)
        return real(*args)
    for replace, left in ((False, [0, 1, 2, 3, 20]), (True, [0, 1, 2, 3])):
        path = folder("t")
        sinks.append_run(spark.range(20, 21).toDF("id"), path, "base")
        monkeypatch.setattr(sinks, "_publish", after_another)
        assert not sinks.append_run(frame, path, "same", replace=replace)
        assert ids(sinks.read_runs(spark, path)) == left


def test_two_replacements_at_once_leave_the_later_commit(spark, monkeypatch):
    path, real = folder("t"), sinks._publish

    def after_another(*args):
        monkeypatch.setattr(sinks, "_publish", real)
        assert sinks.append_run(spark.range(5, 6).toDF("id"), path, "first", replace=True)
        return real(*args)
    monkeypatch.setattr(sinks, "_publish", after_another)
    assert sinks.append_run(spark.range(3).toDF("id"), path, "second", replace=True)
    assert ids(sinks.read_runs(spark, path)) == [0, 1, 2]


def test_columns_must_agree_and_partitions_come_back(spark):
    path = folder("t")
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id long, `odd.name` string, part string")
    sinks.append_run(df, path, "one", partition_by=["part"])
    sinks.append_run(df.select("part", "`odd.name`", "id"), path, "two", partition_by=["part"])
    with pytest.raises(ValueError):
        sinks.append_run(df.drop("part"), path, "three")
    got = sinks.read_runs(spark, path)
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == sorted([tuple(r) for r in df.collect()] * 2, key=str)


def test_metrics_row_of_a_repeated_run_counts_once(spark):
    class Art:
        report = {"training_date": "2024-01-01", "cross_val_score": 0.5, "val_score": 0.25, "model_ver": "1"}
    path = folder("metrics")
    for run in ("a", "a", "b"):
        append_report(spark, Art, path, run_id=run)
    assert sinks.read_runs(spark, path).count() == 2


# ---- heavy hitters --------------------------------------------------------------

def weights(rows):
    out = {}
    for c, w in rows:
        if c is not None:
            out[c] = out.get(c, 0) + (w or 0)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_states_keep_their_bounds_through_merges(spark, seed):
    rng, k = random.Random(seed), 8
    rows = [(None if rng.random() < 0.05 else f"c{int(rng.paretovariate(0.7)) % 300}", rng.choice([None, 0, 1, 2, 50]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "category string, page_views int").repartition(7)
    true, total = weights(rows), sum(w or 0 for c, w in rows if c is not None)
    parts = heavy.states(df, ["category"], k=k).withColumn("half", F.pmod(F.xxhash64("counters"), F.lit(2)))
    halves = heavy.merge(parts, k, ["dimension", "half"])
    for state in (heavy.merge(parts, k), heavy.merge(halves, k)):
        s = state.collect()
        assert len(s) == 1 and len(s[0].counters) <= k and s[0].total == total and s[0].error * (k + 1) <= total
        held = {c.category: c.weight for c in s[0].counters}
        for c, w in true.items():
            assert held.get(c, 0) <= w <= held.get(c, 0) + s[0].error
        assert {c for c, w in true.items() if w * (k + 1) > total} <= set(held)


def test_state_size_does_not_depend_on_the_number_of_categories(spark):
    k = 50
    df = spark.range(1_000_000).select(F.when(F.col("id") % 10 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("c"),
                                       F.lit(1).alias("page_views"))
    parts = heavy.states(df, ["c"], k=k)
    assert parts.agg(F.max(F.size("counters"))).first()[0] <= k
    s = heavy.merge(parts, k).first()
    assert len(s.counters) <= k and s.total == 1_000_000 and max(s.counters, key=lambda c: c.weight).category == "hot"
    assert [tuple(r) for r in heavy.top_n(df, ["c"], 1, k=k).collect()] == [("c", "hot")]


def test_top_n_equals_the_full_aggregate(spark):
    """Heavy, flat, tied, zero, null and few categories, with clashing names."""
    rng = random.Random(1)
    rows = [(f"h{int(rng.paretovariate(0.4)) % 5000}", f"f{i % 900}", rng.choice(["a", "b", None]), None,
             rng.choice([0, 1, 2, None]), 1) for i in range(9000)]
    df = spark.createDataFrame(rows, "heavy string, dimension string, category string, _k string, page_views int, weight int")
    cols = ["heavy", "dimension", "category", "_k"]
    for k, n in ((32, 3), (200, 15), (4, 2)):
        want = sorted(map(tuple, top_categories(df, cols, n).collect()))
        assert sorted(map(tuple, heavy.top_n(df, cols, n, k=k).collect())) == want
    zero = df.withColumn("page_views", F.lit(None).cast("int"))
    assert sorted(map(tuple, heavy.top_n(zero, ["category"], 3).collect())) == [("category", "a"), ("category", "b")]
    assert heavy.top_n(df.limit(0), cols).collect() == []


def test_heavy_refuses_what_it_cannot_count(spark):
    df = spark.createDataFrame([("a", -1, 0.5)], "c string, page_views int, x double")
    with pytest.raises(TypeError):
        heavy.states(df, ["c"], "x")
    with pytest.raises(Exception, match="negative weight"):
        heavy.states(df, ["c"]).collect()


# ---- overlap --------------------------------------------------------------------

def test_small_sets_are_exact_and_days_merge(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(20), rng.choice([None, *range(400)])) for _ in range(3000)]
    sets = {p: {i for q, _, i in rows if q == p and i is not None} for p in "ab"}
    df = spark.createDataFrame(rows, "p string, day int, id long")
    whole = ov.merge(ov.states(df, ["p", "day"], "id", 10), ["p"], 10)
    a, b = (whole.where(F.col("p") == p).select(F.col("state").alias(p)) for p in "ab")
    got = a.join(b).select(*ov.overlap("a", "b", 10)).first()
    assert tuple(got) == (len(sets["a"] | sets["b"]), len(sets["a"] & sets["b"]), len(sets["a"] - sets["b"]), len(sets["b"] - sets["a"]))
    empty = ov.states(spark.createDataFrame([("a", None)], "p string, id long"), ["p"], "id")
    assert empty.select(ov.size("state")).first()[0] == 0 and ov.states(df.limit(0), ["p"], "id").collect() == []


def test_large_sets_stay_within_the_bound(spark):
    lg, n = 9, 120_000
    df = spark.range(n).select((F.col("id") % 30).alias("day"), "id")
    whole = ov.merge(ov.states(df, ["day"], "id", lg), [], lg).select(F.col("state").alias("a"))
    part = ov.states(df.where(f"id < {n // 4}"), [], "id", lg).select(F.col("state").alias("b"))
    row = whole.join(part).select(*ov.overlap("a", "b", lg)).select(
        *[ov.within(c, F.lit(x), F.lit(n), lg).alias(c) for c, x in
          (("either", n), ("both", n // 4), ("left_only", 3 * n // 4), ("right_only", 0))]).first()
    assert all(row)
