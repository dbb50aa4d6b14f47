"""Shapley contributions against all subsets, and regularised leaves."""

import itertools
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kindred.operators import learn as ln
from kindred.operators import trees as tr

NAMES = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def fitted(spark):
    h = lambda salt: (F.abs(F.xxhash64(F.col("id"), F.lit(salt))) % 40) / 40.0
    df = spark.range(300).select(F.col("id").alias("visitor_id"), *[h(n).alias(n) for n in NAMES])
    df = df.withColumn("c_level", ((F.col("x0") + F.col("x1") * F.col("x2") + (F.col("x3") > 0.5).cast("int") * 0.4) > 0.9).cast("int")).checkpoint()
    model = ln.fit_model(df, NAMES, ln.TreeParams(max_iter=4, step_size=0.4, max_depth=4, pos_weight=2))
    data = ln.assemble(ln.with_label_weight(df, 2), NAMES, "visitor_id", "label", "weight").checkpoint()
    return df, model, data


def given(weights, paths, x, known):
    """The margin's mean where only the features in ``known`` are told: down
    both sides of a split on another feature, by the training weight."""
    total = 0.0
    for p in paths:
        share = weights[p.tree] * p.value
        for f, lo, hi, z in p.conditions:
            share *= (float((lo is None or x[f] > lo) and (hi is None or x[f] <= hi)) if f in known else z)
        total += share
    return total


def test_contributions_equal_all_subsets(fitted):
    _, model, data = fitted
    some = data.where("visitor_id < 12")
    got = {(r[0], r[1]): r[2] for r in tr.contributions(some, model).collect()}
    n, paths, weights = len(NAMES), tr.leaves(model), model.treeWeights
    for r in some.collect():
        x = r["features"].toArray()
        v = {frozenset(s): given(weights, paths, x, s) for k in range(n + 1) for s in itertools.combinations(range(n), k)}
        for i in range(n):
            want = sum(math.factorial(len(s)) * math.factorial(n - 1 - len(s)) / math.factorial(n) * (v[s | {i}] - v[s]) for s in v if i not in s)
            assert abs(got.get((r["visitor_id"], i), 0.0) - want) < 1e-9


def test_contributions_add_up_to_the_margin(fitted):
    _, model, data = fitted
    base = tr.base_value(model)
    raw = model.transform(data).select("visitor_id", vector_to_array("rawPrediction")[1].alias("raw"))
    total = tr.contributions(data, model).groupBy("visitor_id").agg(F.sum("phi").alias("phi"))
    worst = raw.join(total, "visitor_id").agg(F.count("*"), F.max(F.abs(F.col("phi") + base - F.col("raw")))).first()
    assert worst[0] == 300 and worst[1] < 1e-9
    imp = tr.shapley_importance(data, model, 6)
    assert min(imp[0], imp[3]) > max(imp[4], imp[5])


def test_nan_and_missing_rows(fitted, spark):
    _, model, data = fitted
    odd = spark.createDataFrame([(1, [float("nan")] * 6), (2, [float("inf"), -1.0, 0.0, 9.0, 0.5, 0.5])], "visitor_id long, a array<double>")
    from pyspark.ml.functions import array_to_vector
    odd = odd.select("visitor_id", array_to_vector("a").alias("features"))
    raw = {r[0]: r[1] for r in model.transform(odd).select("visitor_id", vector_to_array("rawPrediction")[1]).collect()}
    phi = {r[0]: r[1] for r in tr.contributions(odd, model).groupBy("visitor_id").agg(F.sum("phi")).collect()}
    assert all(abs(phi[k] + tr.base_value(model) - raw[k]) < 1e-9 for k in raw)
    assert tr.contributions(odd.limit(0), model).collect() == []


def test_leaves_at_zero_are_the_models_and_shrink(fitted):
    df, model, data = fitted
    sums = tr.leaf_sums(data, model).cache()
    own = {(p.tree, p.leaf): p.value for p in tr.leaves(model)}
    zero = {(r.tree, r.leaf): r.value for r in tr.regularised(sums).collect()}
    assert set(zero) == set(own) and all(abs(zero[k] - own[k]) < 1e-9 for k in own)
    assert {r[1] for r in sums.groupBy("tree").agg(F.sum("n")).collect()} == {300}
    for r in tr.regularised(sums, l2=3.0, l1=2.0).collect():
        want = math.copysign(max(abs(r.gradient) - 2.0, 0.0), r.gradient) / (r.weight + 3.0)
        assert abs(r.value - want) < 1e-12 and abs(r.value) <= abs(own[(r.tree, r.leaf)])
    raw = model.transform(data).select("visitor_id", vector_to_array("rawPrediction")[1].alias("raw"), vector_to_array("probability")[1].alias("p"))
    again = tr.margin(data, model, tr.regularised(sums)).join(raw, "visitor_id")
    assert again.agg(F.max(F.abs(F.col("margin") - F.col("raw"))), F.max(F.abs(F.col("p1") - F.col("p")))).first()[0] < 1e-9
    assert tr.margin(data, model, tr.regularised(sums, l2=1e12)).agg(F.max(F.abs("margin"))).first()[0] < 1e-6
    with pytest.raises(ValueError):
        tr.regularised(sums, l2=-1)


def test_selection_by_shapley_values(fitted):
    df, _, _ = fitted
    out = {r.feature: r for r in ln.shadow_selection(df, NAMES, ln.TreeParams(max_iter=3, step_size=0.4, max_depth=3), trials=8,
                                                     importance="shapley").collect()}
    assert out["x0"].decision == "accepted" and out["x5"].hits < out["x0"].hits
