"""Learning invariants on a generated table with one planted signal."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from kindred.operators import learn as ln
from kindred.operators import trees as tr
from kindred.plans import stages as st


def _table(spark, n=400):
    # signal: c_level = 1 iff s > 0.6 ; noise: n1, n2 independent hashes
    h = lambda salt: (F.abs(F.xxhash64(F.col("id"), F.lit(salt))) % 1000) / 1000.0
    return (spark.range(n).select(
        F.col("id").alias("visitor_id"), h("s").alias("s"), h("a").alias("n1"), h("b").alias("n2"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("cat"))
        .withColumn("c_level", (F.col("s") > 0.6).cast("int")))


def test_fit_calibrate_score_save_load(spark):
    # a dotted and a quoted name, as categories give
    df = _table(spark).withColumnsRenamed({"n1": "rf_news.example.com", "n2": "odd`name"}).checkpoint()
    names = ["s", "rf_news.example.com", "odd`name"]
    model = ln.fit_model(df, names, ln.TreeParams(max_iter=10, step_size=0.3, max_depth=3))
    iso = ln.calibrate(model, df, names)
    scored = ln.score(df, names, model, iso, carry=("c_level",))
    assert scored.agg(F.avg((F.col("predicted") == F.col("c_level")).cast("double"))).first()[0] > 0.95
    # calibrated probabilities are monotone in the raw model probability
    pairs = sorted((r["raw"], r["probability"]) for r in scored.collect())
    assert all(b[1] >= a[1] - 1e-12 for a, b in zip(pairs, pairs[1:]))
    # save / load gives the same scores
    encoders = PipelineModel(stages=[ln.category_encoder(["cat"])[0].fit(df)])
    art = st.Artifacts(names, encoders, model, iso, ["cat"], ["cat_code"], {"x": 1})
    path = os.path.join(tempfile.mkdtemp(prefix="kindred-model-"), "m")
    st.save(art, path)
    back = st.load(path)
    assert (back.features, back.categories, back.codes, back.report) == (names, ["cat"], ["cat_code"], {"x": 1})
    assert st.score_features(df, back).exceptAll(st.score_features(df, art)).count() == 0


def test_scoring_keeps_a_feature_named_like_a_code(spark):
    df = _table(spark).withColumnRenamed("n1", "t1_dress_code").checkpoint()
    names = ["s", "t1_dress_code", "absent_feature"]
    fit = df.withColumn("absent_feature", F.lit(0.0))
    model = ln.fit_model(fit, names, ln.TreeParams(max_iter=3, max_depth=2))
    art = st.Artifacts(names, PipelineModel(stages=[]), model, ln.calibrate(model, fit, names))
    assert st.score_features(df, art).count() == 400


def test_draws_fill_the_space():
    draws = ln.draw_params(60, 4222)
    assert len({p.max_iter for p in draws}) > 50 and max(p.max_iter for p in draws) > 800
    assert {p.max_depth for p in draws} == set(range(2, 14)) and len({p.step_size for p in draws}) == 60
    narrow = ln.draw_params(60, 4222, ln.SearchSpace(max_iter=(2, 6)))
    assert {p.max_iter for p in narrow} == set(range(2, 7))


def test_shadows_permute_each_feature(spark):
    df = _table(spark, 97)
    ranked = ln.ranked_cells(df, ["s", "n1", "n2"])
    rows = ln.with_shadows(ranked, 97, 3, 5).collect()
    own, shadow = [r["x"] for r in rows], [r["shadow"] for r in rows]
    for j in range(3):
        assert sorted(x[j] for x in own) == sorted(x[j] for x in shadow)
        assert sum(a[j] == b[j] for a, b in zip(own, shadow)) < 20
    where = {tuple(x): i for i, x in enumerate(own)}
    assert sum(tuple(s) in where for s in shadow) < 10  # not one permutation of whole rows


def test_shadows_move_in_blocks(spark, monkeypatch):
    """Cells move in buffers: no row a cell, and no table of all shadows on the driver."""
    monkeypatch.setattr(ln, "BLOCK", 16)
    monkeypatch.setattr(ln, "CELLS", 30)
    ranked = ln.ranked_cells(_table(spark, 97), ["s", "n1", "n2"])
    shadowed = ln.with_shadows(ranked, 97, 3, 5)
    plan = shadowed._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Broadcast" not in plan
    rows = sorted(shadowed.collect(), key=lambda r: r["_rn"])
    assert shadowed.columns == ["_rn", "c_level", "x", "shadow"] and [r["_rn"] for r in rows] == list(range(97))
    for j in range(3):
        at = {r["x"][j]: r["_rn"] for r in rows}
        if len(at) == 97:  # a line through the rows: equal steps
            came = [at[r["shadow"][j]] for r in rows]
            assert len({(b - a) % 97 for a, b in zip(came, came[1:])}) == 1


def test_shadow_selection_decides(spark):
    df = _table(spark, 300).checkpoint()
    params = ln.TreeParams(max_iter=5, step_size=0.3, max_depth=3)
    dec = {r["feature"]: r for r in ln.shadow_selection(df, ["s", "n1", "n2"], params, trials=12, seed=3).collect()}
    assert dec["s"]["decision"] == "accepted"
    assert "accepted" not in (dec["n1"]["decision"], dec["n2"]["decision"])
    with pytest.raises(ValueError, match="trials"):
        ln.shadow_selection(df, ["s", "n1", "n2"], params, trials=3)


def test_cross_validate_and_encoder(spark):
    df = _table(spark, 300)
    enc = ln.category_encoder(["cat"])[0].fit(df)
    assert list(enc.labels) == ["x", "y"]
    split = ln.stratify(enc.transform(df), seed=5).checkpoint()
    best, means = ln.cross_validate(split.where(~F.col("holdout")), ["s", "n1", "cat_code"],
                                    [ln.TreeParams(max_iter=3, max_depth=2),
                                     ln.TreeParams(max_iter=1, max_depth=2, step_size=1e-9)], folds=5)
    assert len(means) == 2 and max(means) > 0.9


def test_cross_validate_assembles_once_and_fits_no_rest(spark, monkeypatch):
    """Candidates of different weights share the assembled rows; a fit for each candidate and fold, no other."""
    split = ln.stratify(_table(spark, 300), seed=5).where(~F.col("holdout")).checkpoint()
    made = {"rows": 0, "fits": 0}
    assemble, gbt = ln.assemble, ln.gbt

    def counted(key, f):
        def g(*a, **k):
            made[key] += 1
            return f(*a, **k)
        return g

    monkeypatch.setattr(ln, "assemble", counted("rows", assemble))
    monkeypatch.setattr(ln, "gbt", counted("fits", gbt))
    cands = [ln.TreeParams(max_iter=2, max_depth=2, pos_weight=w) for w in (1, 3)]
    _, means = ln.cross_validate(split, ["s", "n1"], cands, folds=5)
    assert made == {"rows": 1, "fits": 10} and len(means) == 2
    with pytest.raises(ValueError, match="folds"):
        ln.cross_validate(split.where("fold <> 2"), ["s", "n1"], cands, folds=5)


def test_binomial_bounds():
    lo, hi = ln.binomial_bounds(100)
    assert lo < 50 < hi and lo >= 35 and hi <= 65


def test_materialize_keeps_earlier_frames(spark):
    a = st.materialize(spark.range(3), "same-name")
    b = st.materialize(spark.range(5), "same-name")
    assert (a.count(), b.count()) == (3, 5)


def test_training_rows_carry_no_text(spark):
    from kindred.plans.catalog import fixtures, DATE_START, DATE_END
    from conftest import SF001
    fx = fixtures(spark, SF001)
    dims = (fx.content, fx.content_category, fx.sentiment)
    rows = st.training_rows(fx.pageviews, *dims, fx.seed_labels, DATE_START, DATE_END)
    assert not {"body", "clean_body"} & set(rows.columns)


def test_checkpoint_folder_must_be_shared_on_a_cluster(monkeypatch):
    from kindred.sources import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_training_reads_all_labelled_rows(spark, monkeypatch):
    """More than a million labelled rows are all split into folds and hold-out."""
    class Stop(Exception):
        pass

    def split(df, **_):
        raise Stop(df.count(), df.agg(F.sum("visitor_id")).first()[0])

    n = 1_000_500
    monkeypatch.setattr(ln, "stratify", split)
    rows = spark.range(n).select(F.col("id").alias("visitor_id"), F.lit(None).cast("string").alias("management_level"),
                                 F.lit("x").alias("cat"), (F.col("id") % 2).cast("int").alias("c_level"))
    with pytest.raises(Stop) as seen:
        st.train(rows)
    assert seen.value.args == (n, n * (n - 1) // 2)


def _rare(spark, n, names):
    """Each feature is 1 in one row of its own, and those rows are positive."""
    at = {f: (7919 * (j + 1)) % n for j, f in enumerate(names)}
    rows = spark.range(n).select(F.col("id").alias("visitor_id"), *[(F.col("id") == k).cast("double").alias(f) for f, k in at.items()])
    return rows.withColumn("c_level", F.col("visitor_id").isin(*at.values()).cast("int"))


def test_trees_split_at_values_of_one_row(spark):
    """Splits are looked for in every row, also where there are more than Spark ML looks at."""
    names = [f"f{j}" for j in range(8)]
    df = _rare(spark, 40_000, names).checkpoint()
    params = ln.TreeParams(max_iter=1, max_depth=9, step_size=1.0)
    model = ln.fit_model(df, names, params)
    assert {f for p in tr.leaves(model) for f, *_ in p.conditions} == set(range(8))
    scored = ln.score(df, names, model, ln.calibrate(model, df, names), carry=("c_level",))
    assert scored.where("predicted <> c_level").count() == 0 and scored.where("predicted = 1").count() == 8
    folds = df.withColumn("fold", F.when(F.col("c_level") == 1, 0).otherwise(F.col("visitor_id") % 2).cast("int"))
    met = []
    plain = ln.gbt
    try:
        ln.gbt = lambda *a, **k: met.append(k["max_bins"]) or plain(*a, **k)
        ln.cross_validate(folds, names, [params], folds=2)
        ln.shadow_selection(df, names, ln.TreeParams(max_iter=1, max_depth=2), trials=10)
    finally:
        ln.gbt = plain
    assert len(met) == 12 and min(met) ** 2 >= 40_000


def _odd_table(spark, n=3000):
    h = lambda salt, k: F.abs(F.xxhash64(F.col("id"), F.lit(salt))) % k
    return spark.range(n).select(
        F.col("id").alias("visitor_id"), (h("a", 100_003) / 7.0).alias("many"), F.when(h("b", 10) == 0, h("c", 500) - 250).otherwise(0).cast("double").alias("mostly 0"),
        h("d", 32).cast("double").alias("as many as bins"), h("e", 33).cast("double").alias("one more"), F.lit(3.5).alias("one"),
        (h("f", 2) * F.lit(float("inf")) * F.when(h("g", 2) == 0, -1).otherwise(1)).alias("odd"), F.lit(float("nan")).alias("none"),
    ).withColumn("c_level", ((F.col("many") > 5000) == (F.col("mostly 0") > 20)).cast("int"))


def test_cut_points_are_those_of_spark_for_all_rows(spark, monkeypatch):
    df = _odd_table(spark).repartition(5).checkpoint()
    names = ["many", "mostly 0", "as many as bins", "one more", "one"]
    params = ln.TreeParams(max_iter=6, max_depth=5, step_size=0.3)
    own = ln.fit_model(df, names, params)
    monkeypatch.setattr(ln, "SEEN", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")  # values go on from batch to batch
    try:
        cuts = ln.cut_points(df, names)
        model = ln.fit_model(df, names, params, cuts=cuts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert cuts.max_bins ** 2 >= 3000 and [len(p) for p in cuts.of(names)][2:] == [31, 32 - 1, 0]
    tree = lambda m: [(p.tree, p.leaf, p.value, p.conditions) for p in tr.leaves(m)]
    assert tree(model) == tree(own) and model.treeWeights == own.treeWeights
    assert model.featureImportances == own.featureImportances


def test_cut_points_of_odd_values(spark, monkeypatch):
    """Infinite values stand apart, NaN is above all cuts; no value, no cut."""
    monkeypatch.setattr(ln, "SEEN", 0)
    df = _odd_table(spark, 200).checkpoint()
    cuts = ln.cut_points(df, ["odd", "none", "one"])
    assert cuts.of(["none", "one"])[0].size == cuts.of(["none", "one"])[1].size == 0
    rows = df.select(F.array("odd", "none").alias("x"), "odd")
    bins = {(str(r["odd"]), *r["x"]) for r in ln.binned(rows, "x", cuts.of(["odd", "none"])).collect()}
    values = sorted({r["odd"] for r in df.select("odd").collect() if not np.isnan(r["odd"])})
    assert {b for b in bins if b[0] != "nan"} == {(str(v), float(i), 0.0) for i, v in enumerate(values)}
    assert all(b[1] == len(cuts.places["odd"]) for b in bins if b[0] == "nan")
    assert ln.cut_points(df.limit(0), ["odd"]).places is None


def test_walk_takes_values_in_parts():
    """The cuts do not depend on how values and their counts are cut into parts."""
    rng = np.random.default_rng(3)
    v = np.sort(np.round(rng.exponential(40, 5000)))
    whole, parts = ln._Walk(len(v) / 32), ln._Walk(len(v) / 32)
    whole.add(v, np.ones(len(v), dtype=int))
    for part in np.split(v, [1, 2, 50, 51, 1700]):
        parts.add(part, np.ones(len(part), dtype=int))
    assert parts.end() == whole.end() and 8 < len(whole.cuts) <= 31
