"""Encoders, resampling, neighbours, training, bundles and streams."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabulon.operators import bootstrap as BS
from tabulon.operators import encode as E
from tabulon.operators import resample as B
from tabulon.operators.contracts import number_rules
from tabulon.operators.neighbours import nearest_neighbours
from tabulon.operators.splits import folds, split
from tabulon.plans import preparation as prep
from tabulon.plans import training as T
from tabulon.sources import files
from tabulon.streaming import flows


# ------------------------------------------------------------------ encoders

def test_group_median_imputer(spark):
    rows = [(2001.0, 100.0)] * 30 + [(2001.0, None)] + [(1985.0, 50.0)] * 5 + [(1985.0, None), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, year double, d double")
    out = {r["id"]: r for r in E.GroupMedianImputer("year", "d").fit(df).transform(df).collect()}
    assert (out[30]["d"], out[30]["d_missing"]) == (100.0, 1)
    assert out[36]["d"] == 100.0          # small decade: overall median
    assert (out[37]["year"], out[37]["d"]) == (2001.0, 100.0)
    assert out[0]["d_missing"] == 0


def test_multi_hot_counts_unseen_tokens(spark):
    train = spark.createDataFrame([("a, b",), ("b",), (None,)], "g string")
    model = E.MultiHotEncoder("g").fit(train)
    out = model.transform(spark.createDataFrame([("b, z, b",), (" , ",), (None,)], "g string")).collect()
    assert model.feature_names() == ["g=a", "g=b", "g_missing", "g_count"]
    assert [(r["g=a"], r["g=b"], r["g_missing"], r["g_count"]) for r in out] == [(0, 1, 0, 2), (0, 0, 1, 0), (0, 0, 1, 0)]


def test_people_encoder(spark):
    schema = "id int, a string, b string"
    train = spark.createDataFrame([(1, "x", " x "), (2, "y", "x"), (3, None, "y"), (4, "w", None)], schema)
    model = E.PeopleEncoder("who", ["a", "b"], "id", min_count=2).fit(train)
    new = spark.createDataFrame([(1, " x", "y"), (2, "new", None), (3, "x", "x"), (4, None, " ")], schema)
    out = {r["id"]: r for r in model.with_indicators(model.transform(new)).collect()}
    assert (out[1]["a_count"], out[1]["b_count"], out[1]["who_listed"], out[1]["who_frequent"]) == (2, 2, 2, ["x", "y"])
    assert (out[2]["a_count"], out[2]["b_missing"], out[2]["who_listed"], out[2]["who_frequent"]) == (0, 1, 1, [])
    assert (out[3]["who=x"], out[3]["who=y"], out[3]["who_frequent"]) == (1, 0, ["x"])
    assert (out[4]["a_missing"], out[4]["b_missing"]) == (1, 1)


def test_feature_assembly(spark):
    from tabulon.operators.assembly import FeatureAssembler
    train = spark.createDataFrame([(i, 1990.0 + i % 3, float(i), "b,a" if i % 2 else "c", "x" if i % 3 else "y", None) for i in range(12)], "id int, year double, d double, g string, a string, b string")
    groups = {"num": E.GroupMedianImputer("year", "d", min_group_size=1), "g": E.MultiHotEncoder("g"), "who": E.PeopleEncoder("who", ["a", "b"], "id", min_count=5)}
    with pytest.raises(ValueError, match="unknown feature groups"):
        FeatureAssembler(groups, "id", selected=["num", "cast"])
    model = FeatureAssembler(groups, "id").fit(train)
    names = [r["feature"] for r in model.index.orderBy("position").collect()]
    assert names == ["year", "d", "d_missing", "g=a", "g=b", "g=c", "g_missing", "g_count", "a_count", "b_count", "a_missing", "b_missing", "who_listed", "who=x"]
    new = spark.createDataFrame([(1, 1991.0, None, "a, z", " x ", "new"), (2, None, 2.0, None, None, "x"), (3, 1992.0, 0.0, "c,b", "x", "x")], "id int, year double, d double, g string, a string, b string")
    got = {r["id"]: {names[p]: v for p, v in zip(r["positions"], r["values"])} for r in model.transform(new).collect()}
    assert got[1] == {"year": 1991.0, "d": 5.5, "d_missing": 1.0, "g=a": 1.0, "g_count": 2.0, "a_count": 8.0, "who_listed": 2.0, "who=x": 1.0}
    assert got[2] == {"year": 1991.0, "d": 2.0, "g_missing": 1.0, "b_count": 8.0, "a_missing": 1.0, "who_listed": 1.0, "who=x": 1.0}
    assert got[3] == {"year": 1992.0, "g=b": 1.0, "g=c": 1.0, "g_count": 2.0, "a_count": 8.0, "b_count": 8.0, "who_listed": 2.0, "who=x": 1.0}
    vectors = {r["id"]: r["features"] for r in model.vectors(new, ["year"]).collect()}
    assert vectors[1].size == 14 and {names[p]: vectors[1][int(p)] for p in vectors[1].indices} == got[1]
    part = FeatureAssembler(groups, "id", selected=["g"]).fit(train)
    assert part.width == 5 and {r["group"] for r in part.index.collect()} == {"g"}


def test_feature_assembly_is_not_bounded_by_columns(spark):
    from tabulon.operators.assembly import FeatureAssembler
    train = spark.range(3000).select("id", F.concat(F.lit("t"), F.col("id")).alias("g"))
    model = FeatureAssembler({"g": E.MultiHotEncoder("g")}, "id").fit(train)
    assert model.width == 3002 and model.index.agg(F.count_distinct("position"), F.max("position")).first()[:] == (3002, 3001)
    assert {(len(r["positions"]), tuple(r["values"])) for r in model.transform(train).collect()} == {(2, (1.0, 1.0))}


def test_scaler_uses_population_std_and_train_only(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    out = E.PopulationScaler(["x", "c"]).fit(train).transform(spark.createDataFrame([(5.0, 6.0)], "x double, c double")).first()
    assert (out["x"], out["c"]) == (3.0, 1.0)
    logged = E.PopulationScaler(["x"], "log_amount", log_cols=["x"]).fit(train).transform(train).collect()
    assert [round(r["x"], 9) for r in logged] == [-1.0, 1.0]
    with pytest.raises(ValueError):
        E.PopulationScaler(["x"], "robust")


def test_encoder_pipeline_saves_and_loads(spark, tmp_path):
    df = spark.createDataFrame([(i, 1990.0 + i % 30, float(i) if i % 3 else None, "a,b" if i % 2 else "b", f"n{i % 4}") for i in range(120)],
                               "id int, year double, d double, g string, p string")
    model = Pipeline(stages=[E.GroupMedianImputer("year", "d"), E.MultiHotEncoder("g"), E.PeopleEncoder("p", ["p"], "id"), E.PopulationScaler(["d"])]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    cols = ["id", "year", "d", "g=a", "g_count", "p_count"]
    got = lambda m: sorted(tuple(round(float(x), 9) for x in r) for r in m.transform(df).select(cols).collect())
    assert got(model) == got(again)


def test_prepare_flow_is_leak_free(spark):
    from tabulon.operators.contracts import Contract
    df = spark.range(200).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    p = prep.prepare(df, Contract(["id", "x", "y"], not_null=["x"]), ["x"], "y", "id", stratify=True)
    assert p.train.agg(F.avg("x")).first()[0] == pytest.approx(0, abs=1e-9)
    assert abs(p.test.agg(F.avg("x")).first()[0]) > 1e-6
    proof = prep.leak_proof(p.split.frame, p.scaler.state["moments"], ["x"]).first()
    assert proof["fitted_on_train"] and proof["differs_from_all"] and proof["saw_train_rows_only"]
    with pytest.raises(ValueError):
        prep.prepare(df, Contract(["id", "x", "y"]), ["x", "y"], "y", "id")


# ------------------------------------------------------------------ resampling and neighbours

def points(spark, n, d=4, seed=0):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=(n, d)), 1)
    v[: n // 3] = v[0]                    # a third of the points are copies of one
    return v, spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>")


@pytest.mark.parametrize("block", [4096, 25])
def test_neighbours_match_brute_force(spark, block):
    v, df = points(spark, 150)
    got = {}
    for r in nearest_neighbours(df, "id", "v", 3, pivots=6, block=block).collect():
        got.setdefault(r["row_id"], []).append((r["rank"], r["neighbour_id"], r["distance"]))
    for i in range(len(v)):
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(v)), d)) if j != i][:3]
        assert [x[1] for x in sorted(got[i])] == order
        assert [x[2] for x in sorted(got[i])] == pytest.approx(list(d[order]))


def test_smote_points_lie_between_neighbours(spark):
    v, df = points(spark, 90, seed=2)
    rare = df.withColumn("y", (F.col("id") >= 70).cast("int"))
    made = B.smote(rare, "y", "id", "v", k=3).collect()
    new = [r for r in made if r["id"] is None]
    assert len(made) == 140 and len(new) == 50 and all(r["y"] == 1 for r in new)
    base = v[70:]
    for r in new:
        p = np.array(r["v"])
        on_segment = False
        for a in base:
            for b in base:
                ab = b - a
                if not ab.any():
                    on_segment |= np.allclose(p, a)
                    continue
                u = ((p - a) @ ab) / (ab @ ab)
                on_segment |= -1e-9 <= u <= 1 + 1e-9 and np.allclose(a + u * ab, p)
        assert on_segment
    again = B.smote(rare.repartition(7), "y", "id", "v", k=3).where("id is null").orderBy("draw").collect()
    assert [r["v"] for r in again] == [r["v"] for r in sorted(new, key=lambda r: r["draw"])]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_over_and_undersampling(spark, parts):
    df = spark.range(1000).select("id", (F.col("id") < 60).cast("int").alias("y")).repartition(parts)
    over = B.resample(df, "y", "oversample", "id").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in over} == {0: 940, 1: 940}
    under = B.resample(df, "y", "undersample", "id")
    assert {r["y"]: r["count"] for r in under.groupBy("y").count().collect()} == {0: 60, 1: 60}
    assert under.select("id").distinct().count() == 120
    assert B.resample(df, "y", "none", "id") is df


def test_resample_rejects_bad_input(spark):
    df = spark.range(10).select("id", (F.col("id") < 2).cast("int").alias("y"), F.array(F.lit(1.0)).alias("v"))
    for kw in ({"strategy": "mixup"}, {"strategy": "smote"}, {"strategy": "smote", "vector": "v"}):
        with pytest.raises(ValueError):
            B.resample(df, "y", row_id="id", **kw)


def test_class_weights_balance(spark):
    df = spark.range(100).select("id", (F.col("id") < 10).cast("int").alias("y"))
    assert {r["y"]: r["weight"] for r in B.class_weights(df, "y").collect()} == {1: 5.0, 0: pytest.approx(100 / 180)}
    assert {round(r["w"], 6) for r in B.with_class_weights(df, "y", "w").groupBy("y").agg(F.sum("w").alias("w")).collect()} == {50.0}


# ------------------------------------------------------------------ bootstrap

def test_bootstrap_draws_are_poisson(spark):
    per = BS.effective_weights(spark.range(2000), "id", 50).collect()
    totals = [r["total_weight"] for r in per]
    assert len(totals) == 50 and abs(np.mean(totals) / 2000 - 1) < .02 and .7 < np.std(totals) / 2000 ** .5 < 1.3


def replayed(ids, b, seed=42):
    """(rows x b) weights by plain integers."""
    import hashlib
    from tabulon.functions.draws import POISSON_BOUNDS
    out = np.zeros((len(ids), b), int)
    for i, key in enumerate(ids):
        d = int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:15], 16)
        for r in range(1, b + 1):
            x = ((d & 0xFFFFFFFF) + r * (2 * (d >> 32) + 1) + r * 2654435769) & 0xFFFFFFFF
            for _ in range(2):
                x = (x ^ x >> 16) * 73244475 & 0xFFFFFFFF
            x ^= x >> 16
            out[i, r - 1] = sum(x >= bound for bound in POISSON_BOUNDS)
    return out


def test_bootstrap_rmse_against_replayed_weights(spark):
    df = spark.range(300).select("id", F.lit(0.0).alias("y"), (F.col("id") % 7 / 3.0).alias("a"), (F.col("id") % 5 / 2.0).alias("b"))
    w, ids = replayed(range(300), 40), np.arange(300)
    rmse = lambda e: np.sqrt((w * (e ** 2)[:, None]).sum(0) / w.sum(0))
    diff = rmse(ids % 7 / 3.0) - rmse(ids % 5 / 2.0)
    r = BS.rmse_difference(df.repartition(5), "id", "y", ["a", "b"], "b", b=40).first()
    assert [r["low"], r["high"]] == pytest.approx(list(np.quantile(diff, [.025, .975])))
    assert r["share_worse"] == pytest.approx((diff > 0).mean()) and r["low"] <= r["diff"] <= r["high"]


@pytest.mark.parametrize("cell, block", [(64, 1 << 20), (2, 1 << 20), (2, 1 << 7), (1000, 90)])
def test_bootstrap_ranking_metrics_against_replayed_weights(spark, monkeypatch, cell, block):
    monkeypatch.setattr(BS, "CELL_ROWS", cell)
    monkeypatch.setattr(BS, "BLOCK", block)
    ids = np.arange(400)
    score, y = (ids * 37 % 23) / 23.0, (ids % 4 == 0).astype(int)
    score[ids % 3 == 0] = 0.5  # a third of the rows have one score
    df = spark.createDataFrame([(int(i), float(s), int(l)) for i, s, l in zip(ids, score, y)] + [(900, None, 1), (901, .2, None)], "id long, s double, y int")
    got = {r["replicate"]: r for r in BS.classification_values(df.repartition(3), "id", "y", "s", b=30).collect()}
    w = replayed(ids, 30)
    assert len(got) == 30
    for k in range(30):
        pos, neg = w[:, k] * y, w[:, k] * (1 - y)
        ap = auc = tp = fp = 0
        for s in sorted(set(score), reverse=True):
            p, n = pos[score == s].sum(), neg[score == s].sum()
            auc += n * (tp + p / 2)
            tp, fp = tp + p, fp + n
            ap += p * tp / (tp + fp) if p else 0
        hit = score >= .5
        want = (pos[hit].sum() / (pos[hit].sum() + neg[hit].sum()), pos[hit].sum() / tp, ap / tp, auc / (tp * fp))
        assert [got[k + 1][m] for m in ("precision", "recall", "pr_auc", "roc_auc")] == pytest.approx(want)


def test_bootstrap_intervals_hold_the_estimate(spark):
    df = spark.range(400).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"), (((F.col("id") * 37) % 101) / 101.0 * .6 + F.when(F.col("id") % 4 == 0, .3).otherwise(0)).alias("s"))
    from tabulon.operators.metrics import evaluate
    point = evaluate(df, "y", "s").first()
    for r in BS.classification_intervals(df, "id", "y", "s", b=60).collect():
        assert r["low"] - 1e-9 <= point[r["metric"]] <= r["high"] + 1e-9 and r["replicates"] == 60


# ------------------------------------------------------------------ training

@pytest.fixture(scope="module")
def learnable(spark):
    x, z = (F.col("id") * 7919) % 1000 / 1000.0, (F.col("id") * 104729) % 997 / 997.0
    return spark.range(600).select("id", x.alias("x"), z.alias("z"), (x + z / 10 > .8).cast("int").alias("y")).cache()


LOGIT = T.Recipe("logit", "logistic_regression", ("x", "z"), "y", "id")


def test_recipe_validation():
    for change in ({"model": "svm"}, {"strategy": "mixup"}, {"features": ("x", "y")}):
        with pytest.raises(ValueError):
            replace(LOGIT, **change)


@pytest.fixture(scope="module")
def folded(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(500, 3)) * [1, 50, 0.01] + [1e6, -3, 0]
    y = x @ [0.5, 0.02, 30] + r.normal(size=500)
    rows = [(i, i % 4 + 1, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows + [(900, 1, None, 1.0, 1.0, 2.0)], "id int, fold int, a double, b double, c double, y double").repartition(3), x, y


@pytest.mark.parametrize("scaling", ["standard", "minimal", "passthrough"])
def test_linear_family_from_sums(folded, scaling):
    from tabulon.operators import linear
    df, x, y = folded
    moments = linear.fold_moments(df, ["a", "b", "c"], "y", "fold")
    assert {k: m.rows for k, m in moments.items()} == {k: 125 for k in (1, 2, 3, 4)}
    outside = np.arange(500) % 4 != 2
    train, target = x[outside], y[outside]
    scale = np.where([scaling == "standard", scaling != "passthrough", scaling == "standard"], train.std(0), 1.0)
    z = (train - train.mean(0)) / scale
    part = linear.total(moments) - moments[3]
    fit = lambda family, alpha: linear.solve(part, family, alpha=alpha, scaling=scaling, minimal_cols=["b"])
    assert fit("linear", 0).scaled == pytest.approx(np.linalg.lstsq(z, target - target.mean(), rcond=None)[0], rel=1e-5)
    ridge = fit("ridge", 7.0)
    assert ridge.scaled == pytest.approx(np.linalg.solve(z.T @ z + 7 * np.eye(3), z.T @ (target - target.mean())), rel=1e-5)
    assert train @ ridge.weights + ridge.intercept == pytest.approx(z @ ridge.scaled + target.mean(), rel=1e-5)
    lasso = fit("lasso", 0.3).scaled
    slope = z.T @ (target - target.mean() - z @ lasso) / len(target)  # optimality of the lasso
    assert all(abs(g - 0.3 * np.sign(w)) < 1e-6 if w else abs(g) <= 0.3 + 1e-9 for g, w in zip(slope, lasso))
    with pytest.raises(ValueError):
        linear.solve(part, "boosting")


def test_linear_cross_validation_equals_fitted_models(spark, folded):
    df = folded[0].dropna()
    recipes = [T.Recipe("lin", "linear", ("a", "b"), "y", "id"), T.Recipe("ridge", "ridge", ("a", "b", "c"), "y", "id", params={"alpha": 5.0})]
    fast = {(r["config"], r["id"]): r["score"] for r in T.cross_validate_linear(df, recipes, "fold").collect()}
    slow = {(r["config"], r["id"]): r["score"] for r in T.cross_validate(df, recipes, "fold", 4).collect()}
    assert fast.keys() == slow.keys() and len(fast) == 1000
    assert [fast[k] for k in slow] == pytest.approx(list(slow.values()), rel=1e-4)
    with pytest.raises(ValueError):
        T.cross_validate_linear(df, [replace(recipes[0], strategy="oversample")], "fold")


def test_out_of_fold_scores_cover_each_row_once(learnable):
    oof = T.cross_validate(folds(learnable, "id", 3, stratify="y"), [LOGIT], "fold", 3)
    assert oof.count() == 600 and oof.select("id").distinct().count() == 600
    assert T.metrics_of(LOGIT, oof, ["config"]).first()["roc_auc"] > .95


@pytest.mark.parametrize("strategy", ["class_weight", "oversample", "smote", "undersample"])
def test_strategies_train_and_leave_test_alone(learnable, strategy):
    parts = split(learnable, "id", stratify="y")
    rows = {r["part"]: r for r in T.run_experiment(replace(LOGIT, strategy=strategy), parts.train, parts.test).collect()}
    assert rows["test"]["positives"] + rows["test"]["negatives"] == parts.test.count()
    assert rows["test"]["roc_auc"] > .9


def test_regressors_beat_the_mean(learnable):
    for model, params in (("linear", {}), ("ridge", {}), ("lasso", {"alpha": .001}), ("forest", {"numTrees": 5, "maxDepth": 5}), ("boosting", {"maxIter": 5, "stepSize": .3})):
        r = T.Recipe(model, model, ("x", "z"), "t", "id", params=params)
        df = learnable.withColumn("t", 3 * F.col("x") + F.col("z"))
        assert T.metrics_of(r, T.score(T.fit(r, df), df, r)).first()["r2"] > .5


def test_permutation_importance_finds_the_signal(learnable):
    model = T.fit(LOGIT, learnable)
    drop = {r["feature_group"]: r["drop"] for r in T.permutation_importance(model, learnable, LOGIT, {"x": ["x"], "z": ["z"]}, "roc_auc").collect()}
    assert drop["x"] > .2 > drop["z"]


def test_linear_importance_against_replayed_permutation(spark, folded):
    import hashlib
    df, x, y = folded
    recipe = T.Recipe("lin", "linear", ("a", "b", "c"), "y", "id")
    got = {(r["feature_group"], r["fold"], r["repeat"]): (r["base_rmse"], r["permuted_rmse"])
           for r in T.linear_importance(df, recipe, {"ab": ["a", "b"], "c": ["c"]}, "fold", repeats=2).collect()}
    assert len(got) == 2 * 4 * 2
    number = lambda order, rep, ids: sorted(ids, key=lambda i: (hashlib.md5(f"42-{order}|{rep}|{i}".encode()).hexdigest()[:15], i))
    for k in range(1, 5):
        ids = [i for i in range(500) if i % 4 + 1 == k]
        outside = np.arange(500) % 4 + 1 != k
        design = lambda v: np.column_stack([np.ones(len(v)), v - x.mean(0)])
        w = np.linalg.lstsq(design(x[outside]), y[outside], rcond=None)[0]
        rmse = lambda v, at: float(np.sqrt(np.mean((design(v) @ w - y[at]) ** 2)))
        for rep in (1, 2):
            to, source = number("to", rep, ids), number("from", rep, ids)
            for group, at in (("ab", [0, 1]), ("c", [2])):
                mixed = x[to].copy()
                mixed[:, at] = x[source][:, at]
                assert got[group, k, rep] == pytest.approx((rmse(x[to], to), rmse(mixed, to)), rel=1e-5)
    with pytest.raises(ValueError):
        T.linear_importance(df, recipe, {"g": ["zz"]}, "fold")
    assert T.linear_importance(df.where("false"), recipe, {"c": ["c"]}, "fold").count() == 0


def test_batch_scoring_contract(learnable, spark, tmp_path):
    model = T.fit(LOGIT, learnable)
    with pytest.raises(ValueError):
        T.predict_batch(model, learnable, ("x", "z"), "y", .5)
    with pytest.raises(ValueError):
        T.predict_batch(model, learnable.drop("y", "z"), ("x", "z"), "y", .5)
    files.save_bundle(model, {"features": ["x", "z"], "threshold": .4, "label": "y"}, str(tmp_path / "b"), spark)
    again, meta = files.load_bundle(spark, str(tmp_path / "b"))
    score = lambda m: {r["id"]: (r["score"], r["pred"]) for r in T.predict_batch(m, learnable.drop("y"), meta["features"], "y", meta["threshold"]).collect()}
    assert score(model) == score(again)


def test_bundle_refuses_what_changed(learnable, spark, tmp_path):
    import json
    from tabulon.operators.contracts import ContractError
    model, path = T.fit(LOGIT, learnable), str(tmp_path / "b")
    meta = {"features": ["x", "z"], "threshold": .4, "label": "y", **files.training_summary(learnable, ["x", "z"], "y")}
    with pytest.raises(ContractError, match="assembles"):
        files.save_bundle(model, {**meta, "features": ["z", "x"]}, path, spark)
    with pytest.raises(ContractError, match="ranges"):
        files.save_bundle(model, {**meta, "ranges": {"x": [0, 1]}}, path, spark)
    files.save_bundle(model, meta, path, spark)
    _, loaded = files.load_bundle(spark, path)
    assert loaded["rows"] == 600 and sum(loaded["classes"].values()) == 600 and loaded["manifest"]["versions"]["spark"] == spark.version

    def altered(change):
        text = json.loads(json.dumps(loaded))
        change(text)
        spark.createDataFrame([(json.dumps(text),)], "metadata string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
        return pytest.raises(ContractError)

    for change in (lambda m: m["features"].reverse(), lambda m: m["manifest"].update(format=2), lambda m: m.pop("manifest"),
                   lambda m: m["manifest"]["stages"].reverse(), lambda m: m["manifest"]["stages"][-1]["params"].update(tol=1.0),
                   lambda m: m["manifest"]["parts"].update(low=0)):
        with altered(change):
            files.load_bundle(spark, path)
    spark.createDataFrame([(json.dumps(loaded),)], "metadata string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    files.load_bundle(spark, path)
    T.fit(replace(LOGIT, params={"C": .1}), learnable).write().overwrite().save(f"{path}/model")
    with pytest.raises(ContractError, match="parts"):
        files.load_bundle(spark, path)


def test_fit_records_and_suites(learnable, spark):
    from tabulon.operators.suites import preprocessor_checks, resampling_checks, seen_digest, seen_rows
    parts = split(learnable, "id", stratify="y")
    _, record = T.fit_recorded(replace(LOGIT, strategy="undersample", params={"maxIter": 3}), parts.train)
    assert record.rows_seen == 480 and record.positives_fitted == record.negatives_fitted == record.rows_fitted / 2
    assert record.seen_digest == parts.train.agg(seen_digest("id")).first()[0] and record.fit_seconds > 0
    failed = lambda checks: {r["check"] for r in checks.collect() if not r["passed"]}
    scaler = lambda df: E.PopulationScaler(["x", "z"], seen=seen_rows("id")).fit(df).held()
    check = lambda s, **kw: failed(preprocessor_checks(parts.frame, kw.get("train", s.transform(parts.train)), kw.get("test", s.transform(parts.test)), ["x", "z"], "id", [s]))
    good, other = scaler(parts.train), scaler(parts.frame.orderBy(F.col("id").desc()).limit(480))
    assert check(good) == set()
    assert check(other) == {"scalers fitted on other rows than train"}  # as many rows, but not the same ones
    assert check(good, train=good.transform(parts.train).limit(479)) == {"train rows gained or lost"}
    assert check(good, test=good.transform(parts.test).drop("z")) == {"columns in one part only"}
    assert check(good, test=good.transform(parts.test).withColumn("x", F.lit(float("nan")))) == {"missing cells"}
    assert check(good, test=good.transform(parts.test).withColumn("x", F.lit(float("-inf")))) == {"infinite cells"}
    assert failed(preprocessor_checks(parts.frame, parts.train, parts.test, ["x"], "id", [])) == {"a scaler was fitted"}
    rows = parts.train.select("id", "y")
    made = B.resample(rows, "y", "oversample", "id")
    assert failed(resampling_checks(rows, made, parts.test, parts.test, "y")) == set()
    assert failed(resampling_checks(rows, rows, parts.test, parts.test, "y")) == {"training classes changed"}
    assert failed(resampling_checks(rows, made.where("y = 0"), parts.test, parts.test.where("y = 0"), "y")) == {
        "test rows gained or lost", "test classes with another count", "classes in the resampled rows"}


def test_grid_expansion_is_replayable():
    grid = {"C": [.1, 1, 10], "penalty": ["l1", "l2"]}
    assert len(T.expand_grid(LOGIT, grid)) == 6
    assert [r.name for r in T.expand_grid(LOGIT, grid, 2)] == [r.name for r in T.expand_grid(LOGIT, grid, 2)]


# ------------------------------------------------------------------ streams

@pytest.fixture
def event_folder(spark, tmp_path):
    rows = [(i, f"2024-01-01 0{i % 3}:10:00", "view" if i % 2 else "click", str(i) if i % 4 else "bad") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, ts string, kind string, amount string").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(2).write.parquet(str(tmp_path / "in"))
    return df, flows.read_stream(spark, str(tmp_path / "in"), "*.parquet", df.schema), str(tmp_path / "out")


def test_stream_quarantine_equals_batch(event_folder):
    df, stream, out = event_folder
    good, bad = flows.quarantine(stream, number_rules("amount"))
    assert flows.run_once(good.select("id"), out + "-g").count() == 30
    assert sorted(r["id"] for r in flows.run_once(bad.select("id", "errors"), out + "-b").collect()) == list(range(0, 40, 4))


def test_stream_keeps_both_sides_once(event_folder):
    df, stream, out = event_folder
    rules = number_rules("amount")
    good, bad = flows.run_both(stream, rules, out)
    rows = lambda: (sorted(r["id"] for r in good.collect()), sorted((r["id"], tuple(r["errors"])) for r in bad.collect()))
    first = rows()
    assert first[0] == [i for i in range(40) if i % 4] and [i for i, _ in first[1]] == list(range(0, 40, 4)) and all(e for _, e in first[1])
    epochs = {r["epoch"] for r in good.unionByName(bad.drop("errors")).select("epoch").distinct().collect()}
    for epoch in epochs:  # the same batches once more, as after a lost driver
        ids = [r["id"] for r in good.unionByName(bad.drop("errors")).where(F.col("epoch") == epoch).collect()]
        flows.keep_both(rules, out)(df.where(F.col("id").isin(ids)), epoch)
    good, bad = flows.run_both(stream, rules, out)  # nothing new to read
    assert rows() == first


def test_stream_reserved_names_are_refused(event_folder):
    _, stream, out = event_folder
    with pytest.raises(ValueError, match="rejected"):
        flows.run_both(stream.withColumn("rejected", F.lit(1)), number_rules("amount"), out)


def test_stream_hourly_counts(event_folder):
    df, stream, out = event_folder
    got = flows.run_once(flows.hourly_counts(stream, "ts", "kind"), out, mode="update", keys=("hour_start", "kind"))
    want = df.groupBy(F.date_trunc("hour", "ts").alias("hour_start"), "kind").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stream_deduplication(event_folder):
    _, stream, out = event_folder
    twice = stream.withColumn("c", F.explode(F.array(F.lit(1), F.lit(2)))).drop("c")
    assert flows.run_once(flows.drop_duplicates(twice, ["id", "kind"], "ts", lateness="6 hours"), out).count() == 40


def test_people_sensitivity_keeps_names_sparse(spark, monkeypatch):
    from tabulon import session
    rng = np.random.default_rng(4)
    rows = [(i, f" P{rng.integers(9)}" if i % 7 else None, f"Q{rng.integers(8)}" if i % 9 else None, float(rng.normal()), i % 2 + 1) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a string, b string, y double, fold int")
    widths, stored = [], session.stored
    monkeypatch.setattr(session, "stored", lambda frame, name: widths.append((name, len(frame.columns))) or stored(frame, name))
    got = {(r["fold"], r["id"]): (r["features"], r["score"]) for r in T.people_sensitivity(df, "p", ["a", "b"], "y", "id", "fold", 2, [2]).collect()}
    assert max(n for name, n in widths if name == "encoded") <= 5
    encoder = E.PeopleEncoder("p", ["a", "b"], "id", min_count=2).fit(df.where("fold = 2"))
    flags = {f"hot_{j}": F.array_contains("p_frequent", v).cast("double") for j, v in enumerate(encoder.frequent_names())}
    wide = encoder.transform(df).withColumns(flags).persist()  # the same ridge with a scaled column per name
    recipe = T.Recipe("wide", "ridge", (*encoder.fixed_names(), *flags), "y", "id")
    want = {r["id"]: r["score"] for r in T.score(T.fit(recipe, wide.where("fold = 2")), wide.where("fold = 1"), recipe).collect()}
    assert {x for i, x in got if i == 1} == set(want) and len(got) == 300
    assert all(got[1, x][0] == len(recipe.features) and abs(got[1, x][1] - v) < 1e-9 for x, v in want.items())
    with pytest.raises(ValueError, match="sparse"):
        T.Recipe("x", "lasso", ("v",), "y", "id", scaling="sparse")


def test_neighbours_send_on_in_bounded_pieces(spark, monkeypatch):
    from tabulon.operators import neighbours as N
    monkeypatch.setattr(N, "ROUTED", 256)
    monkeypatch.setattr(N, "COMPARED", 512)
    v = np.random.default_rng(5).normal(size=(120, 16))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)) + np.diag(np.full(120, np.inf))
    steps = [len(f) for f in N._nearest(np.arange(120), v, np.arange(120), v, 2)]
    assert max(steps) <= 8 and sum(steps) == 240  # 512 distances are 4 queries at a time
    got = {(r["row_id"], r["rank"]): r["neighbour_id"] for r in nearest_neighbours(df, "id", "v", 3, pivots=4, block=10).collect()}
    assert got == {(i, j + 1): int(n) for i in range(120) for j, n in enumerate(np.argsort(d[i], kind="stable")[:3])}


def test_neighbours_take_turns_where_rows_sent_on_are_many(spark, monkeypatch):
    from tabulon.operators import neighbours as N
    v, df = points(spark, 150)
    sent, write = [], N.stored_in_turn
    monkeypatch.setattr(N, "stored_in_turn", lambda frames, name: write((sent.append(1) or f for f in frames), name))
    rows = lambda: sorted(map(tuple, nearest_neighbours(df, "id", "v", 3, pivots=6, block=25).collect()))
    want = rows()
    assert not sent and len(want) == 450
    monkeypatch.setattr(N, "ROUND_BYTES", 150 * 8 * 12)
    assert rows() == want and len(sent) > 2
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)) + np.diag(np.full(150, np.inf))
    kth = np.sort(d, axis=1)[:, 2]
    for bound in (None, kth):
        got = N._nearest_in_block(np.arange(150), v, np.arange(150), v, 3, bound)
        assert sorted(zip(got["row_id"], got["neighbour_id"])) == sorted((r[0], r[2]) for r in want)
    assert len(N._nearest_in_block(np.arange(150), v, np.arange(150), v, 3, kth - 1)) < 450


def test_linear_importance_tasks_follow_rows(folded, monkeypatch):
    import re
    df, _, _ = folded
    monkeypatch.setattr(T, "TASK_BYTES", 1024)
    per = T.linear_importance(df, T.Recipe("lin", "linear", ("a", "b", "c"), "y", "id"), {"ab": ["a", "b"]}, "fold", repeats=2)
    plan = per._jdf.queryExecution().optimizedPlan().toString()
    tasks = [int(n) for n in re.findall(r"RepartitionByExpression \[repeat[^\]]*\], (\d+)", plan)]
    assert len(tasks) == 4 and set(tasks) == {-(-df.count() * 2 * 8 * 9 // 1024)} and per.count() == 8


def test_linear_importance_shuffles_few_repeats_at_a_time(folded, monkeypatch):
    import re
    df, _, _ = folded
    recipe, groups = T.Recipe("lin", "linear", ("a", "b", "c"), "y", "id"), {"ab": ["a", "b"], "c": ["c"]}
    took = lambda per: {(r["feature_group"], r["fold"], r["repeat"]): (r["base_rmse"], r["permuted_rmse"], r["worse"]) for r in per.collect()}
    want = took(T.linear_importance(df, recipe, groups, "fold"))
    for together in (1, 2, 4):
        monkeypatch.setattr(T, "REPEAT_BYTES", df.count() * 8 * 9 * together)
        per = T.linear_importance(df, recipe, groups, "fold")
        plan = per._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"RepartitionByExpression \[repeat", plan)) <= 4 and plan.count("Relation") >= -(-5 // together) - 1
        got = took(per)
        assert got.keys() == want.keys() and len(got) == 40 and all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12) for k in want)


def test_candidates_share_the_rows_of_a_fold(learnable, monkeypatch):
    scaled, df = [], folds(learnable, "id", 2, stratify="y").withColumn("fold", F.when(F.col("id") != 3, F.col("fold")))
    real = E.PopulationScaler._fit
    monkeypatch.setattr(E.PopulationScaler, "_fit", lambda self, d: scaled.append(1) or real(self, d))
    recipes = [T.Recipe(f"{s} {c}", "logistic_regression", ("x", "z"), "y", "id", strategy=s, params={"C": c, "maxIter": 5})
               for s in ("none", "class_weight") for c in (.01, 1.0)]
    records = []
    got = T.cross_validate(df, recipes, "fold", 2, train_scores=True, records=records)
    assert len(scaled) == 2 and [(c, f) for c, f, _ in records] == [(r.name, i) for r in recipes for i in (1, 2)]
    monkeypatch.undo()
    found = {(r["config"], r["fold"], r["id"]): (r["part"], r["label"], r["score"]) for r in got.collect()}
    assert len(found) == got.count() == len(recipes) * 2 * (df.count() - 1)  # the row without fold is in no part
    for r in recipes:
        model, record = T.fit_recorded(r, df.where("fold <> 1"))
        mine = next(x for c, f, x in records if (c, f) == (r.name, 1))
        assert replace(mine, fit_seconds=0.0) == replace(record, fit_seconds=0.0) and mine.fit_seconds > 0
        for row in T.score(model, df.where("fold IS NOT NULL"), r, ["fold"]).collect():
            part, label, value = found[r.name, 1, row["id"]]
            assert part == ("valid" if row["fold"] == 1 else "train") and label == row["label"] and value == pytest.approx(row["score"], abs=1e-9)
