"""Queries: models, cross-validation, search, importance, bundles, scoring and streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators import metrics as M
from tabulon.operators.choose import paired_folds, summarise_folds
from tabulon.operators.contracts import number_rules
from tabulon.operators.outliers import flag_iqr
from tabulon.operators.relate import step_delta
from tabulon.operators.splits import folds, split
from tabulon.plans import preparation as prep
from tabulon.plans import training as T
from tabulon.plans.q_prepare import SQL_SEEN, sql_folds
from tabulon.plans.q_relate import sql_split
from tabulon.plans.registry import query, r
from tabulon.plans.tables import SQL_TRANSACTIONS, Tables, sql_digest
from tabulon.session import scratch_path, stored
from tabulon.sources import files
from tabulon.streaming import flows

FEATURES = ("time", "amount", "k")


def _tx(t: Tables) -> DataFrame:
    """Transactions with a learnable rare label: large amounts with a high key are positives."""
    score = F.col("amount") / 500 + F.col("k") / 100.0
    return t.transactions.select("event_id", "time", "amount", "k", (score > 1.0).cast("int").alias("label"))


SQL_TX = SQL_TRANSACTIONS + ", lt AS (SELECT event_id, time, amount, k, (amount/500 + k/100.0 > 1.0)::INT AS label FROM tx)"


def _parts(t: Tables):
    return split(_tx(t), "event_id", stratify="label").saved(scratch_path(t.spark, "tx-split"))


def _folded(t: Tables, k: int = 3) -> DataFrame:
    return stored(folds(stored(_tx(t), "tx"), "event_id", k, stratify="label"), "folds")


LOGISTIC = T.Recipe("logistic", "logistic_regression", FEATURES, "label", "event_id")
FOREST = T.Recipe("forest", "random_forest", FEATURES, "label", "event_id", params={"numTrees": 10, "maxDepth": 5})


def _orders(t: Tables) -> DataFrame:
    o = t.orders
    return o.select("o_orderkey", (F.col("o_totalprice") / 50000).alias("y"), F.col("o_custkey").cast("double").alias("cust"),
                    F.year("o_orderdate").cast("double").alias("yr"), F.month("o_orderdate").cast("double").alias("mon"),
                    (F.col("o_totalprice") / 50000 + F.pmod("o_custkey", F.lit(7)) / 5.0).alias("signal"))


REG = ("cust", "yr", "mon", "signal")
LINEAR = T.Recipe("linear", "linear", REG, "y", "o_orderkey")


SQL_REG = """o AS (SELECT o_orderkey, o_totalprice/50000 AS y, o_custkey::DOUBLE AS cust, year(o_orderdate)::DOUBLE AS yr, month(o_orderdate)::DOUBLE AS mon,
 o_totalprice/50000 + (o_custkey % 7)/5.0 AS signal FROM orders)"""


def sql_normal(rows: str, features, alpha: float = 0.0, by: str = "0 AS g", group: str = "1", per_row: bool = False) -> str:
    """SQL of (g, n, means m<i> and deviations s<i>, my, a<i>_<j>, b<i>): the normal equations of scaled features."""
    p, n = range(len(features)), "" if per_row else "count(*) * "
    x = list(features)
    parts = [f"avg({x[i]}) AS m{i}, stddev_pop({x[i]}) AS s{i}, {n}covar_pop({x[i]}, y) / stddev_pop({x[i]}) AS b{i}" for i in p]
    parts += [f"{n}covar_pop({x[i]}, {x[j]}) / stddev_pop({x[i]}) / stddev_pop({x[j]}) + {alpha if i == j else 0.0} AS a{i}_{j}" for i in p for j in p]
    return f"SELECT {by}, count(*) AS n, avg(y) AS my, {', '.join(parts)} FROM {rows} GROUP BY {group}"


def sql_solved(normal: str, p: int) -> str:
    """Gauss-Jordan elimination of the equations of `sql_normal`, a subquery per step: (g, my, m<i>, s<i>, w<i>)."""
    keep = ["g", "my", *(f"{c}{i}" for i in range(p) for c in "ms")]
    for k in range(p):
        step = lambda i, to: to if i == k else f"{to} - a{i}_{k} * {to.replace(f'a{i}_', f'a{k}_') if to[0] == 'a' else f'b{k}'} / a{k}_{k} AS {to}"
        columns = [step(i, f"a{i}_{j}") for i in range(p) for j in range(p)] + [step(i, f"b{i}") for i in range(p)]
        normal = f"SELECT {', '.join(keep + columns)} FROM ({normal})"
    return f"SELECT {', '.join(keep)}, {', '.join(f'b{i} / a{i}_{i} AS w{i}' for i in range(p))} FROM ({normal})"


def sql_fold_scores(rows: str, features, alpha: float = 0.0) -> str:
    """SQL of (fold, y, score): each row by the model of the other folds."""
    pairs = f"(SELECT r.*, f.fold AS g FROM {rows} r, (SELECT DISTINCT fold FROM {rows}) f WHERE r.fold <> f.fold)"
    solved = sql_solved(sql_normal(pairs, features, alpha, "g", "g"), len(features))
    terms = " + ".join(f"w{i} * ({x} - m{i}) / s{i}" for i, x in enumerate(features))
    return f"SELECT fold, y, my + {terms} AS score FROM {rows} JOIN ({solved}) ON fold = g"


@query("m1_mean_baseline", "WITH s AS " + sql_split("orders", "o_orderkey") + f", m AS (SELECT avg(o_totalprice) AS a FROM s WHERE split='train') SELECT count(*) AS n, {r('avg(abs(o_totalprice - a))', 3)} AS mae, {r('sqrt(avg((o_totalprice - a)^2))', 3)} AS rmse FROM s, m WHERE split='test'", 3)
def _(t: Tables):
    parts = split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    scored = M.mean_baseline(parts.train, parts.test, "o_totalprice")
    return M.regression_metrics(scored, "o_totalprice", "prediction").select("n", "mae", "rmse")


@query("m2_prior_baseline", "WITH s AS " + sql_split("labels", "doc_id", strata="toxic") + f", m AS (SELECT avg(toxic) AS p FROM s WHERE split='train') SELECT doc_id, {r('p')} AS score, (p > 0.5)::BIGINT AS pred FROM s, m WHERE split='test'")
def _(t: Tables):
    parts = split(t.labels, "doc_id", stratify="toxic")
    return M.prior_baseline(parts.train, parts.test, "toxic").select("doc_id", "score", "pred")


@query("m3_linear_regression", f"""WITH o AS (SELECT o_totalprice/50000 AS y, o_custkey::DOUBLE AS x FROM orders) SELECT 'cust' AS feature, {r('regr_slope(y, x) * stddev_pop(x)', 5)} AS coefficient, false AS is_zero FROM o
UNION ALL SELECT '(intercept)', {r('avg(y)', 5)}, false FROM o""", 5)
def _(t: Tables):
    recipe = replace(LINEAR, features=("cust",))
    return T.coefficients(T.fit(recipe, _orders(t)), recipe, t.spark)


@query("m3_scaling_invariance", "SELECT count(*) AS rows, 0.0::DOUBLE AS max_diff FROM orders", 6)
def _(t: Tables):
    df = _orders(t)
    raw = replace(LINEAR, scaling="passthrough")
    a = T.score(T.fit(LINEAR, df), df, LINEAR).select("o_orderkey", F.col("score").alias("a"))
    b = T.score(T.fit(raw, df), df, raw).select("o_orderkey", F.col("score").alias("b"))
    return a.join(b, "o_orderkey").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"))


_COEFFICIENTS = lambda w: " UNION ALL ".join([f"SELECT '{x}' AS feature, {r(w(i))} AS coefficient, {w(i)} = 0 AS is_zero FROM z" for i, x in enumerate(REG)] + [f"SELECT '(intercept)', {r('my')}, my = 0 FROM z"])


@query("m4_ridge_coefficients", "WITH " + SQL_REG + f", z AS ({sql_solved(sql_normal('o', REG, 1.0), len(REG))}) " + _COEFFICIENTS(lambda i: f"w{i}"))
def _(t: Tables):
    return T.linear_coefficients(_orders(t), replace(LINEAR, name="ridge", model="ridge", params={"alpha": 1.0}))


def _sql_descent(p: int, alpha: float, sweeps: int) -> str:
    """Coordinate descent as a recursive query: a sweep is a row, a coordinate a subquery."""
    step = f"SELECT d.sweep + 1 AS sweep, {', '.join(f'd.w{i}' for i in range(p))}, q.* FROM descent d, q WHERE d.sweep < {sweeps}"
    for i in range(p):
        rest = f"(b{i} - ({' + '.join(f'a{i}_{j} * w{j}' for j in range(p) if j != i)}))"
        new = f"sign({rest}) * greatest(abs({rest}) - {alpha}, 0) / a{i}_{i}"
        step = f"SELECT * REPLACE ({new} AS w{i}) FROM ({step})"
    return f"SELECT 0 AS sweep, {', '.join(f'0.0::DOUBLE AS w{i}' for i in range(p))} UNION ALL SELECT sweep, {', '.join(f'w{i}' for i in range(p))} FROM ({step})"


@query("m5_lasso_coefficients", "WITH RECURSIVE " + SQL_REG + f", q AS ({sql_normal('o', REG, per_row=True)}), descent AS ({_sql_descent(len(REG), 0.05, 400)}), z AS (SELECT descent.*, my FROM descent, q ORDER BY sweep DESC LIMIT 1) "
       + _COEFFICIENTS(lambda i: f"w{i}"))
def _(t: Tables):
    return T.linear_coefficients(_orders(t), replace(LINEAR, name="lasso", model="lasso", params={"alpha": 0.05}))


_FOLDED = "f AS (SELECT * FROM " + sql_folds("o", "o_orderkey", 5) + ")"
_FAMILY = {"linear": 0.0, "ridge": 1.0, "ridge 1000": 1000.0}


@query("m13_linear_family", "WITH " + SQL_REG + ", " + _FOLDED + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS config, fold, count(*) AS n, {r('sqrt(avg((y - score)^2))')} AS rmse, {r('avg(abs(y - score))')} AS mae FROM ({sql_fold_scores('f', REG, a)}) GROUP BY fold" for c, a in _FAMILY.items()))
def _(t: Tables):
    recipes = [replace(LINEAR, name=c, model="ridge" if a else "linear", params={"alpha": a} if a else {}) for c, a in _FAMILY.items()]
    oof = T.cross_validate_linear(stored(folds(_orders(t), "o_orderkey", 5), "folds"), recipes, "fold")
    return M.regression_metrics(oof, "label", "score", ["config", "fold"]).select("config", "fold", "n", "rmse", "mae")


@query("m6_m7_tree_regressors")
def _(t: Tables):
    parts = split(_orders(t), "o_orderkey").saved(scratch_path(t.spark, "orders-split"))
    recipes = [replace(LINEAR, name="forest", model="forest", params={"numTrees": 10, "maxDepth": 6}),
               replace(LINEAR, name="boosting", model="boosting", params={"maxIter": 10})]
    return T.results_table(recipes, parts.train, parts.test)


@query("m8_logistic_l1_l2")
def _(t: Tables):
    df = _parts(t).train
    out = None
    for penalty in ("l1", "l2"):
        recipe = replace(LOGISTIC, name=penalty, params={"C": 0.1, "penalty": penalty})
        one = T.coefficients(T.fit(recipe, df), recipe, t.spark).withColumn("penalty", F.lit(penalty))
        out = one if out is None else out.unionByName(one)
    return out


@query("m9_forest_scores_repeat", "SELECT count(*) AS rows, 0.0::DOUBLE AS max_diff FROM events", 12)
def _(t: Tables):
    df = _tx(t)
    model = T.fit(FOREST, df)
    a = T.score(model, df, FOREST).select("event_id", F.col("score").alias("a"))
    b = T.score(model, df.repartition(5, "event_id"), FOREST).select("event_id", F.col("score").alias("b"))
    return a.join(b, "event_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"))


@query("m10_m12_results_table")
def _(t: Tables):
    parts = _parts(t)
    recipes = [replace(LOGISTIC, name=f"logistic|{s}", strategy=s) for s in ("none", "class_weight", "oversample", "undersample")]
    return T.results_table(recipes, parts.train, parts.test)


@query("m11_experiment_smote")
def _(t: Tables):
    parts = _parts(t)
    return T.run_experiment(replace(LOGISTIC, name="logistic|smote", strategy="smote"), parts.train, parts.test)


@query("m13_out_of_fold_rows", "WITH " + SQL_TX + ", f AS (SELECT * FROM " + sql_folds("lt", "event_id", 3, strata="label") + """)
SELECT config, fold, count(*) AS rows, count(DISTINCT event_id) AS ids, sum(label)::BIGINT AS positives FROM f, (SELECT unnest(['logistic','forest']) AS config) GROUP BY 1, 2""")
def _(t: Tables):
    oof = T.cross_validate(_folded(t), [LOGISTIC, FOREST], "fold", 3)
    return oof.where(F.col("score").isNotNull()).groupBy("config", "fold").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids"), F.sum("label").alias("positives"))


_STRATEGIES = ("none", "oversample", "undersample")


@query("m13_b6_fit_records", "WITH " + SQL_TX + ", f AS (SELECT * FROM " + sql_folds("lt", "event_id", 3, strata="label") + f"""), n AS (SELECT g.fold, count(*) AS rows_seen, {SQL_SEEN('event_id')} AS seen_digest, sum(label)::BIGINT AS p, sum(1 - label)::BIGINT AS q
 FROM f, (SELECT DISTINCT fold FROM f) g WHERE f.fold <> g.fold GROUP BY 1), v AS (SELECT fold, count(*) AS valid_rows, sum(label)::BIGINT AS valid_positives FROM f GROUP BY 1),
s AS (SELECT *, CASE strategy WHEN 'none' THEN p WHEN 'oversample' THEN greatest(p, q) ELSE least(p, q) END AS positives_fitted, CASE strategy WHEN 'none' THEN q WHEN 'oversample' THEN greatest(p, q) ELSE least(p, q) END AS negatives_fitted
 FROM n, (SELECT unnest({list(_STRATEGIES)}) AS strategy))
SELECT 'logistic|' || strategy AS config, fold, rows_seen, seen_digest, positives_fitted + negatives_fitted AS rows_fitted, positives_fitted, negatives_fitted, valid_rows, valid_positives FROM s JOIN v USING (fold)""")
def _(t: Tables):
    recipes = [replace(LOGISTIC, name=f"logistic|{s}", strategy=s, params={"maxIter": 5}) for s in _STRATEGIES]
    records: list = []
    oof = T.cross_validate(_folded(t), recipes, "fold", 3, records=records)
    valid = oof.where(F.col("score").isNotNull()).groupBy("config", "fold").agg(F.count_distinct("event_id").alias("valid_rows"), F.sum("label").alias("valid_positives"))
    return T.fit_table(records, t.spark).drop("fit_seconds").join(valid, ["config", "fold"])


@query("m11_run_records", "WITH " + SQL_TX + ", s AS " + sql_split("lt", "event_id", strata="label") + f""", n AS (SELECT count(*) AS rows_seen, {SQL_SEEN('event_id')} AS seen_digest, sum(label)::BIGINT AS p, sum(1 - label)::BIGINT AS q FROM s WHERE split = 'train'),
x AS (SELECT split AS part, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives FROM s GROUP BY 1)
SELECT 'logistic|' || strategy AS config, part, positives, negatives, rows_seen, seen_digest, true AS timed, CASE strategy WHEN 'smote' THEN 2*greatest(p, q) ELSE p + q END AS rows_fitted,
 CASE strategy WHEN 'smote' THEN greatest(p, q) ELSE p END AS positives_fitted, CASE strategy WHEN 'smote' THEN greatest(p, q) ELSE q END AS negatives_fitted FROM n, x, (SELECT unnest(['class_weight', 'smote']) AS strategy)""")
def _(t: Tables):
    parts, out = _parts(t), None
    for s in ("class_weight", "smote"):
        one = T.run_experiment(replace(LOGISTIC, name=f"logistic|{s}", strategy=s, params={"maxIter": 5}), parts.train, parts.test)
        out = one if out is None else out.unionByName(one)
    return out.select("config", "part", "positives", "negatives", "rows_seen", "seen_digest", (F.col("fit_seconds") > 0).alias("timed"), "rows_fitted", "positives_fitted", "negatives_fitted")


@query("m13_cross_validated_summary")
def _(t: Tables):
    oof = T.cross_validate(_folded(t), [LOGISTIC, FOREST], "fold", 3)
    per = T.metrics_of(LOGISTIC, oof, ["config", "fold"])
    return summarise_folds(per, ["pr_auc", "roc_auc", "f1", "precision", "recall", "accuracy"], ["config"])


@query("m14_grid_search")
def _(t: Tables):
    per = T.search(_folded(t, 2), LOGISTIC, {"C": [0.01, 1.0], "penalty": ["l1", "l2"]}, "fold", 2, train_scores=True)
    return per.groupBy("config", "part").agg(F.avg("pr_auc").alias("mean_pr_auc"), F.stddev_samp("pr_auc").alias("std_pr_auc"),
                                             F.avg("f1").alias("mean_f1"))


@query("m14_random_search")
def _(t: Tables):
    per = T.search(_folded(t, 2), FOREST, {"numTrees": [5, 10], "maxDepth": [2, 4, 6]}, "fold", 2, n_iter=2)
    return per.groupBy("config").agg(F.avg("pr_auc").alias("mean_pr_auc"), F.min("pr_auc").alias("min_pr_auc"), F.max("pr_auc").alias("max_pr_auc"))


_STEPS = {"1:+time": ("yr", "mon"), "2:+customer": ("yr", "mon", "cust"), "3:+signal": ("yr", "mon", "cust", "signal")}


@query("m15_ablation", "WITH " + SQL_REG + ", " + _FOLDED + ", m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS config, sqrt(avg((y - score)^2)) AS rmse, 1 - avg((y - score)^2) / var_pop(y) AS r2 FROM ({sql_fold_scores('f', xs)})" for c, xs in _STEPS.items())
    + f") SELECT config, {r('rmse')} AS rmse, {r('r2')} AS r2, {r('rmse - lag(rmse) OVER (ORDER BY config)')} AS delta FROM m")
def _(t: Tables):
    oof = T.ablation(stored(folds(_orders(t), "o_orderkey", 5), "folds"), LINEAR, {"time": ["yr", "mon"], "customer": ["cust"], "signal": ["signal"]}, "fold", 5)
    m = M.regression_metrics(oof, "label", "score", ["config"]).select("config", "rmse", "r2")
    return step_delta(m, "config", "rmse")


@query("m16_encoder_sensitivity")
def _(t: Tables):
    frame = prep.modelling_frame(t.titles, "row_id", "rating").select("row_id", "rating", "director", "actor_1")
    df = stored(folds(stored(frame, "frame"), "row_id", 2), "folds")
    oof = T.people_sensitivity(df, "person", ["director", "actor_1"], "rating", "row_id", "fold", 2, [60, 200])
    per = M.regression_metrics(oof, "label", "score", ["config", "fold"])
    return paired_folds(per, "config", "fold", "rmse", "min_count=60")


@query("m17_without_outliers", "WITH " + SQL_REG + ", " + _FOLDED + """, cube AS (SELECT *, signal^3 AS squared FROM f), fence AS (SELECT quantile_cont(squared, 0.25) AS q1, quantile_cont(squared, 0.75) AS q3 FROM cube),
inner_rows AS (SELECT cube.* FROM cube, fence WHERE squared BETWEEN q1 - 1.5*(q3 - q1) AND q3 + 1.5*(q3 - q1)) """ + " UNION ALL ".join(
    f"SELECT '{c}' AS config, count(*) AS n, {r('sqrt(avg((y - score)^2))')} AS rmse, {r('avg(abs(y - score))')} AS mae FROM ({sql_fold_scores(rows, REG)})" for c, rows in (("all rows", "cube"), ("without outliers", "inner_rows"))))
def _(t: Tables):
    df = stored(flag_iqr(folds(_orders(t).withColumn("squared", F.col("signal") ** 3), "o_orderkey", 5), ["squared"]), "flagged")
    out = None
    for name, rows in (("all rows", df), ("without outliers", df.where(~F.col("is_outlier")))):
        one = T.cross_validate_linear(rows, [replace(LINEAR, name=name)], "fold")
        out = one if out is None else out.unionByName(one)
    return M.regression_metrics(out, "label", "score", ["config"]).select("config", "n", "rmse", "mae")


_GROUPS = {"time": ("yr", "mon"), "customer": ("cust",), "signal": ("signal",)}
_PAIRS = "(SELECT r.*, g.fold AS g FROM f r, (SELECT DISTINCT fold FROM f) g WHERE r.fold <> g.fold)"
_NUMBER = lambda order: f"row_number() OVER (PARTITION BY rep, fold ORDER BY {sql_digest('42-' + order, 'rep', 'o_orderkey')}, o_orderkey) AS number"
_GROUP_RMSE = lambda cols: f"sqrt(avg((e{''.join(f' + d{REG.index(c)}' for c in cols)})^2))"


@query("m18_fold_importance", "WITH " + SQL_REG + ", " + _FOLDED + f""", again AS (SELECT * FROM f, (SELECT unnest(range(1, 6)) AS rep)), w AS ({sql_solved(sql_normal(_PAIRS, REG, 0.0, "g", "g"), len(REG))}),
a AS (SELECT *, {_NUMBER('to')} FROM again), b AS (SELECT rep, fold, {', '.join(f'{c} AS p_{c}' for c in REG)}, {_NUMBER('from')} FROM again),
j AS (SELECT fold, rep, my + {' + '.join(f'w{i} * ({c} - m{i}) / s{i}' for i, c in enumerate(REG))} - y AS e, {', '.join(f'w{i} * (p_{c} - {c}) / s{i} AS d{i}' for i, c in enumerate(REG))} FROM a JOIN b USING (rep, fold, number) JOIN w ON fold = g),
k AS (""" + " UNION ALL ".join(f"SELECT '{g}' AS feature_group, fold, rep, {_GROUP_RMSE(cols)} - sqrt(avg(e^2)) AS worse FROM j GROUP BY fold, rep" for g, cols in _GROUPS.items()) + f"""),
v AS (SELECT feature_group, fold, avg(worse) AS x FROM k GROUP BY 1, 2)
SELECT feature_group, count(*) AS folds, {r('avg(x)')} AS mean_worse, {r('stddev_samp(x)')} AS std_worse, count(*) FILTER (x > 0) AS folds_worse FROM v GROUP BY 1""")
def _(t: Tables):
    df = stored(folds(_orders(t), "o_orderkey", 5), "folds")
    return T.importance_summary(T.linear_importance(df, LINEAR, _GROUPS, "fold"))


@query("m18_permutation_importance")
def _(t: Tables):
    parts = split(_orders(t), "o_orderkey").saved(scratch_path(t.spark, "orders-split"))
    model = T.fit(LINEAR, parts.train)
    return T.permutation_importance(model, parts.test, LINEAR, {"time": ["yr", "mon"], "customer": ["cust"], "signal": ["signal"]}, "rmse", repeats=1)


@query("m18_permuted_column_keeps_values", "SELECT sum(o_custkey)::DOUBLE AS total, count(DISTINCT o_custkey) AS customers, count(*) AS rows FROM orders")
def _(t: Tables):
    mixed = T.permuted(_orders(t), ["cust"], "o_orderkey", 1)
    return mixed.agg(F.sum("cust").alias("total"), F.count_distinct("cust").alias("customers"), F.count(F.lit(1)).alias("rows"))


@query("m19_impurity_importance")
def _(t: Tables):
    return T.impurity_importance(T.fit(FOREST, _tx(t)), FOREST, lambda f: "when" if f == "time" else "what", t.spark)


def _bundle(t: Tables):
    df = _tx(t)
    model = T.fit(LOGISTIC, df)
    path = scratch_path(t.spark, "bundle")
    files.save_bundle(model, {"features": list(FEATURES), "threshold": 0.5, "label": "label", "rows": df.count()}, path, t.spark)
    return model, path


@query("s9_s12_bundle_reload_same_scores", "SELECT count(*) AS rows, 0.0::DOUBLE AS max_diff FROM events", 12)
def _(t: Tables):
    model, path = _bundle(t)
    again, _ = files.load_bundle(t.spark, path)
    df = _tx(t)
    a = T.score(model, df, LOGISTIC).select("event_id", F.col("score").alias("a"))
    b = T.score(again, df, LOGISTIC).select("event_id", F.col("score").alias("b"))
    return a.join(b, "event_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"))


@query("s9_s10_bundle_manifest", "WITH " + SQL_TX + f", m AS (SELECT count(*) AS rows, sum(label)::BIGINT AS positives, {', '.join(f'min({c})::DOUBLE AS lo{i}, max({c})::DOUBLE AS hi{i}' for i, c in enumerate(FEATURES))} FROM lt) "
       + " UNION ALL ".join(f"SELECT {i}::BIGINT AS position, '{c}' AS feature, {r(f'lo{i}')} AS low, {r(f'hi{i}')} AS high, rows, positives, rows - positives AS negatives, 'PopulationScalerModel,VectorAssembler,LogisticRegressionModel' AS stages FROM m" for i, c in enumerate(FEATURES)))
def _(t: Tables):
    df, path = _tx(t), scratch_path(t.spark, "bundle")
    model = T.fit(replace(LOGISTIC, params={"maxIter": 5}), df)
    files.save_bundle(model, {"features": list(FEATURES), "threshold": 0.5, "label": "label", **files.training_summary(df, FEATURES, "label")}, path, t.spark)
    _, m = files.load_bundle(t.spark, path)
    stages = ",".join(s["class"] for s in m["manifest"]["stages"])
    rows = [(i, c, *map(float, m["ranges"][c]), m["rows"], m["classes"]["1"], m["classes"]["0"], stages) for i, c in enumerate(m["features"])]
    return t.spark.createDataFrame(rows, "position int, feature string, low double, high double, rows bigint, positives bigint, negatives bigint, stages string")


@query("s11_bundle_metadata", "SELECT 'label' AS label, 3::BIGINT AS features, 0.5::DOUBLE AS threshold, count(*) AS rows FROM events")
def _(t: Tables):
    _, path = _bundle(t)
    m = files.bundle_metadata(t.spark, path)
    return t.spark.createDataFrame([(m["label"], len(m["features"]), m["threshold"], m["rows"])], "label string, features int, threshold double, rows bigint")


@query("m20_m21_refit_and_score_batch", "WITH " + SQL_TRANSACTIONS + " SELECT event_id, time >= 0 AS kept_input, true AS decided_by_threshold FROM tx")
def _(t: Tables):
    model = T.fit(LOGISTIC, _tx(t))
    scored = T.predict_batch(model, _tx(t).drop("label"), FEATURES, "label", 0.4)
    return scored.select("event_id", (F.col("time") >= 0).alias("kept_input"), ((F.col("score") >= 0.4).cast("int") == F.col("pred")).alias("decided_by_threshold"))


@query("m22_single_record_equals_batch", "SELECT 5::BIGINT AS records, 0.0::DOUBLE AS max_diff", 12)
def _(t: Tables):
    df = _tx(t).drop("label")
    model = T.fit(LOGISTIC, _tx(t))
    batch = T.predict_batch(model, df, FEATURES, "label", 0.5).select("event_id", F.col("score").alias("a"))
    singles = None
    for row in df.orderBy("event_id").limit(5).collect():
        one = T.predict_batch(model, t.spark.createDataFrame([row], df.schema), FEATURES, "label", 0.5)
        singles = one if singles is None else singles.unionByName(one)
    joined = singles.select("event_id", F.col("score").alias("b")).join(batch, "event_id")
    return joined.agg(F.count(F.lit(1)).alias("records"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"))


# ---------------------------------------------------------------- streams

def _event_stream(t: Tables) -> DataFrame:
    return flows.read_stream(t.spark, t.dir, "events.parquet", t.events.schema)


@query("z1_stream_quarantine", """SELECT event_id, CASE WHEN k < 10 THEN 'amount: missing' ELSE 'amount: negative' END AS errors FROM (SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events) WHERE k < 20""")
def _(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    amount = F.when(k < 10, F.lit("")).when(k < 20, F.lit("-1.5")).otherwise(F.col("value").cast("string"))
    stream = _event_stream(t).select("event_id", amount.alias("amount"))
    _, bad = flows.quarantine(stream, number_rules("amount", allow_negative=False))
    return flows.run_once(bad.select("event_id", F.concat_ws("; ", "errors").alias("errors")), scratch_path(t.spark, "stream-quarantine"))


@query("z1_stream_both_sides", """SELECT event_id, k < 20 AS rejected, CASE WHEN k < 10 THEN 'amount: missing' WHEN k < 20 THEN 'amount: negative' ELSE '' END AS errors
FROM (SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events)""")
def _(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    amount = F.when(k < 10, F.lit("")).when(k < 20, F.lit("-1.5")).otherwise(F.col("value").cast("string"))
    stream = _event_stream(t).select("event_id", amount.alias("amount"))
    good, bad = flows.run_both(stream, number_rules("amount", allow_negative=False), scratch_path(t.spark, "stream-both"))
    rejected = bad.select("event_id", F.lit(True).alias("rejected"), F.concat_ws("; ", "errors").alias("errors"))
    return rejected.unionByName(good.select("event_id", F.lit(False).alias("rejected"), F.lit("").alias("errors")))


@query("z2_stream_scoring", "SELECT count(*) AS rows, 0.0::DOUBLE AS max_diff FROM events", 12)
def _(t: Tables):
    model = T.fit(LOGISTIC, _tx(t))
    numbers = lambda df: df.select("event_id", (F.col("event_id") * 1.0).alias("time"), F.col("value").alias("amount"),
                                   F.get_json_object("props", "$.k").cast("double").alias("k"))
    out = flows.run_once(flows.score_stream(numbers(_event_stream(t)), model, FEATURES, "label", 0.5).select("event_id", "score"),
                         scratch_path(t.spark, "stream-scores"))
    batch = T.predict_batch(model, numbers(t.events), FEATURES, "label", 0.5).select("event_id", F.col("score").alias("b"))
    return out.join(batch, "event_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("score") - F.col("b"))).alias("max_diff"))


@query("z3_stream_hourly_counts", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t: Tables):
    out = flows.run_once(flows.hourly_counts(_event_stream(t), "ts", "event_type"), scratch_path(t.spark, "stream-hours"), mode="update", keys=("hour_start", "event_type"))
    return out.select(F.date_format("hour_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


@query("z4_stream_deduplication", "SELECT count(*) AS rows, count(DISTINCT event_id) AS events FROM events")
def _(t: Tables):
    doubled = _event_stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    out = flows.run_once(flows.drop_duplicates(doubled, ["event_id", "event_type", "value"], "ts", lateness="1 hour"), scratch_path(t.spark, "stream-dedupe"))
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"))


