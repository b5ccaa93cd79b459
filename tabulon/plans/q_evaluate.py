"""Queries: metrics, curves, thresholds, error analysis and model selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.draws import sql_poisson_weights
from tabulon.functions.numeric import band, bucket_floor
from tabulon.functions.text import split_tokens
from tabulon.operators import bootstrap as BS
from tabulon.operators import choose as S
from tabulon.operators import errors as Q
from tabulon.operators import metrics as M
from tabulon.operators.profile import describe
from tabulon.operators.relate import rank_results
from tabulon.operators.reshape import to_long
from tabulon.operators.splits import repeated_folds
from tabulon.plans.q_prepare import sql_folds
from tabulon.plans.registry import query, r, union
from tabulon.plans.tables import SQL_PREDICTED, SQL_SCORED, Tables, sql_digest

MODELS = ("p_mean", "p_prio", "p_year")
SQL_LONG = SQL_PREDICTED + ", long AS (" + union(f"SELECT o_orderkey, actual, '{m}' AS model, {m} AS predicted FROM pred" for m in MODELS) + ")"
SQL_RESID = SQL_PREDICTED + ", e AS (SELECT *, actual - p_year AS residual, abs(actual - p_year) AS abs_error FROM pred)"
INF = float("inf")


def _long(t: Tables):
    return to_long(t.predicted.select("o_orderkey", "actual", *MODELS), ["o_orderkey", "actual"], MODELS, "model", "predicted")


def _resid(t: Tables):
    return Q.with_residuals(t.predicted, "actual", "p_year")


@query("x1_x2_regression_metrics", "WITH " + SQL_LONG + f""" SELECT model, count(*) AS n, {r('avg(abs(actual-predicted))')} AS mae, {r('avg((actual-predicted)^2)')} AS mse, {r('sqrt(avg((actual-predicted)^2))')} AS rmse,
 {r('1 - sum((actual-predicted)^2)/(count(*)*var_pop(actual))')} AS r2, {r('avg(actual-predicted)')} AS bias, {r('max(abs(actual-predicted))')} AS max_ae,
 {r('1 - var_pop(actual-predicted)/var_pop(actual)')} AS explained_variance, {r('quantile_cont(abs(actual-predicted), 0.5)')} AS median_ae FROM long GROUP BY 1""")
def _(t: Tables):
    df = _long(t)
    return M.regression_metrics(df, "actual", "predicted", ["model"]).join(M.median_absolute_error(df, "actual", "predicted", ["model"]), "model")


_CONF = "count(*) FILTER (label=1 AND score>={t}) AS tp, count(*) FILTER (label=0 AND score>={t}) AS fp, count(*) FILTER (label=1 AND score<{t}) AS fn, count(*) FILTER (label=0 AND score<{t}) AS tn"
_RATES = ", ".join([f"{r('(tp+tn)/(tp+fp+fn+tn)')} AS accuracy", f"{r('coalesce(tp/nullif(tp+fp,0),0)')} AS precision", f"{r('coalesce(tp/nullif(tp+fn,0),0)')} AS recall",
                    f"{r('coalesce(2*tp/nullif(2*tp+fp+fn,0),0)')} AS f1", f"{r('fp/nullif(fp+tn,0)')} AS fpr", f"{r('fn/nullif(fn+tp,0)')} AS fnr", f"{r('tn/nullif(tn+fp,0)')} AS specificity"])


@query("x3_x4_classification_metrics", "WITH " + SQL_SCORED + f", c AS (SELECT config, {_CONF.replace('{t}', '0.5')} FROM scored GROUP BY 1) SELECT config, tp, fp, fn, tn, {_RATES}, tp+fn AS positives, fp+tn AS negatives FROM c")
def _(t: Tables):
    return M.classification_metrics(t.scored, "label", "score", ["config"])


_CURVE = SQL_SCORED + """, h AS (SELECT {by}, score, sum(label)::BIGINT AS pos, sum(1-label)::BIGINT AS neg FROM scored GROUP BY {by}, score),
cv AS (SELECT *, sum(pos) OVER w::BIGINT AS tp, sum(neg) OVER w::BIGINT AS fp, sum(pos) OVER (PARTITION BY {by})::BIGINT AS tot_pos, sum(neg) OVER (PARTITION BY {by})::BIGINT AS tot_neg FROM h WINDOW w AS (PARTITION BY {by} ORDER BY score DESC))"""
_CURVE_OF_NULLS = _CURVE.replace(", h AS (", ", nulled AS (SELECT * REPLACE (nullif(config, 'mix') AS config) FROM scored), h AS (").replace("FROM scored GROUP BY {by}", "FROM nulled GROUP BY {by}")
_AUC = f"{r('sum(neg * (tp - pos + pos/2.0)) / (max(tot_pos) * max(tot_neg))')} AS roc_auc, {r('sum(pos * tp / (tp + fp)) / max(tot_pos)')} AS pr_auc"


@query("x5_x6_auc_and_average_precision", "WITH " + _CURVE.replace("{by}", "config, fold") + f" SELECT config, fold, max(tot_pos) AS positives, max(tot_neg) AS negatives, {_AUC} FROM cv GROUP BY 1, 2")
def _(t: Tables):
    return M.ranking_metrics(M.curve_points(t.scored, "label", "score", ["config", "fold"]), ["config", "fold"])


@query("x5_x6_range_partitioned", "WITH " + _CURVE.replace("{by}", "config") + f" SELECT config, max(tot_pos) AS positives, max(tot_neg) AS negatives, {_AUC} FROM cv GROUP BY 1")
def _(t: Tables):
    return M.ranking_metrics(M.curve_points(t.scored, "label", "score", ["config"]), ["config"])


@query("x7_x8_curve_points", "WITH " + _CURVE.replace("{by}", "config") + f" SELECT config, {r('score')} AS score, pos, neg, tp, fp, tot_pos, tot_neg, {r('tp/(tp+fp)')} AS precision, {r('tp/tot_pos')} AS recall, {r('fp/tot_neg')} AS fpr FROM cv")
def _(t: Tables):
    return M.curve_points(t.scored, "label", "score", ["config"])


@query("x3_x6_evaluate_folds", "WITH " + _CURVE.replace("{by}", "config, fold") + f""", k AS (SELECT config, fold, {_CONF.replace('{t}', '0.4')} FROM scored GROUP BY 1, 2), a AS (SELECT config, fold, {_AUC} FROM cv GROUP BY 1, 2)
SELECT config, fold, tp, fp, fn, tn, {_RATES}, tp+fn AS positives, fp+tn AS negatives, roc_auc, pr_auc FROM k JOIN a USING (config, fold)""")
def _(t: Tables):
    return M.evaluate(t.scored, "label", "score", ["config", "fold"], threshold=0.4)


@query("x3_x6_evaluate_null_group", "WITH " + _CURVE_OF_NULLS.replace("{by}", "config, fold") + f""", k AS (SELECT config, fold, {_CONF.replace('{t}', '0.4')} FROM nulled GROUP BY 1, 2), a AS (SELECT config, fold, {_AUC} FROM cv GROUP BY 1, 2)
SELECT k.config, k.fold, tp, fp, fn, tn, {_RATES}, tp+fn AS positives, fp+tn AS negatives, roc_auc, pr_auc FROM k JOIN a ON k.config IS NOT DISTINCT FROM a.config AND k.fold = a.fold""")
def _(t: Tables):
    return M.evaluate(t.scored.withColumn("config", F.nullif("config", F.lit("mix"))), "label", "score", ["config", "fold"], threshold=0.4)


def _grid_sql(by: str, grid, where: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""g AS (SELECT unnest([{', '.join(str(x) for x in grid)}])::DOUBLE AS threshold), tt AS (SELECT {lead}threshold, count(*) FILTER (label=1 AND score>=threshold) AS tp, count(*) FILTER (label=0 AND score>=threshold) AS fp,
 count(*) FILTER (label=1 AND score<threshold) AS fn, count(*) FILTER (label=0 AND score<threshold) AS tn FROM scored, g {where} GROUP BY {lead}threshold),
th AS (SELECT *, tp + fp AS flagged, tp/nullif(tp+fp,0) AS precision, tp/nullif(tp+fn,0) AS recall, coalesce(2*tp/nullif(2*tp+fp+fn,0),0) AS f1 FROM tt)"""


@query("x9_threshold_table", "WITH " + SQL_SCORED + ", " + _grid_sql("config", M.THRESHOLDS) + f" SELECT config, threshold, tp, fp, fn, tn, flagged, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1 FROM th")
def _(t: Tables):
    return M.threshold_table(t.scored, "label", "score", ["config"])


@query("x10_best_threshold", "WITH " + SQL_SCORED + ", " + _grid_sql("config, fold", M.THRESHOLDS) + f""", k AS (SELECT *, row_number() OVER (PARTITION BY config, fold ORDER BY round(f1, 8) DESC, threshold) AS rn FROM th)
SELECT config, fold, threshold, {r('f1')} AS f1 FROM k WHERE rn = 1""")
def _(t: Tables):
    return M.best_threshold(M.threshold_table(t.scored, "label", "score", ["config", "fold"]), ["config", "fold"])


@query("x10_best_threshold_extended", "WITH " + SQL_SCORED + ", " + _grid_sql("config", [*M.LOWER_EXTENSION, *M.THRESHOLDS, *M.UPPER_EXTENSION]) + f""", b AS (SELECT config, arg_min(threshold, (-round(f1, 8), threshold)) AS t0 FROM th WHERE threshold BETWEEN 0.05 AND 0.95 GROUP BY 1),
e AS (SELECT config, t0, CASE WHEN t0 = 0.95 THEN 'upper' WHEN t0 = 0.05 THEN 'lower' ELSE 'none' END AS edge FROM b),
k AS (SELECT th.*, edge, row_number() OVER (PARTITION BY config ORDER BY round(f1, 8) DESC, threshold) AS rn FROM th JOIN e USING (config) WHERE threshold BETWEEN 0.05 AND 0.95 OR (edge='upper' AND threshold > 0.95) OR (edge='lower' AND threshold < 0.05))
SELECT config, edge, threshold, {r('f1')} AS f1 FROM k WHERE rn = 1""")
def _(t: Tables):
    return M.best_threshold_extended(t.scored, "label", "score", ["config"])


@query("x11_alternative_rules", "WITH " + SQL_SCORED + ", " + _grid_sql("config", M.THRESHOLDS) + " SELECT config, max(threshold) FILTER (recall >= 0.3) AS recall_rule, min(threshold) FILTER (precision >= 0.2) AS precision_rule FROM th GROUP BY 1")
def _(t: Tables):
    return M.alternative_thresholds(M.threshold_table(t.scored, "label", "score", ["config"]), ["config"], recall=.3, precision=.2)


@query("x12_threshold_stability", "WITH " + SQL_SCORED + ", " + _grid_sql("fold", M.THRESHOLDS, "WHERE config = 'mix'") + f""", p AS (SELECT threshold, coalesce(2*sum(tp)/nullif(2*sum(tp)+sum(fp)+sum(fn),0),0) AS f1 FROM th GROUP BY 1), c AS (SELECT arg_min(threshold, (-round(f1, 8), threshold)) AS t0 FROM p),
k AS (SELECT fold, threshold, f1, row_number() OVER (PARTITION BY fold ORDER BY round(f1, 8) DESC, threshold) AS rn FROM th)
SELECT k.fold, k.threshold, {r('k.f1')} AS f1, t0 AS pooled_threshold, {r('th.f1')} AS f1_at_pooled FROM k, c, th WHERE rn = 1 AND th.fold = k.fold AND th.threshold = t0""")
def _(t: Tables):
    return M.threshold_stability(t.scored.where("config = 'mix'"), "label", "score", "fold")


def _sql_reach(table: str, by: str) -> str:
    """SQL of the best threshold per group, the grid being extended behind an edge."""
    return f"""(SELECT * FROM (SELECT t.*, edge, row_number() OVER (PARTITION BY {', '.join('t.' + b for b in by.split(', '))} ORDER BY round(f1, 8) DESC, threshold) AS rn FROM {table} t JOIN (
 SELECT {by}, CASE arg_min(threshold, (-round(f1, 8), threshold)) WHEN 0.95 THEN 'upper' WHEN 0.05 THEN 'lower' ELSE 'none' END AS edge FROM {table} WHERE threshold BETWEEN 0.05 AND 0.95 GROUP BY {by}) USING ({by})
 WHERE threshold BETWEEN 0.05 AND 0.95 OR (edge = 'upper' AND threshold > 0.95) OR (edge = 'lower' AND threshold < 0.05)) WHERE rn = 1)"""


@query("x12_threshold_stability_extended", "WITH " + SQL_SCORED + ", " + _grid_sql("config, fold", [*M.LOWER_EXTENSION, *M.THRESHOLDS, *M.UPPER_EXTENSION]) + f""",
pooled AS (SELECT config, threshold, coalesce(2*sum(tp)/nullif(2*sum(tp)+sum(fp)+sum(fn),0),0) AS f1 FROM th GROUP BY 1, 2)
SELECT k.config, k.fold, k.edge, k.threshold, {r('k.f1')} AS f1, c.threshold AS pooled_threshold, c.edge AS pooled_edge, {r('th.f1')} AS f1_at_pooled
FROM {_sql_reach('th', 'config, fold')} k JOIN {_sql_reach('pooled', 'config')} c ON k.config = c.config JOIN th ON th.config = k.config AND th.fold = k.fold AND th.threshold = c.threshold""")
def _(t: Tables):
    return M.threshold_stability_extended(t.scored, "label", "score", "fold", ["config"])


_FOLDS = SQL_LONG + f""", f AS (SELECT model, 1 + {sql_digest('cv', 'o_orderkey')} % 5 AS fold, sqrt(avg((actual-predicted)^2)) AS rmse, avg(abs(actual-predicted)) AS mae FROM long GROUP BY 1, 2)"""


def _fold_metrics(t: Tables):
    from tabulon.functions.draws import digest
    df = _long(t).withColumn("fold", (F.pmod(digest("cv", "o_orderkey"), F.lit(5)) + 1))
    return M.regression_metrics(df, "actual", "predicted", ["model", "fold"])


@query("x13_fold_summary", "WITH " + _FOLDS + " " + union(f"""SELECT model, '{m}' AS metric, count(*) AS folds, {r(f'avg({m})')} AS mean, {r(f'stddev_samp({m})')} AS std, {r(f'min({m})')} AS min, {r(f'max({m})')} AS max,
 {r(f'avg({m}) - 2.7764451052*stddev_samp({m})/sqrt(5)')} AS ci_low, {r(f'avg({m}) + 2.7764451052*stddev_samp({m})/sqrt(5)')} AS ci_high FROM f GROUP BY 1""" for m in ("rmse", "mae")))
def _(t: Tables):
    return S.summarise_folds(_fold_metrics(t), ["rmse", "mae"], ["model"])


@query("x14_population_std", "WITH " + _FOLDS + f" SELECT model, 'rmse' AS metric, {r('stddev_pop(rmse)')} AS std FROM f GROUP BY 1")
def _(t: Tables):
    return S.summarise_folds(_fold_metrics(t), ["rmse"], ["model"], ddof=0).select("model", "metric", "std")


_PAIR = ", pf AS (SELECT a.model, count(*) AS folds, avg(a.rmse-b.rmse) AS md, stddev_samp(a.rmse-b.rmse) AS sd, count(*) FILTER (a.rmse<b.rmse) AS better, count(*) FILTER (a.rmse>b.rmse) AS worse FROM f a JOIN f b ON a.fold=b.fold AND b.model='p_year' GROUP BY 1)"


@query("x15_x17_paired_and_tied", "WITH " + _FOLDS + _PAIR + f" SELECT model, folds, {r('md')} AS mean_diff, {r('sd')} AS std_diff, better AS folds_better, worse AS folds_worse, abs(md) < coalesce(sd, 0) OR worse < 4 AS tied FROM pf")
def _(t: Tables):
    return S.tied_with(S.paired_folds(_fold_metrics(t), "model", "fold", "rmse", "p_year"))


_RANKS = {"amount": (1, 2), "key": (0, 1), "mix": (1, 0)}


@query("x16_one_se_choice", "WITH " + _CURVE.replace("{by}", "config, fold") + f""", a AS (SELECT config, fold, sum(pos * tp / (tp + fp)) / max(tot_pos) AS ap FROM cv GROUP BY 1, 2), s AS (SELECT config, avg(ap) AS m, stddev_samp(ap) AS sd FROM a GROUP BY 1),
b AS (SELECT arg_max(m, (m, config)) AS bm, arg_max(sd, (m, config)) AS bs FROM s), e AS (SELECT s.*, bm - bs/sqrt(5) AS lim, CASE config WHEN 'key' THEN 0 ELSE 1 END AS fr, CASE config WHEN 'amount' THEN 2 WHEN 'key' THEN 1 ELSE 0 END AS ir FROM s, b WHERE m >= bm - bs/sqrt(5))
SELECT config, {r('m')} AS pr_auc_mean, {r('sd')} AS pr_auc_std, fr::BIGINT AS family_rank, ir::BIGINT AS imbalance_rank, {r('lim')} AS "limit", config = (SELECT arg_min(config, (fr, ir, -m, config)) FROM e) AS choice FROM e""")
def _(t: Tables):
    folds = M.ranking_metrics(M.curve_points(t.scored, "label", "score", ["config", "fold"]), ["config", "fold"])
    s = S.summarise_folds(folds, ["pr_auc"], ["config"]).select("config", F.col("mean").alias("pr_auc_mean"), F.col("std").alias("pr_auc_std"))
    rank = lambda i: F.create_map(*[F.lit(x) for k, v in _RANKS.items() for x in (k, v[i])])[F.col("config")]
    table = s.withColumn("family_rank", rank(0)).withColumn("imbalance_rank", rank(1))
    return S.one_se_choice(table, "pr_auc_mean", "pr_auc_std", 5, ["family_rank", "imbalance_rank"], "config")


@query("x18_generalisation_gap", "WITH " + _FOLDS + f""", g AS (SELECT model, avg(rmse) FILTER (fold < 5) AS tr, avg(rmse) FILTER (fold = 5) AS va FROM f GROUP BY 1)
SELECT model, {r('tr')} AS train, {r('va')} AS valid, {r('tr - va')} AS gap, {r('100*(tr-va)/va')} AS gap_pct FROM g""")
def _(t: Tables):
    f = _fold_metrics(t)
    return S.generalisation_gap(f.where("fold < 5"), f.where("fold = 5"), "rmse", ["model"])


@query("x19_improvement", "WITH " + SQL_LONG + f""", m AS (SELECT model, sqrt(avg((actual-predicted)^2)) AS rmse FROM long GROUP BY 1) SELECT model, {r('rmse')} AS rmse, {r("100*((SELECT rmse FROM m WHERE model='p_mean') - rmse)/(SELECT rmse FROM m WHERE model='p_mean')")} AS improvement_pct FROM m""")
def _(t: Tables):
    m = M.regression_metrics(_long(t), "actual", "predicted", ["model"]).select("model", "rmse")
    return S.improvement(m, "model", "rmse", "p_mean")


_OTHERS = ("p_mean", "p_prio")
_ERRORS = ", ".join(f"(actual - {m})^2 AS {m}" for m in MODELS)


@query("x20_bootstrap_rmse_difference", "WITH " + SQL_PREDICTED + f""", e AS (SELECT o_orderkey, {_ERRORS} FROM pred), w AS ({sql_poisson_weights('e', sql_digest('42', 'o_orderkey'), BS.REPLICATES, ', '.join(MODELS))}),
per AS (SELECT replicate, {', '.join(f'sqrt(sum(w * {m}) / sum(w)) AS {m}' for m in MODELS)} FROM w GROUP BY 1), point AS (SELECT {', '.join(f'sqrt(avg({m})) AS {m}' for m in MODELS)} FROM e)
""" + union(f"SELECT '{m}' AS model, (SELECT {r(f'{m} - p_year')} FROM point) AS diff, {r(f'quantile_cont({m} - p_year, 0.025)')} AS low, {r(f'quantile_cont({m} - p_year, 0.975)')} AS high, {r(f'avg(({m} > p_year)::INT)')} AS share_worse FROM per" for m in _OTHERS))
def _(t: Tables):
    return BS.rmse_difference(t.predicted, "o_orderkey", "actual", list(MODELS), "p_year")


_RATES = {"precision": "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END", "recall": "tp / p", "f1": "2 * tp / (tp + fp + p)", "pr_auc": "steps / p", "roc_auc": "CASE WHEN n > 0 THEN pairs / (p::DOUBLE * n) END"}


@query("x21_bootstrap_classification", "WITH " + SQL_SCORED + f""", mix AS (SELECT row_id, label, score FROM scored WHERE config = 'mix' AND score IS NOT NULL), w AS ({sql_poisson_weights('mix', sql_digest('42', 'row_id'), BS.REPLICATES, 'label, score')}),
cell AS (SELECT replicate, score, sum(w * label) AS pos, sum(w * (1 - label)) AS neg FROM w GROUP BY 1, 2),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY replicate ORDER BY score DESC) AS ap, sum(neg) OVER (PARTITION BY replicate ORDER BY score DESC) AS an FROM cell),
per AS (SELECT replicate, sum(pos) AS p, sum(neg) AS n, coalesce(sum(pos) FILTER (score >= 0.4), 0) AS tp, coalesce(sum(neg) FILTER (score >= 0.4), 0) AS fp, sum(CASE WHEN pos > 0 THEN pos * ap::DOUBLE / (ap + an) ELSE 0 END) AS steps,
 sum(neg * (ap - pos / 2.0)::DOUBLE) AS pairs FROM cum GROUP BY 1), v AS (SELECT {', '.join(f'({e})::DOUBLE AS {m}' for m, e in _RATES.items())} FROM per WHERE p > 0)
""" + union(f"SELECT '{m}' AS metric, {r(f'quantile_cont({m}, 0.025)')} AS low, {r(f'quantile_cont({m}, 0.975)')} AS high, count({m}) AS replicates FROM v" for m in _RATES))
def _(t: Tables):
    mix = t.scored.where("config = 'mix'").select("row_id", "label", "score")
    return BS.classification_intervals(mix, "row_id", "label", "score", threshold=0.4)


@query("x22_residual_summary", "WITH " + SQL_RESID + f""" SELECT o_orderstatus, count(*) AS n, {r('avg(residual)')} AS mean, {r('stddev_samp(residual)')} AS std, {r('min(residual)')} AS min, {r('max(residual)')} AS max, {r('skewness(residual)')} AS skewness,
 {r('avg((residual > 0)::INT)')} AS share_positive, {r('avg((abs_error <= 0.5)::INT)')} AS within_0_5, {r('avg((abs_error <= 1)::INT)')} AS within_1, {r('avg((abs_error <= 2)::INT)')} AS within_2, {r('quantile_cont(residual, 0.5)')} AS median FROM e GROUP BY 1""")
def _(t: Tables):
    return Q.residual_summary(_resid(t), ["o_orderstatus"])


@query("x22_residual_summary_null_group", "WITH " + SQL_RESID + f""" SELECT nullif(o_orderstatus, 'P') AS status, count(*) AS n, {r('avg(residual)')} AS mean, {r('stddev_samp(residual)')} AS std, {r('min(residual)')} AS min, {r('max(residual)')} AS max, {r('skewness(residual)')} AS skewness,
 {r('avg((residual > 0)::INT)')} AS share_positive, {r('avg((abs_error <= 0.5)::INT)')} AS within_0_5, {r('avg((abs_error <= 1)::INT)')} AS within_1, {r('avg((abs_error <= 2)::INT)')} AS within_2, {r('quantile_cont(residual, 0.5)')} AS median FROM e GROUP BY 1""")
def _(t: Tables):
    return Q.residual_summary(_resid(t).withColumn("status", F.nullif("o_orderstatus", F.lit("P"))), ["status"])


@query("x23_error_table", "WITH " + SQL_RESID + f""" SELECT o_orderkey, o_orderpriority, {r('actual')} AS actual, {r('p_year')} AS p_year, {r('residual')} AS residual, {r('abs_error')} AS abs_error, {r('100*abs_error/actual')} AS pct_error
FROM e ORDER BY round(abs_error, 9) DESC, o_orderkey LIMIT 100""")
def _(t: Tables):
    e = _resid(t).select("o_orderkey", "o_orderpriority", "actual", "p_year", "residual", "abs_error", "pct_error")
    return e.orderBy(F.round("abs_error", 9).desc(), "o_orderkey").limit(100)


@query("x24_error_coverage", "WITH " + SQL_RESID + " " + union(f"SELECT {b}::DOUBLE AS bound, {r(f'avg((abs_error <= {b})::INT)')} AS share FROM e" for b in (.5, 1, 1.5, 2)))
def _(t: Tables):
    return Q.error_coverage(_resid(t), (.5, 1, 1.5, 2))


_BY = f"count(*) AS n, {r('avg(abs_error)')} AS mae, {r('sqrt(avg(residual^2))')} AS rmse, {r('avg(actual)')} AS mean_actual, {r('avg(p_year)')} AS mean_predicted, {r('avg(residual)')} AS mean_residual"


@query("x25_error_by_actual_group", "WITH " + SQL_RESID + f" SELECT CASE WHEN actual < 4 THEN 'low' WHEN actual < 7 THEN 'medium' ELSE 'high' END AS actual_group, {_BY} FROM e GROUP BY 1")
def _(t: Tables):
    return Q.error_by(_resid(t), band("actual", [-INF, 4, 7, INF], ["low", "medium", "high"]), "actual_group", "actual", "p_year")


@query("x26_error_by_characteristics", "WITH " + SQL_RESID + " " + union(f"SELECT '{n}' AS key, ({x})::VARCHAR AS value, count(*) AS n, {r('avg(abs_error)')} AS mae, {r('avg(residual)')} AS mean_residual FROM e GROUP BY 2"
                                                                     for n, x in [("priority", "o_orderpriority"), ("status", "nullif(o_orderstatus, 'F')"), ("decade", "(floor(yr/10)*10)::BIGINT")]))
def _(t: Tables):
    return Q.error_by_many(_resid(t), {"priority": F.col("o_orderpriority"), "status": F.nullif("o_orderstatus", F.lit("F")), "decade": bucket_floor("yr", 10)})


@query("x27_error_by_token", "WITH " + SQL_RESID + f", x AS (SELECT *, unnest(string_split(substr(o_orderpriority, 3), ' ')) AS token FROM e) SELECT token, {_BY} FROM x GROUP BY 1 HAVING count(*) >= 30")
def _(t: Tables):
    df = _resid(t).withColumn("token", F.explode(split_tokens(F.substring("o_orderpriority", 3, 20), " ")))
    return Q.error_by(df, F.col("token"), "token", "actual", "p_year", 30)


_BANDS = [-INF, 1, 3, 5, 7, 9, INF]
_LABELS = ["<1", "1-3", "3-5", "5-7", "7-9", ">=9"]


@query("x28_calibration", "WITH " + SQL_RESID + f""" SELECT CASE WHEN actual<1 THEN '<1' WHEN actual<3 THEN '1-3' WHEN actual<5 THEN '3-5' WHEN actual<7 THEN '5-7' WHEN actual<9 THEN '7-9' ELSE '>=9' END AS band, count(*) AS n, {r('avg(abs_error)')} AS mae,
 {r('avg(actual)')} AS mean_actual, {r('avg(p_year)')} AS mean_predicted, {r('avg(residual)')} AS mean_residual, count(*) < 30 AS small_sample FROM e GROUP BY 1""")
def _(t: Tables):
    return Q.calibration(_resid(t), band("actual", _BANDS, _LABELS), "actual", "p_year")


@query("x29_error_profile", "WITH " + SQL_RESID + f""", q AS (SELECT *, abs_error >= (SELECT quantile_cont(abs_error, 0.9) FROM e) AS is_large FROM e)
SELECT is_large, count(*) AS n, {r('avg((residual < 0)::INT)')} AS over_predicted, {r("avg((o_orderstatus = 'P')::INT)")} AS status_p, {r('avg((actual < 1 OR actual >= 9)::INT)')} AS extreme, {r('quantile_cont(o_custkey, 0.5)')} AS median_customer FROM q GROUP BY 1""")
def _(t: Tables):
    df = Q.largest_errors(_resid(t))
    return Q.error_profile(df, {"over_predicted": F.col("residual") < 0, "status_p": F.col("o_orderstatus") == "P",
                                "extreme": (F.col("actual") < 1) | (F.col("actual") >= 9)}, {"median_customer": "o_custkey"})


@query("x30_prediction_range", "WITH " + SQL_PREDICTED + " " + union(f"""SELECT '{c}' AS "column", count({c}) AS n, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, {r(f'quantile_cont({c}, 0.05)')} AS p5,
 {r(f'quantile_cont({c}, 0.5)')} AS p50, {r(f'quantile_cont({c}, 0.95)')} AS p95, {r(f'quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05)')} AS span FROM pred""" for c in ("actual", "p_year")))
def _(t: Tables):
    return Q.prediction_range(t.predicted, ["actual", "p_year"])


_OUT = "CASE WHEN label=1 AND score>=0.5 THEN 'TP' WHEN label=1 THEN 'FN' WHEN score>=0.5 THEN 'FP' ELSE 'TN' END"


@query("x31_x32_outcome_profile", "WITH " + SQL_SCORED + f""", o AS (SELECT *, {_OUT} AS outcome FROM scored) """ + union(f"""SELECT config, outcome, '{c}' AS "column", count({c}) AS n, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max,
 {r(f'quantile_cont({c}, 0.5)')} AS p50 FROM o GROUP BY 1, 2""" for c in ("amount", "score")))
def _(t: Tables):
    df = t.scored.withColumn("outcome", Q.outcome("label", M.decide("score", 0.5)))
    return Q.outcome_profile(df, ["amount", "score"], ["config"])


@query("x33_score_bands", "WITH " + SQL_SCORED + f""" SELECT config, CASE WHEN score<0.01 THEN '<0.01' WHEN score<0.1 THEN '0.01-0.10' WHEN score<0.5 THEN '0.10-0.50' WHEN score<0.9 THEN '0.50-0.90' ELSE '>=0.90' END AS band, count(*) AS n, sum(label)::BIGINT AS positives,
 sum(1-label)::BIGINT AS negatives, {r('avg(label)')} AS positive_share FROM scored GROUP BY 1, 2""")
def _(t: Tables):
    b = band("score", [-INF, .01, .1, .5, .9, INF], ["<0.01", "0.01-0.10", "0.10-0.50", "0.50-0.90", ">=0.90"])
    return Q.score_bands(t.scored, "label", b, ["config"])


@query("x34_miss_distribution", "WITH " + SQL_SCORED + """, m AS (SELECT row_id, count(*) FILTER (score < 0.5) AS missed_by FROM scored WHERE label=1 GROUP BY 1), l AS (SELECT unnest([0,1,2,3])::BIGINT AS missed_by)
SELECT l.missed_by, count(m.row_id) AS rows FROM l LEFT JOIN m USING (missed_by) GROUP BY 1""")
def _(t: Tables):
    return Q.miss_distribution(Q.miss_counts(t.scored, "config", "row_id", "label", M.decide("score", 0.5)), 3)


@query("x34_hard_row_profile", "WITH " + SQL_SCORED + f""", m AS (SELECT row_id, count(*) FILTER (score < 0.5) AS missed_by, any_value(amount) AS amount FROM scored WHERE label=1 GROUP BY 1)
SELECT CASE missed_by WHEN 0 THEN 'none missed' WHEN 3 THEN 'all missed' ELSE 'some missed' END AS hardness, 'amount' AS "column", count(*) AS n, {r('avg(amount)')} AS mean, {r('stddev_samp(amount)')} AS std, {r('min(amount)')} AS min, {r('max(amount)')} AS max,
 {r('quantile_cont(amount, 0.5)')} AS p50 FROM m GROUP BY 1""")
def _(t: Tables):
    hard = Q.hardness(Q.miss_counts(t.scored, "config", "row_id", "label", M.decide("score", 0.5)))
    rows = t.scored.where("config = 'mix' AND label = 1").select("row_id", "amount")
    return describe(rows.join(hard, "row_id"), ["amount"], [.5], ["hardness"])


@query("x35_confusion_costs", "WITH " + SQL_SCORED + f", c AS (SELECT config, {_CONF.replace('{t}', '0.9')} FROM scored GROUP BY 1) SELECT config, tp, fp, fn, tn, {r('100*fn/nullif(fn+tp,0)')} AS missed_pct, {r('fp/nullif(tp,0)')} AS alarms_per_hit FROM c")
def _(t: Tables):
    c = M.classification_metrics(t.scored, "label", "score", ["config"], threshold=.9).select("config", "tp", "fp", "fn", "tn")
    return Q.confusion_costs(c)


@query("x36_x37_ranks_and_lift", "WITH " + _CURVE.replace("{by}", "config") + f""", a AS (SELECT config, {_AUC}, max(tot_pos)/(max(tot_pos)+max(tot_neg)) AS prev FROM cv GROUP BY 1)
SELECT config, roc_auc, pr_auc, rank() OVER (ORDER BY roc_auc DESC) AS roc_rank, rank() OVER (ORDER BY pr_auc DESC) AS pr_rank, {r('pr_auc/prev', 4)} AS lift FROM a""", 6)
def _(t: Tables):
    a = M.ranking_metrics(M.curve_points(t.scored, "label", "score", ["config"]), ["config"])
    a = a.select("config", F.round("roc_auc", 6).alias("roc_auc"), F.round("pr_auc", 6).alias("pr_auc"), "positives", "negatives")
    a = rank_results(rank_results(a, "roc_auc", name="roc_rank"), "pr_auc", name="pr_rank")
    lift = F.col("pr_auc") * (F.col("positives") + F.col("negatives")) / F.col("positives")
    return a.select("config", "roc_auc", "pr_auc", "roc_rank", "pr_rank", F.round(lift, 4).alias("lift"))


@query("x38_repeated_folds_stability", "WITH " + SQL_PREDICTED + ", u AS (" + union(f"SELECT {n} AS rep, fold, actual, p_year FROM {sql_folds('pred', 'o_orderkey', 5, 42000 + n)}" for n in (1, 2)) + f"""),
f AS (SELECT rep, fold, sqrt(avg((actual-p_year)^2)) AS rmse FROM u GROUP BY 1, 2) SELECT 'p_year' AS config, 'rmse' AS metric, count(*) AS folds, {r('avg(rmse)')} AS mean, {r('stddev_samp(rmse)')} AS std, {r('min(rmse)')} AS min, {r('max(rmse)')} AS max,
 {r('avg(rmse) - 2.2621571628*stddev_samp(rmse)/sqrt(10)')} AS ci_low, {r('avg(rmse) + 2.2621571628*stddev_samp(rmse)/sqrt(10)')} AS ci_high FROM f""")
def _(t: Tables):
    df = repeated_folds(t.predicted.select("o_orderkey", "actual", "p_year"), "o_orderkey", 5, 2)
    long = to_long(df, ["o_orderkey", "actual", "p_year"], ["fold_r1", "fold_r2"], "repeat", "fold")
    per = M.regression_metrics(long, "actual", "p_year", ["repeat", "fold"])
    return S.summarise_folds(per.withColumn("config", F.lit("p_year")), ["rmse"], ["config"])


@query("x39_tuned_vs_untuned", "WITH " + SQL_LONG + f""", m AS (SELECT model, sqrt(avg((actual-predicted)^2)) AS rmse, avg(abs(actual-predicted)) AS mae FROM long GROUP BY 1), d AS (SELECT model, max(abs(actual-predicted)) AS rmse, min(abs(actual-predicted)) AS mae FROM long WHERE model <> 'p_prio' GROUP BY 1)
SELECT coalesce(m.model, d.model) AS model, {r('m.rmse')} AS rmse_before, {r('m.mae')} AS mae_before, {r('d.rmse')} AS rmse_after, {r('d.mae')} AS mae_after, {r('d.rmse - m.rmse')} AS rmse_delta, {r('d.mae - m.mae')} AS mae_delta FROM m FULL OUTER JOIN d ON m.model = d.model""")
def _(t: Tables):
    df = _long(t)
    e = F.abs(F.col("actual") - F.col("predicted"))
    before = M.regression_metrics(df, "actual", "predicted", ["model"]).select("model", "rmse", "mae")
    after = df.where("model <> 'p_prio'").groupBy("model").agg(F.max(e).alias("rmse"), F.min(e).alias("mae"))
    return S.delta_between(before, after, "model", ["rmse", "mae"], ("before", "after"))


@query("x40_phase_table", "WITH " + _FOLDS + f""", a AS (SELECT model, sqrt(avg((actual-predicted)^2)) AS rmse FROM long GROUP BY 1), u AS (SELECT 'holdout' AS phase, model, rmse FROM a UNION ALL SELECT 'cv', model, avg(rmse) FROM f GROUP BY 2)
SELECT phase, model, {r('rmse')} AS rmse, rank() OVER (PARTITION BY phase ORDER BY rmse DESC) AS rank_in_phase FROM u""")
def _(t: Tables):
    holdout = M.regression_metrics(_long(t), "actual", "predicted", ["model"])
    cv = _fold_metrics(t).groupBy("model").agg(F.avg("rmse").alias("rmse"))
    return S.phase_table({"holdout": holdout, "cv": cv}, "model", "rmse")


@query("x41_a24_linear_assumptions", "WITH " + SQL_RESID + f" SELECT o_orderstatus, {r('avg(residual)')} AS mean_residual, {r('stddev_samp(residual)')} AS std_residual, {r('corr(p_year, abs_error)')} AS r_pred_abs_residual FROM e GROUP BY 1")
def _(t: Tables):
    return Q.heteroscedasticity(_resid(t), "p_year", ["o_orderstatus"])


@query("x42_normalised_confusion", "WITH " + SQL_SCORED + f" SELECT config, lab AS label, pred, n, {r('n * 1.0 / sum(n) OVER (PARTITION BY config, lab)')} AS share FROM (SELECT config, label::BIGINT AS lab, (score>=0.5)::BIGINT AS pred, count(*) AS n FROM scored GROUP BY 1, 2, 3)")
def _(t: Tables):
    return M.normalised_confusion(t.scored, "label", M.decide("score", 0.5), ["config"])


_SEARCH = SQL_RESID + ", s AS (SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS prio, o_orderstatus AS status, yr::VARCHAR AS yr, sqrt(avg(residual^2)) AS rmse FROM e GROUP BY 1, 2, 3)"


def _search_table(t: Tables):
    return _resid(t).groupBy(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("prio"), F.col("o_orderstatus").alias("status"),
                             F.col("yr").cast("string").alias("yr")).agg(F.sqrt(F.avg(F.col("residual") ** 2)).alias("rmse"))


@query("a39_search_marginals", "WITH " + _SEARCH + " " + union(f"SELECT '{p}' AS param, coalesce({p}, 'null') AS value, {r('avg(rmse)')} AS mean, {r('min(rmse)')} AS min, count(*) AS n FROM s GROUP BY 2" for p in ("prio", "status", "yr")))
def _(t: Tables):
    return S.search_marginals(_search_table(t), ["prio", "status", "yr"], "rmse")


@query("a40_min_pivot", "WITH " + _SEARCH + " SELECT yr, " + ", ".join(r(f"min(rmse) FILTER (status='{s}')") + f" AS \"{s}\"" for s in "FOP") + " FROM s GROUP BY 1")
def _(t: Tables):
    return _search_table(t).groupBy("yr").pivot("status", ["F", "O", "P"]).agg(F.min("rmse"))


@query("a41_tie_counts", "WITH " + SQL_SCORED + " SELECT config, count(DISTINCT score) AS distinct_scores, count(*) FILTER (score=0 AND label=1) AS positives_at_zero, count(*) FILTER (score=0 AND label=0) AS negatives_at_zero FROM scored GROUP BY 1")
def _(t: Tables):
    return M.tie_counts(t.scored, "label", "score", ["config"])


