"""Hand-sized score tables with ties, empty operating points and edge thresholds."""

import random

import pytest
from pyspark.sql import functions as F

from tabulon.operators import choose as S
from tabulon.operators import metrics as M

ROWS = [(1, 1, .9), (2, 0, .8), (3, 1, .8), (4, 0, .3), (5, 1, .3), (6, 0, .1)]


def brute_auc(rows):
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    return sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, ap, before = sum(y for _, y, _ in rows), 0.0, 0.0
    for t in sorted({s for _, _, s in rows}, reverse=True):
        flagged = [y for _, y, s in rows if s >= t]
        recall = sum(flagged) / total
        ap += (recall - before) * sum(flagged) / len(flagged)
        before = recall
    return ap


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "row_id int, label int, score double")


def test_auc_and_ap_with_ties(spark, scored):
    r = M.ranking_metrics(M.curve_points(scored, "label", "score")).first()
    assert r["roc_auc"] == pytest.approx(brute_auc(ROWS))
    assert r["pr_auc"] == pytest.approx(brute_ap(ROWS))


def test_random_scores_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < .3), round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id int, label int, score double").repartition(7)
    r = M.ranking_metrics(M.curve_points(df, "label", "score")).first()
    assert r["roc_auc"] == pytest.approx(brute_auc(rows))
    assert r["pr_auc"] == pytest.approx(brute_ap(rows))


def test_perfect_flat_and_single_class(spark):
    df = spark.createDataFrame([("perfect", 1, .9), ("perfect", 0, .1), ("flat", 1, .5), ("flat", 0, .5), ("one", 1, .5), ("one", 1, .6)],
                               "config string, label int, score double")
    got = {r["config"]: r for r in M.ranking_metrics(M.curve_points(df, "label", "score", ["config"]), ["config"]).collect()}
    assert got["perfect"]["roc_auc"] == 1.0 and got["perfect"]["pr_auc"] == 1.0
    assert got["flat"]["roc_auc"] == 0.5 and got["flat"]["pr_auc"] == 0.5
    assert got["one"]["roc_auc"] is None


def test_threshold_table_rules(scored):
    t = {r["threshold"]: r for r in M.threshold_table(scored, "label", "score", grid=[.3, .8, .95]).collect()}
    assert (t[.8]["tp"], t[.8]["fp"], t[.8]["fn"], t[.8]["tn"]) == (2, 1, 1, 2)
    assert t[.95]["flagged"] == 0 and t[.95]["precision"] is None and t[.95]["f1"] == 0.0
    assert t[.3]["recall"] == 1.0


def test_best_threshold_tie_goes_low(spark):
    df = spark.createDataFrame([(1, .9), (0, .1)], "label int, score double")
    b = M.best_threshold(M.threshold_table(df, "label", "score")).first()
    assert b["threshold"] == 0.15 and b["f1"] == 1.0


def test_grid_extended_only_at_an_edge(spark):
    low = spark.createDataFrame([(1, .04), (0, .01)] * 3, "label int, score double")
    high = spark.createDataFrame([(1, .99), (0, .955)] * 3, "label int, score double")
    mid = spark.createDataFrame([(1, .6), (0, .4)], "label int, score double")
    assert M.best_threshold_extended(low, "label", "score").first()["threshold"] == 0.02
    assert M.best_threshold_extended(high, "label", "score").first()["edge"] == "lower"
    assert M.best_threshold_extended(mid, "label", "score").first()["edge"] == "none"


def test_strict_rule_differs_on_the_threshold(spark):
    df = spark.createDataFrame([(1, .5)], "label int, score double")
    loose, strict = (M.classification_metrics(df, "label", "score", strict=x).first() for x in (False, True))
    assert (loose["tp"], strict["tp"]) == (1, 0)
    assert strict["precision"] == 0.0


def test_fold_summary_conventions(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5])], "config string, fold int, m double")
    r = S.summarise_folds(df, ["m"], ["config"]).first()
    assert r["std"] == pytest.approx(1.5811388)
    assert r["ci_high"] - r["mean"] == pytest.approx(2.7764451 * 1.5811388 / 5 ** .5)
    assert S.summarise_folds(df, ["m"], ["config"], ddof=0).first()["std"] == pytest.approx(2 ** .5)


def test_one_se_rule_prefers_simple(spark):
    t = spark.createDataFrame([("big", .80, .05, 1), ("plain", .79, .02, 0), ("bad", .60, .01, 0)], "k string, m double, s double, rank int")
    got = {r["k"]: r["choice"] for r in S.one_se_choice(t, "m", "s", 5, ["rank"], "k").collect()}
    assert got == {"big": False, "plain": True}


def test_paired_and_tied(spark):
    rows = [(c, f, b + d) for f, b in enumerate([1.0, 1.1, .9, 1.0, 1.2]) for c, d in (("ref", 0), ("worse", .2 + .01 * f), ("near", .01 if f < 3 else -.01))]
    df = spark.createDataFrame(rows, "config string, fold int, rmse double")
    got = {r["config"]: r["tied"] for r in S.tied_with(S.paired_folds(df, "config", "fold", "rmse", "ref")).collect()}
    assert got == {"ref": True, "worse": False, "near": True}


def test_evaluate_matches_separate_metrics(scored):
    e = M.evaluate(scored, "label", "score", threshold=.5).first()
    c = M.classification_metrics(scored, "label", "score").first()
    assert all(e[k] == c[k] for k in ("tp", "fp", "fn", "tn", "precision", "recall", "f1"))
    assert scored.where(F.col("score") > 2).count() == 0


def test_evaluate_reads_its_histogram_once(spark):
    df = spark.createDataFrame([(c, y, s) for c in ("a", None) for _, y, s in ROWS], "c string, label int, score double")
    got = M.evaluate(df, "label", "score", ["c"])
    leaves = got._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert leaves.size() == 2  # the rows with their running totals, and the totals of the ranges
    rows = {r["c"]: r for r in got.collect()}
    assert set(rows) == {"a", None}
    for r in rows.values():
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 2)
        assert r["roc_auc"] == pytest.approx(brute_auc(ROWS)) and r["pr_auc"] == pytest.approx(brute_ap(ROWS))
