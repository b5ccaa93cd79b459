"""Metrics from the long score table (by..., row_id, label, score[, pred]).

Every function takes grouping columns `by` (configuration, fold, ...) and computes all groups in
one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col, count_if, ratio, ratio_or_zero
from tabulon.operators.ordered import histogram_of, quantiles, running_totals
from tabulon.operators.skew import join_groups

# Fixed grid of decision thresholds: 0.05, 0.10, ..., 0.95.
THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))
# Fixed extensions used when the best threshold sits on an edge of the grid.
LOWER_EXTENSION = (0.01, 0.02, 0.03, 0.04)
UPPER_EXTENSION = (0.96, 0.97, 0.98, 0.99)


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, MSE, RMSE, R2, bias (mean residual), max absolute error, explained variance."""
    y, e = col(actual).cast("double"), col(actual).cast("double") - col(predicted).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - ratio(F.avg(e * e), F.var_pop(y))).alias("r2"), F.avg(e).alias("bias"), F.max(F.abs(e)).alias("max_ae"),
        (1 - ratio(F.var_pop(e), F.var_pop(y))).alias("explained_variance"))


def median_absolute_error(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    err = df.select(*by, F.abs(col(actual) - col(predicted)).alias("_e"))
    return quantiles(err, "_e", [.5], by, names=["median_ae"])


def confusion(df: DataFrame, label: str, pred: Column, by: Sequence[str] = ()) -> DataFrame:
    y, p = col(label).cast("int"), pred.cast("int")
    return df.groupBy(*by).agg(count_if((y == 1) & (p == 1)).alias("tp"), count_if((y == 0) & (p == 1)).alias("fp"),
                               count_if((y == 1) & (p == 0)).alias("fn"), count_if((y == 0) & (p == 0)).alias("tn"))


def rates(conf: DataFrame, by: Sequence[str] = (), *, keep: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 when undefined), FPR, FNR, specificity, supports; then the columns `keep`."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return conf.select(
        *by, "tp", "fp", "fn", "tn", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"), ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(fp, fp + tn).alias("fpr"), ratio(fn, fn + tp).alias("fnr"),
        ratio(tn, tn + fp).alias("specificity"), (tp + fn).alias("positives"), (fp + tn).alias("negatives"), *keep)


def classification_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = (), *, threshold: float = 0.5,
                           strict: bool = False) -> DataFrame:
    return rates(confusion(df, label, decide(score, threshold, strict=strict), by), by)


def decide(score: str, threshold: float, *, strict: bool = False) -> Column:
    """score >= threshold (or > with strict=True)."""
    return (col(score) > threshold) if strict else (col(score) >= threshold)


def curve_points(df: DataFrame, label: str, score: str, by: Sequence[str] = (), *, weight: str | None = None) -> DataFrame:
    """One row per distinct score, highest first: tp, fp flagged at `score >= value`, precision,
    recall (tpr) and fpr. Rows with equal scores always move together."""
    y = col(label).cast("int")
    w = col(weight) if weight else F.lit(1)
    hist = histogram_of(df.select(*by, col(score).alias("score"), y.alias("_y"), w.alias("_w")), by, "score",
                        pos=F.sum(F.when(F.col("_y") == 1, F.col("_w")).otherwise(0)),
                        neg=F.sum(F.when(F.col("_y") == 0, F.col("_w")).otherwise(0)))
    cum = running_totals(hist, by, "score", ["pos", "neg"], descending=True)
    return cum.select(*by, "score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      "tot_pos", "tot_neg", ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                      ratio(F.col("cum_pos"), F.col("tot_pos")).alias("recall"),
                      ratio(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"))


def _ranking_aggregates() -> list[Column]:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("tp").cast("double") - pos  # positives scored strictly higher
    tp_pairs = F.sum(neg * (above + pos / 2))
    both = F.max("tot_pos").cast("double") * F.max("tot_neg").cast("double")
    return [ratio(tp_pairs, both).alias("roc_auc"),
            ratio(F.sum(F.when(F.col("pos") > 0, pos * F.col("precision")).otherwise(0.0)), F.max("tot_pos")).alias("pr_auc")]


def ranking_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) from `curve_points`."""
    return curve.groupBy(*by).agg(F.max("tot_pos").alias("positives"), F.max("tot_neg").alias("negatives"), *_ranking_aggregates())


def evaluate(df: DataFrame, label: str, score: str, by: Sequence[str] = (), *, threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """Threshold metrics and ranking metrics of every group from one aggregation of one histogram of scores."""
    curve = curve_points(df, label, score, by)
    flagged = decide("score", threshold, strict=strict)
    per = curve.groupBy(*by).agg(
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, 0).otherwise(F.col("pos"))).alias("fn"), F.sum(F.when(flagged, 0).otherwise(F.col("neg"))).alias("tn"),
        *_ranking_aggregates())
    return rates(per, by, keep=["roc_auc", "pr_auc"])


def threshold_table(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
                    grid: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Counts, precision (null when nothing is flagged), recall and F1 for each threshold.

    A row is counted once, in the grid slot it reaches; thresholds then add up the slots at or
    above them, so the cost does not grow with rows x thresholds.
    """
    grid = sorted(grid)
    y, s = col(label).cast("int"), col(score)
    slot = sum((F.when(s >= F.lit(float(t)), 1).otherwise(0) for t in grid), F.lit(0))
    slots = df.groupBy(*by, slot.alias("_slot")).agg(count_if(y == 1).alias("_p"), count_if(y == 0).alias("_n"))
    at = lambda i, c: F.coalesce(F.sum(F.when(F.col("_slot") > i, F.col(c))), F.lit(0))
    wide = slots.groupBy(*by).agg(F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn"), *[e for i in range(len(grid)) for e in (
        at(i, "_p").alias(f"_p{i}"), at(i, "_n").alias(f"_n{i}"))])
    from tabulon.operators.reshape import rows_from
    rows = rows_from(wide, list(by), [{
        "threshold": F.lit(float(t)), "tp": F.col(f"_p{i}"), "fp": F.col(f"_n{i}"), "fn": F.col("_tp") - F.col(f"_p{i}"),
        "tn": F.col("_tn") - F.col(f"_n{i}")} for i, t in enumerate(grid)])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return rows.select("*", (tp + fp).alias("flagged"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                       ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def best_threshold(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Highest F1, ties (to 8 decimals) to the lower threshold."""
    best = F.min(F.struct((-F.round("f1", 8)).alias("neg"), F.col("threshold").alias("t"), F.col("f1").alias("f")))
    return table.groupBy(*by).agg(best.alias("_b")).select(*by, F.col("_b.t").alias("threshold"), F.col("_b.f").alias("f1"))


def _within_reach(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of a table over the extended grid that count, with `edge`: the base grid, and the extension on the side where
    the best base threshold is an edge."""
    low, high = THRESHOLDS[0], THRESHOLDS[-1]
    base = best_threshold(table.where(F.col("threshold").between(low, high)), by)
    edge = F.when(F.col("threshold") == high, "upper").when(F.col("threshold") == low, "lower").otherwise("none")
    base = base.select(*by, edge.alias("edge"))
    if by:
        tagged = join_groups(table, base, list(by))
    else:
        tagged = table.withColumn("edge", base.select("edge").scalar())
    return tagged.where(F.col("threshold").between(low, high) | ((F.col("edge") == "upper") & (F.col("threshold") > high))
                        | ((F.col("edge") == "lower") & (F.col("threshold") < low)))


def best_threshold_extended(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Best threshold; when it is an edge of the base grid, the grid is extended on that side only."""
    table = threshold_table(df, label, score, by, [*LOWER_EXTENSION, *THRESHOLDS, *UPPER_EXTENSION])
    return best_threshold(_within_reach(table, by), [*by, "edge"])


def alternative_thresholds(table: DataFrame, by: Sequence[str] = (), *, recall: float = .85, precision: float = .90) -> DataFrame:
    """Highest threshold with enough recall and lowest threshold with enough precision."""
    return table.groupBy(*by).agg(
        F.max(F.when(F.col("recall") >= recall, F.col("threshold"))).alias("recall_rule"),
        F.min(F.when(F.col("precision") >= precision, F.col("threshold"))).alias("precision_rule"))


def threshold_stability(df: DataFrame, label: str, score: str, fold: str) -> DataFrame:
    """Best threshold of each fold and that fold's F1 at the pooled best threshold."""
    per_fold = threshold_table(df, label, score, [fold])
    pooled = per_fold.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).withColumn(
        "f1", ratio_or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    chosen = best_threshold(pooled).select("threshold").scalar()
    at_pooled = per_fold.withColumn("_t", chosen).where(F.col("threshold") == F.col("_t")).select(
        fold, F.col("threshold").alias("pooled_threshold"), F.col("f1").alias("f1_at_pooled"))
    return join_groups(best_threshold(per_fold, [fold]), at_pooled, [fold])


def threshold_stability_extended(df: DataFrame, label: str, score: str, fold: str, by: Sequence[str]) -> DataFrame:
    """`threshold_stability` per group of `by`, the grid being extended where the best threshold of a fold, or of all folds
    together, is an edge of it."""
    by = list(by)
    per_fold = threshold_table(df, label, score, [*by, fold], [*LOWER_EXTENSION, *THRESHOLDS, *UPPER_EXTENSION])
    pooled = per_fold.groupBy(*by, "threshold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).withColumn(
        "f1", ratio_or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    chosen = best_threshold(_within_reach(pooled, by), [*by, "edge"]).select(*by, F.col("edge").alias("pooled_edge"), F.col("threshold").alias("pooled_threshold"))
    at_pooled = join_groups(per_fold, chosen, by).where(F.col("threshold") == F.col("pooled_threshold")).select(
        *by, fold, "pooled_threshold", "pooled_edge", F.col("f1").alias("f1_at_pooled"))
    return join_groups(best_threshold(_within_reach(per_fold, [*by, fold]), [*by, fold, "edge"]), at_pooled, [*by, fold])


def tie_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores and rows scored exactly 0, per class."""
    y = col(label).cast("int")
    hist = df.groupBy(*by, score).agg(count_if(y == 1).alias("p"), count_if(y == 0).alias("n"))
    zero = col(score) == 0
    return hist.groupBy(*by).agg(F.count(F.lit(1)).alias("distinct_scores"),
                                 F.coalesce(F.sum(F.when(zero, F.col("p"))), F.lit(0)).alias("positives_at_zero"),
                                 F.coalesce(F.sum(F.when(zero, F.col("n"))), F.lit(0)).alias("negatives_at_zero"))


def normalised_confusion(df: DataFrame, label: str, pred: Column, by: Sequence[str] = ()) -> DataFrame:
    """(label, pred) cells as counts and as a share of the actual class."""
    cells = df.groupBy(*by, col(label).cast("int").alias("label"), pred.cast("int").alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = cells.groupBy(*by, "label").agg(F.sum("n").alias("_t"))
    return join_groups(cells, totals, [*by, "label"]).withColumn("share", ratio(F.col("n"), F.col("_t"))).drop("_t")


def mean_baseline(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Test rows with the training mean as prediction."""
    return test.withColumn("prediction", train.agg(F.avg(col(target).cast("double"))).scalar())


def prior_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Test rows with the training prior as score and the majority class as prediction."""
    y = col(label).cast("double")
    from tabulon.session import with_state
    prior = train.agg(F.avg(y).alias("p"))
    return with_state(test, prior, "_p").withColumn("score", F.col("_p.p")).withColumn(
        "pred", (F.col("_p.p") > 0.5).cast("int")).drop("_p")
