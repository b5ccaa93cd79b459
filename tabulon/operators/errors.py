"""Where a model errs: residual tables, breakdowns, calibration, outcome profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col, count_if, mean_if, ratio
from tabulon.operators.ordered import quantiles
from tabulon.operators.profile import corrected_skewness, describe
from tabulon.operators.reshape import reindex, rows_from
from tabulon.operators.skew import join_groups
from tabulon.session import with_state


def with_residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Add residual (actual - predicted), abs_error and pct_error (null for actual 0)."""
    e = col(actual).cast("double") - col(predicted).cast("double")
    return df.withColumns({"residual": e, "abs_error": F.abs(e), "pct_error": 100 * F.abs(ratio(e, col(actual)))})


def residual_summary(df: DataFrame, by: Sequence[str] = (), bounds: Sequence[float] = (.5, 1, 2)) -> DataFrame:
    r = F.col("residual")
    stats = df.groupBy(*by).agg(
        F.count(r).alias("n"), F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"), F.min(r).alias("min"), F.max(r).alias("max"),
        corrected_skewness(r).alias("skewness"), mean_if(r > 0).alias("share_positive"),
        *[mean_if(F.abs(r) <= b).alias(f"within_{str(b).replace('.', '_')}") for b in bounds])
    med = quantiles(df, "residual", [.5], by, names=["median"])
    if by:
        return join_groups(stats, med, list(by))
    return stats.withColumn("median", med.select("median").scalar())


def error_coverage(df: DataFrame, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with an absolute error within each bound."""
    wide = df.groupBy(*by).agg(*[mean_if(F.col("abs_error") <= b).alias(f"_b{i}") for i, b in enumerate(bounds)])
    return rows_from(wide, list(by), [{"bound": F.lit(float(b)), "share": F.col(f"_b{i}")} for i, b in enumerate(bounds)])


def error_by(df: DataFrame, key: Column, name: str, actual: str, predicted: str, min_support: int = 1) -> DataFrame:
    """n, MAE, RMSE, mean actual / predicted / residual per value of `key`."""
    return df.groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("residual") ** 2)).alias("rmse"),
        F.avg(col(actual)).alias("mean_actual"), F.avg(col(predicted)).alias("mean_predicted"),
        F.avg("residual").alias("mean_residual")).where(F.col("n") >= min_support)


def error_by_many(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """(key, value, n, mae, mean_residual) for several breakdowns in one pass (grouping sets)."""
    names = list(keys)
    tagged = df.select("abs_error", "residual", *[c.cast("string").alias(n) for n, c in keys.items()])
    sets = [[F.col(f"`{n}`")] for n in names]
    out = tagged.groupingSets(sets, *[F.col(f"`{n}`") for n in names]).agg(
        F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"),
        F.avg("residual").alias("mean_residual"))
    full = 2 ** len(names) - 1
    which, value = None, None
    for i, n in enumerate(names):
        mine = F.col("_g") == F.lit(full - 2 ** (len(names) - 1 - i))
        which = F.when(mine, F.lit(n)) if which is None else which.when(mine, F.lit(n))
        value = F.when(mine, col(n)) if value is None else value.when(mine, col(n))
    return out.select(which.alias("key"), value.alias("value"), "n", "mae", "mean_residual")


def calibration(df: DataFrame, band: Column, actual: str, predicted: str, small: int = 30) -> DataFrame:
    return error_by(df, band, "band", actual, predicted).drop("rmse").withColumn("small_sample", F.col("n") < small)


def largest_errors(df: DataFrame, share: float = 0.1) -> DataFrame:
    """Flag rows whose absolute error reaches the (1 - share) quantile."""
    cut = quantiles(df, "abs_error", [1 - share], names=["cut"])
    return with_state(df, cut, "_q").withColumn("is_large", F.col("abs_error") >= F.col("_q.cut")).drop("_q")


def error_profile(df: DataFrame, shares: Mapping[str, Column], medians: Mapping[str, str], *, flag: str = "is_large") -> DataFrame:
    """Flagged rows against the rest: n, shares of conditions, medians of columns."""
    base = df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"), *[mean_if(c).alias(n) for n, c in shares.items()])
    for name, c in medians.items():
        base = join_groups(base, quantiles(df, c, [.5], [flag], names=[name]), [flag], "left")
    return base


def prediction_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spread of actual against predicted values, incl. the p95 - p5 span."""
    d = describe(df, cols, [.05, .5, .95])
    return d.withColumn("span", F.col("p95") - F.col("p5"))


def outcome(label: str, pred: Column) -> Column:
    y, p = col(label).cast("int"), pred.cast("int")
    return F.when((y == 1) & (p == 1), "TP").when((y == 1) & (p == 0), "FN").when((y == 0) & (p == 1), "FP").otherwise("TN")


def outcome_profile(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """mean / median / max of columns per outcome (and configuration)."""
    return describe(df, cols, [.5], [*by, "outcome"])


def score_bands(df: DataFrame, label: str, band: Column, by: Sequence[str] = ()) -> DataFrame:
    y = col(label).cast("int")
    return df.groupBy(*by, band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), count_if(y == 1).alias("positives"), count_if(y == 0).alias("negatives"),
        F.avg(y.cast("double")).alias("positive_share"))


def miss_counts(df: DataFrame, config: str, row_id: str, label: str, pred: Column) -> DataFrame:
    """Per positive row: how many configurations missed it and how many scored it."""
    missed = F.when(~pred.cast("boolean"), 1).otherwise(0)
    return df.where(col(label) == 1).groupBy(row_id).agg(F.sum(missed).alias("missed_by"), F.count(config).alias("configs"))


def miss_distribution(counts: DataFrame, n_configs: int) -> DataFrame:
    """Rows by number of configurations missing them, all of 0..n shown."""
    d = counts.groupBy("missed_by").agg(F.count(F.lit(1)).alias("rows"))
    return reindex(d, "missed_by", list(range(n_configs + 1)), {"rows": 0}).drop("missed_by_order")


def hardness(counts: DataFrame) -> DataFrame:
    group = F.when(F.col("missed_by") == 0, "none missed").when(
        F.col("missed_by") == F.col("configs"), "all missed").otherwise("some missed")
    return counts.withColumn("hardness", group)


def confusion_costs(rates: DataFrame) -> DataFrame:
    """Missed share of positives and false alarms per hit."""
    return rates.withColumn("missed_pct", 100 * ratio(F.col("fn"), F.col("fn") + F.col("tp"))).withColumn(
        "alarms_per_hit", ratio(F.col("fp"), F.col("tp")))


def heteroscedasticity(df: DataFrame, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Residual mean / std and the correlation of prediction with absolute residual."""
    return df.groupBy(*by).agg(F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("std_residual"),
                               F.corr(col(predicted).cast("double"), F.abs("residual")).alias("r_pred_abs_residual"))


