"""Outlier audits: fences first, then one flagging pass over all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col, count_if, ratio
from tabulon.operators.contracts import any_of
from tabulon.operators.profile import describe
from tabulon.operators.reshape import rows_from
from tabulon.operators.skew import attach_few, join_groups
from tabulon.session import with_state


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """One row with <c>_lo and <c>_hi for every column."""
    d = describe(df, cols, [.25, .75])
    iqr = F.col("p75") - F.col("p25")
    pick = lambda c, e: F.max(F.when(F.col("column") == c, e))
    return d.agg(*[e for c in cols for e in (pick(c, F.col("p25") - k * iqr).alias(f"{c}_lo"),
                                             pick(c, F.col("p75") + k * iqr).alias(f"{c}_hi"))])


def iqr_audit(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Fences and counts below / above per column."""
    fenced = with_state(df, iqr_fences(df, cols, k), "_f")
    one = fenced.agg(*[e for c in cols for e in (
        count_if(col(c) < F.col(f"_f.{c}_lo")).alias(f"{c}__below"), count_if(col(c) > F.col(f"_f.{c}_hi")).alias(f"{c}__above"),
        F.max(F.col(f"_f.{c}_lo")).alias(f"{c}__lo"), F.max(F.col(f"_f.{c}_hi")).alias(f"{c}__hi"), F.count(col(c)).alias(f"{c}__n"))])
    return rows_from(one, [], [{
        "column": F.lit(c), "lower": F.col(f"{c}__lo"), "upper": F.col(f"{c}__hi"), "below": F.col(f"{c}__below"),
        "above": F.col(f"{c}__above"),
        "outlier_pct": ratio(100 * (F.col(f"{c}__below") + F.col(f"{c}__above")), F.col(f"{c}__n"))} for c in cols])


def flag_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5, *, flag: str = "is_outlier") -> DataFrame:
    """Row flag: outside the fences on any column."""
    fenced = with_state(df, iqr_fences(df, cols, k), "_f")
    hit = any_of([(col(c) < F.col(f"_f.{c}_lo")) | (col(c) > F.col(f"_f.{c}_hi")) for c in cols])
    return fenced.withColumn(flag, hit).drop("_f")


def flagged_by_class(df: DataFrame, flag: str, label: str) -> DataFrame:
    """Rows, flagged rows and flagged share per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"), count_if(col(flag)).alias("flagged"),
                                 ratio(100 * count_if(col(flag)), F.count(F.lit(1))).alias("flagged_pct"))


def z_audit(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Rows with |z| > limit per column; z uses the population standard deviation."""
    state = df.agg(*[e for c in cols for e in (F.avg(col(c)).alias(f"{c}_m"), F.stddev_pop(col(c)).alias(f"{c}_s"))])
    one = with_state(df, state, "_z").agg(*[
        count_if(F.abs(ratio(col(c) - F.col(f"_z.{c}_m"), F.col(f"_z.{c}_s"))) > limit).alias(c) for c in cols])
    return rows_from(one, [], [{"column": F.lit(c), "outliers": col(c)} for c in cols])


def box_stats(df: DataFrame, value: str, by: str, k: float = 1.5) -> DataFrame:
    """Quartiles and whiskers (furthest values inside the fences) per group."""
    q = describe(df, [value], [.25, .5, .75], [by])
    iqr = F.col("p75") - F.col("p25")
    q = q.select(by, "n", "p25", "p50", "p75", (F.col("p25") - k * iqr).alias("_lo"), (F.col("p75") + k * iqr).alias("_hi"))
    fences = q.select(by, "_lo", "_hi", F.col("n").alias("_n"))
    inside = attach_few(df.select(by, value), fences, [by], rows="_n", spread=value).where(
        col(value).between(F.col("_lo"), F.col("_hi")))
    whiskers = inside.groupBy(by).agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))
    return join_groups(q, whiskers, [by], "left").drop("_lo", "_hi")
