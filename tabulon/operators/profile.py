"""Column profiles, distributions, frequency tables and associations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.numeric import col, count_if, ratio
from tabulon.operators.ordered import histogram_of, quantile_label, quantiles, running_totals
from tabulon.operators.reshape import rows_from
from tabulon.operators.skew import attach, join_groups
from tabulon.session import one_row


def _value_family(t: T.DataType) -> str:
    """Common type a column is profiled in, so that values of one family share one pass."""
    if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "bigint"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "double"
    return t.simpleString()


def profile(df: DataFrame, cols: Sequence[str] | None = None, *, exact: bool = True) -> DataFrame:
    """One row per column: type, non-null, null, null %, distinct, min and max (as text).

    exact: values are counted per (column, value), family of types by family; everything else
    follows from that table of distinct values. Otherwise one pass with approximate distinct counts.
    """
    cols = list(cols or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = F.create_map(*[F.lit(x) for c in cols for x in (c, kinds[c].simpleString())])
    if exact:
        out = None
        families: dict[str, list[str]] = {}
        for c in cols:
            families.setdefault(_value_family(kinds[c]), []).append(c)
        for family, members in families.items():
            long = df.select(*[col(c).cast(family).alias(c) for c in members]).unpivot([], members, "column", "v")
            freq = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
            one = freq.groupBy("column").agg(
                F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
                F.count("v").alias("distinct_values"), F.min("v").cast("string").alias("min_value"), F.max("v").cast("string").alias("max_value"))
            out = one if out is None else out.unionByName(one)
    else:
        one = df.agg(F.count(F.lit(1)).alias("_n"), *[e for c in cols for e in (
            F.count(col(c)).alias(f"{c}__cnt"), F.approx_count_distinct(col(c)).alias(f"{c}__dst"),
            F.min(col(c)).cast("string").alias(f"{c}__min"), F.max(col(c)).cast("string").alias(f"{c}__max"))])
        out = rows_from(one, [], [{
            "column": F.lit(c), "rows": F.col("_n"), "non_null": F.col(f"{c}__cnt"), "distinct_values": F.col(f"{c}__dst"),
            "min_value": F.col(f"{c}__min"), "max_value": F.col(f"{c}__max")} for c in cols])
    nulls = F.col("rows") - F.col("non_null")
    return out.select("column", names[F.col("column")].alias("dtype"), "non_null", nulls.alias("nulls"),
                      ratio(100 * nulls, F.col("rows")).alias("null_pct"), "distinct_values", "min_value", "max_value")


def missing_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing count and percentage per column."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(col(c).isNull()).alias(f"{c}__m") for c in cols])
    return rows_from(one, [], [{"column": F.lit(c), "missing": F.col(f"{c}__m"),
                                "missing_pct": ratio(100 * F.col(f"{c}__m"), F.col("_n"))} for c in cols])


def missing_totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total missing cells, rows with any / all values missing."""
    k = sum((F.when(col(c).isNull(), 1).otherwise(0) for c in cols), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(k).alias("missing_cells"),
                  count_if(k > 0).alias("rows_any_missing"), count_if(k == len(cols)).alias("rows_all_missing"))


def null_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How often every combination of missing / present occurs."""
    return df.groupBy(*[col(c).isNull().alias(f"{c}_missing") for c in cols]).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (.25, .5, .75),
             by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, exact quantiles, max: one row per (group, column)."""
    by, cols = list(by), list(cols)
    stats = [e for c in cols for e in (
        F.count(col(c)).alias(f"{c}__n"), F.avg(col(c)).alias(f"{c}__mean"),
        F.stddev_samp(col(c)).alias(f"{c}__std"), F.min(col(c)).cast("double").alias(f"{c}__min"),
        F.max(col(c)).cast("double").alias(f"{c}__max"))]
    wide = df.groupBy(*by).agg(*stats)
    rows = rows_from(wide, by, [{
        "column": F.lit(c), "n": F.col(f"{c}__n"), "mean": F.col(f"{c}__mean"), "std": F.col(f"{c}__std"),
        "min": F.col(f"{c}__min"), "max": F.col(f"{c}__max")} for c in cols])
    long = df.select(*by, *[col(c).cast("double").alias(c) for c in cols]).unpivot(by, cols, "column", "value")
    qt = quantiles(long, "value", probs, [*by, "column"])
    return join_groups(rows, qt, [*by, "column"], "left")


def corrected_skewness(c: Column) -> Column:
    """Sample skewness with the usual bias correction (Spark's own is the population form)."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def corrected_kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis."""
    n = F.count(c).cast("double")
    denominator = F.nullif((n - 2) * (n - 3), F.lit(0.0))
    return F.when(n > 3, (n - 1) / denominator * ((n + 1) * F.kurtosis(c) + 6))


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample std, corrected skewness and excess kurtosis per column."""
    wide = df.groupBy(*by).agg(*[e for c in cols for e in (
        F.avg(col(c)).alias(f"{c}__mean"), F.stddev_samp(col(c)).alias(f"{c}__std"),
        corrected_skewness(col(c)).alias(f"{c}__skew"), corrected_kurtosis(col(c)).alias(f"{c}__kurt"))])
    return rows_from(wide, list(by), [{
        "column": F.lit(c), "mean": F.col(f"{c}__mean"), "std": F.col(f"{c}__std"), "skewness": F.col(f"{c}__skew"),
        "kurtosis": F.col(f"{c}__kurt")} for c in cols])


def value_counts(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def freq_of_freq(df: DataFrame, c: str) -> DataFrame:
    """How many values occur exactly k times."""
    return value_counts(df.where(col(c).isNotNull()), [c]).groupBy(F.col("n").alias("times")).agg(
        F.count(F.lit(1)).alias("values"))


def pooled(df: DataFrame, slots: Sequence[str], name: str = "value") -> DataFrame:
    """All non-null values of several slot columns as (slot, value) rows."""
    return df.select(*slots).unpivot([], list(slots), "slot", name).where(F.col(name).isNotNull())


def categorical_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value (ties: smallest), its count, unique ratio - per column."""
    long = df.select(*[col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    freq = value_counts(long.where(F.col("value").isNotNull()), ["column", "value"])
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v")))
    return freq.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("non_null"),
                                      best.alias("_b")).select(
        "column", "distinct_values", F.col("_b.v").alias("mode"), (-F.col("_b.neg")).alias("mode_count"),
        ratio(F.col("distinct_values"), F.col("non_null")).alias("unique_ratio"))


def coverage(counts: DataFrame, ks: Sequence[int]) -> DataFrame:
    """For each minimum count k: values kept and rows covered. `counts` has a column `n`."""
    one = counts.agg(F.sum("n").alias("_rows"), *[e for k in ks for e in (
        count_if(F.col("n") >= k).alias(f"_k{k}"),
        F.coalesce(F.sum(F.when(F.col("n") >= k, F.col("n"))), F.lit(0)).alias(f"_r{k}"))])
    return rows_from(one, [], [{"min_count": F.lit(k).cast("int"), "values_kept": F.col(f"_k{k}"), "rows_covered": F.col(f"_r{k}"),
                                "pct_covered": ratio(100 * F.col(f"_r{k}"), F.col("_rows"))} for k in ks])


def slot_coverage(df: DataFrame, slots: Sequence[str], row_id: str, ks: Sequence[int]) -> DataFrame:
    """Coverage over several slot columns: a row is covered when any of its values is kept.

    A value counts once per row; a row's best value decides from which k on it is lost.
    """
    long = df.select(row_id, F.array_distinct(F.array_compact(F.array(*[col(s) for s in slots]))).alias("_a"))
    pairs = long.select(row_id, F.explode("_a").alias("_value"))
    counts = value_counts(pairs, ["_value"])
    best = attach(pairs, counts, ["_value"], rows="n", spread=row_id).groupBy(row_id).agg(F.max("n").alias("n"))
    kept = counts.agg(*[count_if(F.col("n") >= k).alias(f"_k{k}") for k in ks])
    rows = best.agg(*[count_if(F.col("n") >= k).alias(f"_r{k}") for k in ks])
    merged = rows.withColumn("_kept", one_row(kept))
    return rows_from(merged, [], [{"min_count": F.lit(k).cast("int"), "values_kept": F.col(f"_kept._k{k}"),
                                   "rows_covered": F.col(f"_r{k}")} for k in ks])


def contingency(df: DataFrame, a: str | Column, b: str, b_values: Sequence) -> DataFrame:
    """Two-way count table with zeros for absent cells."""
    return df.groupBy(a).pivot(b, list(b_values)).agg(F.count(F.lit(1))).na.fill(0)


def token_stats(df: DataFrame, tokens: str, value: str, min_support: int = 1) -> DataFrame:
    """Per list element: rows, mean, median and sample std of `value`, with a support floor."""
    long = df.where(col(value).isNotNull()).select(F.explode(col(tokens)).alias("token"), col(value).cast("double").alias("_v"))
    stats = long.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"))
    med = quantiles(long, "_v", [.5], ["token"], names=["median"])
    return join_groups(stats, med, ["token"]).where(F.col("n") >= min_support)


def histogram(df: DataFrame, value: str, edges_state: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram between one-row (lo, hi); the last bin is closed, as in numpy.

    Returns (by, bin from 0, n, density) for non-empty bins.
    """
    from tabulon.session import with_state
    v, lo, hi = col(value).cast("double"), F.col("_e.lo"), F.col("_e.hi")
    inside = with_state(df, edges_state, "_e").where((v >= lo) & (v <= hi))
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int")
    counts = inside.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.max(width).alias("_w"))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_tot"), F.max("_w").alias("_width"))
    if by:
        joined = join_groups(counts, totals, list(by))
    else:
        joined = counts.withColumn("_t", one_row(totals)).select("*", "_t.*")
    return joined.select(*by, "bin", "n", ratio(F.col("n"), F.col("_tot") * F.col("_width")).alias("density"))


def class_histogram_limits(df: DataFrame, value: str, label: str) -> DataFrame:
    """One-row (lo, hi): 0.1 / 99.9 percentiles, widened by the positive class's 1 / 99."""
    everyone = quantiles(df, value, [.001, .999], names=["a", "b"])
    positive = quantiles(df.where(col(label) == 1), value, [.01, .99], names=["c", "d"])
    return everyone.withColumn("_p", one_row(positive)).select(
        F.least("a", "_p.c").alias("lo"), F.greatest("b", "_p.d").alias("hi"))


def ecdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Empirical distribution function at every distinct value."""
    hist = histogram_of(df.where(col(value).isNotNull()).select(*by, value), by, value)
    cum = running_totals(hist, by, value, ["n"])
    return cum.select(*by, value, "n", ratio(F.col("cum_n"), F.col("tot_n")).alias("ecdf"))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair a < b (declared order), all pairs in one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(col(a), col(b)).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    return rows_from(one, [], [{"a": F.lit(a), "b": F.lit(b), "r": F.col(f"_r{i}")} for i, (a, b) in enumerate(pairs)])


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman correlation with average ranks for ties.

    Works on distinct (x, y) pairs with counts; ranks come from value histograms.
    """
    pairs = (df.where(col(x).isNotNull() & col(y).isNotNull())
             .groupBy(col(x).alias("x"), col(y).alias("y")).agg(F.count(F.lit(1)).alias("n")))

    def ranks(c):
        hist = pairs.groupBy(c).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"))
        cum = running_totals(hist, [], c, ["n"])
        centred = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2 - (F.col("tot_n") + 1) / 2
        return cum.select(c, centred.alias(f"r_{c}"), F.col("pairs").alias(f"pairs_{c}"))

    got = attach(pairs, ranks("x"), ["x"], rows="pairs_x", spread="y")
    got = attach(got, ranks("y"), ["y"], rows="pairs_y", spread="x")
    n, a, b = F.col("n"), F.col("r_x"), F.col("r_y")
    return got.agg(F.sum(n).alias("n"), ratio(F.sum(n * a * b), F.sqrt(F.sum(n * a * a) * F.sum(n * b * b))).alias("rho"))


def class_separation(df: DataFrame, cols: Sequence[str], label: Column) -> DataFrame:
    """Per feature: mean / median / std per class and the standardised mean difference."""
    tagged = df.select(label.cast("int").alias("_y"), *[col(c).cast("double").alias(c) for c in cols])
    d = describe(tagged, cols, [.5], ["_y"])
    pick = lambda k, c: F.max(F.when(F.col("_y") == k, F.col(c)))
    wide = d.groupBy("column").agg(*[pick(k, c).alias(f"{c}_{k}") for k in (0, 1) for c in ("n", "mean", "p50", "std")])
    pooled_var = ((F.col("n_0") - 1) * F.col("std_0") ** 2 + (F.col("n_1") - 1) * F.col("std_1") ** 2) / (
        F.nullif(F.col("n_0") + F.col("n_1") - 2, F.lit(0)))
    return wide.withColumn("std_mean_diff", ratio(F.col("mean_1") - F.col("mean_0"), F.sqrt(pooled_var)))


def scale_audit(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Min, max, range, mean and population std over all cells of each feature group."""
    where = {c: g for g, cols in groups.items() for c in cols}
    long = df.select(*[col(c).cast("double").alias(c) for c in where]).unpivot([], list(where), "column", "value")
    mapping = F.create_map(*[F.lit(x) for pair in where.items() for x in pair])
    return long.groupBy(mapping[F.col("column")].alias("feature_group")).agg(
        F.count_distinct("column").alias("columns"), F.min("value").alias("min"), F.max("value").alias("max"),
        (F.max("value") - F.min("value")).alias("range"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def linear_fit(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """Least-squares line of y on each x separately, all in one pass."""
    one = df.agg(*[e for x in xs for e in (F.regr_slope(col(y), col(x)).alias(f"{x}__s"),
                                           F.regr_intercept(col(y), col(x)).alias(f"{x}__i"))])
    return rows_from(one, [], [{"feature": F.lit(x), "slope": F.col(f"{x}__s"), "intercept": F.col(f"{x}__i")} for x in xs])


def class_balance(df: DataFrame, label: Column) -> DataFrame:
    """Counts, shares, imbalance ratio and the accuracy of always answering the majority."""
    y = label.cast("int")
    one = df.agg(F.count(F.lit(1)).alias("rows"), count_if(y == 1).alias("positives"), count_if(y == 0).alias("negatives"))
    hi, lo = F.greatest("positives", "negatives"), F.least("positives", "negatives")
    return one.select("rows", "positives", "negatives", ratio(100 * F.col("positives"), F.col("rows")).alias("positive_pct"),
                      ratio(hi, lo).alias("imbalance_ratio"), ratio(F.col("rows"), F.col("positives")).alias("one_in"),
                      ratio(hi, F.col("rows")).alias("majority_accuracy"))


def monotonic(df: DataFrame, order: str, value: str, *, ranges: int = 65536) -> DataFrame:
    """Is `value` non-decreasing along `order` (a unique key)?

    Rows are cut into equal-width key ranges; neighbours are compared inside each range and the
    last value of a range with the first value of the next non-empty one.
    """
    from pyspark.sql import Window
    from tabulon.session import with_state
    k = col(order)
    limits = df.agg(F.min(k).cast("double").alias("lo"), F.max(k).cast("double").alias("hi"))
    width = F.greatest((F.col("_l.hi") - F.col("_l.lo")) / ranges, F.lit(1e-9))
    cut = with_state(df, limits, "_l").select(
        k.alias("_k"), col(value).alias("_v"), F.floor((k - F.col("_l.lo")) / width).alias("_r"))
    near = Window.partitionBy("_r").orderBy("_k")
    steps = cut.withColumn("_down", F.col("_v") < F.lag("_v").over(near))
    per = steps.groupBy("_r").agg(F.count(F.lit(1)).alias("n"), count_if(F.col("_down")).alias("down"),
                                  F.min_by("_v", "_k").alias("first"), F.max_by("_v", "_k").alias("last"))
    seam = F.col("first") < F.lag("last").over(Window.partitionBy(F.lit(1)).orderBy("_r"))
    return per.withColumn("_seam", seam).agg(
        F.sum("n").alias("rows"), (F.sum("down") + count_if(F.col("_seam"))).alias("descents")).withColumn(
        "is_monotonic", F.col("descents") == 0)


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns whose minimum equals their maximum (or that hold no value)."""
    one = df.agg(*[F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias(c) for c in cols])
    return rows_from(one, [], [{"column": F.lit(c), "is_constant": col(c)} for c in cols])


def gram_rank(df: DataFrame, cols: Sequence[str]) -> int:
    """Numeric rank of the column matrix from its p x p Gram matrix (one aggregation)."""
    import numpy as np
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.sum(col(cols[i]).cast("double") * col(cols[j]).cast("double")) for i, j in pairs]).first()
    g = np.zeros((len(cols), len(cols)))
    for v, (i, j) in zip(row, pairs, strict=True):
        g[i, j] = g[j, i] = v
    scale = np.sqrt(np.maximum(np.diag(g), 1e-300))
    return int(np.linalg.matrix_rank(g / np.outer(scale, scale), tol=1e-9))


