"""Order-dependent aggregates that do not pull a group into one task.

The input is first collapsed to one row per distinct (group, value) - ties vanish and a value held
by a third of all rows becomes a single row. The rest is range-partitioned on the composite key
(group, value), so even one dominating group is spread over many tasks; running totals are taken
inside each range and shifted by the totals of the ranges before it. There is one plan at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.numeric import col
from tabulon.session import input_bytes, materialise


RANGE_BYTES = 128 * 1024 * 1024
# Catalyst's estimate for a relation of unknown size is beyond any real one.
UNKNOWN_BYTES = 1 << 60


def histogram_of(df: DataFrame, by: Sequence[str], value: str, **sums: Column) -> DataFrame:
    """One row per distinct (by, value) with the given aggregates (default: `n` rows)."""
    aggs = [c.alias(name) for name, c in sums.items()] or [F.count(F.lit(1)).alias("n")]
    return df.groupBy(*by, value).agg(*aggs)


def range_count(df: DataFrame) -> int:
    """Ranges to sort into: the shuffle setting, or more where the files below hold over RANGE_BYTES per range."""
    size = input_bytes(df)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-size // RANGE_BYTES)) if size < UNKNOWN_BYTES else least


def running_totals(hist: DataFrame, by: Sequence[str], value: str, sums: Sequence[str], *,
                   descending: bool = False,
                   ranges: int | None = None) -> DataFrame:
    """Add `cum_<s>` (inclusive running total along `value`) and `tot_<s>` (group total).

    `hist` must be unique on (by, value).
    """
    by = list(by)
    key = col(value).desc() if descending else col(value).asc()
    group = by or [F.lit(1)]
    ranges = ranges or range_count(hist)
    parts = materialise(
        hist.repartitionByRange(ranges, *[col(b).asc() for b in by], key)
        .withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *by).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select("*", *[F.sum(s).over(inside).alias(f"_run_{s}") for s in sums])
    # At most (ranges + number of groups) rows: a group's rows sit in consecutive ranges.
    per_range = parts.groupBy("_range", *by).agg(*[F.sum(s).alias(f"_part_{s}") for s in sums])
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = per_range.select(
        F.col("_range").alias("_o_range"), *[col(b).alias(f"_o_{b}") for b in by],
        *[F.coalesce(F.sum(f"_part_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_part_{s}").over(whole).alias(f"tot_{s}") for s in sums])
    on = F.col("_range") == F.col("_o_range")
    for b in by:
        on = on & col(b).eqNullSafe(F.col(f"`_o_{b}`"))
    joined = local.join(offsets, on)
    return joined.select(*hist.columns,
                         *[(F.col(f"_run_{s}") + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums],
                         *[F.col(f"tot_{s}") for s in sums])


def quantile_label(q: float) -> str:
    """0.25 -> 'p25', 0.999 -> 'p99_9'."""
    return "p" + f"{q * 100:.10g}".replace(".", "_")


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), *,
              names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group; nulls are ignored."""
    by, names = list(by), list(names or [quantile_label(q) for q in probs])
    present = df.where(col(value).isNotNull())
    hist = histogram_of(present.select(*by, col(value).cast("double").alias("_v")), by, "_v")
    cum = running_totals(hist, by, "_v", ["n"])
    picks = []
    for q, nm in zip(probs, names, strict=True):
        pos = (F.col("tot_n") - 1) * F.lit(float(q))
        covers = lambda i: (i >= F.col("cum_n") - F.col("n")) & (i < F.col("cum_n"))
        picks += [F.max(F.when(covers(F.floor(pos)), F.col("_v"))).alias(f"_lo_{nm}"),
                  F.max(F.when(covers(F.ceil(pos)), F.col("_v"))).alias(f"_hi_{nm}"),
                  F.max(pos - F.floor(pos)).alias(f"_w_{nm}")]
    got = cum.groupBy(*by).agg(*picks)
    return got.select(*by, *[(F.col(f"_lo_{nm}") + (F.col(f"_hi_{nm}") - F.col(f"_lo_{nm}")) * F.col(f"_w_{nm}"))
                             .alias(nm) for nm in names])


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = (), *, descending: bool = False) -> DataFrame:
    """(by, value, n, first_rank, avg_rank): ties share the average rank; one row per value."""
    hist = histogram_of(df.where(col(value).isNotNull()).select(*by, value), by, value)
    cum = running_totals(hist, by, value, ["n"], descending=descending)
    start = F.col("cum_n") - F.col("n")
    return cum.select(*by, value, "n", (start + 1).alias("first_rank"),
                      (start + (F.col("n") + 1) / F.lit(2.0)).alias("avg_rank"))


def kth_in_hash_order(keys: DataFrame, hash_col: str, tie: str, wanted: DataFrame,
                      strata: Sequence[str] = ()) -> DataFrame:
    """The (hash, tie) pair at each wanted rank of the (hash, tie) order, per stratum.

    `wanted` holds (strata..., mark, rank). Hashes are uniform, so counting their top 16 bits
    finds the slice every wanted rank falls in; only those slices (1/65536 of the rows each) are
    ranked. Returns (strata..., mark, cut_hash, cut_tie).
    """
    strata = list(strata)
    sliced = keys.select(*strata, F.col(hash_col).alias("_h"), F.col(tie).alias("_t"),
                         F.shiftright(F.col(hash_col), 44).alias("_slice"))
    counts = sliced.groupBy(*strata, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*(strata or [F.lit(1)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    inside = (F.col("rank") > F.col("_start")) & (F.col("rank") <= F.col("_end"))
    if strata:
        marks = ends.join(wanted, strata).where(inside)
    else:
        listed = wanted.agg(F.collect_list(F.struct("mark", "rank"))).scalar()
        marks = ends.withColumn("_w", F.explode(listed)).select("*", "_w.*").where(inside)
    marks = marks.select(*strata, "_slice", "mark", (F.col("rank") - F.col("_start")).alias("_local"))
    # One entry per stratum and mark, tested on the scan: only rows of those slices are shuffled.
    slot = F.concat_ws("|", *[col(s).cast("string") for s in strata], F.col("_slice").cast("string"))
    needed = sliced.where(F.array_contains(marks.agg(F.collect_set(slot)).scalar(), slot))
    rn = Window.partitionBy(*strata, "_slice").orderBy("_h", "_t")
    ranked = needed.withColumn("_local", F.row_number().over(rn))
    return (ranked.join(marks, [*strata, "_slice", "_local"])
            .select(*strata, "mark", F.col("_h").alias("cut_hash"), F.col("_t").alias("cut_tie")))


def hash_numbering(keys: DataFrame, hash_col: str, tie: str, *, by: Sequence[str] = (), name: str = "number",
                   parts: int | None = None) -> DataFrame:
    """Number rows 0, 1, 2, ... in (hash, tie) order, anew in each group of `by` (without nulls), without a global sort.

    Rows are ranked inside 65536 uniform hash slices of a group and shifted by the counts of earlier slices, in `parts` tasks
    (by default as many as the files below call for) where that is more than the shuffle setting.
    """
    sliced = keys.withColumn("_slice", F.shiftright(F.col(hash_col), 44))
    counts = sliced.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(by or [F.lit(1)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rn = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy(hash_col, tie))
    parts = parts or range_count(keys)
    if parts > int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")):
        sliced = sliced.repartition(parts, *by, "_slice")
    return (sliced.withColumn("_rn", rn).join(starts, [*by, "_slice"])
            .withColumn(name, F.col("_start") + F.col("_rn") - 1).drop("_slice", "_rn", "_start"))
