"""Replayable train/test splits and folds.

Rows are ordered by a hash of (seed, key). A split or fold boundary is the exact hash at a wanted
rank (see `kth_in_hash_order`), so sizes are exact, and assigning rows is a comparison with a few
boundary values: the wide table itself is never sorted, ranked or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.draws import digest
from tabulon.functions.numeric import col, count_if, ratio
from tabulon.operators.contracts import Check, run_checks
from tabulon.operators.ordered import kth_in_hash_order
from tabulon.session import one_row


@dataclass(frozen=True)
class Split:
    """A frame with a `split` column and its two filtered views."""

    frame: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.frame.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.frame.where(F.col("split") == "test")

    def saved(self, path: str) -> Split:
        """The same split from a table partitioned by part: later jobs prune to the part they read."""
        self.frame.write.partitionBy("split").parquet(path)
        return Split(self.frame.sparkSession.read.schema(self.frame.schema).parquet(path))


# Strata are class labels: their boundaries travel as one map value. More strata than this are refused.
MAX_STRATA = 10_000


def _stratum(stratify: str | None) -> Column:
    """Stratum key; null is a stratum of its own."""
    return F.coalesce(F.concat(F.lit("="), col(stratify).cast("string")), F.lit("null")) if stratify else F.lit("all")


def _boundaries(df: DataFrame, key: str, seed, shares: Sequence[float], stratify: str | None, distinct: bool) -> Column:
    """Map stratum -> boundary (hash, key) after each cumulative share, as a scalar subquery."""
    by = ["_s"] if stratify else []
    keys = df.select(*([_stratum(stratify).alias("_s")] if by else []), col(key).alias("_key"))
    if distinct:
        keys = keys.distinct()
    keys = keys.withColumn("_hash", digest(seed, "_key"))
    totals = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    marks = F.array(*[F.struct(F.lit(i).alias("mark"), F.round(F.col("_total") * F.lit(float(s))).cast("bigint").alias("rank"))
                      for i, s in enumerate(shares)])
    cuts = kth_in_hash_order(keys, "_hash", "_key", totals.select(*by, F.inline(marks)), by)
    if not by:
        cuts = cuts.withColumn("_s", _stratum(None))
    per = cuts.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("mark", "cut_hash", "cut_tie"))).alias("_cuts"))
    too_many = F.raise_error(F.lit(f"more than {MAX_STRATA} strata")).cast("string")
    entry = F.struct(F.when(F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_s")) <= MAX_STRATA, F.col("_s"))
                     .otherwise(too_many), F.col("_cuts"))
    return per.select(entry.alias("_e")).agg(F.map_from_entries(F.collect_list("_e"))).scalar()


def _position(df: DataFrame, key: str, seed, shares: Sequence[float], stratify: str | None, distinct: bool) -> DataFrame:
    """Add `_pos`: how many boundaries lie strictly before the row. A narrow projection of `df`."""
    cuts = _boundaries(df, key, seed, shares, stratify, distinct)
    placed = df.withColumn("_all", cuts).withColumn("_cuts", F.col("_all")[_stratum(stratify)]).withColumn("_h", digest(seed, key))
    h, k = F.col("_h"), col(key)
    before = lambda b: (b["cut_hash"] < h) | ((b["cut_hash"] == h) & (b["cut_tie"] < k))
    found = F.when(F.col("_cuts").isNotNull(), F.size("_cuts")).otherwise(F.lit(0))
    passed = F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", before))).otherwise(F.lit(0))
    missing = F.lit(len(shares)) - found  # a share that rounds to rank 0 lies before every row
    return placed.withColumn("_pos", (passed + missing).cast("int")).drop("_all", "_cuts", "_h")


def split(df: DataFrame, row_id: str, *, test: float = 0.2, seed: int = 42, stratify: str | None = None,
          group: str | None = None) -> Split:
    """Random, stratified (`stratify`) or whole-group (`group`) split; `test` is a share of rows,
    of every class, or of groups. The test part holds exactly round(n * test) of them.

    Key and label columns of `df` are read up to three times; hand in a stored table, not a long
    chain of transformations.
    """
    if stratify and group:
        raise ValueError("stratify and group cannot be combined")
    out = _position(df, group or row_id, seed, [test], stratify, bool(group))
    label = F.when(F.col("_pos") == 0, F.lit("test")).otherwise(F.lit("train"))
    return Split(out.withColumn("split", label).drop("_pos"))


def folds(df: DataFrame, row_id: str, k: int = 5, *, seed: int = 42, stratify: str | None = None,
          group: str | None = None, name: str = "fold") -> DataFrame:
    """Add fold numbers 1..k; fold sizes (rows, rows per class, or groups) differ by at most one."""
    if stratify and group:
        raise ValueError("stratify and group cannot be combined")
    out = _position(df, group or row_id, seed, [i / k for i in range(1, k)], stratify, bool(group))
    return out.withColumn(name, F.col("_pos") + 1).drop("_pos")


def repeated_folds(df: DataFrame, row_id: str, k: int = 5, repeats: int = 5, *, seed: int = 42) -> DataFrame:
    """Fold columns fold_r1..fold_rR with an own seed per repeat."""
    for r in range(1, repeats + 1):
        df = folds(df, row_id, k, seed=seed * 1000 + r, name=f"fold_r{r}")
    return df


def split_summary(df: DataFrame, label: Column, by: str = "split") -> DataFrame:
    """Rows, share of all rows, positives, negatives and imbalance per part."""
    y = label.cast("int")
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), count_if(y == 1).alias("positives"),
                              count_if(y == 0).alias("negatives")).select(
        by, "rows", ratio(F.col("rows"), total).alias("share"), "positives", "negatives",
        ratio(100 * F.col("positives"), F.col("rows")).alias("positive_pct"),
        ratio(F.col("negatives"), F.col("positives")).alias("imbalance_ratio"))


def fold_report(df: DataFrame, label: Column, fold: str = "fold", group: str | None = None) -> DataFrame:
    """Per fold: training and validation rows, positives and (optionally) groups, from one aggregation."""
    y = label.cast("int")
    aggs = [F.count(F.lit(1)).alias("valid_rows"), count_if(y == 1).alias("valid_positives")]
    if group:
        aggs.append(F.count_distinct(col(group)).alias("valid_groups"))
    per = df.groupBy(fold).agg(*aggs)
    totals = one_row(per.agg(F.sum("valid_rows").alias("rows"), F.sum("valid_positives").alias("pos")))
    return per.withColumn("_t", totals).select(
        fold, (F.col("_t.rows") - F.col("valid_rows")).alias("train_rows"), "valid_rows",
        (F.col("_t.pos") - F.col("valid_positives")).alias("train_positives"), "valid_positives",
        ratio(100 * F.col("valid_positives"), F.col("valid_rows")).alias("valid_positive_pct"),
        *([F.col("valid_groups")] if group else []))


def overlap(df: DataFrame, key: str, part: str) -> DataFrame:
    """Keys found in more than one part (0 proves disjointness)."""
    per = df.groupBy(key).agg(F.min(part).alias("_a"), F.max(part).alias("_b"))
    return per.agg(F.count(F.lit(1)).alias("keys"), count_if(F.col("_a") != F.col("_b")).alias("shared_keys"))


def validate_split(df: DataFrame, row_id: str, label: str, *, test: float = 0.2, tolerance_pp: float = 0.05) -> DataFrame:
    """The split check list: sizes, classes, rates and disjointness."""
    y, tr, te = col(label).cast("int"), F.col("split") == "train", F.col("split") == "test"
    n, n_tr, n_te = F.count(F.lit(1)), count_if(tr), count_if(te)
    rate = lambda cond: 100 * F.avg(F.when(cond, y.cast("double")))
    full = 100 * F.avg(y.cast("double"))
    as_int = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return run_checks(df, [
        Check("rows outside train and test", n - n_tr - n_te),
        Check("label outside 0/1", count_if(~F.coalesce(y.isin(0, 1), F.lit(False)))),
        Check("classes in the table", F.count_distinct(y), 2),
        Check("classes in train", F.count_distinct(F.when(tr, y)), 2),
        Check("classes in test", F.count_distinct(F.when(te, y)), 2),
        Check("test size off by more than one", as_int(F.abs(n_te - F.round(n * test)) > 1)),
        Check("train rate off", as_int(F.abs(rate(tr) - full) > tolerance_pp)),
        Check("test rate off", as_int(F.abs(rate(te) - full) > tolerance_pp)),
        Check("row ids used twice", n - F.count_distinct(col(row_id))),
    ])


def validate_folds(df: DataFrame, row_id: str, label: Column, k: int, fold: str = "fold") -> DataFrame:
    """Each row validated once, folds complete, positives per fold differ by at most one."""
    y = label.cast("int")
    per = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), count_if(y == 1).alias("pos"))
    rows = df.groupBy(row_id).agg(F.count(F.lit(1)).alias("m"))
    seen = one_row(rows.agg(F.count(F.lit(1)).alias("ids"), count_if(F.col("m") != 1).alias("bad")))
    return run_checks(per.withColumn("_s", seen), [
        Check("folds", F.count(F.lit(1)), k), Check("rows validated more than once", F.max("_s.bad")),
        Check("rows never validated", F.max("_s.ids") - F.sum("n")),
        Check("positives per fold differ by more than one",
              F.greatest(F.max("pos") - F.min("pos") - 1, F.lit(0)))])
