"""Duplicates, keep-first and normalised identity keys.

Groups are reduced by hash aggregation (combined before the shuffle), never by a window over the
duplicate key, so a group holding a third of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col, count_if, ratio
from tabulon.operators.skew import attach


def duplicate_flags(df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
    """Add `copies` (group size), `is_extra` (not the first copy) and `in_duplicate_group`.

    Nulls compare equal. `row_id` (unique) defines which copy is first.
    """
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"), F.min(row_id).alias("_first"))
    out = attach(df, groups, cols, rows="copies", spread=row_id)
    return (out.withColumn("is_extra", col(row_id) != F.col("_first"))
            .withColumn("in_duplicate_group", F.col("copies") > 1).drop("_first"))


def dedupe_first(df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
    """Drop later copies, keeping the row with the smallest `row_id` of every group."""
    if row_id not in df.columns:
        raise ValueError(f"dedupe_first needs a row id column, {row_id!r} is absent")
    keep = df.groupBy(*cols).agg(F.min(row_id).alias(row_id))
    rest = [c for c in df.columns if c not in cols and c != row_id]
    if not rest:
        return keep.select(*df.columns)
    return df.join(keep.select(row_id), row_id, "left_semi")


def duplicate_stats(df: DataFrame, cols: Sequence[str], flag: Column | None = None) -> DataFrame:
    """Rows, extra copies, rows in duplicate groups, groups, largest group. With `flag` (a class) also the rows of
    duplicate groups that carry it, all rows that do, and their share in per cent. One pass."""
    mark = F.coalesce(flag, F.lit(False)) if flag is not None else F.lit(False)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"), count_if(mark).alias("flagged"))
    out = groups.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("extra_copies"),
                     F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_groups"),
                     count_if(F.col("n") > 1).alias("groups"), F.max("n").alias("largest_group"),
                     F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("flagged"))), F.lit(0)).alias("flagged_in_groups"),
                     F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_rows"))
    if flag is None:
        return out.drop("flagged_in_groups", "flagged_rows")
    return out.withColumn("flagged_share", 100 * ratio(F.col("flagged_in_groups"), F.col("flagged_rows")))


def group_size_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("group_size")).groupBy("group_size").agg(
        F.count(F.lit(1)).alias("groups"))


def row_log(df: DataFrame, raw_cols: Sequence[str], row_id: str, target: str) -> DataFrame:
    """(step, rows) of dedupe + target filter, in one pass over flagged rows."""
    flagged = duplicate_flags(df, raw_cols, row_id)
    has = col(target).isNotNull()
    one = flagged.agg(F.count(F.lit(1)).alias("a"), count_if(F.col("is_extra")).alias("b"),
                      count_if(F.col("is_extra") & has).alias("c"), count_if(~F.col("is_extra")).alias("d"),
                      count_if(~F.col("is_extra") & ~has).alias("e"), count_if(~F.col("is_extra") & has).alias("f"))
    steps = ["raw_rows", "exact_duplicates_removed", "exact_duplicates_with_target", "rows_after_dedupe",
             "rows_without_target", "final_rows"]
    return one.select(F.inline(F.array(*[F.struct(F.lit(s).alias("step"), F.col(k).alias("rows"))
                                         for s, k in zip(steps, "abcdef", strict=True)])))
