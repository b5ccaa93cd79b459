"""Joins between results and rows, set comparisons, ordered lookups and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.draws import digest
from tabulon.functions.numeric import col, count_if, ratio
from tabulon.operators.skew import attach


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, *, default, rows: str, spread: str,
           name: str | None = None) -> DataFrame:
    """value of `key` in `table` (unique, non-null keys), `default` when the key is unseen or null.

    `rows` (about how many rows carry the key) and `spread` (a column to scatter hot keys by) keep
    the join safe against dominating keys.
    """
    got = table.select(col(key), col(value).alias("_lv"), col(rows).alias("_ln"))
    out = attach(df, got, [key], rows="_ln", spread=spread, null_keys=False)
    return out.withColumn(name or value, F.coalesce("_lv", F.lit(default))).drop("_lv", "_ln")


def compare_counts(a: DataFrame, b: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Full outer comparison of two count tables, absent counts as 0 and nulls as a key of their own."""
    left = a.select(*[col(k).alias(f"_a_{k}") for k in keys], col(n).alias("_na"))
    right = b.select(*[col(k).alias(f"_b_{k}") for k in keys], col(n).alias("_nb"))
    on = None
    for k in keys:
        c = col(f"_a_{k}").eqNullSafe(col(f"_b_{k}"))
        on = c if on is None else on & c
    both = left.join(right, on, "full_outer")
    return both.select(*[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys],
                       F.coalesce("_na", F.lit(0)).alias("left_n"), F.coalesce("_nb", F.lit(0)).alias("right_n"))


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys in a, in b, in both, only in a, only in b - one aggregation, no join."""
    tagged = a.select(col(key).alias("k"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(col(key).alias("k"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    per = tagged.where(F.col("k").isNotNull()).groupBy("k").agg(F.max("in_a").alias("a"), F.max("in_b").alias("b"))
    one = F.lit(1)
    return per.agg(count_if(F.col("a") == one).alias("left_keys"), count_if(F.col("b") == one).alias("right_keys"),
                   count_if((F.col("a") == one) & (F.col("b") == one)).alias("both"),
                   count_if((F.col("a") == one) & (F.col("b") == 0)).alias("only_left"),
                   count_if((F.col("a") == 0) & (F.col("b") == one)).alias("only_right"))


def membership_overlap(long: DataFrame, config: str, item: str, configs: Sequence[str]) -> DataFrame:
    """For every pair of configurations: sizes, common items, Jaccard, identical sets.

    Items are collapsed to one row with 0/1 marks per configuration, so no self-join is needed.
    """
    marks = long.groupBy(item).agg(*[F.max(F.when(col(config) == c, 1).otherwise(0)).alias(f"_m{i}")
                                     for i, c in enumerate(configs)])
    pairs = [(i, j) for i in range(len(configs)) for j in range(i + 1, len(configs))]
    one = marks.agg(*[F.coalesce(F.sum(f"_m{i}"), F.lit(0)).alias(f"_s{i}") for i in range(len(configs))],
                    *[F.coalesce(F.sum(F.col(f"_m{i}") * F.col(f"_m{j}")), F.lit(0)).alias(f"_p{i}_{j}") for i, j in pairs])
    from tabulon.operators.reshape import rows_from
    return rows_from(one, [], [{
        "config_a": F.lit(configs[i]), "config_b": F.lit(configs[j]), "size_a": F.col(f"_s{i}"), "size_b": F.col(f"_s{j}"),
        "common": F.col(f"_p{i}_{j}"),
        "jaccard": ratio(F.col(f"_p{i}_{j}"), F.col(f"_s{i}") + F.col(f"_s{j}") - F.col(f"_p{i}_{j}")),
        "identical": (F.col(f"_s{i}") == F.col(f"_p{i}_{j}")) & (F.col(f"_s{j}") == F.col(f"_p{i}_{j}"))} for i, j in pairs])


def first_per(df: DataFrame, category: str, row_id: str, cols: Sequence[str]) -> DataFrame:
    """First row of each category in row order, by a map-side combined min_by."""
    return df.groupBy(category).agg(F.min_by(F.struct(row_id, *cols), col(row_id)).alias("_r")).select(category, "_r.*")


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*by).limit(k)


def hash_sample(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """`n` replayable random rows: the smallest hashes (top-k per task, then merged)."""
    return df.withColumn("_h", digest(seed, row_id)).orderBy("_h", row_id).limit(n).drop("_h")


def step_delta(df: DataFrame, order: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Difference to the previous row of a result table in its declared order.

    Meant for tables of aggregates (one row per step); without `by` all steps share one window.
    """
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy(order)
    return df.withColumn("delta", col(value) - F.lag(value).over(w))


def rank_results(df: DataFrame, value: str, *, name: str = "rank", descending: bool = True, method: str = "min",
                 by: Sequence[str] = ()) -> DataFrame:
    """Rank rows of a result table; ties get the lowest ('min') or the mean ('average') rank."""
    part = Window.partitionBy(*(by or [F.lit(1)]))
    r = F.rank().over(part.orderBy(col(value).desc() if descending else col(value).asc()))
    if method == "min":
        return df.withColumn(name, r)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
    return df.withColumn(name, r + (ties - 1) / F.lit(2.0))


def edge_of_grid(best: DataFrame, grid: DataFrame, param: str) -> DataFrame:
    """Flag a best value that is the smallest or largest searched."""
    from tabulon.session import with_state
    limits = grid.agg(F.min(param).alias("lo"), F.max(param).alias("hi"))
    return with_state(best, limits, "_g").withColumn("at_lower_edge", col(param) == F.col("_g.lo")).withColumn(
        "at_upper_edge", col(param) == F.col("_g.hi")).drop("_g")
