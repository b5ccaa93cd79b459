"""Joining per-key results back to rows when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col
from tabulon.session import stored

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE
# hot keys whatever the data: the broadcast below has a fixed bound.
HOT_SHARE = 1000
SALTS = 256


def _same(left: DataFrame, keys: Sequence[str], prefix: str):
    on = None
    for k in keys:
        c = col(k).eqNullSafe(F.col(f"`{prefix}{k}`"))
        on = c if on is None else on & c
    return on


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two per-group results on their grouping keys; a null key is a group like any other."""
    values = [c for c in right.columns if c not in keys]
    renamed = right.select(*[col(k).alias(f"_g_{k}") for k in keys], *values)
    return left.join(renamed, _same(left, keys, "_g_"), how).select(*[col(c) for c in left.columns], *values)


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str], *, rows: str, spread: str,
           null_keys: bool = True) -> DataFrame:
    """Left join of `table` (unique on `keys`, nulls equal) to `df`, safe against hot keys.

    `rows` is the column of `table` that says how many rows of `df` carry the key; `spread` is a
    high-cardinality column of `df` used to scatter the rows of hot keys. With null_keys=False the
    table has no null keys, and rows of `df` without a key are scattered as well.
    """
    values = [c for c in table.columns if c not in keys]
    renamed = table.select(*[col(k).alias(f"_k_{k}") for k in keys], F.struct(*values).alias("_v"))
    renamed = stored(renamed, "attach")  # read for the total, the hot and the other keys
    total = renamed.agg(F.sum(F.col(f"_v.{rows}"))).scalar()
    is_hot = F.col(f"_v.{rows}") * F.lit(HOT_SHARE) > total
    hot = renamed.where(is_hot).select(*[F.col(f"`_k_{k}`").alias(f"_h_{k}") for k in keys],
                                       F.col("_v").alias("_hot"))
    cold = renamed.where(~is_hot).withColumn("_salt_c", F.lit(0))
    alone = F.col("_hot").isNotNull()
    if not null_keys:
        for k in keys:
            alone = alone | col(k).isNull()
    marked = df.join(F.broadcast(hot), _same(df, keys, "_h_"), "left").withColumn(
        "_salt", F.when(alone, F.pmod(F.xxhash64(col(spread)), F.lit(SALTS)).cast("int") + 1).otherwise(F.lit(0)))
    joined = marked.join(cold, _same(df, keys, "_k_") & (F.col("_salt") == F.col("_salt_c")), "left")
    return joined.withColumn("_v", F.coalesce("_hot", "_v")).select(*df.columns, "_v.*")


def attach_few(df: DataFrame, table: DataFrame, keys: Sequence[str], *, rows: str, spread: str) -> DataFrame:
    """`attach` for keys expected to take few values (labels, categories, periods).

    The per-key table is written once, so that Spark knows its size: a small one is broadcast by the
    planner and `df` is not shuffled; a large one is joined by a shuffle whose skewed parts Spark splits.
    """
    values = [c for c in table.columns if c not in keys]
    renamed = stored(table.select(*[col(k).alias(f"_k_{k}") for k in keys], F.struct(*values).alias("_v")), "attach")
    return df.join(renamed, _same(df, keys, "_k_"), "left").select(*df.columns, "_v.*")
