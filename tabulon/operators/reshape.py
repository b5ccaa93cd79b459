"""Wide/long reshaping, with explicit value lists so no extra job discovers them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col


def rows_from(df: DataFrame, keep: Sequence[str], items: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn one wide row into len(items) rows; every item maps output columns to expressions."""
    structs = [F.struct(*[c.alias(name) for name, c in item.items()]) for item in items]
    return df.select(*keep, F.inline(F.array(*structs)))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "column",
            value: str = "value") -> DataFrame:
    """Melt `values` into (name, value) rows."""
    return df.unpivot(list(ids), list(values), name, value)


def to_wide(df: DataFrame, keys: Sequence[str], name: str, values: Sequence[str], agg: Column) -> DataFrame:
    """Pivot with a declared value list."""
    return df.groupBy(*keys).pivot(name, list(values)).agg(agg)


def reindex(df: DataFrame, key: str, labels: Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """Keep exactly `labels` in `key`; labels without a row get the fill values."""
    spark = df.sparkSession
    order = spark.createDataFrame([(v, i) for i, v in enumerate(labels)], [key, f"{key}_order"])
    out = order.join(df, key, "left")
    return out.select(key, F.col(f"{key}_order").cast("int").alias(f"{key}_order"),
                      *[F.coalesce(col(c), F.lit(fill[c])).alias(c) if c in fill else col(c)
                        for c in df.columns if c != key])


def transpose_stats(df: DataFrame, label: str, stats: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Statistics table turned on its side: one row per statistic, one column per label."""
    return to_wide(to_long(df, [label], stats, "statistic", "value"), ["statistic"], label, labels,
                   F.first("value"))
