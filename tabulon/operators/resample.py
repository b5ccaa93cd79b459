"""Class weights and resampling of training rows.

Draws are hashes of (seed, draw number), so the same rows come out for any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.draws import digest, uniform
from tabulon.functions.numeric import col, ratio
from tabulon.operators.neighbours import nearest_neighbours
from tabulon.operators.ordered import hash_numbering, kth_in_hash_order
from tabulon.session import one_row

STRATEGIES = ("none", "class_weight", "oversample", "smote", "undersample")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = one_row(counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")))
    return counts.withColumn("_t", total).select(
        label, "n", ratio(F.col("_t.rows"), F.col("_t.classes") * F.col("n")).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight column for a 0/1 label, from one scalar aggregate (no join, hence no label skew)."""
    y = col(label).cast("int")
    t = one_row(df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos")))
    out = df.withColumn("_t", t)
    share = F.when(y == 1, F.col("_t.pos")).otherwise(F.col("_t.n") - F.col("_t.pos"))
    return out.withColumn(name, ratio(F.col("_t.n"), 2 * share)).drop("_t")


def _class_sizes(df: DataFrame, label: str) -> tuple[int, int, int]:
    """(minority label, minority rows, majority rows) of a 0/1 label; one small job."""
    y = col(label).cast("int")
    r = df.agg(F.count(F.when(y == 1, 1)).alias("p"), F.count(F.when(y == 0, 1)).alias("n")).first()
    return (1, r["p"], r["n"]) if r["p"] <= r["n"] else (0, r["n"], r["p"])


def _draws(spark, count: int, slots: int, seed) -> DataFrame:
    """`count` uniform picks with replacement from 0..slots-1."""
    d = spark.range(1, count + 1).withColumnRenamed("id", "draw")
    return d.withColumn("number", F.pmod(digest(f"{seed}-pick", "draw"), F.lit(slots)))


def oversample(df: DataFrame, label: str, row_id: str, *, seed: int = 42) -> DataFrame:
    """All rows plus minority copies (with replacement) up to the majority size; `draw` is 0 for originals."""
    minor, n_min, n_maj = _class_sizes(df, label)
    base = df.withColumn("draw", F.lit(0).cast("bigint"))
    if n_min == 0 or n_maj == n_min:
        return base
    pool = hash_numbering(df.where(col(label) == minor).withColumn("_h", digest(f"{seed}-order", row_id)), "_h", row_id)
    extra = _draws(df.sparkSession, n_maj - n_min, n_min, seed).join(pool, "number").drop("number", "_h")
    return base.unionByName(extra.select(*base.columns))


def undersample(df: DataFrame, label: str, row_id: str, *, seed: int = 42) -> DataFrame:
    """All minority rows and as many majority rows, drawn without replacement."""
    minor, n_min, _ = _class_sizes(df, label)
    major = df.where(col(label) != minor).withColumn("_h", digest(seed, row_id))
    wanted = df.sparkSession.createDataFrame([(0, n_min)], "mark int, rank bigint")
    cut = one_row(kth_in_hash_order(major.select("_h", row_id), "_h", row_id, wanted))
    h = digest(seed, row_id)
    inside = (h < F.col("_c.cut_hash")) | ((h == F.col("_c.cut_hash")) & (col(row_id) <= F.col("_c.cut_tie")))
    kept = df.withColumn("_c", cut).where((col(label) == minor) | F.coalesce(inside, F.lit(False)))
    return kept.drop("_c")


def smote(df: DataFrame, label: str, row_id: str, vector: str, *, k: int = 5, seed: int = 42) -> DataFrame:
    """(row_id null for synthetic, label, vector, draw): synthetic minority points x + u * (nb - x)."""
    minor, n_min, n_maj = _class_sizes(df, label)
    base = df.select(col(row_id).cast("bigint").alias(row_id), label, col(vector).cast("array<double>").alias(vector),
                     F.lit(0).cast("bigint").alias("draw"))
    if n_maj == n_min:
        return base
    if n_min <= k:
        raise ValueError(f"SMOTE with k={k} needs more than {k} minority rows, got {n_min}")
    rare = df.where(col(label) == minor).select(col(row_id).cast("bigint").alias("_id"),
                                               col(vector).cast("array<double>").alias("_x"))
    near = nearest_neighbours(rare, "_id", "_x", k, seed=seed)
    pool = hash_numbering(rare.withColumn("_h", digest(f"{seed}-order", "_id")), "_h", "_id")
    picks = (_draws(df.sparkSession, n_maj - n_min, n_min, seed).join(pool, "number")
             .withColumn("_rank", (F.pmod(digest(f"{seed}-near", "draw"), F.lit(k)) + 1).cast("int"))
             .withColumn("_u", uniform(f"{seed}-u", "draw")))
    pair = picks.join(near, (F.col("_id") == F.col("row_id")) & (F.col("_rank") == F.col("rank")))
    other = rare.select(F.col("_id").alias("_nid"), F.col("_x").alias("_y"))
    made = pair.join(other, F.col("neighbour_id") == F.col("_nid"))
    point = F.zip_with("_x", "_y", lambda a, b: a + F.col("_u") * (b - a))
    extra = made.select(F.lit(None).cast("bigint").alias(row_id),
                        F.lit(minor).cast(df.schema[label].dataType).alias(label), point.alias(vector), "draw")
    return base.unionByName(extra)


def resample(df: DataFrame, label: str, strategy: str, row_id: str, *, vector: str | None = None, seed: int = 42,
             k: int = 5) -> DataFrame:
    """Dispatch by strategy name; 'none' and 'class_weight' leave the rows alone."""
    if strategy in ("none", "class_weight"):
        return df
    if strategy == "oversample":
        return oversample(df, label, row_id, seed=seed)
    if strategy == "undersample":
        return undersample(df, label, row_id, seed=seed)
    if strategy == "smote":
        if vector is None:
            raise ValueError("smote needs the vector column")
        return smote(df, label, row_id, vector, k=k, seed=seed)
    raise ValueError(f"unknown strategy {strategy!r}; expected one of {STRATEGIES}")


def resampling_summary(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows and class counts per strategy."""
    out = None
    for name, df in parts.items():
        y = col(label).cast("int")
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(y == 1, 1)).alias("positives"),
                     F.count(F.when(y == 0, 1)).alias("negatives")).select(F.lit(name).alias("strategy"), "*")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("minority_pct", ratio(100 * F.least("positives", "negatives"), F.col("rows"))).withColumn(
        "ratio", ratio(F.greatest("positives", "negatives"), F.least("positives", "negatives")))
