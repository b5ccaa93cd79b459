"""Check suites: what a fitted preprocessor and a resampler read and left, held against what they should have.

Fitted stages keep the number and the digest of the rows they were fitted on in their state (`seen_rows`), taken in the
aggregation that fits them. The suites compare both with the training part, so a stage fitted on as many, but other, rows
is found as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.draws import digest
from tabulon.functions.numeric import col, count_if
from tabulon.operators.contracts import CHECK_SCHEMA, Check, run_checks
from tabulon.session import one_row

#: Digests of row ids are summed modulo this.
MODULUS = 2 ** 48


def seen_digest(row_id: str, where: Column | None = None) -> Column:
    """Aggregate: order-independent digest of the ids of the rows (of those with `where`) as a multiset."""
    d = digest("seen", row_id).cast("decimal(19,0)")
    total = F.coalesce(F.sum(d if where is None else F.when(where, d)), F.lit(0).cast("decimal(29,0)"))
    return (total % F.lit(MODULUS)).cast("bigint")


def seen_rows(row_id: str) -> dict[str, Column]:
    """Aggregates a stage keeps in its state beside the number of rows."""
    return {"seen_digest": seen_digest(row_id)}


def preprocessor_checks(raw: DataFrame, train: DataFrame, test: DataFrame, features: Sequence[str], row_id: str,
                        scalers: Sequence) -> DataFrame:
    """Eight checks of a fitted preprocessor: rows of both parts kept, the same columns in both, none gained or lost, no
    missing or infinite feature cell, and scalers fitted on exactly the training rows.

    `raw` has a `split` column; `train` and `test` are its transformed parts. One pass over each of the three.
    """
    have = [c for c in features if c in train.columns and c in test.columns]
    value = {c: col(c).cast("double") for c in have}
    count = lambda flags: F.coalesce(F.sum(sum((f.cast("bigint") for f in flags), F.lit(0))), F.lit(0))
    missing = count([v.isNull() | F.isnan(v) for v in value.values()])
    infinite = count([F.coalesce(F.abs(v) == F.lit(float("inf")), F.lit(False)) for v in value.values()])
    part = lambda df: one_row(df.agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing"), infinite.alias("infinite")))
    in_train = F.col("split") == "train"
    one = raw.agg(count_if(in_train).alias("n_train"), count_if(F.col("split") == "test").alias("n_test"),
                  seen_digest(row_id, in_train).alias("digest")).withColumns({"_train": part(train), "_test": part(test)})
    off = F.lit(0)
    for i, s in enumerate(scalers):
        state = s.state["moments"]
        one = one.withColumn(f"_s{i}", one_row(state.select(*[c for c in ("n_seen", "seen_digest") if c in state.columns])))
        wrong = F.col(f"_s{i}.n_seen") != F.col("n_train")
        if "seen_digest" in state.columns:
            wrong = wrong | (F.col(f"_s{i}.seen_digest") != F.col("digest"))
        off = off + wrong.cast("int")
    differ = len(set(train.columns) ^ set(test.columns))
    changed = len((set(train.columns) | set(test.columns)) ^ set(raw.columns))
    static = [("columns in one part only", differ, 0, differ == 0), ("columns gained or lost", changed, 0, changed == 0),
              ("a scaler was fitted", min(len(scalers), 1), 1, bool(scalers))]
    return raw.sparkSession.createDataFrame(static, CHECK_SCHEMA).unionByName(run_checks(one, [
        Check("train rows gained or lost", F.max(F.abs(F.col("_train.rows") - F.col("n_train")))),
        Check("test rows gained or lost", F.max(F.abs(F.col("_test.rows") - F.col("n_test")))),
        Check("missing cells", F.max(F.col("_train.missing") + F.col("_test.missing"))),
        Check("infinite cells", F.max(F.col("_train.infinite") + F.col("_test.infinite"))),
        Check("scalers fitted on other rows than train", F.max(off))]))


def resampling_checks(train: DataFrame, resampled: DataFrame, test_before: DataFrame, test_after: DataFrame, label: str, *,
                      changes: bool = True) -> DataFrame:
    """Four checks of a resampler: the test part keeps its rows and its class counts, the training part changed (or did not,
    with changes=False) and still holds both classes. A null label counts as a class of its own."""
    frames = {"train": train, "resampled": resampled, "before": test_before, "after": test_after}
    long = None
    for name, df in frames.items():
        one = df.select(col(label).cast("string").alias("_y"), F.lit(name).alias("_frame"))
        long = one if long is None else long.unionByName(one)
    counts = long.groupBy("_y").agg(*[count_if(F.col("_frame") == n).alias(n) for n in frames])
    return run_checks(counts, [
        Check("test rows gained or lost", F.abs(F.sum("after") - F.sum("before"))),
        Check("test classes with another count", count_if(F.col("after") != F.col("before"))),
        Check("training classes changed", F.max((F.col("resampled") != F.col("train")).cast("int")), int(changes)),
        Check("classes in the resampled rows", count_if(F.col("resampled") > 0), 2)])
