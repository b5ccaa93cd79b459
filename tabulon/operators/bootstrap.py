"""Bootstrap intervals by Poisson(1) weights.

A row's weights in all replicates follow from one digest of (seed, row id) by integer arithmetic, so no resampled copy of
the data exists anywhere: tasks draw a block of rows x replicates at a time, reduce it at once, and leave one partial sum
per replicate. Models share their draws.

Ranking metrics need the rows in the order of their scores. Rows of one score that come in numbers are reduced to one cell
with a weight per replicate before anything is sorted, so a score that a third of all rows have is a row per task. The
rest is range-partitioned by score; a first pass sums the weights of each range, a second one runs over the ranges with
the sums of the higher ones as its start.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.functions.draws import draw_state, poisson_weights
from tabulon.functions.numeric import col, ratio, ratio_or_zero
from tabulon.operators.reshape import to_long
from tabulon.session import stored

REPLICATES = 2000
# Draws that are made at a time.
BLOCK = 1 << 20
# Rows of one score in a batch from which they are one cell, and cells that a task holds before it sends them.
CELL_ROWS, CELLS = 64, 1000


def weighted_sums(df: DataFrame, row_id: str, values: Mapping[str, Column], b: int, seed: int = 42) -> DataFrame:
    """(replicate, weight, <values>): per replicate the total weight and the weighted sum of each value (null counts as 0)."""
    names = list(values)
    a, c = draw_state(seed, row_id)
    rows = df.select(a.alias("_a"), c.alias("_b"), *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(n) for n, v in values.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((b, 1 + len(names))), False
        for batch in batches:
            x = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for at in range(0, batch.num_rows, max(1, BLOCK // b)):
                part = [v[at:at + max(1, BLOCK // b)] for v in x]
                w = poisson_weights(part[0], part[1], 1, b).astype(float)
                total += w.T @ np.stack([np.ones(len(w)), *part[2:]], 1)
                any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, b + 1)), *(pa.array(total[:, i]) for i in range(total.shape[1]))], names=["replicate", "weight", *names])

    fields = ", ".join(f"`{n}` double" for n in ("weight", *names))
    return rows.mapInArrow(run, f"replicate long, {fields}").groupBy("replicate").agg(*[F.sum(n).alias(n) for n in ("weight", *names)])


def intervals(values: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """2.5 / 97.5 % limits of replicate values (b rows per group: a bounded table)."""
    long = to_long(values.select(*by, *[col(m).cast("double").alias(m) for m in metrics]), list(by), metrics, "metric", "v")
    q = F.percentile(F.col("v"), F.array(F.lit(.025), F.lit(.975)))
    return long.where(F.col("v").isNotNull()).groupBy(*by, "metric").agg(
        q[0].alias("low"), q[1].alias("high"), F.count("v").alias("replicates"))


def rmse_difference(df: DataFrame, row_id: str, actual: str, models: Sequence[str], best: str, *, b: int = REPLICATES,
                    seed: int = 42) -> DataFrame:
    """(model, diff, low, high, share_worse): RMSE minus the best model's RMSE, shared resamples."""
    sq = {f"_e{i}": (col(actual) - col(m)) ** 2 for i, m in enumerate(models)}
    point = df.agg(*[F.sqrt(F.avg(e)).alias(m) for m, e in zip(models, sq.values(), strict=True)])
    per = weighted_sums(df, row_id, sq, b, seed).select(*[F.sqrt(ratio(F.col(e), F.col("weight"))).alias(m) for m, e in zip(models, sq, strict=True)])
    others = [m for m in models if m != best]
    diff = lambda d: to_long(d.select(*[(col(m) - col(best)).alias(m) for m in others]), [], others, "model", "v")
    q = F.percentile(F.col("v"), F.array(F.lit(.025), F.lit(.975)))
    spread = diff(per).groupBy("model").agg(q[0].alias("low"), q[1].alias("high"),
                                            F.avg((F.col("v") > 0).cast("double")).alias("share_worse"))
    return diff(point).withColumnRenamed("v", "diff").join(spread, "model")


def _cells(b: int):
    """(score, positive, a, b) -> the same rows, those of frequent (score, positive) reduced to their weights `w`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[float, bool], np.ndarray] = {}
        names = ["score", "positive", "a", "b", "w"]

        def flush() -> pa.RecordBatch:
            keys, weights = list(held), [w.astype("<i8").tobytes() for w in held.values()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.float64()), pa.array([k[1] for k in keys], pa.bool_()), pa.nulls(len(keys), pa.int64()),
                                               pa.nulls(len(keys), pa.int64()), pa.array(weights, pa.binary())], names=names)

        for batch in batches:
            score, positive, a, c = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            order = np.lexsort((positive, score))
            score, positive, a, c = score[order], positive[order].astype(bool), a[order], c[order]
            starts = np.flatnonzero(np.r_[True, (score[1:] != score[:-1]) | (positive[1:] != positive[:-1])]) if len(score) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(score)]) if len(starts) else starts
            for s, n in zip(starts[sizes >= CELL_ROWS].tolist(), sizes[sizes >= CELL_ROWS].tolist()):
                total = held.setdefault((float(score[s]), bool(positive[s])), np.zeros(b, np.int64))
                for at in range(s, s + n, max(1, BLOCK // b)):
                    total += poisson_weights(a[at:min(at + BLOCK // b, s + n)], c[at:min(at + BLOCK // b, s + n)], 1, b).sum(0, dtype=np.int64)
            single = np.repeat(sizes < CELL_ROWS, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(score[single]), pa.array(positive[single]), pa.array(a[single]), pa.array(c[single]), pa.nulls(int(single.sum()), pa.binary())], names=names)
            if len(held) > CELLS:
                yield flush()
        if held:
            yield flush()
    return run


def _weights(columns: Mapping[str, pa.Array], at: int, stop: int, b: int) -> np.ndarray:
    """(rows x replicates) weights of rows, drawn or as summed before."""
    w = columns["w"].slice(at, stop - at)
    own = np.asarray(w.is_null())
    out = np.zeros((stop - at, b), np.int64)
    if own.any():
        a, c = (np.asarray(columns[x].slice(at, stop - at).fill_null(0), np.int64)[own] for x in ("a", "b"))
        out[own] = poisson_weights(a, c, 1, b)
    if not own.all():
        out[~own] = np.frombuffer(b"".join(w.drop_null().to_pylist()), "<i8").reshape(-1, b)
    return out


def _range_sums(b: int, threshold: float):
    """Rows -> (part, replicate, pos, neg, tp, fp): sums of the weights of a range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            score, positive, part = (np.asarray(columns[x].to_numpy(zero_copy_only=False)) for x in ("score", "positive", "part"))
            for at in range(0, batch.num_rows, max(1, BLOCK // b)):
                stop = min(batch.num_rows, at + max(1, BLOCK // b))
                w = _weights(columns, at, stop, b)
                p, over = positive[at:stop].astype(bool), score[at:stop] >= threshold
                for k in np.unique(part[at:stop]).tolist():
                    of = part[at:stop] == k
                    add = np.stack([w[of & m].sum(0) for m in (p, ~p, p & over, ~p & over)])
                    sums[k] = sums[k] + add if k in sums else add
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b, k, np.int32)), pa.array(np.arange(1, b + 1)), *map(pa.array, s)], names=["part", "replicate", "pos", "neg", "tp", "fp"])
    return run


def _areas(b: int):
    """A range's rows and the weights above it -> (replicate, steps, pairs): its share of the sums that make the areas."""
    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by([("score", "descending")]).combine_chunks()
        columns = {c: rows.column(c).combine_chunks() if rows.num_rows else rows.column(c) for c in rows.column_names}
        order = np.argsort(np.asarray(above.column("replicate")))
        tp, fp = (np.asarray(above.column(c), np.float64)[order] for c in ("pos", "neg"))
        steps, pairs = np.zeros(b), np.zeros(b)
        open_score, open_pos, open_neg = None, np.zeros(b), np.zeros(b)

        def close(pos: np.ndarray, neg: np.ndarray) -> None:  # (scores x replicates), from high to low
            nonlocal tp, fp, steps, pairs
            after_p, after_n = tp + np.cumsum(pos, 0), fp + np.cumsum(neg, 0)
            flagged = after_p + after_n
            steps += (pos * np.divide(after_p, flagged, out=np.zeros_like(flagged), where=flagged > 0)).sum(0)
            pairs += (neg * (after_p - pos / 2)).sum(0)
            tp, fp = after_p[-1], after_n[-1]

        n, size = rows.num_rows, max(1, BLOCK // b)
        score = np.asarray(columns["score"]) if n else np.zeros(0)
        positive = np.asarray(columns["positive"].to_numpy(zero_copy_only=False)).astype(float) if n else score
        for at in range(0, n, size):
            stop = min(n, at + size)
            w = _weights(columns, at, stop, b).astype(float)
            s, p = score[at:stop], positive[at:stop, None]
            starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            pos, neg = np.add.reduceat(w * p, starts), np.add.reduceat(w * (1 - p), starts)
            if open_score is not None and s[0] == open_score:
                pos[0] += open_pos
                neg[0] += open_neg
            elif open_score is not None:
                close(open_pos[None], open_neg[None])
            if len(starts) > 1:
                close(pos[:-1], neg[:-1])
            open_score, open_pos, open_neg = s[-1], pos[-1], neg[-1]
        if open_score is not None:
            close(open_pos[None], open_neg[None])
        return pa.table({"replicate": np.arange(1, b + 1), "steps": steps, "pairs": pairs})
    return run


def classification_values(df: DataFrame, row_id: str, label: str, score: str, *, threshold: float = .5, b: int = REPLICATES,
                          seed: int = 42) -> DataFrame:
    """(replicate, precision, recall, f1, pr_auc, roc_auc) of every replicate with a positive. Rows without a label or
    score are left out."""
    a, c = draw_state(seed, row_id)
    rows = df.where(col(label).isNotNull() & col(score).isNotNull()).select(
        (col(score).cast("double") + F.lit(0.0)).alias("score"), (col(label).cast("int") == 1).alias("positive"), a.alias("a"), c.alias("b"))
    cells = rows.mapInArrow(_cells(b), "score double, positive boolean, a long, b long, w binary")
    ranged = stored(cells.repartitionByRange("score").withColumn("part", F.spark_partition_id()), "ranges")
    sums = stored(ranged.mapInArrow(_range_sums(b, threshold), "part int, replicate long, pos long, neg long, tp long, fp long")
                  .groupBy("part", "replicate").agg(*[F.sum(x).alias(x) for x in ("pos", "neg", "tp", "fp")]), "range_sums")
    higher = W.partitionBy("replicate").orderBy(F.col("part").desc()).rowsBetween(W.unboundedPreceding, -1)
    above = sums.select("part", "replicate", *[F.coalesce(F.sum(x).over(higher), F.lit(0)).alias(x) for x in ("pos", "neg")])
    areas = ranged.groupBy("part").cogroup(above.groupBy("part")).applyInArrow(_areas(b), "replicate long, steps double, pairs double")
    areas = areas.groupBy(F.col("replicate").alias("_r")).agg(F.sum("steps").alias("steps"), F.sum("pairs").alias("pairs"))
    totals = sums.groupBy("replicate").agg(*[F.sum(x).alias(x) for x in ("pos", "neg", "tp", "fp")]).where(F.col("pos") > 0)
    tp, fp, p, n = (F.col(x) for x in ("tp", "fp", "pos", "neg"))
    return totals.join(areas, F.col("replicate") == F.col("_r")).select(
        "replicate", ratio_or_zero(tp, tp + fp).alias("precision"), ratio(tp, p).alias("recall"), ratio_or_zero(2 * tp, tp + fp + p).alias("f1"),
        ratio(F.col("steps"), p).alias("pr_auc"), ratio(F.col("pairs"), p.cast("double") * n.cast("double")).alias("roc_auc"))


def classification_intervals(df: DataFrame, row_id: str, label: str, score: str, *, threshold: float = .5, b: int = REPLICATES,
                             seed: int = 42) -> DataFrame:
    """Intervals of precision, recall, F1, PR-AUC and ROC-AUC; replicates without a positive are skipped."""
    values = classification_values(df, row_id, label, score, threshold=threshold, b=b, seed=seed)
    return intervals(values, ["precision", "recall", "f1", "pr_auc", "roc_auc"])


def effective_weights(df: DataFrame, row_id: str, b: int, seed: int = 42) -> DataFrame:
    """Total weight per replicate: averages the row count, used to check the draws."""
    return weighted_sums(df, row_id, {}, b, seed).withColumnRenamed("weight", "total_weight")
