"""Exact k nearest neighbours without comparing all pairs.

Points are assigned to the cell of their nearest pivot. A first pass inside a point's own block
gives an upper bound for its k-th distance; triangle-inequality bounds then tell which other cells
can still hold a neighbour, and the point is sent only to those. Cells are cut into blocks of
bounded size, so a dominating cell is spread over tasks; each task compares one block of
candidates with one chunk of queries in numpy and keeps k rows per query. What a task holds at a
time - rows sent on, distances - is bounded by ROUTED and COMPARED, however many blocks there are.
Queries take turns where the rows sent on are over ROUND_BYTES, so what lies on disk is bounded too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.draws import digest
from tabulon.functions.numeric import col
from tabulon.session import stored, stored_in_turn

#: Numbers of the vectors that are sent on in one piece, and distances that are held at a time.
ROUTED, COMPARED = 1 << 20, 1 << 20
#: Bytes of the rows that are sent on at a time.
ROUND_BYTES = 1 << 30


def _distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    d2 = (q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * q @ c.T
    return np.sqrt(np.maximum(d2, 0.0))


def _nearest_in_block(qid, q, cid, c, k: int, bound=None) -> pd.DataFrame:
    """Top-k of one block per query, of those within its bound: (query, neighbour, distance); ties go to the smaller id."""
    rough = _distances(q, c)
    rough[qid[:, None] == cid[None, :]] = np.inf
    take = min(k, len(cid)) - 1
    limit = np.partition(rough, take, axis=1)[:, take]
    if bound is not None:
        limit = np.minimum(limit, bound)
    scale = 1e-6 * (1.0 + np.abs(q).max(initial=0.0) + np.abs(c).max(initial=0.0))
    i, j = np.nonzero((rough <= (limit + scale)[:, None]) & np.isfinite(rough))
    exact, step = np.empty(len(i)), max(1, COMPARED // max(q.shape[1], 1))
    for s in range(0, len(i), step):
        exact[s:s + step] = np.sqrt(((q[i[s:s + step]] - c[j[s:s + step]]) ** 2).sum(1))
    order = np.lexsort((cid[j], exact, i))
    i, j, exact = i[order], j[order], exact[order]
    first = np.arange(len(i)) - np.searchsorted(i, i) < k
    return pd.DataFrame({"row_id": qid[i[first]], "neighbour_id": cid[j[first]], "distance": exact[first]})


def _nearest(qid, q, cid, c, k: int, bound=None) -> Iterator[pd.DataFrame]:
    """Frames of `_nearest_in_block`, COMPARED distances at a time."""
    step = max(1, COMPARED // max(len(cid), 1))
    for s in range(0, len(qid), step):
        yield _nearest_in_block(qid[s:s + step], q[s:s + step], cid, c, k, None if bound is None else bound[s:s + step])


def _few_points(pts: DataFrame, rows: list, k: int) -> DataFrame:
    """All candidates fit one block: it travels with the task, queries stay partitioned."""
    cid = np.array([r["id"] for r in rows], dtype="int64")
    cv = np.array([r["v"] for r in rows], dtype=float)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                out = pd.concat(_nearest(b["id"].to_numpy(), np.stack(b["v"]), cid, cv, k))
                out["rank"] = (out.groupby("row_id").cumcount() + 1).astype("int32")
                yield out[["row_id", "rank", "neighbour_id", "distance"]]

    spread = pts.repartition(max(1, min(64, len(rows) // 256)), "id")
    return spread.mapInPandas(search, "row_id bigint, rank int, neighbour_id bigint, distance double")


def nearest_neighbours(points: DataFrame, row_id: str, vector: str, k: int = 5, *, seed: int = 42,
                       pivots: int = 64, block: int = 4096) -> DataFrame:
    """(row_id, rank 1..k, neighbour_id, distance) for every point, Euclidean, exact."""
    pts = points.select(col(row_id).cast("bigint").alias("id"), col(vector).cast("array<double>").alias("v"))
    head = pts.limit(block + 1).collect()  # at most block + 1 rows
    if len(head) <= block:
        return _few_points(pts, head, k)
    chosen = pts.orderBy(digest(seed, "id"), "id").limit(pivots).collect()  # bounded by `pivots`
    centre = np.array([r["v"] for r in chosen], dtype=float)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                d = _distances(np.stack(b["v"]), centre)
                yield b.assign(cell=d.argmin(1).astype("int32"), reach=d.min(1))

    cells = pts.mapInPandas(assign, "id bigint, v array<double>, cell int, reach double")
    stats = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect()
    radius = np.full(len(centre), -np.inf)
    blocks = np.zeros(len(centre), dtype=int)
    for r in stats:
        radius[r["cell"]], blocks[r["cell"]] = r["radius"], math.ceil(r["n"] / block)
    total = sum(r["n"] for r in stats)
    n_blocks = F.array(*[F.lit(int(max(b, 1))) for b in blocks])
    placed = cells.withColumn("blk", F.pmod(F.xxhash64("id"), F.element_at(n_blocks, F.col("cell") + 1)).cast("int"))

    def own_block(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, v = pdf["id"].to_numpy(), np.stack(pdf["v"])
        bound = np.full(len(ids), np.inf)
        if len(ids) > k:
            step = max(1, COMPARED // len(ids))
            for s in range(0, len(ids), step):
                d = _distances(v[s:s + step], v)
                d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
                bound[s:s + step] = np.partition(d, k - 1, axis=1)[:, k - 1]
        return pdf.assign(bound=bound)

    bounded = stored(placed.groupBy("cell", "blk").applyInPandas(
        own_block, "id bigint, v array<double>, cell int, reach double, blk int, bound double"), "bounded")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """(batch, query, cell, block): where each query goes, ROUTED numbers at a time."""
        for b in batches:
            if not len(b):
                continue
            v = np.stack(b["v"])
            d = _distances(v, centre)
            lower = np.maximum(d - radius[None, :], (d - d.min(1)[:, None]) / 2.0)
            near = (lower <= b["bound"].to_numpy()[:, None] + 1e-6 * (1.0 + d)) & (blocks > 0)[None, :]
            qi, ci = np.nonzero(near)
            ends, most = np.cumsum(blocks[ci]), max(1, ROUTED // max(v.shape[1], 1))
            for low in range(0, int(ends[-1]) if len(ends) else 0, most):
                at = np.arange(low, min(low + most, int(ends[-1])))
                pair = np.searchsorted(ends, at, "right")
                yield b, qi[pair], ci[pair].astype("int32"), (at - (ends - blocks[ci])[pair]).astype("int32")

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, cell, blk in route(batches):
            yield pd.DataFrame({"cell": cell, "blk": blk}).value_counts(sort=False).reset_index(name="n")

    def queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, rows, cell, blk in route(batches):
            yield pd.DataFrame({"id": b["id"].to_numpy()[rows], "v": b["v"].to_numpy()[rows], "bound": b["bound"].to_numpy()[rows], "cell": cell, "blk": blk})

    chunks, sent, most = [1] * len(centre), 0, {}
    if total > 2 * block:
        counts = bounded.mapInPandas(visits, "cell int, blk int, n bigint").groupBy("cell", "blk").agg(F.sum("n").alias("n"))
        for r in counts.groupBy("cell").agg(F.max("n").alias("m"), F.sum("n").alias("n")).collect():
            most[r["cell"]], sent = r["m"], sent + r["n"]
    rounds = max(1, math.ceil(sent * 8 * (centre.shape[1] + 8) / ROUND_BYTES))  # a row sent on has eight numbers besides its vector, lengths included
    for cell, m in most.items():
        chunks[cell] = math.ceil(m / (rounds * 2 * block))
    n_chunks = F.element_at(F.array(*[F.lit(c) for c in chunks]), F.col("cell") + 1)
    turn = F.pmod(F.xxhash64(F.lit("round"), "id"), F.lit(rounds))
    asked = lambda r: bounded.where(turn == r).mapInPandas(queries, "id bigint, v array<double>, bound double, cell int, blk int").withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit("chunk"), "id"), n_chunks).cast("int"))
    offered = bounded.select("id", "v", "cell", "blk", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("chunk"))

    def meet(_key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame([], columns=["row_id", "neighbour_id", "distance"])
        return pd.concat(_nearest(q["id"].to_numpy(), np.stack(q["v"]), c["id"].to_numpy(), np.stack(c["v"]), k, q["bound"].to_numpy()))

    def found(r: int) -> DataFrame:
        at = ["cell", "blk", "chunk"]
        near = asked(r).groupBy(*at).cogroup(offered.groupBy(*at)).applyInPandas(
            meet, "row_id bigint, neighbour_id bigint, distance double")
        return near.groupBy("row_id").agg(
            F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbour_id"))), 1, k).alias("_b"))

    best = found(0) if rounds == 1 else stored_in_turn(map(found, range(rounds)), "nearest")
    return best.select("row_id", F.posexplode("_b").alias("_p", "_x")).select(
        "row_id", (F.col("_p") + 1).alias("rank"), F.col("_x.neighbour_id").alias("neighbour_id"),
        F.col("_x.distance").alias("distance"))
