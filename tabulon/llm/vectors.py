"""Embedding near-duplicates by a pivot-permutation index.

Pivots are a bounded sample of the vectors. Each distinct vector is described by its NEAREST most similar pivots in order,
and stands in the inverted list of each. Two vectors in a list are candidates when their descriptions share SHARED pivots
or more; the cosine of candidates is taken in double precision. A pair that meets in several lists counts in that of the
smallest pivot they share. Every vector is indexed; long lists are cut into blocks which are compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import components, drop, roots, stored

THRESHOLD = 0.9
NEAREST = 8
SHARED = 2
#: Twice the square root of the number of distinct vectors, up to this many, are pivots.
MAX_PIVOTS = 65_536
BLOCK = 2048


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with zeros."""
    out = np.zeros((len(raw), width))
    for i, x in enumerate(raw):
        v = np.frombuffer(x, "<f8")
        out[i, :len(v)] = v
    return out


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) -> (vec_id, key, vec); key and vec are null where a vector links with nothing."""
    for batch in batches:
        keys, vectors = [], []
        for item in batch.column(1):
            v = None if item.as_py() is None else np.array([np.nan if x is None else x for x in item.as_py()], np.float64) + 0.0
            good = v is not None and len(v) > 0 and np.isfinite(v).all() and bool(v.any())
            raw = v.astype("<f8").tobytes() if good else None
            vectors.append(raw)
            keys.append(xxhash.xxh3_128_digest(raw) if good else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["vec_id", "key", "vec"])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _describer(pivots: np.ndarray, nearest: int):
    """cid, n, vec -> the same and the `nearest` pivots, most similar first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                raw = part.column(2).to_pylist()
                width = max(pivots.shape[1], max(len(x) // 8 for x in raw))
                mine = _unit(_matrix(raw, width))[:, :pivots.shape[1]].astype(np.float32)
                near = mine @ pivots.T
                k = min(nearest, len(pivots))
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * k, pa.int32()), pa.array(top.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), lists], names=["cid", "n", "vec", "pivots"])
    return run


def _meeting(pivot: int, crossed: bool, cids: np.ndarray, n: np.ndarray, raw: list[bytes], own: np.ndarray, block: np.ndarray, threshold: float, shared: int):
    """(cid, root, linked vectors) of the classes that link in one meeting of a pivot's list."""
    width = max(len(x) for x in raw) // 8
    unit = _unit(_matrix(raw, width))
    length = np.array([len(x) for x in raw])
    distinct, code = np.unique(own, return_inverse=True)
    has = np.zeros((len(raw), len(distinct)), np.float32)
    np.put_along_axis(has, code.reshape(own.shape), 1, 1)
    low = has[:, :np.searchsorted(distinct, pivot)]
    candidate = (has @ has.T >= shared) & (low @ low.T == 0) & (length[:, None] == length[None, :])
    if crossed:
        candidate &= block[:, None] != block[None, :]
    link = candidate & (unit @ unit.T >= threshold)
    np.fill_diagonal(link, False)
    counts = link @ n
    a, b = np.nonzero(np.triu(link, 1))
    root = roots(a, b, len(raw))
    some = np.flatnonzero(counts)
    return cids[some], cids[root[some]], counts[some]


def _compare(threshold: float, shared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def close() -> pa.RecordBatch:
            cids, n, block = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 7))
            got = _meeting(rows[0][1], rows[0][2], cids, n, [r[5] for r in rows], np.array([r[6] for r in rows]), block, threshold, min(shared, len(rows[0][6])))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["cid", "to", "links"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != current:
                    if len(rows) > 1:
                        yield close()
                    current, rows = row[0], []
                rows.append(row)
        if len(rows) > 1:
            yield close()
    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST, shared: int = SHARED, max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors` (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do vectors of
    different length. Equal vectors link. Repeated rows are vectors of their own; a null vec_id never names a component
    unless all of it are null. Other columns are not looked at.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(rows.mapInArrow(_prepare, "vec_id long, key binary, vec binary"), "vectors")
    classes = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.min("vec").alias("vec"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    wanted = min(max_pivots, max(1, int(2 * classes.count() ** 0.5)))
    sample = [r[0] for r in classes.orderBy(F.xxhash64("key"), "cid").select("vec").limit(wanted).collect()]
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    pivots = _unit(_matrix(sample, max(len(x) for x in sample) // 8)).astype(np.float32)
    described = stored(classes.select("cid", "n", "vec").mapInArrow(_describer(pivots, nearest), "cid long, n long, vec binary, pivots array<int>"), "described")
    listed = described.select("*", F.explode("pivots").alias("pivot"))
    sizes = stored(listed.groupBy(F.col("pivot").alias("_pivot")).agg(F.ceil(F.count("*") / block).cast("int").alias("parts")), "lists")
    spread = listed.join(sizes, F.col("pivot") == F.col("_pivot")).withColumn("mine", F.expr("pmod(xxhash64(cid), parts)"))
    spread = spread.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1L)")))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    met = spread.select(F.xxhash64("pivot", low, high).alias("meet"), "pivot", (F.col("mine") != F.col("other")).alias("crossed"), "cid", "n", "vec", "pivots", "mine")
    found = met.repartition("meet").sortWithinPartitions("meet").mapInArrow(_compare(threshold, shared), "cid long, `to` long, links long")
    found = stored(found, "found")
    counts = found.groupBy(F.col("cid").alias("_cid")).agg(F.sum("links").alias("links"))
    joined = components(found, "cid", "to")
    rooted = classes.select("key", "first_id", "n", "cid").join(joined, F.col("cid") == F.col("node"), "left").join(counts, F.col("cid") == F.col("_cid"), "left")
    rooted = stored(rooted.select("key", "first_id", F.coalesce("component", "cid").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "rooted")
    named = stored(rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first_id").alias("component_id")), "named")
    labels = stored(rooted.join(named, F.col("root") == F.col("_root")).select(F.col("key").alias("_key"), "n_links", "component_id"), "labels")
    drop(described, sizes, found, rooted, named)
    linked = rows.filter("key IS NOT NULL").join(labels, F.col("key") == F.col("_key")).select("vec_id", "n_links", "component_id")
    alone = rows.filter("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: All pairs in DuckDB; the index finds every pair of the small tables.
ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= {THRESHOLD}),
r(id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept FROM v JOIN m ON m.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
