"""Shared pieces of the corpus operators: stored tables, text chunks for tasks, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step inside a task handles at a time (a single longer text is one step).
CHUNK_BYTES = 1 << 20
#: The words of all operators are maximal runs of other characters than these.
BLANKS = b" \t\n\x0b\x0c\r"
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`. Only a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if getattr(spark, "_tabulon_scratch", None) is None:
        spark._tabulon_scratch = tempfile.mkdtemp(prefix="tabulon-")
    return spark._tabulon_scratch


#: Spark's own setting: shuffle files of an execution are removed at its end, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back. It cuts the lineage in a way that survives lost executors,
    and gives the planner exact sizes for the joins above it. The shuffle files of the write go as soon as it has ended."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._tabulon_path = path
    return back


def drop(*frames: DataFrame) -> None:
    """Delete tables of `stored` that no later step reads, and let Spark remove the shuffle files of finished steps."""
    for df in frames:
        jvm, path = df.sparkSession._jvm, getattr(df, "_tabulon_path", None)
        if path:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
    gc.collect()
    if frames:
        frames[0].sparkSession._jvm.System.gc()


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of `texts` whose UTF-8 bytes stay under `limit` (or hold a single row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the offset of each text in them (one more than there are texts)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def blank_bytes(data: np.ndarray) -> np.ndarray:
    return _IS_BLANK[data]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text have their flag set."""
    where = np.flatnonzero(flags)
    return np.diff(np.searchsorted(where, offsets)).astype(np.int64)


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions at which a word begins; a word never runs over the end of its text."""
    word = ~blank_bytes(data)
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    return np.flatnonzero(word & ~before)


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each of `n` nodes' component, by links a[i] - b[i]: hook to the smaller root, then jump."""
    parent = np.arange(n)
    while len(a):
        x, y = parent[a], parent[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        if not len(a):
            break
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one batch, cut to one link from each node to the smallest node it reaches inside the batch."""
    for batch in batches:
        ids, codes = np.unique(np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()]), return_inverse=True)
        root = roots(codes[:batch.num_rows], codes[batch.num_rows:], len(ids))
        own = np.flatnonzero(root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[root[own]])], names=["node", "to"])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of a link table of long ids: (node, component), the smallest id of each, for linked nodes.

    Each task first reduces its batches of links to forests. Then rounds of two steps run until nothing changes: every
    node hands its smallest neighbour to its larger ones, and then to its smaller ones. Both halves of a round are joins
    of stored tables, which Spark splits when a node has very many links; no list of neighbours is ever gathered.
    Rounds grow with the logarithm of a component's diameter. Null ids and links of a node to itself are ignored.
    """
    pairs = links.select(F.col(a).cast("long").alias("node"), F.col(b).cast("long").alias("to")).filter("node <> `to`")
    edges = stored(pairs.mapInArrow(_forest, "node long, `to` long").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
        low = stored(both.groupBy("node").agg(F.min("to").alias("m")).select(F.col("node").alias("center"), F.least("node", "m").alias("m")), "lows")
        large = stored(edges.join(low, F.col("to") == F.col("center")).select("node", F.col("m").alias("to")).distinct(), "large")
        down = stored(large.groupBy("node").agg(F.min("to").alias("m")).select(F.col("node").alias("center"), "m"), "lows")
        small = large.join(down, F.col("node") == F.col("center")).filter("`to` <> m").select(F.col("to").alias("node"), F.col("m").alias("to"))
        after = stored(small.unionByName(down.select(F.col("center").alias("node"), F.col("m").alias("to"))).distinct(), "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()
        drop(edges, low, large, down)
        edges = after
        if mark == state or mark[0] == 0:
            return edges.select("node", F.col("to").alias("component"))
        state = mark


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of equal first `keys` columns, from batches sorted by them."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate([r, c]) for r, c in zip(rest, columns)]
        if not len(columns[0]):
            continue
        same = np.ones(len(columns[0]), bool)
        for c in columns[:keys]:
            same &= c == c[-1]
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        rest = [c[cut:] for c in columns]
        if cut:
            yield [c[:cut] for c in columns]
    if rest is not None and len(rest[0]):
        yield rest


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def strings(values: pa.Array) -> list:
    """The values of a string or binary array as Python objects, made in one step."""
    return values.to_numpy(zero_copy_only=False).tolist()
