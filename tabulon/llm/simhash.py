"""SimHash near-duplicates: fingerprints of three-word shingles, linked within a Hamming radius.

A 64-bit fingerprint is cut into 32 segments of two bits, and described by how many bits are set in each. One differing
bit moves one count by one, so the Manhattan distance of two descriptions never exceeds the Hamming distance of the
fingerprints. Two fingerprints within radius 3 agree within distance 1 on the segments of one of the two halves. The
16 counts of a half are a cell of a grid; each fingerprint stands in its own cell of either half and looks into the cells
one step up, so that any such pair meets in a cell, where the exact distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tabulon.llm.common import components, drop, roots, stored

SHINGLE = 3
SEED = 42
#: The grid below is exact for differences of up to three bits.
RADIUS = 3
#: Fingerprints in one cell, its own and visitors, before it is cut into blocks which are compared pair by pair.
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint. A bit is set if it is set in over half of the shingle hashes; no words give zero."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        hashes = [xxhash.xxh64_intdigest(b" ".join(x), seed) for x in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, np.int64)
    packed = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(packed), 1 << 16):
        ones += np.unpackbits(packed[i:i + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


@F.arrow_udf(LongType())
def _fingerprint_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([fingerprint(x.as_py()) for x in texts], pa.int64())


def fingerprint_of(text: Column) -> Column:
    return _fingerprint_udf(text.cast("string"))


def _cells(prints: DataFrame) -> DataFrame:
    """(half, cell, fp, own): each fingerprint's own cell in both halves, and the cells one step up."""
    both = prints.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    bits = F.when(F.col("half") == 0, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    counts = F.expr("(bits & 1431655765L) + (shiftrightunsigned(bits, 1) & 1431655765L)")
    own = both.withColumn("bits", bits).withColumn("cell", counts).select("fp", "half", "cell")
    steps = F.expr("filter(transform(sequence(0, 15), s -> if((shiftrightunsigned(cell, 2 * s) & 3L) < 2L, cell + shiftleft(1L, 2 * s), -1L)), c -> c >= 0L)")
    up = own.select("fp", "half", F.explode(steps).alias("cell"))
    return own.withColumn("own", F.lit(True)).unionByName(up.withColumn("own", F.lit(False)))


def _blocks(cells: DataFrame, block: int) -> DataFrame:
    """Cells with over `block` fingerprints, own or visiting, become pairs of blocks: a row goes to each pair with its block."""
    crowded = cells.groupBy("half", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    crowded = stored(crowded.select(F.col("half").alias("h"), F.col("cell").alias("c"), F.ceil(F.col("n") / block).cast("int").alias("parts")), "crowded")
    joined = cells.join(crowded, (F.col("half") == F.col("h")) & (F.col("cell") == F.col("c")), "left")
    mine = F.expr("coalesce(pmod(xxhash64(fp), parts), 0)")
    other = F.explode(F.expr("sequence(0L, coalesce(parts, 1) - 1L)"))
    pairs = joined.withColumn("mine", mine).withColumn("other", other)
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    return pairs.select(F.xxhash64("half", "cell", low, high).alias("meet"), "fp", "own")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the fingerprints of each run of equal `meet`; yield one link per fingerprint that is not its run's root."""
    rest = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def links(meet: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        left = np.arange(len(meet) - 1)
        lag = 1
        while len(left := left[left + lag < len(meet)]) and len(left := left[meet[left] == meet[left + lag]]):
            near = left[np.bitwise_count(fp[left] ^ fp[left + lag]) <= RADIUS]
            a.append(near)
            b.append(near + lag)
            lag += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        root = roots(a, b, len(fp))
        own = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[root[own]])], names=["a", "b"])

    for batch in batches:
        meet, fp = (np.concatenate([old, batch.column(i).to_numpy()]) for i, old in enumerate(rest))
        if not len(meet):
            continue
        cut = int(np.searchsorted(meet, meet[-1]))  # the last run may go on in the next batch
        rest = meet[cut:], fp[cut:]
        if cut:
            yield links(meet[:cut], fp[:cut])
    if len(rest[0]):
        yield links(*rest)


def hamming_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints `fp` that connect all which differ in up to three bits.

    Every close pair is compared; inside a meeting of many close fingerprints only a spanning forest is returned. A cell
    holds a bounded number of rows: a crowded one is cut into blocks of fingerprints, and each pair of blocks is a meeting.
    """
    met = _blocks(_cells(prints), block)
    runs = met.repartition("meet").sortWithinPartitions("meet").select("meet", "fp")
    return runs.mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, fp, root, component_id (smallest doc_id reachable over links, itself included) of every row of `docs`;
    root is the component's smallest fingerprint.

    Null and empty texts have fingerprint zero and link like any other. Null doc_ids belong to components but never name
    one, unless all of a component are null. Repeated rows give repeated rows; other columns are not looked at.
    """
    printed = stored(docs.select("doc_id", fingerprint_of(F.col("text")).alias("fp")), "fingerprints")
    distinct = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    linked = components(hamming_links(distinct.select("fp"), block), "a", "b")
    rooted = stored(distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root")), "rooted")
    named = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "named")
    labels = stored(rooted.join(named, "root").select(F.col("fp").alias("__fp"), "root", "component_id"), "labels")
    drop(distinct, rooted, named)
    return printed.join(labels, F.col("fp") == F.col("__fp")).select("doc_id", "fp", "root", "component_id")


def digest(marked: DataFrame) -> DataFrame:
    return marked.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of near-duplicates: its smallest doc_id, all columns as they were. Of the component's rows
    with that doc_id one stays; rows without doc_id stay (one of them) only where their whole component has none. A doc_id
    whose rows belong to several components is looked at component by component."""
    marks = stored(near_duplicates(docs), "marks")
    several = marks.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.min("root").alias("a"), F.max("root").alias("b"))
    several = stored(several.filter("a <> b").select("__id"), "several")
    named = marks.filter("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    named = stored(named.join(several, "__id", "left_anti"), "kept")
    rows = docs.join(named.hint("merge"), F.col("doc_id") == F.col("__id"), "left_semi").dropDuplicates(["doc_id"])
    unclear = lambda df: df.filter("doc_id IS NULL").unionByName(df.join(several, F.col("doc_id") == F.col("__id"), "left_semi"))
    first = unclear(marks.filter("component_id IS NULL OR doc_id = component_id")).select(F.col("doc_id").alias("__own"), F.col("fp").alias("__fp"), F.col("root").alias("__root"))
    first = stored(first.distinct(), "unclear")
    others = unclear(docs).withColumn("__print", fingerprint_of(F.col("text")))
    others = others.join(first, (F.col("__print") == F.col("__fp")) & F.col("doc_id").eqNullSafe(F.col("__own"))).dropDuplicates(["__root"])
    return rows.unionByName(others.select(*[F.col(f"`{c}`") for c in docs.columns]))
