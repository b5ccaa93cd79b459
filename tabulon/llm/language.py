"""Language identification with a string kernel.

Two texts are compared by the blended spectrum of n-grams of one to three characters: how many n-grams they share, over
the geometric mean of how many each has (presence, not frequency). A bounded, balanced sample of labelled texts is
learned from. Some of it serve as Nystrom landmarks, and one-versus-rest kernel ridge regression is solved on kernel
values against them. A text is then scored by two matrix products per batch: presence x landmarks, kernel x weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField, StructType

ORDERS = (1, 2, 3)
#: n-grams of each order fall into 2**BITS buckets by hash.
BITS = 16
WIDTH = len(ORDERS) << BITS
#: Bounds of what is learned from: texts in all (shared evenly by the labels), and landmarks among them.
SAMPLE = 1200
LANDMARKS = 160
RIDGE = 1e-3
#: Texts per matrix product, and characters of one text that are hashed at a time.
BATCH = 128
SPAN = 1 << 20
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> itself if it is a letter or combining mark of a word, else a blank."""
    if not _LETTERS:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            if chr(i).isalpha():
                table[i] = i
        _LETTERS.append(table)
    return _LETTERS[0]


def presence(text: str, flags: np.ndarray) -> bool:
    """Set in `flags` (WIDTH booleans) the buckets of the text's n-grams. False if it has no letter."""
    table, any_letter, tail = _letters(), False, np.full(1, 32, np.uint32)
    lower = text.lower()
    for at in range(0, max(len(lower), 1), SPAN):
        points = table[np.frombuffer(lower[at:at + SPAN].encode("utf-32-le", "surrogatepass"), np.uint32)]
        any_letter = any_letter or bool((points != 32).any())
        points = np.concatenate([tail, points, np.full(1 if at + SPAN >= len(lower) else 0, 32, np.uint32)])
        tail = points[-2:]
        gram = np.zeros(len(points), np.uint32)
        for k, n in enumerate(ORDERS):
            size = len(points) - n + 1
            if size <= 0:
                break
            gram = gram[:size] * np.uint32(0x9E3779B1) + points[n - 1:n - 1 + size]
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA77)
            flags[(mixed >> np.uint32(32 - BITS)).astype(np.int64) + (k << BITS)] = True
    return any_letter


@dataclass
class Model:
    """labels; landmarks as a packed presence matrix, its used columns and row sizes; weights per landmark and label."""
    labels: list[str]
    packed: np.ndarray
    columns: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def matrix(self) -> np.ndarray:
        rows = np.unpackbits(self.packed, axis=1, count=WIDTH)[:, self.columns]
        return np.ascontiguousarray(rows.T.astype(np.float32))


def _kernel(rows: np.ndarray, sizes: np.ndarray, landmarks: np.ndarray, landmark_sizes: np.ndarray) -> np.ndarray:
    shared = rows.astype(np.float32) @ landmarks
    return shared / np.sqrt(np.maximum(sizes, 1)[:, None] * landmark_sizes[None, :]).astype(np.float32)


def fit_kernel(packed: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from packed presence rows and their labels; every (n / landmarks)-th row is a landmark."""
    names = sorted(set(labels))
    order = sorted(range(len(labels)), key=lambda i: (i % max(1, len(labels) // max(1, landmarks)), i))[:landmarks]
    chosen = np.array(sorted(order))
    columns = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(packed[chosen], axis=0), count=WIDTH))
    sizes = np.bitwise_count(packed).sum(1, dtype=np.int64)
    model = Model(names, packed[chosen], columns, sizes[chosen], np.zeros(0))
    marks = model.matrix()
    blocks = [_kernel(np.unpackbits(packed[i:i + BATCH], axis=1, count=WIDTH)[:, columns], sizes[i:i + BATCH], marks, model.sizes) for i in range(0, len(packed), BATCH)]
    k = np.concatenate(blocks).astype(np.float64)
    targets = (np.array(labels)[:, None] == np.array(names)[None, :]).astype(np.float64)
    model.weights = np.linalg.solve(k.T @ k + ridge * len(k) * (k[chosen] + 1e-6 * np.eye(len(chosen))), k.T @ targets).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5. Rows without id are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """Model from text and lang of the rows that are not held out; None where there are no such rows.

    The sample is taken per label by lowest hash of the id, `sample` texts in all, found by one aggregation and a ranking
    of the few rows below a rough cutoff. The driver receives a fixed number of bytes per sampled text.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("text", "lang", F.xxhash64("doc_id").alias("draw"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a label set
    if not counts:
        return None
    quota = max(1, sample // len(counts))
    span = 2.0 ** 64
    cut = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 4.0 * quota / n + 64.0 / n))])
    rough = rows.select("lang", "draw").filter((F.col("draw").cast("double") + span / 2) / span <= cut[F.col("lang")])
    ranked = rough.distinct().withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("draw")))
    last = {r[0]: r[1] for r in ranked.filter(F.col("n") <= quota).groupBy("lang").agg(F.max("draw")).collect()}
    if not last:
        return None
    most = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])

    @F.arrow_udf(BinaryType())
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts:
                flags = np.zeros(WIDTH, bool)
                out.append(np.packbits(flags).tobytes() if presence(text.as_py(), flags) else None)
            yield pa.array(out, pa.binary())

    found = rows.filter(F.col("draw") <= most[F.col("lang")]).select("lang", "draw", packed("text").alias("row")).filter("row IS NOT NULL")
    found = found.groupBy("lang", "draw").agg(F.min("row").alias("row"))  # rows that repeat an id count once
    got = sorted(found.collect(), key=lambda r: (r["draw"], r["lang"], r["row"]))
    if not got:
        return None
    return fit_kernel(np.stack([np.frombuffer(r["row"], np.uint8) for r in got]), [r["lang"] for r in got], landmarks)


def predictor(model: Model | None):
    """Arrow UDF: text -> (lang_pred, score)."""
    @F.arrow_udf(StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        marks = model.matrix() if model else None
        for texts in batches:
            names, scores = [], []
            for at in range(0, len(texts), BATCH):
                part = texts.slice(at, BATCH)
                rows = np.zeros((len(part), len(model.columns) if model else 0), np.uint8)
                sizes, known = np.zeros(len(part)), np.zeros(len(part), bool)
                flags = np.zeros(WIDTH, bool)
                for i, text in enumerate(part):
                    if text.is_valid and model:
                        flags[:] = False
                        known[i] = presence(text.as_py(), flags)
                        rows[i], sizes[i] = flags[model.columns], np.count_nonzero(flags)
                if model:
                    values = np.clip(_kernel(rows, sizes, marks, model.sizes) @ model.weights, 0, 1)
                    best = values.argmax(1)
                    share = values[np.arange(len(part)), best] / np.maximum(values.sum(1), 1e-9)
                    names += [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, known)]
                    scores += [float(s) if ok else 0.0 for s, ok in zip(share, known)]
                else:
                    names += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])
    return predict


def identify(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of `docs`, learned from its own rows that are not held out.

    Null texts and texts without a letter are `und` with score 0; so is every text where nothing could be learned. Whole
    texts are scored. Repeated rows give repeated rows; no column but text plays a part in a prediction.
    """
    predict = predictor(learn(docs, sample, landmarks))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text").cast("string")).alias("_p"))
    return rows.select("doc_id", "held_out", "_p.lang_pred", "_p.score")
