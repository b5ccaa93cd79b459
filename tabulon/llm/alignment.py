"""Alignment of the tokens of two tokenizers by the byte offsets at which they end.

1. Each text is encoded by both tokenizers; token lengths in bytes turn into end offsets, increasing over a whole chunk of
   documents.
2. The two lists of ends are merged by merge paths: binary searches on equally spaced diagonals of the (A, B) grid cut the
   merge into independent pieces of equal work. A piece emits the ends that both lists have. Between two such ends lies a
   group; groups that run over a border of pieces are stitched, since a group goes from the last common end of the pieces
   before to the next one.
3. The tokens that end together are links. A chunk sends each of its distinct (A, B) pairs once, with its count, to be
   summed over the corpus; the sums come back to the chunk, where each document looks its links up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import chunks, stored, text_of, utf8

#: Bytes of text whose distinct pairs are counted together, and list elements merged in one piece.
CHUNK_BYTES = 8 << 20
WORK = 1 << 16


def _byte_of_mark() -> dict[str, int]:
    """Bytes by the printable characters that stand for them in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers in a worker: ids of texts, and the bytes of every id."""

    def __init__(self, byte_level: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(byte_level, encoding="utf-8") as f:
            content = json.load(f)
        mark = _byte_of_mark()
        special = {t["content"] for t in content["added_tokens"]}
        vocabulary = {token: bytes(mark[c] for c in token) for token in content["model"]["vocab"] if token not in special}
        self.a_bytes = [b""] * (1 + max(max(content["model"]["vocab"].values()), *(t["id"] for t in content["added_tokens"])))
        for token, i in content["model"]["vocab"].items():
            self.a_bytes[i] = vocabulary.get(token, b"")
        # Ids of this vocabulary are in the order of its merges, so they are the ranks that the library asks for.
        self.a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                   mergeable_ranks={raw: content["model"]["vocab"][token] for token, raw in vocabulary.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        size = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(size))]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        bars = [[f"{i}{end}" for i in range(n)] for n, ends in ((len(self.a_bytes), ",|"), (size, ",;")) for end in ends]
        self.words = list(chain.from_iterable(bars))
        self.word_at = np.cumsum([0, *map(len, bars)])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text, empty where one of the tokenizers does not give the text back."""
        if not texts:
            return [], []
        spaced = [" " + t for t in texts]
        a = [self.a.encode_ordinary(s) for s in spaced]
        b = self.b.encode(texts, num_threads=1)
        for i, s in enumerate(spaced):
            raw = s.encode()
            if len(s) == 1 or b"".join(map(self.a_bytes.__getitem__, a[i])) != raw or b"".join(map(self.b_bytes.__getitem__, b[i])) != raw:
                a[i], b[i] = [], []
        return a, b


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where merge pieces of `work` elements begin in two increasing lists: binary searches on all diagonals at once. An end
    that both lists have is left to one piece."""
    diagonal = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        before = np.zeros(len(diagonal), bool)
        before[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    i, j = low, diagonal - low
    split = (i > 0) & (j < len(b))
    split[split] = a[i[split] - 1] == b[j[split]]
    return i, j + split


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Indices in both increasing lists of the values that both have, piece by piece."""
    i, j = merge_path(a, b, work)
    found = []
    for p in range(len(i) - 1):
        _, x, y = np.intersect1d(a[i[p]:i[p + 1]], b[j[p]:j[p + 1]], assume_unique=True, return_indices=True)
        found.append((x + i[p], y + j[p]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def align_texts(pair: Pair, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of each text in words, its numbers of A tokens, B tokens and groups, and the pair codes of all links."""
    lists = pair.encode(texts)
    (a, n_a), (b, n_b) = map(_flat, lists)
    x, y = common_ends(np.cumsum(pair.a_length[a]), np.cumsum(pair.b_length[b]))
    links = a[x] * len(pair.b_bytes) + b[y]
    # place of each token in the words: A tokens of a group stand before its B tokens
    group_a = np.repeat(np.arange(len(x)), np.diff(x, prepend=-1))
    group_b = np.repeat(np.arange(len(y)), np.diff(y, prepend=-1))
    code = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[x], last_b[y] = True, True
    code[np.arange(len(a)) + np.concatenate([[0], y + 1])[group_a]] = a + np.where(last_a, pair.word_at[1], pair.word_at[0])
    code[np.arange(len(b)) + x[group_b] + 1] = b + np.where(last_b, pair.word_at[3], pair.word_at[2])
    ends = np.cumsum(n_a + n_b)
    words = code.tolist()
    groups = ["".join(map(pair.words.__getitem__, words[s:e]))[:-1] for s, e in zip((ends - n_a - n_b).tolist(), ends.tolist())]
    n_groups = np.diff(np.searchsorted(x, np.concatenate([[0], np.cumsum(n_a)])))
    return groups, n_a, n_b, n_groups, links


_PAIRS: dict[tuple[str, str], Pair] = {}
_ROW = ("doc_id long, chunk long, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, links binary, pairs array<long>, counts array<long>")
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, groups_sha256 string"


def _encoder(byte_level: str, pieces: str, keep_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = byte_level, pieces
        if key not in _PAIRS:
            _PAIRS[key] = Pair(*key)
        pair, number = _PAIRS[key], 0
        for batch in batches:
            for a, b in chunks(batch.column(1), CHUNK_BYTES):
                part = batch.slice(a, b - a)
                done = [align_texts(pair, part.column(1).slice(s, e - s).to_pylist()) for s, e in chunks(part.column(1))]
                groups = list(chain.from_iterable(d[0] for d in done))
                n_a, n_b, n_groups, links = (np.concatenate([d[i] for d in done]) for i in range(1, 5))
                pairs, code, counts = np.unique(links, return_inverse=True, return_counts=True)
                raw = code.astype("<i4").tobytes()
                ends = 4 * np.cumsum(n_groups)
                rows = b - a
                one_list = lambda v: pa.ListArray.from_arrays(pa.array(np.r_[0, np.full(rows, len(v))], pa.int32()), pa.array(v, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pc.add(pc.multiply(part.column(2).cast(pa.int64()), 1 << 32), number), *(pa.array(v, pa.int64()) for v in (n_a, n_b, n_groups)),
                    pa.array(groups if keep_groups else [None] * rows, pa.string()), pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                    pa.array([raw[s:e] for s, e in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())], pa.binary()), one_list(pairs), one_list(counts)], names=_NAMES)
                number += 1
    return run


def _looked_up(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Documents of a chunk and (code, total, best) of its pairs -> documents with sums over their links."""
    code = np.asarray(found.column("code"), np.int64)
    total, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    total[code], best[code] = np.asarray(found.column("total"), np.int64), np.asarray(found.column("best")).astype(np.int64)
    links = docs.column("links").combine_chunks()
    data, offsets = utf8(links.cast(pa.large_binary()).view(pa.large_string()))
    each = data.view("<i4").astype(np.int64)
    sums = [np.concatenate([[0], np.cumsum(v[each])]) for v in (best, total)]
    n_best, count_sum = (s[offsets[1:] // 4] - s[offsets[:-1] // 4] for s in sums)
    return pa.table({
        **{c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")}, "n_links": pa.array(np.diff(offsets) // 4, pa.int64()),
        "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()), "groups": docs.column("groups"), "groups_sha256": docs.column("groups_sha256")})


def align(docs: DataFrame, byte_level: str, pieces: str, keep_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (null unless asked for), groups_sha256.

    Texts that are null or empty, or that one of the tokenizers does not give back byte by byte, have no tokens: zeros and an
    empty groups_sha256. Repeated rows and null doc_ids are documents like any other, and count. Other columns are not
    looked at. A text is handled whole in one task, in merge pieces of WORK tokens.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"), F.spark_partition_id().alias("part"))
    made = stored(rows.mapInArrow(_encoder(byte_level, pieces, keep_groups), _ROW), "aligned")
    told = made.filter(F.size("pairs") > 0).select(F.col("chunk").alias("at"), F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "p"))
    told = told.select("at", "code", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    size = _vocabulary(pieces)
    counts = stored(told.groupBy("pair").agg(F.sum("n").alias("total")), "pairs").withColumn("b", F.col("pair") % size)
    most = counts.groupBy(F.col("b").alias("_b")).agg(F.max("total").alias("most"))
    judged = counts.join(most, F.col("b") == F.col("_b")).select(F.col("pair").alias("_pair"), "total", (F.col("total") == F.col("most")).alias("best"))
    found = told.join(judged, F.col("pair") == F.col("_pair")).select("at", "code", "total", "best")
    kept = made.drop("pairs", "counts")
    return kept.groupBy("chunk").cogroup(found.groupBy("at")).applyInArrow(_looked_up, _OUT)


def _vocabulary(pieces: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()


def digest(aligned: DataFrame) -> DataFrame:
    return aligned.drop("groups")
