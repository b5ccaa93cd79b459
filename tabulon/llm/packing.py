"""Packing documents into sequences of fixed length by bin completion.

Only lengths matter for packing, and there are fewer than `capacity` of them, so the problem that is solved on the driver
is a histogram whose size does not depend on the data. The search takes the largest length left, lists the fillings of
the rest of its sequence that no other filling dominates, and applies the best one to as many sequences as the histogram
has. The first descent always ends; after it the search backtracks within a node budget, cut off where the sequences used and the waste bound of what is left cannot beat
the best packing known; the first known one is best-fit decreasing. The result is a list of patterns with the number of
times each is used: at most one pattern per exhausted length. Spark then gives every piece its rank among the pieces of
its length, and looks up the place of that rank.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabulon.llm.common import chunks, stored, strings, text_of

CAPACITY = 4096
END_ID = 1
#: Fillings tried per sequence, and patterns placed by the search after its first descent.
WIDTH = 6
NODES = 4000
#: Words whose ids a worker keeps, and bytes of text that are encoded together.
CACHE_WORDS = 1_000_000
TEXT_BYTES = 4 << 20

Pattern = tuple[int, ...]


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, by the package that has them."""
    import public_tokenizers
    return public_tokenizers.path(name)


# ---- packing a histogram of lengths

def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: sequences that are alike are handled together."""
    groups: dict[int, list[tuple[Pattern, int]]] = {capacity: []}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for room in sorted(r for r in groups if r >= length):
            for pattern, times in groups.pop(room, []):
                fit = room // length
                full = min(times, left // fit)
                rest = min(left - full * fit, fit) if full < times else 0
                for used, n in ((fit, full), (rest, 1 if rest else 0)):
                    if n:
                        groups.setdefault(room - used * length, []).append((pattern + (length,) * used, n))
                left -= full * fit + rest
                if times - full - bool(rest):
                    groups.setdefault(room, []).append((pattern, times - full - bool(rest)))
            if not left:
                break
        if left:
            fit = capacity // length
            for used, n in ((fit, left // fit), (left % fit, 1)):
                if used and n:
                    groups.setdefault(capacity - used * length, []).append(((length,) * used, n))
    return [x for g in groups.values() for x in g]


def _fullest(gap: int, counts: np.ndarray) -> Pattern:
    """The filling with the largest sum up to `gap`: subset sums as bit sets, then traced back from long to short."""
    mask, reach, steps = (1 << (gap + 1)) - 1, 1, []
    for length in np.flatnonzero(counts[:gap + 1]).tolist():
        n = min(int(counts[length]), gap // length)
        part = 1
        while n > 0:  # binary splitting of the count
            use = min(part, n)
            steps.append((length, use, reach))
            reach |= reach << (length * use) & mask
            n -= use
            part *= 2
    total, out = reach.bit_length() - 1, []
    for length, use, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * use
            total -= length * use
    return tuple(sorted(out, reverse=True))


def fillings(gap: int, counts: np.ndarray, width: int = WIDTH) -> list[Pattern]:
    """Undominated fillings of `gap`, best first. One item of exactly the gap dominates all others; of fillings without
    waste those with the longest items come first; where none of up to three items exists, the fullest of any size."""
    if gap <= 0 or not counts[1:gap + 1].any():
        return [()]
    if counts[gap]:
        return [(gap,)]
    have = np.flatnonzero(counts[:gap + 1])

    def pairs(rest: int, most: int, used: int = 0) -> list[Pattern]:
        a = have[(have <= min(most, rest - 1)) & (2 * have >= rest)][::-1]
        b = rest - a
        need = (a == b).astype(int) + 1
        ok = (counts[a] - (a == used) >= need) & (counts[b] - (b == used) >= 1)
        return [(int(x), int(rest - x)) for x in a[ok][:width]]

    out = pairs(gap, gap)
    if not out:
        for a in have[3 * have >= gap][::-1].tolist():
            out += [(a, *p) for p in pairs(gap - a, a, a)]
            if len(out) >= width:
                break
    if out:
        return out[:width]
    best = _fullest(gap, counts)
    longest = int(have[-1])
    left = counts.copy()
    left[longest] -= 1
    other = (longest, *_fullest(gap - longest, left))
    return [best] if sum(other) < sum(best) - 64 or Counter(other) == Counter(best) else [best, other]


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Pattern list that packs counts[length] items of each length into as few sequences as the search finds."""
    counts = counts.astype(np.int64).copy()
    sizes = np.arange(len(counts))
    best = best_fit_decreasing(counts, capacity)
    best_bins = sum(n for _, n in best)
    bound = -(-int((counts * sizes).sum()) // capacity)
    stack: list[tuple[Pattern, int, list[Pattern]]] = []  # chosen pattern, times, alternatives left
    used, left = 0, int((counts * sizes).sum())
    descended = False  # the first descent is free: its placements are a small multiple of the number of lengths

    def options() -> list[Pattern]:
        first = int(np.flatnonzero(counts)[-1])
        counts[first] -= 1
        found = [(first, *f) for f in fillings(capacity - first, counts)]
        counts[first] += 1
        return found[::-1]

    def place(alternatives: list[Pattern]) -> None:
        nonlocal used, left
        pattern = alternatives.pop()
        need = Counter(pattern)
        times = min(int(counts[x]) // k for x, k in need.items())
        for x, k in need.items():
            counts[x] -= k * times
        used, left = used + times, left - sum(pattern) * times
        stack.append((pattern, times, alternatives))

    while best_bins > bound and nodes > 0:
        if left and used + -(-left // capacity) < best_bins:
            nodes -= descended
            place(options())
            continue
        descended = True
        if not left and used < best_bins:
            best, best_bins = [(p, n) for p, n, _ in stack], used
        while stack:  # back to the last sequence that has another filling
            pattern, times, alternatives = stack.pop()
            for x, k in Counter(pattern).items():
                counts[x] += k * times
            used, left = used - times, left + sum(pattern) * times
            if alternatives:
                nodes -= 1
                place(alternatives)
                break
        else:
            break
    return best


def slots(patterns: list[tuple[Pattern, int]], first_sequence: int = 0) -> dict[str, np.ndarray]:
    """Where the k-th item of a length goes: runs of ranks per (length, pattern), sorted by (length, first rank)."""
    rows, taken, sequence = [], Counter(), first_sequence
    for pattern, times in patterns:
        offset = 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            rows.append((length, taken[length], each, sequence, offset))
            taken[length] += each * times
            offset += length * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {k: table[:, i] for i, k in enumerate(("length", "rank", "each", "sequence", "offset"))}


# ---- ids and pieces

#: A word that ends in a letter and marks after it. The tokenizer splits there whatever comes before.
_TAIL = r"^(?P<core>.*\p{L})(?P<tail>[.,!?;:]+)$"


class _Ids:
    """Token ids of words, kept per worker. The tokenizer's splits never span ASCII blanks, so the ids of a text are those
    of its blank-separated words in turn; and it lower-cases, so words are looked up with A-Z lower-cased, unless they may
    hold a special token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.known: dict[str, int] = {}
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.filled, self.used = np.zeros(4096, np.uint32), 0, 0

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> int:
        """Append lists of ids; the slot of the first."""
        base, n, total = self.used, len(lengths), len(ids)
        while base + n > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.filled + total > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.filled:self.filled + total] = ids
        self.start[base:base + n] = self.filled + np.cumsum(lengths) - lengths
        self.length[base:base + n] = lengths
        self.filled, self.used = self.filled + total, base + n
        return base

    def _gather(self, slots: np.ndarray) -> np.ndarray:
        lengths = self.length[slots]
        ends = np.cumsum(lengths)
        return self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[slots] - (ends - lengths), lengths)]

    def slots(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.slot]
        if new:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            lengths = np.array([len(x) for x in lists], np.int64)
            base = self._add(lengths, np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())))
            self.slot.update(zip(new, range(base, base + len(new))))
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))

    def whole(self, distinct: pa.Array) -> np.ndarray:
        """Slots of distinct blank-separated words. One that is new is lower-cased and cut before the marks at its end."""
        words = strings(distinct)
        found = list(map(self.known.get, words))
        new = [w for w, k in zip(words, found) if k is None] if None in found else []
        if new:
            lower = pa.array(new, distinct.type)
            lower = pc.if_else(pc.match_substring(lower, "<|"), lower, pc.ascii_lower(lower))
            parts = pc.extract_regex(lower, _TAIL)
            matched = parts.is_valid()
            core = pc.if_else(matched, parts.field(0), lower).dictionary_encode()
            tail = pc.if_else(matched, parts.field(1), "").dictionary_encode()
            halves = np.stack([self.slots(strings(x.dictionary))[np.asarray(x.indices, np.int64)] for x in (core, tail)], 1)
            base = self._add(self.length[halves].sum(1), self._gather(halves.ravel()))
            self.known.update(zip(new, range(base, base + len(new))))
            found = list(map(self.known.__getitem__, words))
        return np.array(found, np.int64)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words, owner = split.flatten(), pc.list_parent_indices(split)
        real = pc.not_equal(words, "")
        words, owner = words.filter(real), np.asarray(owner.filter(real), np.int64)
        if len(self.known) > CACHE_WORDS:
            self.clear()
        coded = words.dictionary_encode()
        mine = self.whole(coded.dictionary)[np.asarray(coded.indices, np.int64)]
        return self._gather(mine), np.bincount(owner, weights=self.length[mine], minlength=len(texts)).astype(np.int64)


_WORKER: dict[str, _Ids] = {}


def piece_rows(texts: pa.Array, ids: _Ids, capacity: int, end_id: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, piece, start, length, crc32 of the ids) of every piece of every text."""
    for a, b in chunks(texts, TEXT_BYTES):
        flat, sizes = ids.of(texts.slice(a, b - a))
        begin = np.cumsum(sizes) - sizes
        for row, (start, n) in enumerate(zip(begin.tolist(), sizes.tolist())):
            whole = np.append(flat[start:start + n], np.uint32(end_id)).astype("<u4")
            for piece, at in enumerate(range(0, n + 1, capacity)):
                part = whole[at:at + capacity]
                yield a + row, piece, at, len(part), zlib.crc32(part.tobytes())


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with the number `nth` among the pieces of its length in its task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _WORKER:
            _WORKER[tokenizer] = _Ids(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = np.array(list(piece_rows(batch.column(1), _WORKER[tokenizer], capacity, end_id)), np.int64).reshape(-1, 5)
            lengths = rows[:, 3]
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            nth = np.empty(len(rows), np.int64)
            nth[order] = np.arange(len(rows)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(lengths, minlength=capacity + 1)
            columns = [batch.column(0).take(pa.array(rows[:, 0])), *(pa.array(rows[:, i]) for i in range(1, 5)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays([columns[0], columns[1].cast(pa.int32()), *columns[2:]], names=["doc_id", "piece", "start", "length", "ids_crc32", "nth"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, nth long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, nodes: int = NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of every row of `docs`.

    A document is its ids and `end_id`; null and empty texts are `end_id` alone. Only documents of more than `capacity`
    ids are cut. Repeated rows and null doc_ids are packed like any other row. Other columns are not looked at.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end_id).withColumn("part", F.spark_partition_id()), "pieces")
    sums = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in sums.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    full, counts[capacity] = int(counts[capacity]), 0
    plan = complete_bins(counts, capacity, nodes)
    table = slots(([((capacity,), full)] if full else []) + plan)
    key = table["length"] << 44 | table["rank"]

    @F.arrow_udf(StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())]))
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = length.to_numpy(zero_copy_only=False).astype(np.int64), rank.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(key, length << 44 | rank, "right") - 1
        nth = rank - table["rank"][at]
        each = table["each"][at]
        return pa.StructArray.from_arrays([pa.array(table["sequence"][at] + nth // each), pa.array(table["offset"][at] + nth % each * length)], names=["sequence_id", "offset"])

    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")  # a row per task
    shifts = sums.select(F.col("part").alias("_part"), F.col("length").alias("_length"), before.alias("_before"))
    ranked = cut.join(shifts, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
    placed = ranked.withColumn("_at", place("length", F.col("nth") + F.col("_before")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")
