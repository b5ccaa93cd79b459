"""Removal of repeated passages of words by recompression.

A word goes when a window of WINDOW words covers it whose words also start earlier: in a document with a smaller doc_id, or
further ahead in its own.

1. Equal texts are one class, that of the smallest doc_id. The others are removed whole (if they have a window).
2. Recompression: rounds that name first the runs of a symbol and then the pairs (left, right) of neighbouring symbols, left
   and right being told by a bit of the name. A name is a hash of what it stands for, so all tasks give equal runs and pairs
   equal names without asking each other. Whatever a symbol's forming depended on, its neighbours in all rounds before, is
   its support; a stretch of words forms the same symbols wherever it stands, as long as their supports lie inside it.
3. A window's anchor is a symbol of the highest round that has one with its support inside the window (the one with the
   least hash; a single word at worst). Equal windows have equal anchors at equal places. Neighbouring windows mostly share
   theirs. Spark counts the anchors, named by the words of their support, over the corpus: only windows whose anchor stands
   in two places need a look.
4. Those windows are named by two 64-bit hashes of their words' 128-bit hashes and meet in a shuffle: all but the first of
   each name are repeats. Of equal windows that a task sees only the first is sent, what the others cover is known.
5. Covered ranges are gathered per document and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabulon.llm.common import chunks, drop, run_starts, stored, strings, text_of, whole_runs

WINDOW = 20
#: Rounds of naming: runs, then pairs. With more of them supports fill the window, neighbouring windows share fewer anchors
#: and more rows are sent (on whole texts 2.4 windows an anchor after 8 rounds, 3.9 after 3); with fewer, anchors say less.
ROUNDS = 3
_FACTOR = np.uint64(0x9FB21C651E98DF25)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Words:
    """Words of several texts end to end: two 64-bit hashes of each, and the bounds of each text."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(texts)
        words, owner = split.flatten(), pc.list_parent_indices(split)
        real = pc.not_equal(words, "")
        coded = words.filter(real).dictionary_encode()
        owner = np.asarray(owner.filter(real), np.int64)
        raw = b"".join(xxhash.xxh3_128_digest(w) for w in strings(coded.dictionary.cast(pa.large_binary())))
        names = np.frombuffer(raw, np.uint64).reshape(-1, 2)[np.asarray(coded.indices, np.int64)]
        self.h1, self.h2 = np.ascontiguousarray(names[:, 0]), np.ascontiguousarray(names[:, 1])
        self.bounds = np.searchsorted(owner, np.arange(len(texts) + 1))

    def window_starts(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, first word) of each window."""
        counts = np.maximum(np.diff(self.bounds) - window + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        return text, np.arange(len(text)) + np.repeat(self.bounds[:-1] - (np.cumsum(counts) - counts), counts)


def _powers(h: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, ... words from each position on, as far as `longest`."""
    out, size = [_mix(h)], 1
    while 2 * size <= longest:
        h = out[-1]
        out.append(_mix(h[:-size] * _FACTOR + h[size:]) if len(h) > size else h[:0])
        size *= 2
    return out


def _stretch_hash(powers: list[np.ndarray], start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of stretches of up to twice the longest power: of the powers at both of their ends."""
    out = np.zeros(len(start), np.uint64)
    level = np.frexp(length.astype(float))[1] - 1
    for k in np.unique(level):
        of = level == k
        a, n = start[of], length[of]
        out[of] = _mix(powers[k][a] * _FACTOR + powers[k][a + n - (1 << int(k))] + n.astype(np.uint64))
    return out


class Symbols:
    """One round's symbols of several texts: names, and the words [left, right) that their forming depends on. Where it
    depends on an end of the text, the support reaches one word beyond it, so that no window holds it."""

    def __init__(self, name: np.ndarray, left: np.ndarray, right: np.ndarray, text: np.ndarray, bounds: np.ndarray):
        self.name, self.left, self.right, self.text, self.bounds = name, left, right, text, bounds

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Left support of the symbol before each, right support of the one behind it."""
        first, last = np.ones(len(self.name), bool), np.ones(len(self.name), bool)
        first[1:] = self.text[1:] != self.text[:-1]
        last[:-1] = first[1:]
        before, behind = np.roll(self.left, 1), np.roll(self.right, -1)
        return np.where(first, self.bounds[self.text] - 1, before), np.where(last, self.bounds[self.text + 1] + 1, behind)

    def runs(self) -> Symbols:
        starts = run_starts(self.name, self.text)
        ends = np.append(starts[1:], len(self.name)) - 1
        before, behind = self._neighbours()
        times = (ends - starts + 1).astype(np.uint64)
        name = np.where(times > 1, _mix(self.name[starts] * _FACTOR + times), self.name[starts])
        return Symbols(name, before[starts], behind[ends], self.text[starts], self.bounds)

    def pairs(self, round_: int) -> Symbols:
        opens = _mix(self.name + np.uint64(round_ + 1)) >> np.uint64(63) == 1
        joined = np.zeros(len(opens), bool)
        joined[:-1] = opens[:-1] & ~opens[1:] & (self.text[1:] == self.text[:-1])
        second = np.zeros(len(opens), bool)
        second[1:] = joined[:-1]
        before, behind = self._neighbours()
        after = np.roll(self.name, -1)
        name = np.where(joined, _mix(self.name * _FACTOR + after), self.name)
        # a lone symbol knows by the neighbour it could have joined that it is alone
        left = np.where(~opens, before, self.left)
        right = np.where(opens, behind, self.right)
        stay = ~second
        return Symbols(name[stay], left[stay], right[stay], self.text[stay], self.bounds)


def _least(priority: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Index of the first least priority in each non-empty range [start, stop)."""
    tables, size = [np.arange(len(priority))], 1
    longest = int((stop - start).max(initial=1))
    while 2 * size <= longest:
        t = tables[-1]
        a, b = t[:-size], t[size:]
        tables.append(np.where(priority[a] <= priority[b], a, b))
        size *= 2
    level = np.frexp((stop - start).astype(float))[1] - 1
    out = np.zeros(len(start), np.int64)
    for k in np.unique(level):
        of = level == k
        a, b = tables[k][start[of]], tables[k][stop[of] - (1 << int(k))]
        out[of] = np.where(priority[a] <= priority[b], a, b)
    return out


def anchors(words: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, text, first, last window) of each run of windows of one text with the same anchor in the same place."""
    text, at = words.window_starts(window)
    powers = _powers(words.h1, window)
    owner = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    place = np.arange(len(owner))
    symbols = Symbols(words.h1, place, place + 1, owner, words.bounds)
    rounds = [symbols]
    while len(rounds) <= ROUNDS and len(symbols.name) and (symbols.right - symbols.left <= window).any():
        symbols = symbols.runs().pairs(len(rounds))
        rounds.append(symbols)
    left, right = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    for symbols in reversed(rounds):  # supports begin and end in the order of their symbols
        start, stop = np.searchsorted(symbols.left, at[open_], "left"), np.searchsorted(symbols.right, at[open_] + window, "right")
        has = start < stop
        chosen = _least(_mix(symbols.name), start[has], stop[has])
        left[open_[has]], right[open_[has]] = symbols.left[chosen], symbols.right[chosen]
        open_ = open_[~has]
        if not len(open_):
            break
    starts = run_starts(text, left, right)
    ends = np.append(starts[1:], len(at)) - 1
    key = _stretch_hash(powers, left[starts], right[starts] - left[starts]).view(np.int64)
    return key, text[starts], at[starts], at[ends] if len(starts) else starts


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, text) -> (anchor, tid, many, known), distinct. An anchor that stands in several places of a batch is known to
    be shared: one row of it (many) takes part in the count for other tasks to see, the others are marked."""
    for batch in batches:
        tids, parts = batch.column(0).to_numpy(), []
        for a, b in chunks(batch.column(1)):
            key, text, _, _ = anchors(Words(batch.column(1).slice(a, b - a)))
            parts.append((key, tids[text + a], text + a))
        key, tid, row = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((row, tid, key))
        key, tid, row = key[order], tid[order], row[order]
        starts = run_starts(key)
        sizes = np.diff(np.append(starts, len(key)))
        twice = np.zeros(len(key), bool)  # a second text, or a second place in one text: rows of equal texts are one
        twice[1:] = (key[1:] == key[:-1]) & ((tid[1:] != tid[:-1]) | (row[1:] == row[:-1]))
        many = np.repeat(np.logical_or.reduceat(twice, starts), sizes) if len(starts) else twice
        first = np.zeros(len(key), bool)
        first[starts] = True
        distinct = run_starts(key, tid)
        yield pa.RecordBatch.from_arrays([pa.array(key[distinct]), pa.array(tid[distinct]), pa.array(many[distinct]), pa.array((many & ~first)[distinct])], names=["anchor", "tid", "many", "known"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, tid, many, known) by anchor -> (anchor, tid) of the anchors in two places or more."""
    for anchor, tid, many, _ in whole_runs(batches, 1):
        starts = run_starts(anchor)
        out = (np.minimum.reduceat(tid, starts) != np.maximum.reduceat(tid, starts)) | np.logical_or.reduceat(many, starts)
        out = np.repeat(out, np.diff(np.append(starts, len(anchor))))
        yield pa.RecordBatch.from_arrays([pa.array(anchor[out]), pa.array(tid[out])], names=["anchor", "tid"])


def _ranges(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted rows (..., start) -> (..., start, count) of neighbouring starts."""
    *keys, at = columns
    starts = run_starts(*keys, at - np.arange(len(at)))
    return *(k[starts] for k in keys), at[starts], np.diff(np.append(starts, len(at)))


_FOUND = "h1 long, h2 long, doc_id long, tid long, start long, count long"
_NAMES = ["h1", "h2", "doc_id", "tid", "start", "count"]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tid, text, wanted anchors) -> (h1, h2, doc_id, tid, start, 1) of the windows with such an anchor that a batch
    has first, and ranges (null, null, doc_id, tid, start, count) of the others, which are known to be repeats."""
    for batch in batches:
        docs, tids, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
        for a, b in chunks(batch.column(2)):
            words = Words(batch.column(2).slice(a, b - a))
            key, text, first, last = anchors(words)
            wanted = batch.column(3).slice(a, b - a)
            owner = np.repeat(np.arange(b - a), np.asarray(wanted.value_lengths()))
            tag = lambda v, t: _mix(v.view(np.uint64) * np.uint64(3) + _mix(t.astype(np.uint64) + np.uint64(9)))
            pick = np.isin(tag(key, text), tag(np.ascontiguousarray(wanted.flatten().to_numpy()), owner))
            text, first, counts = text[pick], first[pick], (last - first + 1)[pick]
            at = np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)
            text = np.repeat(text, counts)
            names = []
            for h in (words.h1, words.h2):
                p = _powers(h, WINDOW)
                names.append(_stretch_hash(p, at, np.full(len(at), WINDOW)).view(np.int64))
            parts.append((*names, docs[text + a], tids[text + a], at - words.bounds[text]))
        if not parts:
            continue
        h1, h2, doc, tid, at = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order = np.lexsort((at, tid, doc, h2, h1))
        order = order[run_starts(*(x[order] for x in (h1, h2, doc, tid, at)))]  # equal rows are one
        first = np.zeros(len(order), bool)
        first[run_starts(h1[order], h2[order])] = True
        sent, rest = order[first], order[~first]
        rest = rest[np.lexsort((at[rest], tid[rest], doc[rest]))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1[sent], h2[sent], doc[sent], tid[sent], at[sent], np.ones(len(sent), np.int64))], names=_NAMES)
        known = _ranges(doc[rest], tid[rest], at[rest])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(known[0]), pa.int64())] * 2 + [pa.array(x, pa.int64()) for x in known], names=_NAMES)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc_id, tid, start) in this order -> (doc_id, tid, start, 1) of all but the first of each name."""
    head = None  # the first row of the run that is open
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns]
        starts = run_starts(*columns[:2])
        sizes = np.diff(np.append(starts, batch.num_rows))
        heads = [c[starts] for c in columns]
        if head is not None and (heads[0][0], heads[1][0]) == head[:2]:
            for c, v in zip(heads, head):
                c[0] = v
        hit = np.zeros(batch.num_rows, bool)
        for c, h in zip(columns[2:], heads[2:]):
            hit |= c != np.repeat(h, sizes)
        head = tuple(h[-1] for h in heads)
        yield pa.RecordBatch.from_arrays([pa.array(c[hit]) for c in columns[2:]] + [pa.array(np.ones(hit.sum(), np.int64))], names=_NAMES[2:])


def covered_ranges(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc_id, tid, start, count): from word `start` on, `count` neighbouring windows also start earlier. `docs` has doc_id,
    text, tid (hash of the text); `firsts` the smallest doc_id (first_id) of each tid."""
    told = docs.select("tid", "text").mapInArrow(_anchor_rows, "anchor long, tid long, many boolean, known boolean")
    dealt = told.repartition(F.when(F.col("known"), F.xxhash64("anchor", "tid")).otherwise(F.col("anchor"))).sortWithinPartitions("anchor")
    shared = stored(dealt.mapInArrow(_shared, "anchor long, tid long"), "anchors")
    del told, dealt  # Spark removes the shuffle files of plans that nobody holds
    drop(docs)
    wanted = shared.groupBy("tid").agg(F.collect_set("anchor").alias("wanted")).join(firsts, "tid").select(F.col("first_id").alias("_id"), F.col("tid").alias("_tid"), "wanted")
    found = docs.join(wanted.hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("tid") == F.col("_tid"))).select("doc_id", "tid", "text", "wanted")
    rows = stored(found.mapInArrow(_windows, _FOUND), "windows")
    del wanted, found
    drop(shared)
    known = rows.filter("h1 IS NULL").select("doc_id", "tid", "start", "count")
    met = rows.filter("h1 IS NOT NULL").select(*_NAMES[:5]).repartition("h1").sortWithinPartitions(*_NAMES[:5])
    out = stored(known.unionByName(met.mapInArrow(_repeats, "doc_id long, tid long, start long, count long")), "covered")
    drop(rows)
    return out


_CUT = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("text", StringType()), StructField("kept_sha256", StringType())])


@F.arrow_udf(_CUT)
def _cut(texts: pa.Array, starts: pa.Array, counts: pa.Array, copy: pa.Array) -> pa.Array:
    """Cut covered words out of texts (all words of a copy that has a window)."""
    rows = []
    for text, start, count, whole in zip(texts.cast(pa.binary()), starts, counts, copy.to_pylist()):
        words = text.as_py().split()  # bytes are split at the six ASCII blanks
        n, kept, spans = len(words), words, 0
        if whole and n >= WINDOW:
            kept, spans = [], 1
        elif start.is_valid:
            depth = np.zeros(n + 1, np.int64)
            first = np.asarray(start.values, np.int64)
            np.add.at(depth, first, 1)
            np.add.at(depth, first + np.asarray(count.values, np.int64) + WINDOW - 1, -1)
            gone = np.cumsum(depth)[:n] > 0
            spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
            kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
        left = b" ".join(kept)
        rows.append((n, n - len(kept), spans, left, hashlib.sha256(left).hexdigest()))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    columns[3] = columns[3].cast(pa.string())
    return pa.StructArray.from_arrays(columns, names=_CUT.names)


def remove_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, text (the words that are left, one blank between them), kept_sha256 for every row.

    Null and empty texts have no words. Rows without doc_id lose nothing, and nothing is lost to them. Equal rows are one
    document: they get equal results and take nothing from each other. Rows with one doc_id and different texts are
    documents of their own, in the order of the hashes of their texts. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    rows = rows.withColumn("tid", F.xxhash64("text"))
    keyed = stored(rows.select("doc_id", "tid", F.md5("text").alias("digest")).filter("doc_id IS NOT NULL"), "digests")
    classes = stored(keyed.groupBy("digest", "tid").agg(F.min("doc_id").alias("first_id")), "classes")
    ranges = covered_ranges(rows.filter("doc_id IS NOT NULL"), classes.select("tid", "first_id"))
    gathered = ranges.groupBy(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid")).agg(F.collect_list("start").alias("_starts"), F.collect_list("count").alias("_counts"))
    copies = keyed.join(classes.select(F.col("digest").alias("_digest"), "first_id"), F.col("digest") == F.col("_digest")).filter("doc_id > first_id")
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid"), F.lit(True).alias("_copy")).distinct()
    marks = stored(gathered.join(copies, ["_id", "_tid"], "full"), "marks")
    drop(ranges, keyed, classes)
    joined = rows.join(marks.hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("tid") == F.col("_tid")), "left")
    cut = joined.withColumn("_c", _cut("text", "_starts", "_counts", F.coalesce("_copy", F.lit(False))))
    return cut.select("doc_id", "_c.*")


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")
