"""Removal of repeated passages by sorted suffixes.

A byte goes when some string of LENGTH bytes covers it that also starts in a document with a smaller doc_id.

1. Equal texts are one class, that of the smallest doc_id. The others are removed whole (if LENGTH bytes or longer).
2. Each string of LENGTH bytes has an anchor: the smallest hash of the ANCHOR-byte strings in it. Equal strings have equal
   anchors, so only strings whose anchor occurs in two texts or more need a look. Anchors are counted in shuffles of
   (anchor, text); an anchor that a task sees in several texts is reported once and not per text.
3. Neighbouring strings with the same anchor are one piece of text, sent to the block of its anchor. Equal pieces that a
   task sees are sent once, for the smallest doc_id: what the others hold is covered.
4. A block's pieces are joined and their suffixes sorted in two stages: those smaller than their successor directly, all
   others induced by a scan over the buckets of first bytes. Neighbours in that order with LENGTH bytes in common are
   occurrences of one string; all but those of the smallest doc_id are covered.
   An anchor with more than HEAVY pieces does not fit a block. Its strings are compared by their 128-bit hashes, one row
   each, which can be dealt out freely.
5. Covered ranges are gathered per document and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tabulon.llm.common import chunks, drop, stored, strings, text_of, utf8

LENGTH = 50
ANCHOR = 16
#: Bytes of pieces that are sorted together, and pieces of one anchor from which its strings go their own way.
BLOCK_BYTES = 2 << 20
HEAVY = 20_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _grams(data: np.ndarray, length: int, odd: int) -> np.ndarray:
    """64-bit hash of the `length` bytes from each position on; made of hashes of halves, the rest overlapping."""
    h, size = _mix(data.astype(np.uint64) + np.uint64(odd)), 1
    while size < length:
        step = min(size, length - size)
        h = _mix(h[:-step] * np.uint64(0x9FB21C651E98DF25) + h[step:]) if len(h) > step else h[:0]
        size += step
    return h


def anchors(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> np.ndarray:
    """Anchor of the string of `length` bytes at each position."""
    low, size, want = _grams(data, anchor, 1), 1, length - anchor + 1
    while size < want:
        step = min(size, want - size)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        size += step
    return low


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, text, first, last position) of each run of strings of one text with the same anchor."""
    low = anchors(data, length, anchor)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) + np.repeat(offsets[:-1] - (np.cumsum(counts) - counts), counts)
    value = low[at]
    starts = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])])) if len(at) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(at)) - 1
    return value[starts].view(np.int64), text[starts], at[starts], at[ends] if len(at) else starts


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, text) -> (anchor, tid, known), distinct. Anchors that several texts of a batch hold are known to repeat: two
    of the rows take part in the count for other tasks to see, the rest are marked."""
    for batch in batches:
        tids, parts = batch.column(0).to_numpy(), []
        for a, b in chunks(batch.column(1)):
            value, text, _, _ = _runs(*utf8(batch.column(1).slice(a, b - a)), LENGTH, ANCHOR)
            parts.append((value, tids[text + a]))
        value, tid = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
        order = np.lexsort((tid, value))
        value, tid = value[order], tid[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (tid[1:] != tid[:-1])
        value, tid = value[new], tid[new]
        starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
        known = np.arange(len(value)) - np.repeat(starts, np.diff(np.append(starts, len(value)))) >= 2
        yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(tid), pa.array(known)], names=["anchor", "tid", "known"])


def _by_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
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


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, tid, known) by anchor -> (anchor, tid) of the anchors in two texts or more."""
    for anchor, tid, known in _by_runs(batches, 1):
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        many = (np.minimum.reduceat(tid, starts) != np.maximum.reduceat(tid, starts)) | np.logical_or.reduceat(known, starts)
        out = np.repeat(many, np.diff(np.append(starts, len(anchor))))
        yield pa.RecordBatch.from_arrays([pa.array(anchor[out]), pa.array(tid[out])], names=["anchor", "tid"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, wanted anchors) -> (anchor, doc_id, start, count, piece): `count` strings from `start` on. Without a
    piece it is known that they are covered."""
    for batch in batches:
        for a, b in chunks(batch.column(1)):
            part = batch.slice(a, b - a)
            data, offsets = utf8(part.column(1))
            value, text, first, last = _runs(data, offsets, LENGTH, ANCHOR)
            wanted = part.column(2)
            owner = np.repeat(np.arange(len(part)), np.asarray(wanted.value_lengths()))
            tag = lambda v, t: _mix(v.view(np.uint64) * np.uint64(3) + _mix(t.astype(np.uint64) + np.uint64(9)))
            pick = np.isin(tag(value, text), tag(np.ascontiguousarray(wanted.flatten().to_numpy()), owner))
            value, text, first, last = value[pick], text[pick], first[pick], last[pick]
            docs = part.column(0).to_numpy()[text]
            raw = data.tobytes()
            pieces = [raw[i:j + LENGTH] for i, j in zip(first.tolist(), last.tolist())]
            best: dict[bytes, int] = {}
            for p, d in zip(pieces, docs.tolist()):
                if d < best.get(p, d + 1):
                    best[p] = d
            sent = [p if best[p] == d else None for p, d in zip(pieces, docs.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(value), pa.array(docs), pa.array(first - offsets[text]), pa.array(last - first + 1), pa.array(sent, pa.binary())],
                names=["anchor", "doc_id", "start", "count", "piece"])


def _by_words(at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """`at` in the order of the 56 bytes from there on, by one sort of whole numbers a round: first of 8 bytes, then, where
    those are equal, of the number of the group of equals with as many of the next bytes as there is room for."""
    keys = words[at]
    first = np.argsort(keys)
    at, keys = at[first], keys[first]
    new, done = np.ones(len(at), bool), 8
    new[1:] = keys[1:] != keys[:-1]
    while done < 56:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        some, group = at[tied], np.cumsum(new[tied])
        size = 8 - (int(group[-1]).bit_length() + 7) // 8
        keys = group.astype(np.uint64) << np.uint64(8 * size) | words[some + done] >> np.uint64(64 - 8 * size)
        order = np.argsort(keys)
        at[tied], keys = some[order], keys[order]
        new[tied[1:]] |= keys[1:] != keys[:-1]
        done += size
    return at


def sort_suffixes(text: np.ndarray) -> np.ndarray:
    """Positions of a byte array that ends in a zero in the order of their suffixes, exact for 56 bytes.

    Suffixes smaller than their successor are sorted directly. In a bucket of one first byte they stand behind the others,
    which are found by scanning the buckets in order: whoever precedes a scanned suffix, with a byte that is larger, or
    equal but in front of such a suffix, comes next in the bucket of that byte.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    step = np.sign(np.diff(text.astype(np.int16), append=np.int16(256)))
    place = np.where(step != 0, np.arange(n), n - 1)
    smaller = step[np.minimum.accumulate(place[::-1])[::-1]] > 0
    words = np.concatenate([text, np.zeros(64, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        words = words[:-size] << np.uint64(8 * size) | words[size:]
    direct = np.flatnonzero(smaller)
    direct = _by_words(direct, words)
    heads = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        waves = [np.concatenate(queues[c])] if queues[c] else []
        while waves and len(waves[-1]):
            before = waves[-1][waves[-1] > 0] - 1
            waves.append(before[(text[before] == c) & ~smaller[before]])
        queues[c] = []
        bucket = np.concatenate([*waves, direct[heads[c]:heads[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        before = before[np.argsort(text[before], kind="stable")]
        firsts = text[before]
        edges = np.flatnonzero(np.concatenate([[True], firsts[1:] != firsts[:-1]])) if len(before) else np.zeros(0, np.int64)
        for i, j in zip(edges, np.append(edges[1:], len(before))):
            queues[firsts[i]].append(before[i:j])
    return np.concatenate(out)


def common_strings(pieces: list[bytes], docs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(piece, position) of every string of `length` bytes in the pieces that a piece of a smaller document holds too."""
    text = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)  # a piece and the mark after it
    room = np.concatenate([[0], np.repeat(begin + sizes, sizes + 1) - np.arange(1, len(text))])
    order = sort_suffixes(text)
    order = order[room[order] >= length]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = np.concatenate([text, np.zeros(64, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        words = words[:-size] << np.uint64(8 * size) | words[size:]
    same = np.ones(len(order) - 1, bool)
    for at in [*range(0, length - 7, 8), length - 8]:
        w = words[order + at]
        same &= w[1:] == w[:-1]
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    of = owner[order - 1]
    least = np.repeat(np.minimum.reduceat(docs[of], starts), np.diff(np.append(starts, len(order))))
    hit = docs[of] > least
    return of[hit], order[hit] - begin[of[hit]]


def _joined(piece: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring positions of a piece: (piece, first, how many)."""
    order = np.lexsort((at, piece))
    piece, at = piece[order], at[order]
    starts = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (at[1:] != at[:-1] + 1)])) if len(at) else np.zeros(0, np.int64)
    return piece[starts], at[starts], np.diff(np.append(starts, len(at)))


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, doc_id, start, count, piece) by anchor -> (doc_id, start, count) of covered strings. Blocks end where an
    anchor does."""
    columns = ["doc_id", "start", "count"]
    rows: list[tuple] = []
    held, last = 0, None

    def close() -> pa.RecordBatch:
        known: list[tuple[int, int, int]] = []
        best: dict[bytes, tuple[int, list[int]]] = {}  # equal pieces are sorted once, for the smallest document
        for _, doc, start, count, piece in rows:
            if piece is None:
                known.append((doc, start, count))
                continue
            least, starts = best.get(piece, (doc, None))
            if starts is None or doc < least:
                known.extend((least, s, count) for s in starts or ())
                best[piece] = doc, [start]
            elif doc == least:
                starts.append(start)
            else:
                known.append((doc, start, count))
        docs = np.array([d for d, _ in best.values()], np.int64)
        found = common_strings(list(best), docs) if len(best) > 1 else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        piece, at, count = _joined(*found)
        times = np.array([len(s) for _, s in best.values()], np.int64)
        starts = np.array([x for _, s in best.values() for x in s], np.int64)
        again = np.repeat(np.arange(len(piece)), times[piece])
        nth = np.arange(len(again)) - np.repeat(np.cumsum(times[piece]) - times[piece], times[piece])
        piece, at, count = piece[again], at[again], count[again]
        begin = starts[(np.cumsum(times) - times)[piece] + nth]
        whole = np.array(known, np.int64).reshape(-1, 3)
        out = [np.concatenate([whole[:, i], x]) for i, x in enumerate((docs[piece], begin + at, count))]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=columns)

    for batch in batches:
        for row in zip(*(strings(c) for c in batch.columns)):
            if held > BLOCK_BYTES and row[0] != last:
                yield close()
                rows, held = [], 0
            rows.append(row)
            held += len(row[4] or b"") + 32
            last = row[0]
    if rows:
        yield close()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces -> (h1, h2, doc_id, start, known) of each string in them; the smallest doc_id of a batch takes part in the
    comparison of its string, the others are known to be covered."""
    for batch in batches:
        docs, begin = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        data, offsets = utf8(batch.column(4).cast(pa.large_binary()).view(pa.large_string()))
        counts = np.diff(offsets) - LENGTH + 1
        owner = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        h1, h2 = (_grams(data, LENGTH, odd)[offsets[owner] + inside].view(np.int64) for odd in (1, 1000003))
        doc, at = docs[owner], begin[owner] + inside
        order = np.lexsort((at, doc, h2, h1))
        h1, h2, doc, at = h1[order], h2[order], doc[order], at[order]
        starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        known = doc > np.repeat(doc[starts], np.diff(np.append(starts, len(doc))))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1, h2, doc, at, known)], names=["h1", "h2", "doc_id", "start", "known"])


def _covered_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for h1, h2, doc, at, known in _by_runs(batches, 2):
        starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        hit = known | (doc > np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(doc)))))
        of, first, count = _joined(doc[hit], at[hit])
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(first), pa.array(count.astype(np.int64))], names=["doc_id", "start", "count"])


_CUT = StructType([StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", IntegerType()), StructField("text", StringType()), StructField("kept_sha256", StringType())])


@F.arrow_udf(_CUT)
def _cut(texts: pa.Array, starts: pa.Array, counts: pa.Array, copy: pa.Array) -> pa.Array:
    """Cut covered ranges out of texts (all of a copy)."""
    rows = []
    for text, start, count, whole in zip(texts.cast(pa.binary()).to_pylist(), starts.to_pylist(), counts.to_pylist(), copy.to_pylist()):
        if whole and len(text) >= LENGTH:
            spans = [(0, len(text))]
        else:
            spans = []
            for a, n in sorted(zip(start or [], count or [])):
                b = a + n + LENGTH - 1
                if spans and a <= spans[-1][1]:
                    spans[-1] = spans[-1][0], max(b, spans[-1][1])
                else:
                    spans.append((a, b))
        edges = [0, *(x for s in spans for x in s), len(text)]
        left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        rows.append((len(text), len(text) - len(left), len(spans), left.decode("utf-8", "replace"), hashlib.sha256(left).hexdigest()))
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()))], names=_CUT.names)


def covered_ranges(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc_id, start, count): from `start` on, `count` neighbouring strings of LENGTH bytes stand in smaller documents.
    `docs` has doc_id, text, tid (hash of the text); `firsts` the smallest doc_id (first_id) of each tid."""
    told = docs.select("tid", "text").mapInArrow(_anchor_rows, "anchor long, tid long, known boolean")
    dealt = told.repartition(F.when(F.col("known"), F.xxhash64("anchor", "tid")).otherwise(F.col("anchor"))).sortWithinPartitions("anchor")
    repeated = stored(dealt.mapInArrow(_repeated, "anchor long, tid long"), "anchors")
    wanted = repeated.groupBy("tid").agg(F.collect_set("anchor").alias("wanted")).join(firsts, "tid").select(F.col("first_id").alias("_id"), F.col("tid").alias("_tid"), "wanted")
    found = docs.join(wanted.hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("tid") == F.col("_tid"))).select("doc_id", "text", "wanted")
    rows = stored(found.mapInArrow(_pieces, "anchor long, doc_id long, start long, count long, piece binary"), "pieces")
    drop(repeated)
    heavy = rows.filter("piece IS NOT NULL").groupBy(F.col("anchor").alias("_anchor")).agg(F.count("*").alias("n")).filter(F.col("n") > HEAVY).select("_anchor")
    heavy = stored(heavy, "heavy")
    known = rows.filter("piece IS NULL").select("doc_id", "start", "count")
    open_ = rows.filter("piece IS NOT NULL")
    light = open_.join(heavy, F.col("anchor") == F.col("_anchor"), "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    light = light.mapInArrow(_covered, "doc_id long, start long, count long")
    strings = open_.join(heavy, F.col("anchor") == F.col("_anchor"), "left_semi").mapInArrow(_strings, "h1 long, h2 long, doc_id long, start long, known boolean")
    strings = strings.repartition(F.when(F.col("known"), F.xxhash64("doc_id", "start")).otherwise(F.col("h1"))).sortWithinPartitions("h1", "h2")
    strings = strings.mapInArrow(_covered_strings, "doc_id long, start long, count long")
    return stored(known.unionByName(light).unionByName(strings), "covered")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, text (what is left), kept_sha256 for every row of `docs`.

    Null and empty texts have no bytes. Rows without doc_id lose nothing, and nothing is lost to them. Equal rows get equal
    results and take nothing from each other; rows with one doc_id and different texts count as that document holding
    each text, and ranges found in one are cut from all. Where a cut splits a character, text has a replacement mark;
    kept_sha256 is that of the bytes. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    rows = rows.withColumn("tid", F.xxhash64("text"))
    keyed = stored(rows.select("doc_id", "tid", F.md5("text").alias("digest")).filter("doc_id IS NOT NULL"), "digests")
    classes = stored(keyed.groupBy("digest", "tid").agg(F.min("doc_id").alias("first_id")), "classes")
    ranges = covered_ranges(rows.filter("doc_id IS NOT NULL"), classes.select("tid", "first_id"))
    gathered = ranges.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("start").alias("_starts"), F.collect_list("count").alias("_counts"))
    copies = keyed.join(classes.select(F.col("digest").alias("_digest"), "first_id"), F.col("digest") == F.col("_digest")).filter("doc_id > first_id")
    copies = copies.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_copy")).distinct()
    marks = stored(gathered.join(copies, "_id", "full"), "marks")
    drop(ranges, keyed, classes)
    joined = rows.join(marks.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    cut = joined.withColumn("_c", _cut("text", "_starts", "_counts", F.coalesce("_copy", F.lit(False))))
    return cut.select("doc_id", "_c.n_bytes", "_c.n_removed", F.col("_c.n_spans").cast("long").alias("n_spans"), "_c.text", "_c.kept_sha256")


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
