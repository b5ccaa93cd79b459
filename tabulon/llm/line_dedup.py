"""Fuzzy duplicate lines: MinHash of character shingles, banding, exact Jaccard, union-find.

1. Every line with a word gets a digest and the band keys of a one-permutation MinHash signature; equal lines become one
   class (a third of all rows may be one line).
2. Classes meet in buckets of equal band keys and bring their sketch along, a few bits of each value of the signature.
   They travel as entries of one width, packed by slots of the keys, and a task sorts a slot at a time. A bucket of over
   BLOCK classes is cut into blocks, and each pair of blocks meets on its own.
3. Before any text moves, the members of a meeting compare sketches. Members whose sketches still allow the threshold
   form a party; who has nobody leaves. Parties with the same members are one.
4. The text of each class in a party is fetched once and sent to the largest of its parties; there the shingle sets of
   members with alike sketches are compared exactly, first with PIVOTS members, then pair by pair where members are not
   joined yet. What the other parties still leave open - members alike, not joined and not compared - meets once more.
5. Components of the links that hold keep the line of the smallest (doc_id, line number).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tabulon.llm.common import chunks, components, drop, roots, run_starts, stored, strings, text_of

#: A character changed in the middle of a line takes SHINGLE shingles; at the threshold this links lines of 39 characters on.
SHINGLE = 4
#: Lines of fewer characters are one shingle, so only equal ones are linked.
WHOLE = 8
THRESHOLD = 0.8
#: 14 bands of 4 values: a pair at the threshold shares a band with probability 0.9994.
BANDS, ROWS = 14, 4
KEY_BYTES = 5
BLOCK = 2048
#: Bits of each signature value in a sketch, and how many standard deviations below the agreement that is expected at the
#: threshold a pair may fall before it is left out (4: 3 pairs of 100,000 at the threshold itself, fewer above it).
SKETCH_BITS, DEVIATIONS = 2, 4.0
#: Meetings up to this size are compared together, pair by pair; rows that are handled at a time.
SMALL, STEP = 48, 4096
#: Distinct shingles of a bucket that are counted at a time.
COLUMNS = 20_000
#: Members of a party that all others are compared with before pairs are, and pairs a member that are compared one by one.
PIVOTS, FEW = 4, 64
#: Bits of the map of a line's shingles, by which pairs are told apart before their sets are compared.
MAP_BITS = 4096
#: Entries of buckets that a slot has on average at most, and entries of a slot that a task holds at a time.
SLOT, HELD = 1 << 18, 1 << 20
#: What stays in a processor's cache: bytes of text signed together, characters hashed, numbers compared at a time.
TEXT_PIECE, PIECE = 1 << 17, 1 << 14

_BINS = BANDS * ROWS
_SKETCH = _BINS * SKETCH_BITS // 8 + 1
_ENTRY = 8 + KEY_BYTES + 1 + _SKETCH
_EMPTY = np.uint32(0xFFFFFFFF)
_DONORS = np.stack([np.random.default_rng(11 + j).permutation(_BINS) for j in range(_BINS)], 1)  # attempt x bin


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(28)
    return x


def _rolling(points: np.ndarray) -> np.ndarray:
    """The hash of the SHINGLE characters that begin at each place, of 2 and then 4 characters from those of half as many."""
    out = np.empty(max(len(points) - SHINGLE + 1, 0), np.uint64)
    for at in range(0, len(out), PIECE):
        h, step = _mix(points[at:at + PIECE + SHINGLE - 1].astype(np.uint64) + np.uint64(1)), 1
        while step < SHINGLE:
            h = _mix(h[:-step] * np.uint64(0xD6E8FEB86659FD93) + h[step:])
            step *= 2
        out[at:at + PIECE] = h
    return out


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all character shingles of all lines, and the line of each. A line below WHOLE is one shingle."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.where(sizes >= WHOLE, sizes - SHINGLE + 1, 0)
    ends = np.cumsum(sizes)
    inside = np.ones(len(points), bool)
    for k in range(1, WHOLE):  # no shingle begins at the last places of a line, none at all in a short one
        inside[(ends - k)[np.where(sizes >= WHOLE, k < SHINGLE, k <= sizes)]] = False
    owner = np.repeat(np.arange(len(lines)), counts)
    short = np.flatnonzero(counts == 0)
    alone = np.fromiter((xxhash.xxh64_intdigest(lines[i].encode("utf-8", "surrogatepass"), 8) for i in short), np.uint64, len(short))
    h = _rolling(points)
    return np.concatenate([h[inside[:len(h)]], alone]), np.concatenate([owner, short])


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(lines x BANDS) keys of KEY_BYTES each: one-permutation MinHash, empty bins filled from other bins. (lines x _SKETCH)
    bytes: the number of bins that had a value of their own, and the low SKETCH_BITS of each value."""
    h, owner = shingle_hashes(lines)
    bins = ((h >> np.uint64(32)) * np.uint64(_BINS) >> np.uint64(32)).astype(np.int64)
    table = np.full(len(lines) * _BINS, _EMPTY, np.uint32)
    np.minimum.at(table, owner * _BINS + bins, np.minimum(h.astype(np.uint32), _EMPTY - np.uint32(1)))
    table = table.reshape(-1, _BINS)
    filled, own = table.copy(), (table != _EMPTY).sum(1, keepdims=True).astype(np.uint8)
    row, bin_ = np.nonzero(table == _EMPTY)
    for donors in _DONORS:
        if not len(row):
            break
        got = table[row, donors[bin_]]
        ok = got != _EMPTY
        filled[row[ok], bin_[ok]] = got[ok]
        row, bin_ = row[~ok], bin_[~ok]
    values = filled.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.zeros(values.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + values[:, :, i] + np.uint64(1))
    low = (filled & np.uint32((1 << SKETCH_BITS) - 1)).astype(np.uint8)
    packed = np.zeros((len(lines), _SKETCH - 1), np.uint8)
    for i in range(8 // SKETCH_BITS):
        packed |= low[:, i::8 // SKETCH_BITS] << np.uint8(i * SKETCH_BITS)
    return key, np.concatenate([own, packed], 1)


def _first_of(texts: list[str]) -> list[bool]:
    seen: set[str] = set()
    return [not (x in seen or seen.add(x)) for x in texts]


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, doc (hash of the text), line_no, digest of every line with a word; bands (keys and sketch) with the first of
    equal lines in a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column(2), TEXT_PIECE):
                split = pc.split_pattern(batch.column(2).slice(a, b - a), "\n")
                owner, lines = np.asarray(pc.list_parent_indices(split), np.int64), split.flatten()
                number = np.arange(len(owner)) - np.searchsorted(owner, owner)
                real = np.flatnonzero(np.asarray(pc.not_equal(pc.ascii_trim_whitespace(lines), "")))
                texts = strings(lines.take(pa.array(real)))
                distinct = list(dict.fromkeys(texts))
                keys, sketches = signatures(distinct)
                keys = keys.astype("<u8").view(np.uint8).reshape(len(distinct), BANDS, 8)[:, :, :KEY_BYTES]
                keys = np.concatenate([keys.reshape(len(distinct), BANDS * KEY_BYTES), sketches], 1)
                packed = {x: (xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")), keys[i].tobytes()) for i, x in enumerate(distinct)}
                signed = [packed[x][1] if new else None for x, new in zip(texts, _first_of(texts))]  # once per chunk
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i).take(pa.array(owner[real] + a)) for i in (0, 1)), pa.array(number[real].astype(np.int32)),
                    pa.array([packed[x][0] for x in texts], pa.binary()), pa.array(signed, pa.binary())],
                    names=["doc_id", "doc", "line_no", "digest", "bands"])

    text = text_of(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("doc"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, doc long, line_no int, digest binary, bands binary")


def _rows_of_bytes(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of one width as rows of bytes, without a Python object for each."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    fixed = column.cast(pa.binary(width))
    return np.frombuffer(fixed.buffers()[1], np.uint8)[fixed.offset * width:(fixed.offset + len(fixed)) * width].reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as binary values."""
    rows = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def _keys(entries: np.ndarray) -> np.ndarray:
    """The bucket of each entry: its band key, then its band."""
    wide = np.zeros((len(entries), 8), np.uint8)
    wide[:, 0] = entries[:, 8 + KEY_BYTES]
    wide[:, 1:KEY_BYTES + 1] = entries[:, 8:8 + KEY_BYTES]
    return wide.view("<i8")[:, 0]


def _deal_bands(slots: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, bands) -> (slot, entries): one entry (id, band key, band, sketch) for each band of a class, those of a batch that
    have the same slot end to end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _rows_of_bytes(batch.column(1), BANDS * KEY_BYTES + _SKETCH)
            entries = np.empty((len(raw), BANDS, _ENTRY), np.uint8)
            entries[:, :, :8] = np.ascontiguousarray(batch.column(0).to_numpy(), "<i8").view(np.uint8).reshape(-1, 1, 8)
            entries[:, :, 8:8 + KEY_BYTES] = raw[:, :BANDS * KEY_BYTES].reshape(-1, BANDS, KEY_BYTES)
            entries[:, :, 8 + KEY_BYTES] = np.arange(BANDS)
            entries[:, :, _ENTRY - _SKETCH:] = raw[:, None, BANDS * KEY_BYTES:]
            entries = entries.reshape(-1, _ENTRY)
            slot = (_keys(entries) >> 8) % slots
            order = np.argsort(slot.astype(np.uint16) if slots <= 1 << 16 else slot, kind="stable")
            slot = slot[order]
            begin = run_starts(slot)
            ends = pa.py_buffer(np.append(begin, len(slot)) * _ENTRY)
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, ends, pa.py_buffer(entries[order])])
            yield pa.RecordBatch.from_arrays([pa.array(slot[begin]), packed.cast(pa.binary())], names=["slot", "entries"])

    return run


def similar(lines: list[str], threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of lines whose shingle sets have Jaccard similarity `threshold` or more."""
    h, owner = shingle_hashes(lines)
    distinct, code = np.unique(h, return_inverse=True)
    common = np.zeros((len(lines), len(lines)), np.float32)
    sizes = np.zeros(len(lines))
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    columns = max(1, min(COLUMNS, 40_000_000 // max(len(lines), 1)))
    for at in range(0, len(distinct), columns):
        a, b = np.searchsorted(code, [at, at + columns])
        has = np.zeros((len(lines), min(columns, len(distinct) - at)), np.float32)
        has[owner[a:b], code[a:b] - at] = 1
        common += has @ has.T
        sizes += has.sum(1)
    union = sizes[:, None] + sizes[None, :] - common
    x, y = np.nonzero(np.triu(common >= threshold * union, 1))
    return x, y


def _candidates(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """All index pairs inside the groups of up to SMALL rows that begin at `starts`, and the bounds of the larger ones."""
    stops = np.append(starts[1:], n)
    large = stops - starts > SMALL
    end = np.repeat(np.where(large, starts, stops), stops - starts)  # rows of large groups are in no pair here
    more = np.maximum(end - np.arange(n) - 1, 0)
    a = np.repeat(np.arange(n), more)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(more) - more, more)
    return a, b, list(zip(starts[large].tolist(), stops[large].tolist()))


_FIRST_BITS = np.uint64(sum(1 << i for i in range(0, 64, SKETCH_BITS)))
_EXPECTED = THRESHOLD + (1 - THRESHOLD) / (1 << SKETCH_BITS)
#: By the number of values of its own that a line has: how many values of a partner's sketch may differ.
_LIMITS = np.floor(_BINS * (1 - _EXPECTED + DEVIATIONS * np.sqrt(_EXPECTED * (1 - _EXPECTED) / np.maximum(np.arange(_BINS + 1), 1)))).astype(np.uint8)


def sketch_words(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches as columns of 64-bit words, and how many of their values may differ from a partner's."""
    wide = np.zeros((len(rows), -(-(_SKETCH - 1) // 8) * 8), np.uint8)
    wide[:, :_SKETCH - 1] = rows[:, 1:]
    return np.ascontiguousarray(wide.view(np.uint64).T), _LIMITS[rows[:, 0]]


def _alike(words: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the sketches with these pairs of words, which may be broadcast, and these limits allow the threshold."""
    differ = np.uint8(0)
    for a, b in words:
        bits = a ^ b
        bits |= bits >> np.uint64(1)  # two bits a value
        bits &= _FIRST_BITS
        differ = differ + np.bitwise_count(bits)
    return differ <= np.maximum(x, y)


def alike(sketches: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of sketches may belong to lines at the threshold."""
    words, limits = sketches
    return _alike([(w[a], w[b]) for w in words], limits[a], limits[b])


def _alike_rows(sketches: tuple[np.ndarray, np.ndarray], apart: Callable[[slice, slice], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with alike sketches, and of those that are `apart`: some rows at a time against all that follow."""
    words, limits = sketches
    n = len(limits)
    step = max(1, PIECE // max(n, 1))
    for i in range(0, n, step):
        ok = _alike([(w[i:i + step, None], w[None, i:]) for w in words], limits[i:i + step, None], limits[None, i:])
        if apart is not None:
            ok &= apart(slice(i, i + step), slice(i, None))
        a, b = np.nonzero(ok)
        yield a + i, b + i


def _alike_within(sketches: tuple[np.ndarray, np.ndarray], apart: Callable[[slice, slice], np.ndarray] | None = None) -> np.ndarray:
    """The smallest row that each row reaches by pairs of `_alike_rows`."""
    n = len(sketches[1])
    to = np.arange(n)
    for a, b in _alike_rows(sketches, apart):
        if (a != b).any():
            to = roots(np.concatenate([np.arange(n), a]), np.concatenate([to, b]), n)
    return to


def _meetings(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """Rows sorted by their first column -> (where groups begin, columns) of whole groups, about STEP rows at a time. Of a
    group that has not ended after `limit` rows and a batch, pieces are given out without a beginning."""
    rest: list[pa.Array] | None = None
    flowing = None  # the group that is given out in pieces
    for batch in batches:
        columns = batch.columns if rest is None else [pa.concat_arrays([r, c]) for r, c in zip(rest, batch.columns)]
        if flowing is not None:
            more = int(np.searchsorted(columns[0].to_numpy(), flowing, "right"))
            if more:
                yield np.zeros(0, np.int64), [c.slice(0, more) for c in columns]
            if more == len(columns[0]):
                continue
            columns, flowing = [c.slice(more) for c in columns], None
        starts = run_starts(columns[0].to_numpy())
        at = 0
        while len(starts) - at > 1:  # the last group may go on
            stop = min(max(at + 1, int(np.searchsorted(starts, starts[at] + STEP, "right")) - 1), len(starts) - 1)
            yield starts[at:stop] - starts[at], [c.slice(starts[at], starts[stop] - starts[at]) for c in columns]
            at = stop
        rest = [c.slice(starts[at]) for c in columns] if len(starts) else columns
        if limit is not None and len(rest[0]) > limit:
            yield np.zeros(0, np.int64), rest
            flowing, rest = rest[0][0].as_py(), None
    if rest is not None and len(rest[0]):
        yield np.zeros(1, np.int64), rest


def _groups_of_alike(starts: np.ndarray, ids: np.ndarray, sketches: np.ndarray, told: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Groups of rows that begin at `starts` -> (party, row) of members with a partner; the party is the number of its
    members and then a hash of them, so of two parties the larger number has more members. What is `told` of each row: what
    it is joined with, and whether it was compared with all rows of its group of which that is told too; such are no partners."""
    words, limits = sketches = sketch_words(sketches)
    a, b, big = _candidates(starts, len(ids))
    if told is not None:
        joined, met = told
        open_ = (joined[a] != joined[b]) & ~(met[a] & met[b])
        a, b = a[open_], b[open_]
    ok = alike(sketches, a, b)
    links = [(a[ok], b[ok])]
    for low, high in big:
        apart = None
        if told is not None:
            j, m = joined[low:high], met[low:high]
            apart = lambda x, y: (j[x, None] != j[None, y]) & ~(m[x, None] & m[None, y])  # noqa: B023
        links.append((np.arange(low, high), _alike_within((words[:, low:high], limits[low:high]), apart) + low))
    root = roots(*(np.concatenate(x) for x in zip(*links)), len(ids))
    order = np.argsort(root, kind="stable")
    starts = run_starts(root[order])
    sizes = np.diff(np.append(starts, len(order)))
    total = np.add.reduceat(_mix(ids[order].astype(np.uint64) + np.uint64(77)), starts) if len(ids) else np.zeros(0, np.uint64)
    party = np.minimum(sizes, 4095) << 51 | (_mix(total + sizes.astype(np.uint64)) >> np.uint64(13)).astype(np.int64)
    many = np.repeat(sizes > 1, sizes)
    return np.repeat(party, sizes)[many], order[many]


def _parties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(meet, id, sketch) sorted by meet -> (party, id)."""
    for starts, columns in _meetings(batches):
        ids = columns[1].to_numpy()
        party, rows = _groups_of_alike(starts, ids, _rows_of_bytes(columns[2], _SKETCH))
        yield pa.RecordBatch.from_arrays([pa.array(party), pa.array(ids[rows])], names=["party", "id"])


def _left_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(party, id, sketch, joined, met) sorted by party -> (party, id, joined) of parties of those that may still be joined;
    `met` tells who was compared in this party."""
    for starts, columns in _meetings(batches):
        joined, met = columns[3].to_numpy(), np.asarray(columns[4])
        sizes = np.diff(np.append(starts, len(joined)))
        more = (np.minimum.reduceat(joined, starts) != np.maximum.reduceat(joined, starts)) & ~np.logical_and.reduceat(met, starts)
        rows = np.flatnonzero(np.repeat(more, sizes))
        if not len(rows):
            continue
        ids, joined = columns[1].to_numpy()[rows], joined[rows]
        party, at = _groups_of_alike(np.cumsum(sizes[more]) - sizes[more], ids, _rows_of_bytes(columns[2], _SKETCH)[rows], (joined, met[rows]))
        yield pa.RecordBatch.from_arrays([pa.array(party), pa.array(ids[at]), pa.array(joined[at])], names=["party", "id", "joined"])


def _meet(block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, id, sketch) sorted by key -> (party, id) without a sketch, but the rows of buckets of over `block` as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, columns in _meetings(batches, block):
            n = len(columns[0])
            sizes = np.diff(np.append(starts, n)) if len(starts) else np.zeros(0, np.int64)
            crowded = np.repeat(sizes > block, sizes) if len(starts) else np.ones(n, bool)
            if crowded.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(crowded)) for c in columns], names=["party", "id", "sketch"])
            few = (sizes > 1) & (sizes <= block)
            rows = np.flatnonzero(np.repeat(few, sizes))
            if len(rows):
                begins = np.cumsum(sizes[few]) - sizes[few]
                ids = columns[1].to_numpy()[rows]
                party, at = _groups_of_alike(begins, ids, _rows_of_bytes(columns[2], _SKETCH)[rows])
                yield pa.RecordBatch.from_arrays([pa.array(party), pa.array(ids[at]), pa.nulls(len(at), pa.binary())], names=["party", "id", "sketch"])

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
    """(slot, entries) sorted by slot -> the entries of each slot, in one piece a batch, and an end."""
    for batch in batches:
        slot, entries = batch.column(0).to_numpy(), batch.column(1).cast(pa.large_binary())
        if not len(slot):
            continue
        ends = np.frombuffer(entries.buffers()[1], np.int64)[entries.offset:entries.offset + len(entries) + 1]
        data = np.frombuffer(entries.buffers()[2], np.uint8)
        begin = run_starts(slot)
        for low, high in zip(begin, np.append(begin[1:], len(slot))):
            yield int(slot[low]), data[ends[low]:ends[high]].reshape(-1, _ENTRY)
    yield None, np.zeros((0, _ENTRY), np.uint8)


def _meet_in_slots(block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(slot, entries) sorted by slot -> what `_meet` gives. Of a slot with over HELD entries, rows of crowded buckets go on
    before its end."""
    meet = _meet(block)

    def rows_of(entries: np.ndarray, key: np.ndarray, names: list[str]) -> pa.RecordBatch:
        ids = np.ascontiguousarray(entries[:, :8]).view("<i8")[:, 0]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids), _binary(entries[:, _ENTRY - _SKETCH:])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, limit, crowded = None, [], HELD, np.zeros(0, np.int64)
        for slot, piece in _pieces(batches):
            ended = slot != at
            if held and (ended or sum(map(len, held)) > limit):
                entries = np.concatenate(held)
                key = _keys(entries)
                order = np.argsort(key, kind="stable")
                key = key[order]
                starts = run_starts(key)
                sizes = np.diff(np.append(starts, len(key)))
                full = (sizes > block) | np.isin(key[starts], crowded)
                out = np.repeat(full, sizes)
                if out.any():
                    yield rows_of(entries[order[out]], key[out], ["party", "id", "sketch"])
                kept = np.repeat(~full & (sizes > 1 if ended else True), sizes)
                if ended:
                    yield from meet(iter([rows_of(entries[order[kept]], key[kept], ["key", "id", "sketch"])]))
                else:
                    held, crowded = [entries[order[kept]]], np.union1d(crowded, key[starts[full]])
                    limit = max(HELD, 2 * len(held[0]))
            if ended:
                at, held, limit, crowded = slot, [], HELD, np.zeros(0, np.int64)
            held.append(piece)

    return run


def _shingle_sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each line, sorted, line after line, and where each line's begin. Hashes lose as many
    bits, which are zero at their end, as the number of a line takes."""
    bits = np.uint64(max(len(lines) - 1, 1).bit_length())
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    sets, at = [], 0
    while at < len(lines):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * PIECE, "right")))
        h, owner = shingle_hashes(lines[at:stop])
        x = np.sort((owner + at).astype(np.uint64) << (np.uint64(64) - bits) | h >> bits)
        sets.append(x[run_starts(x)])
        at = stop
    x = np.concatenate(sets)
    begin = np.append(0, np.cumsum(np.bincount((x >> (np.uint64(64) - bits)).astype(np.int64), minlength=len(lines))))
    return x << bits, begin


def _similar_pairs(lines: list[str], a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which of the pairs have shingle sets of Jaccard similarity `threshold` or more."""
    return _similar_sets(_shingle_sets(lines), a, b, threshold)


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


def _common(x: np.ndarray, begin: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many hashes of each a its b has too. The hashes of an a are put into eight times as many slots; those whose slot
    another one took are put into slots again, by other bits, and only what was not found yet is looked for there."""
    first, row = np.unique(a, return_inverse=True)
    size, n = begin[first + 1] - begin[first], begin[b + 1] - begin[b]
    bits = np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 3
    at, shift = np.cumsum(1 << bits) - (1 << bits), (64 - bits).astype(np.uint64)
    own, table = x[_ranges(begin[first], size)], np.repeat(np.arange(len(first)), size)
    asked, pair = x[_ranges(begin[b], n)], np.repeat(np.arange(len(b)), n)
    base, by = np.repeat(at[row], n), np.repeat(shift[row], n)
    common = np.zeros(len(b), np.int64)
    factor = 1
    slots = np.empty((1 << bits).sum(), np.uint64)
    while len(own) and len(asked):
        slots.fill(1)  # no hash: their last bits are zero
        slot = at[table] + (own * np.uint64(factor) >> shift[table]).astype(np.int64)
        slots[slot] = own
        found = slots[base + (asked * np.uint64(factor) >> by).astype(np.int64)] == asked
        common += np.bincount(pair[found], minlength=len(b))
        lost = slots[slot] != own
        own, table = own[lost], table[lost]
        more = np.bincount(table, minlength=len(first))[row] > 0
        left = ~found & more[pair]
        asked, pair, base, by = asked[left], pair[left], base[left], by[left]
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    return common


def _similar_sets(sets: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """_similar_pairs of lines whose sets are known."""
    x, begin = sets
    sizes = np.diff(begin)
    out = np.zeros(len(a), bool)
    able = np.flatnonzero(np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b]))
    a, b = a[able], b[able]
    ends = np.cumsum(sizes[a] + sizes[b])
    at = 0
    while at < len(a):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 2 * PIECE, "right")))
        common = _common(x, begin, a[at:stop], b[at:stop])
        total = sizes[a[at:stop]] + sizes[b[at:stop]] - common
        out[able[at:stop]] = common >= threshold * total
        at = stop
    return out


def _maps(sets: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each set a map of MAP_BITS bits, as a row of 64-bit words: those bits are on that one of its hashes falls on."""
    x, begin = sets
    n = len(begin) - 1
    maps = np.empty((n, MAP_BITS // 8), np.uint8)
    bit, step = (x >> np.uint64(64 - MAP_BITS.bit_length() + 1)).astype(np.int64), max(1, 32 * PIECE // MAP_BITS)
    for i in range(0, n, step):
        stop = min(i + step, n)
        on = np.zeros((stop - i, MAP_BITS), bool)
        on.ravel()[np.repeat(np.arange(stop - i) * MAP_BITS, np.diff(begin[i:stop + 1])) + bit[begin[i]:begin[stop]]] = True
        maps[i:stop] = np.packbits(on, axis=1)
    return maps.view(np.uint64)


def _maybe_similar(maps: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of sets may have Jaccard similarity `threshold`: where a bit differs, one of them has a hash that the other
    has not, and at the threshold they have (1 - threshold) / (1 + threshold) of their sizes of such hashes at most."""
    out, step = np.empty(len(a), bool), max(1, 32 * PIECE // MAP_BITS)
    most = (sizes[a] + sizes[b]) * (1 - threshold) / (1 + threshold) + 1e-6
    for i in range(0, len(a), step):
        out[i:i + step] = np.bitwise_count(maps[a[i:i + step]] ^ maps[b[i:i + step]]).sum(1, dtype=np.int64) <= most[i:i + step]
    return out


def _joined(texts: list[str], starts: np.ndarray, sketches: tuple[np.ndarray, np.ndarray] | None = None, known: np.ndarray | None = None) -> np.ndarray:
    """The smallest index that each text reaches by links inside its group. Pairs that are joined already, by links or by
    what is `known` of both, are left out, and where there are sketches, pairs that these rule out."""
    n = len(texts)
    sets, of = _shingle_sets(texts), np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    to, done = np.arange(n), np.zeros(n, bool)  # done: compared with all of its group
    if known is not None:
        order = np.lexsort((known, of))
        begin = run_starts(of[order], known[order])
        to[order] = np.repeat(order[begin], np.diff(np.append(begin, n)))

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return roots(np.concatenate([np.arange(n), a]), np.concatenate([to, b]), n)

    maps, sizes = _maps(sets), np.diff(sets[1])

    def maybe(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = np.flatnonzero(alike(sketches, a, b)) if sketches is not None else np.arange(len(a))
        ok = ok[_maybe_similar(maps, sizes, a[ok], b[ok])]
        return a[ok], b[ok]

    def near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = maybe(a, b)
        ok = _similar_sets(sets, a, b)
        return a[ok], b[ok]

    for _ in range(PIVOTS):
        new = np.flatnonzero((to == np.arange(n)) & ~done)
        new = new[run_starts(of[new])]  # one of each group
        pivot = np.full(len(starts), -1)
        pivot[of[new]] = new
        b = np.flatnonzero((pivot[of] >= 0) & ~done & (to != to[pivot[of]]))
        links = near(pivot[of[b]], b)
        done[new] = True
        to = joined(*links)
    rest = np.flatnonzero(np.logical_or.reduceat(to != np.repeat(starts, np.diff(np.append(starts, n))), starts)[of] & ~done)
    if not len(rest):
        return to
    a, b, big = _candidates(run_starts(of[rest]), len(rest))
    pairs = [(rest[a], rest[b])]
    for low, high in big:
        rows = rest[low:high]
        found = _few_apart(rows, to[rows], None if sketches is None else (sketches[0][:, rows], sketches[1][rows]), maybe)
        if found is None:
            x, y = similar([texts[i] for i in rows])
            to = joined(rows[x], rows[y])
        else:
            pairs.append(found)
    a, b = (np.concatenate(x) for x in zip(*pairs))
    apart = to[a] != to[b]
    return joined(*near(a[apart], b[apart]))


def _few_apart(rows: np.ndarray, to: np.ndarray, sketches: tuple[np.ndarray, np.ndarray] | None,
               maybe: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray] | None:
    """The pairs of rows that are not joined, of those with alike sketches that `maybe` leaves where there are sketches, if
    these are few."""
    if sketches is not None:
        found, left = [], FEW * len(rows)
        for a, b in _alike_rows(sketches, lambda x, y: to[x, None] != to[None, y]):
            later = b > a
            found.append(maybe(rows[a[later]], rows[b[later]]))
            left -= len(found[-1][0])
            if left < 0:
                return None
        return tuple(np.concatenate(x) for x in zip(*found))
    size = np.unique(to, return_counts=True)[1]
    if len(rows) ** 2 - (size ** 2).sum() > FEW * len(rows):
        return None
    order = np.argsort(to, kind="stable")
    after = np.searchsorted(to[order], to[order], "right")  # where members of other components follow
    more, order = len(order) - after, rows[order]
    return np.repeat(order, more), order[np.repeat(after, more) + np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (party, id, text), then sketch and what the id is joined with where that is known, sorted by party -> links, one
    per class that is not its party's root."""
    for starts, columns in _meetings(batches):
        sizes = np.diff(np.append(starts, len(columns[0])))
        several = np.repeat(sizes > 1, sizes)
        if not several.any():
            continue
        columns, sizes = [c.filter(pa.array(several)) for c in columns[1:]], sizes[sizes > 1]
        ids = columns[0].to_numpy()
        sketches = sketch_words(_rows_of_bytes(columns[2], _SKETCH)) if len(columns) > 2 else None
        root = _joined(strings(columns[1]), np.cumsum(sizes) - sizes, sketches, columns[3].to_numpy() if len(columns) > 3 else None)
        own = np.flatnonzero(root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[root[own]])], names=["a", "b"])


@F.arrow_udf(ArrayType(StructType([StructField("id", LongType()), StructField("text", StringType())])))
def _pick(texts: pa.Array, wanted: pa.Array) -> pa.Array:
    """The lines of a text whose numbers are wanted, with their ids."""
    out = []
    for text, want in zip(texts.to_pylist(), wanted.to_pylist()):
        lines = text.split("\n")
        out.append([{"id": w["id"], "text": lines[w["line_no"]]} for w in want])
    return pa.array(out, pa.list_(pa.struct([("id", pa.int64()), ("text", pa.string())])))


def duplicate_lines(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, line_no, keep_doc_id, keep_line_no, kept: every line with a word, and the line its component keeps.

    Lines are what stands between \\n, compared as they are; lines without a word are in no component and have no row.
    Null doc_id counts as larger than any other. Rows alike in doc_id and text are one document, whose lines share their
    fate; rows of one doc_id (or none) with different texts are documents of their own, and of equal line numbers the text
    with the smaller hash comes first. Null and empty texts have no rows; other columns are not looked at.
    """
    return _decided(docs, block).drop("doc")


def _decided(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """duplicate_lines with `doc`, the hash of the text."""
    lines = stored(_lines(docs), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "line_no", "doc")
    classes = lines.groupBy("digest").agg(F.min(place).alias("first"), F.min("bands").alias("bands"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    slots = max(8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-classes.count() * BANDS // SLOT))
    banded = classes.select("id", "bands").mapInArrow(_deal_bands(slots), "slot long, entries binary")
    met = stored(banded.repartition("slot").sortWithinPartitions("slot").mapInArrow(_meet_in_slots(block), "party long, id long, sketch binary"), "met")
    crowded = met.filter("sketch IS NOT NULL").withColumnRenamed("party", "bucket")
    sizes = stored(crowded.groupBy(F.col("bucket").alias("_b")).agg(F.ceil(F.count("*") / block).cast("int").alias("parts")), "crowded")
    spread = crowded.join(sizes, F.col("bucket") == F.col("_b")).withColumn("mine", F.expr("pmod(xxhash64(id), parts)"))
    spread = spread.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1L)")))
    spread = spread.select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("meet"), "id", "sketch")
    apart = spread.repartition("meet").sortWithinPartitions("meet").mapInArrow(_parties, "party long, id long")
    parties = stored(met.filter("sketch IS NULL").select("party", "id").unionByName(apart).distinct(), "parties")
    drop(met, sizes)
    wanted = parties.select("id").distinct().join(classes.select("id", "first.doc_id", "first.doc", "first.line_no"), "id")
    wanted = wanted.groupBy(F.col("doc_id").alias("_doc_id"), F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("id", "line_no")).alias("wanted"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).withColumn("doc", F.xxhash64("text"))
    texts = texts.join(wanted.hint("merge"), (F.col("doc") == F.col("_doc")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))).select(F.explode(_pick("text", "wanted")).alias("x")).select("x.id", "x.text")
    texts = stored(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
    members = stored(parties.groupBy("id").agg(F.max("party").alias("own")).join(classes.select("id", F.substring("bands", BANDS * KEY_BYTES + 1, _SKETCH).alias("sketch")), "id"), "members")
    gathered = lambda rows: rows.repartition("party").sortWithinPartitions("party")
    largest = texts.join(members, "id").select(F.col("own").alias("party"), "id", "text", "sketch")
    first = stored(gathered(largest).mapInArrow(_verify, "a long, b long"), "first")
    told = members.join(first, F.col("id") == F.col("a"), "left").select("id", "own", "sketch", F.coalesce("b", "id").alias("joined"))
    told = parties.join(told, "id").select("party", "id", "sketch", "joined", (F.col("own") == F.col("party")).alias("met"))
    open_ = stored(gathered(told).mapInArrow(_left_open, "party long, id long, joined long").distinct(), "open")
    again = open_.join(texts, "id").join(members.select("id", "sketch"), "id").select("party", "id", "text", "sketch", "joined")
    linked = components(first.unionByName(gathered(again).mapInArrow(_verify, "a long, b long")), "a", "b")
    linked = linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct())
    # a line that nothing equals or is linked with keeps itself and needs no label
    grouped = stored(classes.select("id", "digest", "first", "n").join(linked, F.col("id") == F.col("node"), "left").filter("n > 1 OR component IS NOT NULL")
                     .select("digest", "first", F.coalesce("component", "id").alias("root")), "grouped")
    drop(parties, texts, members, first, open_)
    kept = grouped.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("keep"))
    labels = stored(grouped.join(kept, F.col("root") == F.col("_root")).select(F.col("digest").alias("_digest"), "keep"), "labels")
    drop(classes, grouped)
    out = lines.select("doc_id", "doc", "line_no", "digest").join(labels, F.col("digest") == F.col("_digest"), "left")
    keep = {c: F.when(F.col("_digest").isNull(), F.col(c)).otherwise(F.col(f"keep.{c}")) for c in ("doc_id", "line_no")}
    same = F.col("_digest").isNull() | F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("line_no") == F.col("keep.line_no")) & (F.col("doc") == F.col("keep.doc"))
    return out.select("doc_id", "doc", "line_no", keep["doc_id"].alias("keep_doc_id"), keep["line_no"].alias("keep_line_no"), same.alias("kept"))


@F.arrow_udf(StringType())
def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, numbers in zip(texts.to_pylist(), gone.to_pylist()):
        if text is None or not numbers:
            out.append(text)
            continue
        numbers = set(numbers)
        left = [x for i, x in enumerate(text.split("\n")) if i not in numbers]
        out.append("\n".join(left) if any(x.strip(" \t\n\x0b\x0c\r") for x in left) else None)
    return pa.array(out, pa.string())


def drop_duplicate_lines(docs: DataFrame) -> DataFrame:
    """`docs` without the lines that are not kept; n_chars, where it is a column, is the new length. A document that
    loses its last line with a word is dropped: all it said stands in other documents. Texts without a word stay."""
    found = _decided(docs).filter("NOT kept")
    gone = stored(found.groupBy(F.col("doc_id").alias("__id"), F.col("doc").alias("__doc")).agg(F.collect_set("line_no").alias("__gone")), "gone")
    same = (F.xxhash64(text_of(F.col("text"))) == F.col("__doc")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    rows = docs.join(gone.hint("merge"), same, "left").withColumn("__left", _without(F.col("text").cast("string"), "__gone"))
    rows = rows.filter(F.col("__left").isNotNull() | F.col("__gone").isNull())
    new = {"text": F.col("__left"), "n_chars": F.length("__left").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
