"""Token counts of a unigram segmentation, shared along a trie of pre-tokens.

A pre-token is a word with the mark ▁ in front. Its segmentation into pieces is the one with the highest sum of scores;
the pieces are those of a public vocabulary, a piece's score follows Zipf's law by its rank there, and a character that no
piece has costs its UTF-8 bytes. The distinct pre-tokens that a task has not met yet are put into a trie, level by level.
The best score of a prefix and its number of pieces are computed once per node from those of its ancestors, and words
read their counts from their last node. Documents then add up the counts of their words; no text and no list of words
leaves its task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabulon.llm.common import chunks, text_of

MARK = "▁"
#: Score per UTF-8 byte of a character outside the vocabulary.
BYTE_SCORE = -12.0
#: Longer pre-tokens are rarely shared; they are segmented one by one, by the same rule.
DEEPEST = 64
#: Words whose counts a worker keeps.
CACHE_WORDS = 1_000_000

_M = np.uint64(0x9E3779B97F4A7C15)


def piece_scores(path: str) -> dict[str, float]:
    """Ordinary pieces of a vocabulary file and their scores."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {p: -math.log(rank + 2.0) for rank, p in enumerate(pieces)}


def segment(word: str, scores: dict[str, float], longest: int) -> int:
    """Number of pieces of one pre-token. Of equal scores fewer pieces win."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode("utf-8", "surrogatepass"))
        options = [(best[end - 1][0] + BYTE_SCORE * n, -best[end - 1][1] - n)]
        for start in range(max(0, end - longest), end):
            s = scores.get(word[start:end])
            if s is not None:
                options.append((best[start][0] + s, -best[start][1] - 1))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def _roll(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    return (h + points + np.uint64(1)) * _M ^ (h >> np.uint64(29))


class Trie:
    """Segments many pre-tokens at once; the pieces are looked up by rolling hash of the last characters of a prefix."""

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores))
        keys = np.zeros(len(scores), np.uint64)
        for i, p in enumerate(scores):
            h = np.zeros(1, np.uint64)
            for c in p:
                h = _roll(h, np.array([ord(c)], np.uint64))
            keys[i] = h[0]
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.array(list(scores.values()))[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.near = np.zeros(1 << 22, bool)
        self.near[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        self.known: dict[str, int] = {}

    def _look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of hashes that are pieces, and their scores."""
        at = np.flatnonzero(self.near[(h >> np.uint64(42)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[place] == h[at]
        return at[ok], self.values[place[ok]]

    def segment_all(self, words: list[str]) -> np.ndarray:
        """Number of pieces of every word (each without a mark in front, at most DEEPEST characters)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.cumsum(sizes) - sizes
        out = np.zeros(len(words), np.int64)
        # the root: no characters. One column per length of a last piece: hash of that many last characters,
        # score and count of the prefix in front of them.
        node = np.zeros(len(words), np.int64)
        hashes = np.zeros((1, self.longest + 1), np.uint64)
        best, count = np.full((1, self.longest + 1), -np.inf), np.zeros((1, self.longest + 1), np.int32)
        best[0, 0] = 0.0
        words_left = np.arange(len(words))
        for depth in range(int(sizes.max(initial=-1)) + 1):
            char = np.full(len(words_left), ord(MARK), np.uint64) if depth == 0 else points[begin[words_left] + depth - 1].astype(np.uint64)
            key, mine = np.unique(node.astype(np.uint64) << np.uint64(21) | char, return_inverse=True)
            parent, char = (key >> np.uint64(21)).astype(np.int64), key & np.uint64((1 << 21) - 1)
            new_h = np.zeros((len(key), self.longest + 1), np.uint64)
            new_h[:, 1:] = _roll(hashes[parent, :-1], char[:, None])
            new_b, new_c = np.empty((len(key), self.longest + 1)), np.empty((len(key), self.longest + 1), np.int32)
            new_b[:, 1:], new_c[:, 1:] = best[parent, :-1], count[parent, :-1]
            utf = 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)
            top, used = new_b[:, 1] + BYTE_SCORE * utf, new_c[:, 1] + utf
            for n in range(min(self.longest, depth + 1), 0, -1):
                at, value = self._look_up(new_h[:, n])
                score, pieces = new_b[at, n] + value, new_c[at, n] + 1
                wins = (score > top[at]) | ((score == top[at]) & (pieces < used[at]))
                top[at[wins]], used[at[wins]] = score[wins], pieces[wins]
            new_b[:, 0], new_c[:, 0] = top, used
            done = sizes[words_left] == depth
            out[words_left[done]] = used[mine[done]]
            words_left, node = words_left[~done], mine[~done]
            hashes, best, count = new_h, new_b, new_c
        return out

    def counts(self, words: list[str]) -> np.ndarray:
        """Piece counts of distinct words, from what is known or by the trie of the new ones."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new = [w for w in words if w not in self.known]
        short = [w for w in new if len(w) <= DEEPEST]
        if short:
            self.known.update(zip(short, self.segment_all(short).tolist()))
        long_ = {w: segment(MARK + w, self.scores, self.longest) for w in new if len(w) > DEEPEST}
        return np.fromiter((long_[w] if w in long_ else self.known[w] for w in words), np.int64, len(words))


@lru_cache(maxsize=2)
def _trie(path: str) -> Trie:
    return Trie(piece_scores(path))


def count_texts(texts: pa.Array, trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, owner = split.flatten(), pc.list_parent_indices(split)
    real = pc.not_equal(words, "")
    words, owner = words.filter(real), np.asarray(owner.filter(real), np.int64)
    coded = words.dictionary_encode()
    each = trie.counts(coded.dictionary.to_pylist())[np.asarray(coded.indices, np.int64)]
    return np.bincount(owner, minlength=len(texts)), np.bincount(owner, weights=each, minlength=len(texts)).astype(np.int64)


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_tokens for every row of `docs`. Null, empty and blank texts have none; repeated rows give
    repeated rows; other columns are not looked at. Text outside the vocabulary counts by its bytes."""
    @F.arrow_udf(StructType([StructField("n_words", LongType()), StructField("n_tokens", LongType())]))
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [count_texts(texts.slice(a, b - a), _trie(vocabulary)) for a, b in chunks(texts)] or [(np.zeros(0, int), np.zeros(0, int))]
            yield pa.StructArray.from_arrays([pa.array(np.concatenate([p[i] for p in parts]), pa.int64()) for i in (0, 1)], names=["n_words", "n_tokens"])

    rows = docs.select("doc_id", count(text_of(F.col("text"))).alias("_n"))
    return rows.select("doc_id", "_n.n_words", "_n.n_tokens")
