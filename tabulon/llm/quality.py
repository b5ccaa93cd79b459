"""Quality rules with thresholds that follow the data of each language and source.

Per text, counts of words, symbols, repeated lines and repeated five-word windows are taken. Fixed base rules reject what
is hopeless anywhere. All other cutoffs come from quantile sketches (Spark's mergeable `percentile_approx`) per
(lang, source): a text is rejected when a ratio lies far outside the middle half of its own group. The thresholds are a
table of one row per group, joined back to the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import blank_bytes, chunks, per_text, stored, utf8, word_starts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_echoes")
STATS = "__quality_stats"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Ratios that are judged: name -> (expression over the counts, smallest distance from the quartile that counts as far).
RATIOS = {
    "symbols": ("n_symbols / n_words", 0.1),
    "word_length": ("word_chars / n_words", 2.0),
    "dup_lines": ("n_dup_lines / n_lines", 0.5),
    "repeats": ("n_repeat_words / n_words", 0.2),
    "echoes": ("n_echoes / n_words", 0.2),
    "upper": ("n_upper / word_chars", 0.2),
}
#: Interquartile ranges beyond the quartile at which a ratio is rejected.
REACH = 6.0
#: Relative accuracy of the sketches (ranks within 1/ACCURACY).
ACCURACY = 10_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_MIX = np.random.default_rng(5).integers(1 << 62, 1 << 63, WINDOW + 1, dtype=np.uint64) | np.uint64(1)


def _repeated_words(texts: pa.Array, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text inside a five-word window that the text holds twice or more, and words equal to the one before."""
    words = pc.ascii_split_whitespace(texts).flatten()
    words = words.filter(pc.not_equal(words, ""))
    codes = np.asarray(words.dictionary_encode().indices).astype(np.uint64)
    text_of_word = np.repeat(np.arange(len(n_words)), n_words)
    echo = 1 + np.flatnonzero((codes[1:] == codes[:-1]) & (text_of_word[1:] == text_of_word[:-1]))
    echoes = np.bincount(text_of_word[echo], minlength=len(n_words)).astype(np.int64)
    if len(codes) < WINDOW:
        return np.zeros(len(n_words), np.int64), echoes
    n = len(codes) - WINDOW + 1
    starts = np.flatnonzero(text_of_word[:n] == text_of_word[WINDOW - 1:])
    key = text_of_word[starts].astype(np.uint64) * _MIX[WINDOW]
    for j in range(WINDOW):
        x = codes[starts + j] * _MIX[j]
        key += (x ^ (x >> np.uint64(29))) * _MIX[(j + 1) % WINDOW]
    order = np.argsort(key, kind="stable")
    twin = np.zeros(len(starts), bool)
    same = key[order[1:]] == key[order[:-1]]
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts[twin], 1)
    np.add.at(edge, starts[twin] + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(text_of_word[covered], minlength=len(n_words)).astype(np.int64), echoes


def _line_counts(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    if not text or "\n" not in text:
        return int(bool(text and text.strip(" \t\n\x0b\x0c\r"))), 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def _counts(texts: pa.Array) -> pa.StructArray:
    texts = pc.fill_null(texts, "")
    data, offsets = utf8(texts)
    blank = blank_bytes(data)
    starts = word_starts(data, offsets)
    n_words = np.diff(np.searchsorted(starts, offsets)).astype(np.int64)
    lines = np.array([_line_counts(x) for x in texts.to_pylist()], np.int64).reshape(-1, 2)
    repeats, echoes = _repeated_words(texts, n_words)
    columns = {
        "n_words": n_words,
        "word_chars": per_text(~blank & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeats,
        "n_lines": lines[:, 0],
        "n_upper": per_text(_UPPER[data], offsets),
        "n_echoes": echoes,
    }
    return pa.StructArray.from_arrays([pa.array(columns[c]) for c in COUNTS], names=list(COUNTS))


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [_counts(texts.slice(a, b - a)) for a, b in chunks(texts)]
        yield pa.concat_arrays(parts) if parts else _counts(texts)


def text_counts(text: Column) -> Column:
    """Struct of COUNTS for a text column. Null text counts as empty."""
    return _counts_udf(text.cast("string"))


def base_failed(counts: str = STATS) -> Column:
    return F.expr(f"`{counts}`.n_words < 10 OR 100 * `{counts}`.n_repeat_words > 20 * `{counts}`.n_words")


def _ratio(name: str, counts: str = STATS) -> Column:
    top, bottom = RATIOS[name][0].split(" / ")
    return F.expr(f"try_divide(cast(`{counts}`.{top} AS double), `{counts}`.{bottom})")


def thresholds(df: DataFrame, reach: float = REACH, accuracy: int = ACCURACY) -> DataFrame:
    """(lang, source, low and high per ratio) of every group, from the texts that pass the base rules.

    Quantile sketches are built per task and merged, so a group with a third of all rows costs no more than its sketch.
    A group in which no text passes has no row: its texts fail the base rules anyway.
    """
    quartiles = [F.percentile_approx(_ratio(n), [0.25, 0.75], accuracy).alias(n) for n in RATIOS]
    fitted = df.filter(~base_failed()).groupBy("lang", "source").agg(*quartiles)
    bounds = []
    for n, (_, least) in RATIOS.items():
        gap = F.greatest((F.col(n)[1] - F.col(n)[0]) * reach, F.lit(least))
        bounds += [(F.col(n)[0] - gap).alias(f"{n}_low"), (F.col(n)[1] + gap).alias(f"{n}_high")]
    return fitted.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *bounds)


def judge(df: DataFrame, limits: DataFrame) -> DataFrame:
    """`df` (with its STATS) and the columns __base_failed and __kept."""
    inside = F.lit(True)
    for n in RATIOS:
        inside &= F.coalesce(_ratio(n).between(F.col(f"{n}_low"), F.col(f"{n}_high")), F.lit(True))
    joined = df.join(limits, df["lang"].eqNullSafe(limits["__lang"]) & df["source"].eqNullSafe(limits["__source"]), "left")
    return joined.select(*[df[c] for c in df.columns], base_failed().alias("__base_failed"), (~base_failed() & inside).alias("__kept"))


def with_counts(docs: DataFrame) -> DataFrame:
    return docs.withColumn(STATS, text_counts(F.col("text")))


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every row of `docs`.

    Null and empty texts have no words and fail the base rules. Null lang or source is a group of its own. Repeated rows
    give repeated rows. Other columns of `docs`, whatever their names, are not looked at.
    """
    counted = stored(with_counts(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality")
    judged = judge(counted, stored(thresholds(counted), "thresholds"))
    return judged.select("doc_id", *[F.col(STATS)[c].alias(c) for c in COUNTS[:5]], F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, all columns as they were. The counts are taken a second time rather than joined, so
    texts are not shuffled and rows need no key."""
    fitted = stored(with_counts(docs.select("text", "lang", "source")).drop("text"), "quality")
    limits = stored(thresholds(fitted), "thresholds")
    return judge(with_counts(docs), limits).filter("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])
