"""Fill-in-the-middle: documents are cut at two line ends and their parts exchanged by rotations of one byte buffer.

1. Two line ends are drawn from the sha256 of a seed and the document's id, so a rerun cuts alike.
2. The three sentinels are inserted at the head and at the two cuts: prefix, middle and suffix stand behind their own.
3. One rotation of neighbouring blocks gives either order: (middle)(suffix) for prefix-suffix-middle,
   (prefix, middle)(suffix) for suffix-prefix-middle. A rotation is three reversals in place.
4. The way back finds the sentinels, rotates the other way and takes them out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabulon.llm.common import text_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rates:
    """Seed of the draws, share of documents (in percent) that are transformed, and of those in suffix-prefix-middle form."""

    seed: int = 7
    transformed: int = 100
    spm: int = 50


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange buffer[start:cut] and buffer[cut:end] in place: reverse each of them, then both together."""
    for a, b in ((start, cut), (cut, end), (start, end)):
        part = memoryview(buffer)[a:b]
        part[:] = bytes(part)[::-1]


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document. Without an id the number is that of the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def line_ends(text: bytes) -> list[int]:
    """Places where a line ends: behind each newline, and at the end of the text."""
    ends, at = [], text.find(b"\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find(b"\n", at + 1)
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def _characters(text: bytes) -> int:
    return len(text.decode("utf-8", "surrogatepass"))


def transform(text: bytes, doc_id: int | None, rates: Rates = Rates()) -> tuple[bytes, str, int, int | None, int | None]:
    """(output, form, lines, characters of the prefix, of the middle) of one text."""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(rates.seed, doc_id)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rates.transformed:
        return text, PLAIN, n, None, None
    first, second = ([0, *ends][i] for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    counts = _characters(text[:first]), _characters(text[first:second])
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):  # from behind, so that places stay right
        buffer[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    form = SPM if h4 % 100 < rates.spm else PSM
    rotate(buffer, 0 if form == SPM else middle, suffix, len(buffer))
    return bytes(buffer), form, n, *counts


def restore(output: bytes, form: str) -> bytes:
    """The text that `transform` turned into `output`."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    start = 0 if form == SPM else buffer.index(SUFFIX)
    moved = (buffer.index(PREFIX) if form == SPM else buffer.index(MIDDLE)) - start  # length of the block in front
    rotate(buffer, start, start + moved, len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.rindex(sentinel)
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


_RESULT = StructType([StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                      StructField("output", StringType()), StructField("output_sha256", StringType()), StructField("restored_sha256", StringType())])
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]


def _transformer(rates: Rates):
    @F.arrow_udf(_RESULT)
    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = []
        for doc_id, text in zip(ids.to_pylist(), texts.cast(pa.binary())):
            output, form, n, prefix, middle = transform(text.as_py(), doc_id, rates)
            back = restore(output, form)
            rows.append((n, form, prefix, middle, output, hashlib.sha256(output).hexdigest(), hashlib.sha256(back).hexdigest()))
        columns = [pa.array([r[i] for r in rows], pa.binary() if i == 4 else t).cast(t) for i, t in enumerate(_TYPES)]
        return pa.StructArray.from_arrays(columns, names=_RESULT.names)
    return run


def fill_in_middle(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256: one row per row of `docs`.

    Null texts count as empty; empty texts, and those that hold a sentinel, stay as they are (form plain, counts null).
    Rows without doc_id are all drawn alike, from the seed alone; rows with one doc_id share their draws. Repeated rows
    give repeated results. A text is handled whole, whatever its length. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.select("doc_id", _transformer(rates)("doc_id", "text").alias("_m")).select("doc_id", "_m.*")


def digest(made: DataFrame) -> DataFrame:
    return made.drop("output")


_DRAW = lambda i: f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT"
ORACLE_SQL = f"""
WITH rows AS (
  SELECT doc_id::BIGINT AS doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::BIGINT::VARCHAR, '')) AS h FROM documents
), cut AS (
  SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units FROM rows
), placed AS (
  SELECT *, len(units)::BIGINT AS n, least({_DRAW(0)} % (len(units) + 1), {_DRAW(1)} % (len(units) + 1)) AS a,
    greatest({_DRAW(0)} % (len(units) + 1), {_DRAW(1)} % (len(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_DRAW(2)} % 100 >= 100 THEN 'plain'
      WHEN {_DRAW(3)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts"""
