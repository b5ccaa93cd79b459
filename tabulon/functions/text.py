"""Text parsing and cleaning as column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulon.functions.numeric import col

# Fixed formats of the dirty text columns.
YEAR_PATTERN = r"^\((\d{4})\)$"
MINUTES_PATTERN = r"^(\d+) min$"
GROUPED_INT_PATTERN = r"^\d{1,3}(,\d{3})*$"

_LEADING_BLANK = r"(?U)^\s+"
_TRAILING_BLANK = r"(?U)\s+$"


def strip(c: str | Column) -> Column:
    """Remove every kind of Unicode blank at both ends."""
    return F.regexp_replace(F.regexp_replace(col(c), _LEADING_BLANK, ""), _TRAILING_BLANK, "")


def clean_text(c: str | Column) -> Column:
    """Strip; blank text becomes null."""
    return F.nullif(strip(c), F.lit(""))


def _first_group(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def parse_year(c: str | Column) -> Column:
    """'(2019)' -> 2019.0, anything else null."""
    return _first_group(col(c), YEAR_PATTERN).cast("double")


def parse_minutes(c: str | Column) -> Column:
    """'109 min' -> 109.0, anything else null."""
    return _first_group(col(c), MINUTES_PATTERN).cast("double")


def parse_grouped_int(c: str | Column) -> Column:
    """'25,732' -> 25732.0; text without proper thousands groups ('25732', '$5.16M') is null."""
    v = col(c)
    return F.when(v.rlike(GROUPED_INT_PATTERN), F.regexp_replace(v, ",", "").cast("double"))


def lenient_year(c: str | Column) -> Column:
    """Accepts '(2024)', '2024' and '2024.0'; anything else is null."""
    text = strip(col(c).cast("string"))
    wrapped = F.concat(F.lit("("), F.substring_index(text, ".", 1), F.lit(")"))
    return parse_year(F.when(text.startswith("("), text).otherwise(wrapped))


def lenient_minutes(c: str | Column) -> Column:
    """Accepts '120 min', '120' and '120.0'; anything else is null."""
    text = strip(col(c).cast("string"))
    suffixed = F.concat(F.substring_index(text, ".", 1), F.lit(" min"))
    return parse_minutes(F.when(text.endswith("min"), text).otherwise(suffixed))


def split_tokens(c: str | Column, sep: str = ",") -> Column:
    """Distinct stripped tokens in first-seen order; null when there is none."""
    tokens = F.array_distinct(F.filter(F.transform(F.split(col(c), sep), strip), lambda t: t != ""))
    return F.when(F.size(tokens) > 0, tokens)


def malformed(raw: str | Column, parsed: str | Column) -> Column:
    """Text was given but did not parse."""
    return col(raw).isNotNull() & col(parsed).isNull()


def flag_below(c: str | Column, limit: float) -> Column:
    """value < limit with null counting as false."""
    return F.coalesce(col(c) < F.lit(limit), F.lit(False))


def name_set(cols: list[str]) -> Column:
    """Sorted distinct non-blank names over several slot columns."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[clean_text(c) for c in cols]))))


def repeats_a_name(cols: list[str]) -> Column:
    """True when one name fills more than one slot of the row."""
    names = F.array_compact(F.array(*[clean_text(c) for c in cols]))
    return F.size(names) > F.size(F.array_distinct(names))


def strict_number(c: str | Column) -> Column:
    """Text to double where the text is a plain finite number, else null (booleans do not pass)."""
    text = strip(col(c).cast("string"))
    number = F.when(text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return F.when(F.abs(number) != F.lit(float("inf")), number)


def group_key(title: str, year: str, row_id: str) -> Column:
    """Normalised 'title|year' key; a blank title gets a key of its own from the row id.

    Case is folded with `lower`, which differs from full Unicode case folding for a few letters
    such as the sharp s.
    """
    flat = F.lower(F.regexp_replace(strip(F.coalesce(col(title), F.lit(""))), r"(?U)\s+", " "))
    y = F.coalesce(col(year).cast("int").cast("string"), F.lit("NA"))
    return F.when(flat == "", F.concat(F.lit("no title|"), col(row_id).cast("string"))).otherwise(
        F.concat_ws("|", flat, y))


def slug(name: str) -> str:
    """Column-name slug used for encoder outputs."""
    return name.lower().replace(" ", "_")
