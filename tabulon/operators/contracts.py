"""Contracts and checks that report instead of filtering.

All value checks of a frame are evaluated in one aggregation pass; schema checks cost no job.
Every check table has the columns (check, observed, expected, passed).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.numeric import col, count_if, finite, ratio
from tabulon.operators.reshape import rows_from

CHECK_SCHEMA = "check string, observed bigint, expected bigint, passed boolean"


@dataclass(frozen=True)
class Check:
    """An aggregate that must equal `expected`."""

    name: str
    observed: Column
    expected: int = 0


@dataclass(frozen=True)
class Contract:
    """What a table must look like before anything is computed from it."""

    columns: Sequence[str]
    numeric: Sequence[str] = ()
    exact: bool = True
    ordered: bool = False
    rows: int | None = None
    not_null: Sequence[str] = ()
    finite: Sequence[str] = ()
    domains: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in a single aggregation."""
    names = [f"_c{i}" for i in range(len(checks))]
    one = df.agg(*[c.observed.cast("bigint").alias(n) for c, n in zip(checks, names, strict=True)])
    return rows_from(one, [], [
        {"check": F.lit(c.name), "observed": F.col(n), "expected": F.lit(c.expected).cast("bigint"),
         "passed": F.coalesce(F.col(n) == F.lit(c.expected), F.lit(False))}
        for c, n in zip(checks, names, strict=True)])


def schema_checks(df: DataFrame, contract: Contract) -> list[tuple[str, int, int, bool]]:
    """Missing / unexpected columns, order and numeric types; driver-side only."""
    have, want = list(df.columns), list(contract.columns)
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    not_numeric = [c for c in contract.numeric if c in kinds and not isinstance(kinds[c], T.NumericType)]
    rows = [("required columns missing", len(missing), 0, not missing)]
    if contract.exact:
        rows.append(("unexpected columns", len(extra), 0, not extra))
    if contract.ordered:
        same = [c for c in have if c in want] == want
        rows.append(("columns out of order", int(not same), 0, same))
    rows.append(("non-numeric columns", len(not_numeric), 0, not not_numeric))
    return rows


def value_checks(contract: Contract) -> list[Check]:
    checks = [Check(f"nulls in {c}", count_if(col(c).isNull())) for c in contract.not_null]
    checks += [Check(f"non-finite in {c}", count_if(col(c).isNotNull() & ~finite(c))) for c in contract.finite]
    checks += [Check(f"outside domain in {c}", count_if(~F.coalesce(col(c).isin(list(v)), F.lit(False))))
               for c, v in contract.domains.items()]
    checks += [Check(f"domain values present in {c}", F.count_distinct(F.when(col(c).isin(list(v)), col(c))), len(v))
               for c, v in contract.domains.items()]
    checks += [Check(f"outside range in {c}", count_if(col(c).isNotNull() & ~col(c).between(lo, hi)))
               for c, (lo, hi) in contract.ranges.items()]
    if contract.rows is not None:
        checks.append(Check("row count", F.count(F.lit(1)), contract.rows))
    return checks


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Schema checks first; value checks run only on columns that exist."""
    static = schema_checks(df, contract)
    have = set(df.columns)
    usable = Contract(
        contract.columns, contract.numeric, contract.exact, contract.ordered, contract.rows,
        [c for c in contract.not_null if c in have], [c for c in contract.finite if c in have],
        {c: v for c, v in contract.domains.items() if c in have},
        {c: v for c, v in contract.ranges.items() if c in have})
    out = df.sparkSession.createDataFrame(static, CHECK_SCHEMA)
    checks = value_checks(usable)
    return out.unionByName(run_checks(df, checks)) if checks else out


class ContractError(ValueError):
    pass


def require(df: DataFrame, contract: Contract) -> DataFrame:
    """Return `df` unchanged or raise with the failed checks (one job)."""
    require_passed(check_contract(df, contract))
    return df


def require_passed(checks: DataFrame) -> None:
    """Raise with the failed checks of a check table."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        raise ContractError("; ".join(f"{r['check']}: {r['observed']}" for r in failed))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: number of checks, failures and the overall PASS / FAIL."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), count_if(~F.col("passed")).alias("failures"),
        F.when(F.bool_and("passed"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("verdict"))


def suspicious_values(df: DataFrame, cols: Sequence[str], sentinels: Sequence[float] = (-1, -999, 999)) -> DataFrame:
    """Per column: negatives, zeros, sentinel hits, distinct values, top share, constant flags."""
    from tabulon.operators.profile import value_counts
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[e for c in cols for e in (
        count_if(col(c) < 0).alias(f"{c}__neg"), count_if(col(c) == 0).alias(f"{c}__zero"),
        count_if(col(c).isin(list(sentinels))).alias(f"{c}__sent"))])
    base = rows_from(one, ["_n"], [{"column": F.lit(c), "negatives": F.col(f"{c}__neg"),
                                    "zeros": F.col(f"{c}__zero"), "sentinels": F.col(f"{c}__sent")} for c in cols])
    long = df.select(*[col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    top = value_counts(long.where(F.col("value").isNotNull()), ["column", "value"]).groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.max("n").alias("top_count"))
    return base.join(top, "column", "left").select(
        "column", "negatives", "zeros", "sentinels", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
        ratio(F.col("top_count"), F.col("_n")).alias("top_share"),
        (F.coalesce("distinct_values", F.lit(0)) <= 1).alias("is_constant"),
        F.coalesce(ratio(F.col("top_count"), F.col("_n")) > 0.95, F.lit(False)).alias("near_constant"))


def pattern_report(df: DataFrame, patterns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """name -> (column, regex): rows that match, fail to match, or are null."""
    one = df.agg(*[e for n, (c, p) in patterns.items() for e in (
        count_if(col(c).rlike(p)).alias(f"{n}__m"), count_if(~col(c).rlike(p)).alias(f"{n}__f"),
        count_if(col(c).isNull()).alias(f"{n}__n"))])
    return rows_from(one, [], [{"pattern": F.lit(n), "matching": F.col(f"{n}__m"), "failing": F.col(f"{n}__f"),
                                "nulls": F.col(f"{n}__n")} for n in patterns])


def text_hygiene(df: DataFrame, c: str) -> DataFrame:
    from tabulon.functions.text import strip
    v = col(c)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), count_if(v != strip(v)).alias("padded"),
        count_if(v.startswith("#")).alias("hash_prefixed"), count_if(v.rlike(r"[^\x00-\x7F]")).alias("non_ascii"),
        count_if(v.isNull() | (strip(v) == "")).alias("blank"))


def leakage_audit(df: DataFrame, features: Sequence[str], label: str, *, r_max: float = 0.95) -> DataFrame:
    """Per feature: equals label, |r| too high, classes disjoint, constant ratio, worst correlation.

    `label` is binary 0/1 for the disjointness test and any number for the others. One pass.
    """
    y = col(label).cast("double")
    aggs = []
    for c in features:
        x = col(c).cast("double")
        aggs += [F.bool_and(F.equal_null(x, y)).alias(f"{c}__copy"), F.corr(x, y).alias(f"{c}__r"),
                 F.max(F.when(y == 0, x)).alias(f"{c}__max0"), F.min(F.when(y == 0, x)).alias(f"{c}__min0"),
                 F.max(F.when(y == 1, x)).alias(f"{c}__max1"), F.min(F.when(y == 1, x)).alias(f"{c}__min1"),
                 F.stddev_samp(ratio(x, y)).alias(f"{c}__ratio")]
    one = df.agg(*aggs)
    return rows_from(one, [], [{
        "feature": F.lit(c), "copies_label": F.col(f"{c}__copy"), "r": F.col(f"{c}__r"),
        "suspicious_r": F.coalesce(F.abs(F.col(f"{c}__r")) > r_max, F.lit(False)),
        "disjoint": F.coalesce((F.col(f"{c}__max0") < F.col(f"{c}__min1"))
                               | (F.col(f"{c}__max1") < F.col(f"{c}__min0")), F.lit(False)),
        "constant_ratio": F.coalesce(F.abs(F.col(f"{c}__ratio")) <= 1e-8, F.lit(False))} for c in features])


def identical_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every pair of columns and whether they hold the same value on all rows (one pass)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.bool_and(F.equal_null(col(a), col(b))).alias(f"_p{i}") for i, (a, b) in enumerate(pairs)])
    return rows_from(one, [], [{"left_column": F.lit(a), "right_column": F.lit(b), "identical": F.col(f"_p{i}")}
                               for i, (a, b) in enumerate(pairs)])


def conflicting_labels(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Feature combinations that occur with more than one label: groups and rows affected."""
    groups = df.groupBy(*features).agg(F.count(F.lit(1)).alias("_n"), F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    conflict = F.col("_lo") != F.col("_hi")
    return groups.agg(F.count(F.lit(1)).alias("feature_groups"), count_if(conflict).alias("conflicting_groups"),
                      F.coalesce(F.sum(F.when(conflict, F.col("_n"))), F.lit(0)).alias("conflicting_rows"))


#: Digest limbs of a fingerprint: two of 48 bits, summed modulo 2^48.
LIMB_BITS = 48


def _millionths(x: Column) -> Column:
    """`x` rounded half away from zero, as text: in whole numbers below 2^53, where doubles still have fractions."""
    size = F.abs(x)
    small = F.when(size < F.lit(2.0 ** 53), size)
    whole = small.cast("bigint")
    whole = whole + F.when(small - whole >= F.lit(0.5), 1).otherwise(0)
    return F.when(small.isNotNull(), F.when(x < 0, -whole).otherwise(whole).cast("string")).otherwise(F.round(x).cast("decimal(38,0)").cast("string"))


def _wrapped_sum(parts: Sequence[tuple[Column, int]], bits: int) -> Column:
    """Aggregate: sum of (number * 2^shift) over rows and parts, modulo 2^bits. The numbers are below 2^24 and summed as they
    are, which holds for 2^39 rows; `bits` is 62 at most."""
    total = F.lit(0).cast("bigint")
    for number, shift in parts:
        one = F.shiftleft(F.pmod(F.coalesce(F.sum(number), F.lit(0)), F.lit(2 ** (bits - shift))), shift)
        total = F.pmod(total + one, F.lit(2 ** bits))
    return total.cast("bigint")


def row_digests(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(text, values) of every row: the MD5 of its text and a 64-bit hash of its values. The text has per column `n` for null
    or `v`, its length, `:` and its value, joined by `|`. Floating-point numbers are written as whole millionths, dates and
    times as days and microseconds since 1970. Written in steps, so that the generated code stays small."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = list(cols or df.columns)
    values = F.xxhash64(*[F.struct(F.lit(i), col(c)) for i, c in enumerate(names)])
    first, second = [values.alias("values")], ["values"]
    for i, c in enumerate(names):
        kind, v = kinds[c], col(c)
        if isinstance(kind, T.FractionalType):
            first += [F.when(finite(c), v.cast("double") * F.lit(1e6)).alias(f"_x{i}"), F.when(~finite(c), v.cast("string")).alias(f"_s{i}")]
            second.append(F.coalesce(_millionths(F.col(f"_x{i}")), F.col(f"_s{i}")).alias(f"_t{i}"))
            continue
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            v = F.unix_micros(v.cast("timestamp"))
        elif isinstance(kind, T.DateType):
            v = F.unix_date(v)
        first.append(v.cast("string").alias(f"_t{i}"))
        second.append(f"_t{i}")
    written = [F.when(t.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(t).cast("string"), F.lit(":"), t))
               for t in (F.col(f"_t{i}") for i in range(len(names)))]
    return df.select(*first).select(*second).select(F.md5(F.concat_ws("|", *written)).alias("text"), "values")


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(rows, low, high, exact): an order-independent digest of a table as a multiset of rows, equal for any partitioning.

    The first 24 hex digits of the MD5 of each row's text (`row_digests`) are two numbers; both are summed modulo 2^48. Sums, unlike
    XOR, tell how often a row occurs, and any SQL engine can repeat them. `exact` is such a sum of 64-bit hashes of the
    values as they are: it also sees changes below a millionth, but only Spark has it.
    """
    half = lambda at: F.conv(F.substring("text", at, LIMB_BITS // 8), 16, 10).cast("bigint")
    wrapped = lambda at: _wrapped_sum([(half(at), LIMB_BITS // 2), (half(at + LIMB_BITS // 8), 0)], LIMB_BITS)
    values = F.col("values")
    low = F.lit(2 ** 24 - 1)
    exact = _wrapped_sum([(F.shiftright(values, 48), 48), (F.shiftright(values, 24).bitwiseAND(low), 24), (values.bitwiseAND(low), 0)], 62)
    return row_digests(df, cols).agg(F.count(F.lit(1)).alias("rows"), wrapped(1).alias("low"), wrapped(1 + LIMB_BITS // 4).alias("high"), exact.alias("exact"))


def sql_fingerprint(table: str, cols: Mapping[str, str]) -> str:
    """SQL of `fingerprint`; the kind of each column is "text", "whole", "number", "date" or "time"."""
    forms = {"text": "{c}", "whole": "{c}::VARCHAR", "number": "round({c}::DOUBLE * 1e6)::HUGEINT::VARCHAR", "date": "date_diff('day', DATE '1970-01-01', {c}::DATE)::VARCHAR", "time": "epoch_us({c})::VARCHAR"}
    texts = [forms[kind].format(c=c) for c, kind in cols.items()]
    row = " || '|' || ".join(f"CASE WHEN {c} IS NULL THEN 'n' ELSE 'v' || length({x}) || ':' || {x} END" for c, x in zip(cols, texts))
    limb = lambda at: f"(coalesce(sum(('0x' || substr(h, {at}, {LIMB_BITS // 4}))::HUGEINT), 0) % {2 ** LIMB_BITS})::BIGINT"
    return f"SELECT count(*) AS rows, {limb(1)} AS low, {limb(1 + LIMB_BITS // 4)} AS high FROM (SELECT md5({row}) AS h FROM {table})"


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in a, only in b (with multiplicity), and whether the frames are equal.

    Both sides are collapsed to counted rows first, so no all-columns sort-merge of raw rows.
    """
    cols = a.columns
    left = a.groupBy(*cols).agg(F.count(F.lit(1)).alias("_d"))
    right = b.select(*cols).groupBy(*cols).agg((-F.count(F.lit(1))).alias("_d"))
    diff = left.unionByName(right).groupBy(*cols).agg(F.sum("_d").alias("_d"))
    return diff.agg(F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).alias("only_left"),
                    F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("only_right"),
                    F.coalesce(F.bool_and(F.col("_d") == 0), F.lit(True)).alias("equal"))


@dataclass(frozen=True)
class Rule:
    """One record rule: `error` is reported when `bad` holds."""

    error: str
    bad: Column


def number_rules(c: str, *, allow_negative: bool = True) -> list[Rule]:
    """Rules for a text cell that must hold a finite (non-negative) number."""
    from tabulon.functions.text import strict_number, strip
    v, num = col(c), strict_number(c)
    text = F.lower(strip(v.cast("string")))
    special = text.isin("nan", "inf", "-inf", "+inf", "infinity", "-infinity")
    rules = [Rule(f"{c}: missing", v.isNull() | (text == "")), Rule(f"{c}: not finite", special),
             Rule(f"{c}: not a number", v.isNotNull() & (text != "") & ~special & num.isNull())]
    if not allow_negative:
        rules.append(Rule(f"{c}: negative", F.coalesce(num < 0, F.lit(False))))
    return rules


def with_errors(df: DataFrame, rules: Sequence[Rule], name: str = "errors") -> DataFrame:
    """Add the array of all rule violations of each row (works on streams).

    The array passes through a one-element explode, so that a later filter on it reads the
    computed value: pushed below the projection it would run every rule again.
    """
    hits = F.array(*[F.when(F.coalesce(r.bad, F.lit(False)), F.lit(r.error)) for r in rules])
    computed = df.withColumn("_hits", F.array_compact(hits))
    return computed.withColumn(name, F.explode(F.array("_hits"))).drop("_hits")


def validate_records(df: DataFrame, rules: Sequence[Rule], *, fail_fast: bool = False):
    """(valid rows, quarantined rows with `errors`). fail_fast raises on the first bad row."""
    marked = with_errors(df, rules)
    bad = F.size("errors") > 0
    if fail_fast:
        stop = F.when(bad, F.raise_error(F.concat_ws("; ", "errors"))).otherwise(F.lit(True))
        return marked.where(stop.cast("boolean")).drop("errors"), marked.where(bad)
    return marked.where(~bad).drop("errors"), marked.where(bad)


def out_of_range(df: DataFrame, ranges: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add `outside`: names of columns whose value lies outside the one-row trained ranges.

    `ranges` holds <c>_min and <c>_max per column.
    """
    from tabulon.session import with_state
    marked = with_state(df, ranges, "_r")
    hits = F.array(*[F.when((col(c) < F.col(f"_r.{c}_min")) | (col(c) > F.col(f"_r.{c}_max")), F.lit(c)) for c in cols])
    return marked.withColumn("outside", F.array_compact(hits)).drop("_r")


def training_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[e for c in cols for e in (F.min(col(c)).alias(f"{c}_min"), F.max(col(c)).alias(f"{c}_max"))])


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conditions])
