"""Whole preparation flows: check, split, fit on train, transform both parts, check again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col, count_if, finite
from tabulon.functions.text import (clean_text, flag_below, lenient_minutes, lenient_year, malformed, parse_grouped_int,
                                    parse_minutes, parse_year, split_tokens)
from tabulon.operators.contracts import Check, Contract, require, require_passed, run_checks
from tabulon.operators.dedupe import dedupe_first
from tabulon.operators.encode import PopulationScaler, PopulationScalerModel
from tabulon.operators.skew import attach
from tabulon.operators.splits import Split, split
from tabulon.operators.suites import preprocessor_checks, seen_rows
from tabulon.session import scratch_path, stored


@dataclass(frozen=True)
class Prepared:
    """Raw split, transformed parts, the fitted preprocessor and the checks they passed."""

    split: Split
    scaler: PopulationScalerModel
    train: DataFrame
    test: DataFrame
    features: tuple[str, ...]
    label: str
    checks: DataFrame

    @property
    def feature_names(self) -> list[str]:
        """Names of the transformed features, in order."""
        return self.scaler.feature_names()


def prepare(df: DataFrame, contract: Contract, features: Sequence[str], label: str, row_id: str, *, test: float = 0.2,
            seed: int = 42, scaling: str = "standard", stratify: bool = False) -> Prepared:
    """Contract -> split -> fit scaler on train -> transform both -> check what came out.

    The split is stored once, partitioned by part, and the fitted state is one row; a failed check raises.
    """
    if label in features:
        raise ValueError(f"label {label!r} is among the features")
    spark = df.sparkSession
    parts = split(require(df, contract), row_id, test=test, seed=seed, stratify=label if stratify else None).saved(
        scratch_path(spark, "prepared-split"))
    scaler = PopulationScaler(features, scaling, seen=seen_rows(row_id)).fit(parts.train).held()
    train, test_rows = scaler.transform(parts.train), scaler.transform(parts.test)
    checks = stored(preprocessor_checks(parts.frame, train, test_rows, features, row_id, [scaler]), "prepared-checks")
    require_passed(checks)
    return Prepared(parts, scaler, train, test_rows, tuple(features), label, checks)


def transformed_checks(df: DataFrame, features: Sequence[str], expected_rows: int) -> DataFrame:
    """Row count, missing and non-finite cells of a feature matrix."""
    return run_checks(df, [
        Check("rows", F.count(F.lit(1)), expected_rows),
        Check("missing cells", F.sum(sum((col(c).isNull().cast("int") for c in features), F.lit(0)))),
        Check("non-finite cells", F.sum(sum((count_flag(c) for c in features), F.lit(0))))])


def count_flag(c: str):
    return (col(c).isNotNull() & ~finite(c)).cast("int")


def leak_proof(frame: DataFrame, state: DataFrame, features: Sequence[str]) -> DataFrame:
    """Does the fitted state equal train-only statistics, and differ from all-row statistics?"""
    train = F.col("split") == "train"
    stats = frame.agg(*[e for c in features for e in (
        F.avg(F.when(train, col(c))).alias(f"{c}_train"), F.avg(col(c)).alias(f"{c}_all"))], count_if(train).alias("n_train"))
    from tabulon.operators.reshape import rows_from
    from tabulon.session import with_state
    both = with_state(stats, state, "_s")
    return rows_from(both, [], [{
        "feature": F.lit(c), "fitted_on_train": F.abs(F.col(f"_s.{c}_mean") - F.col(f"{c}_train")) < 1e-6 * (1 + F.abs(f"{c}_train")),
        "differs_from_all": F.abs(F.col(f"_s.{c}_mean") - F.col(f"{c}_all")) > 0,
        "saw_train_rows_only": F.col("_s.n_seen") == F.col("n_train")} for c in features])


def clean_titles(raw: DataFrame) -> DataFrame:
    """Row-wise cleaning of the dirty metadata table; raw text stays beside the parsed columns."""
    out = raw.withColumns({c: clean_text(c) for c in ("name", "genre", "director", "actor_1", "actor_2", "actor_3")})
    return out.withColumns({
        "year_raw": col("year"), "year": parse_year("year"), "duration_min": parse_minutes("duration"),
        "votes_num": parse_grouped_int("votes")}).withColumns({
            "duration_questionable": flag_below("duration_min", 40), "votes_malformed": malformed("votes", "votes_num"),
            "genre_list": split_tokens("genre")})


def modelling_frame(raw: DataFrame, row_id: str, target: str) -> DataFrame:
    """Exact duplicates out (first kept), rows with a target only, (name, year) repeats flagged."""
    cols = [c for c in raw.columns if c != row_id]
    rated = clean_titles(dedupe_first(raw, cols, row_id)).where(col(target).isNotNull())
    groups = rated.groupBy("name", "year").agg(F.count(F.lit(1)).alias("_repeat"))
    return attach(rated, groups, ["name", "year"], rows="_repeat", spread=row_id).withColumn(
        "name_year_repeat", F.col("_repeat") > 1).drop("_repeat")


def prepare_records(df: DataFrame) -> DataFrame:
    """Loose scoring input to feature columns: year and duration in any accepted spelling, absent
    optional fields null, target and votes ignored. `usable` is false without a year."""
    if "year" not in df.columns:
        raise ValueError("records need a year")
    get = lambda c: col(c) if c in df.columns else F.lit(None).cast("string")
    keep = [c for c in df.columns if c not in ("year", "duration", "genre", "director", "actor_1", "actor_2", "actor_3",
                                               "rating", "votes")]
    out = df.select(*keep, lenient_year("year").alias("year"), lenient_minutes(get("duration")).alias("duration_min"),
                    *[clean_text(get(c)).alias(c) for c in ("genre", "director", "actor_1", "actor_2", "actor_3")])
    return out.withColumn("usable", col("year").isNotNull())
