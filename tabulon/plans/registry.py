"""Registry of named queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.numeric import col
from tabulon.plans.tables import Tables
from tabulon.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def presentable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: doubles rounded, NaN as null, integers as bigint."""
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            v = c.cast("double")
            c = F.when(~F.isnan(v), F.round(v, digits) + F.lit(0.0))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register `fn(tables) -> DataFrame` under `name`; `sql` is the same result in DuckDB SQL."""
    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(Tables(configure(spark), sf_dir)), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def r(expr: str, digits: int = 6) -> str:
    """SQL twin of the rounding in `presentable`."""
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0)"


def i(expr: str) -> str:
    return f"({expr})::BIGINT"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)
