"""Session helpers: input sizes, durable intermediate results, one-row state."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def configure(spark: SparkSession) -> SparkSession:
    """Settings every plan of this package relies on (all are session scoped)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def input_bytes(df: DataFrame) -> int:
    """Bytes of all leaf relations below `df` as known to Catalyst (no job is run)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. A session on one machine that names none gets a temporary one;
    a cluster must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tabulon-")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder.

    Used where a later stage must see exactly the same physical layout twice. The folder is the
    one set in `spark.checkpoint.dir` (see `shared_folder`).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery: Spark runs it once and inlines it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns])).scalar()


def with_state(df: DataFrame, state: DataFrame, name: str = "_state") -> DataFrame:
    """Attach one-row `state` to every row of `df` as the struct column `name`."""
    return df.withColumn(name, one_row(state))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for written results, below the shared checkpoint folder where one is set."""
    import uuid
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's own setting: shuffle files of an execution are removed at its end, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, *, clean: bool = False) -> DataFrame:
    """Write `df` once below the shared folder and read it back: cuts the lineage and gives the
    planner exact sizes for everything built on it. With `clean` the shuffle files of the write go
    as soon as it has ended; nothing that `df` reads may be cached then."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP)
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_turn(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of all frames (one at least, of one schema) in one table like that of `stored`. They are
    written one after another, and the shuffle files of one go before the next is asked for."""
    path = None
    for df in frames:
        spark, schema = df.sparkSession, df.schema
        path, before = path or scratch_path(spark, name), spark.conf.get(CLEANUP)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(schema).parquet(path)
