"""Structured Streaming counterparts of the batch operators; the expressions are the same."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tabulon.functions.numeric import col
from tabulon.operators.contracts import Rule, with_errors
from tabulon.plans.training import predict_batch


def read_stream(spark: SparkSession, folder: str, file_glob: str, schema) -> DataFrame:
    """Parquet files appearing in `folder` as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(folder)


def quarantine(stream: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rows with `errors`; start one sink on each."""
    marked = with_errors(stream, rules)
    bad = F.size("errors") > 0
    return marked.where(~bad).drop("errors"), marked.where(bad)


def keep_both(rules: Sequence[Rule], path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer: valid and rejected rows of a batch in one write, below a folder named by the batch id.

    The write replaces that folder, so a batch that is run again after a failure neither doubles nor loses rows, and both
    sides of a batch appear together.
    """
    def keep(batch: DataFrame, epoch: int) -> None:
        marked = with_errors(batch, rules).withColumn("rejected", F.size("errors") > 0)
        marked.write.mode("overwrite").partitionBy("rejected").parquet(f"{path}/data/epoch={epoch}")
    return keep


def run_both(stream: DataFrame, rules: Sequence[Rule], path: str) -> tuple[DataFrame, DataFrame]:
    """Process everything available: (valid rows, rejected rows with their `errors`), each with the `epoch` it came in.

    The stream must not have columns named errors, rejected or epoch. A later call with the same path goes on where the
    last one stopped.
    """
    taken = {"errors", "rejected", "epoch"} & set(stream.columns)
    if taken:
        raise ValueError(f"the stream has columns of reserved names: {', '.join(sorted(taken))}")
    q = (stream.writeStream.foreachBatch(keep_both(rules, path)).option("checkpointLocation", f"{path}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    fields = [*with_errors(stream, rules).schema.fields, StructField("epoch", LongType()), StructField("rejected", BooleanType())]
    rows = stream.sparkSession.read.schema(StructType(fields)).parquet(f"{path}/data")
    return rows.where(~F.col("rejected")).drop("errors", "rejected"), rows.where("rejected").drop("rejected")


def hourly_counts(stream: DataFrame, ts: str, kind: str, *, lateness: str = "1 hour") -> DataFrame:
    """Rows per hour and kind with a watermark."""
    return (stream.withColumn("_ts", col(ts).cast("timestamp")).withWatermark("_ts", lateness)
            .groupBy(F.window("_ts", "1 hour"), kind).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("hour_start"), kind, "n"))


def drop_duplicates(stream: DataFrame, keys: Sequence[str], ts: str, *, lateness: str = "1 hour") -> DataFrame:
    """Exact duplicates within the watermark removed; state is bounded by the lateness."""
    return (stream.withColumn("_ts", col(ts).cast("timestamp")).withWatermark("_ts", lateness)
            .dropDuplicatesWithinWatermark(list(keys)).drop("_ts"))


def score_stream(stream: DataFrame, model: PipelineModel, features: Sequence[str], label: str, threshold: float) -> DataFrame:
    return predict_batch(model, stream, features, label, threshold)


def run_once(stream: DataFrame, path: str, *, mode: str = "append", keys: tuple[str, ...] = ()) -> DataFrame:
    """Process everything available into parquet files under `path` and read them back.

    `update` output needs the `keys` of a row: each batch writes the rows it changed (again, if it is replayed), and the
    latest of each key is read. State behind the watermark is dropped and late rows are refused, as in append mode.
    """
    spark = stream.sparkSession
    if mode == "append":
        q = (stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint")
             .outputMode("append").trigger(availableNow=True).start())
    else:
        def keep(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/data/epoch={epoch}")
        q = (stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint")
             .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if mode == "append":
        return spark.read.schema(stream.schema).parquet(f"{path}/data")
    rows = spark.read.schema(StructType([*stream.schema.fields, StructField("epoch", LongType())])).parquet(f"{path}/data")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "epoch").alias("_row"))
    return last.select("_row.*")
