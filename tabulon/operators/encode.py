"""Encoders fitted on training rows only, as `pyspark.ml` estimators.

Fitted state is a DataFrame (saved as parquet next to the parameters), so a people table with
millions of names never visits the driver.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import bucket_floor, col
from tabulon.functions.text import clean_text, name_set, slug, split_tokens, strip
from tabulon.operators.skew import attach
from tabulon.session import one_row, stored, with_state

# Indicator columns are real columns; beyond this many use `assembly.FeatureAssembler`, whose vectors have no such bound.
MAX_INDICATORS = 2000


class _StateWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        extra = {"config": json.dumps(self.model.config), "tables": sorted(self.model.state)}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)
        for name, table in self.model.state.items():
            table.write.parquet(f"{path}/state_{name}")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        state = {n: self.sparkSession.read.parquet(f"{path}/state_{n}") for n in meta["tables"]}
        model = self.cls(json.loads(meta["config"]), state)
        model._resetUid(meta["uid"])
        return model


class StateModel(Model, MLWritable, MLReadable):
    """A fitted encoder: plain-JSON configuration plus named state tables."""

    def __init__(self, config: dict | None = None, state: dict[str, DataFrame] | None = None):
        super().__init__()
        self.config, self.state = config or {}, state or {}

    def write(self) -> MLWriter:
        return _StateWriter(self)

    def settled(self, path: str):
        """Write the fitted state once and return the model reading it from there."""
        for name, table in self.state.items():
            table.write.parquet(f"{path}/state_{name}")
        spark = next(iter(self.state.values())).sparkSession
        return type(self)(self.config, {n: spark.read.parquet(f"{path}/state_{n}") for n in self.state})

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)

    def feature_names(self) -> list[str]:
        return list(self.config["features"])


class GroupMedianImputerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.config
        with_global = with_state(df, self.state["overall"], "_o")
        by = F.coalesce(col(c["by"]).cast("double"), F.col("_o.by_median"))
        keyed = with_global.withColumn("_filled_by", by).withColumn("_bucket", bucket_floor("_filled_by", c["width"]))
        medians = self.state["medians"].select(F.col("bucket").alias("_b"), F.col("median").alias("_m"))
        out = keyed.join(medians, F.col("_bucket") == F.col("_b"), "left")
        value = col(c["value"]).cast("double")
        return out.withColumns({
            c["by"]: F.col("_filled_by"), f"{c['value']}_missing": value.isNull().cast("int"),
            c["value"]: F.coalesce(value, F.col("_m"), F.col("_o.value_median")),
        }).drop("_o", "_filled_by", "_bucket", "_b", "_m")


class GroupMedianImputer(Estimator):
    """Fill `value` with the training median of its bucket of `by` (e.g. decade of year).

    Buckets with fewer than `min_group_size` known values use the overall training median; `by`
    itself is filled with its training median. Adds <value>_missing.
    """

    def __init__(self, by: str, value: str, *, width: int = 10, min_group_size: int = 30):
        super().__init__()
        self.by, self.value, self.width = by, value, width
        self.min_group_size = min_group_size

    def _fit(self, df: DataFrame) -> GroupMedianImputerModel:
        from tabulon.operators.ordered import quantiles
        rows = df.select(col(self.by).cast("double").alias("by"), col(self.value).cast("double").alias("value"))
        overall = quantiles(rows, "value", [.5], names=["value_median"]).withColumn(
            "by_median", one_row(quantiles(rows, "by", [.5], names=["m"]))["m"])
        known = with_state(rows.where(F.col("value").isNotNull()), overall, "_o").select(
            bucket_floor(F.coalesce("by", "_o.by_median"), self.width).alias("bucket"), "value")
        sizes = known.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self.min_group_size)
        medians = quantiles(known, "value", [.5], ["bucket"], names=["median"]).join(sizes, "bucket")
        return GroupMedianImputerModel(
            {"by": self.by, "value": self.value, "width": self.width,
             "features": [self.by, self.value, f"{self.value}_missing"]},
            {"overall": stored(overall, "overall"), "medians": stored(medians, "medians")})


class MultiHotModel(StateModel):
    def vocabulary(self) -> list[str]:
        """Sorted vocabulary; refuses to grow past MAX_INDICATORS columns."""
        got = [r["token"] for r in self.state["vocabulary"].limit(MAX_INDICATORS + 1).collect()]
        if len(got) > MAX_INDICATORS:
            raise ValueError(f"more than {MAX_INDICATORS} tokens: use the '{self.config['col']}_tokens' array")
        return sorted(got)

    def with_tokens(self, df: DataFrame) -> DataFrame:
        """<col>_tokens, <col>_missing and <col>_count, without a column per token."""
        c = self.config["col"]
        out = df.withColumn(f"{c}_tokens", split_tokens(c, self.config["sep"]))
        return out.withColumns({f"{c}_missing": F.col(f"{c}_tokens").isNull().cast("int"),
                                f"{c}_count": F.coalesce(F.size(F.col(f"{c}_tokens")), F.lit(0)) * F.col(f"{c}_tokens").isNotNull().cast("int")})

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.config["col"]
        out = self.with_tokens(df)
        t = F.coalesce(F.col(f"{c}_tokens"), F.array().cast("array<string>"))
        return out.withColumns({f"{c}={v}": F.array_contains(t, v).cast("int") for v in self.vocabulary()})

    def feature_names(self) -> list[str]:
        c = self.config["col"]
        return [f"{c}={v}" for v in self.vocabulary()] + [f"{c}_missing", f"{c}_count"]


class MultiHotEncoder(Estimator):
    """Indicator columns for the tokens of a delimited text column.

    Tokens unseen in training get no column but still count in <col>_count.
    """

    def __init__(self, col: str, *, sep: str = ",", min_count: int = 1):
        super().__init__()
        self.col, self.sep, self.min_count = col, sep, min_count

    def _fit(self, df: DataFrame) -> MultiHotModel:
        counts = df.select(F.explode(split_tokens(self.col, self.sep)).alias("token")).groupBy("token").agg(
            F.count(F.lit(1)).alias("n"))
        return MultiHotModel({"col": self.col, "sep": self.sep},
                             {"vocabulary": stored(counts.where(F.col("n") >= self.min_count), "vocabulary")})


class PeopleEncoderModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.config
        cols, row_id, prefix = c["cols"], c["row_id"], c["prefix"]
        # `_cnt` is how many training rows carry the name: a good guide to hot names at scoring.
        table = self.state["counts"].select(F.col("name").alias("_name"), F.col("n").alias("_cnt"))
        out = df
        # Only (row id, slot, name) is shuffled by name; the wide rows move once, by row id.
        long = df.select(row_id, F.posexplode(F.array(*[strip(s) for s in cols])).alias("_slot", "_name")).where(
            F.col("_name").isNotNull())
        found = attach(long, table, ["_name"], rows="_cnt", spread=row_id)
        per_row = found.groupBy(row_id).agg(*[
            F.max(F.when(F.col("_slot") == i, F.col("_cnt"))).alias(f"_c_{slug(s)}") for i, s in enumerate(cols)])
        out = out.join(per_row, row_id, "left")
        for s in cols:
            out = out.withColumns({f"{slug(s)}_count": F.coalesce(f"_c_{slug(s)}", F.lit(0)),
                                   f"{slug(s)}_missing": clean_text(s).isNull().cast("int")}).drop(f"_c_{slug(s)}")
        frequent = F.array_compact(F.array(*[
            F.when(F.col(f"{slug(s)}_count") >= c["min_count"], strip(s)) for s in cols]))
        out = out.withColumn(f"{prefix}_frequent", F.array_sort(F.array_distinct(frequent)))
        if len(cols) > 1:
            listed = sum((clean_text(s).isNotNull().cast("int") for s in cols), F.lit(0))
            out = out.withColumn(f"{prefix}_listed", listed)
        return out

    def feature_names(self) -> list[str]:
        """The fixed columns, then the indicators of the frequent names."""
        return self.fixed_names() + [f"{self.config['prefix']}={n}" for n in self.frequent_names()]

    def fixed_names(self) -> list[str]:
        cols = self.config["cols"]
        return ([f"{slug(s)}_count" for s in cols] + [f"{slug(s)}_missing" for s in cols]
                + ([f"{self.config['prefix']}_listed"] if len(cols) > 1 else []))

    def frequent_names(self) -> list[str]:
        got = [r["name"] for r in self.state["counts"].where(F.col("n") >= self.config["min_count"])
               .limit(MAX_INDICATORS + 1).collect()]
        if len(got) > MAX_INDICATORS:
            raise ValueError(f"more than {MAX_INDICATORS} frequent names: use the '_frequent' array")
        return sorted(got)

    def with_indicators(self, transformed: DataFrame) -> DataFrame:
        """0/1 column per frequent name from the '<prefix>_frequent' array."""
        p = self.config["prefix"]
        return transformed.withColumns({
            f"{p}={n}": F.array_contains(f"{p}_frequent", n).cast("int") for n in self.frequent_names()})


class PeopleEncoder(Estimator):
    """Training-frequency of the people named in one or several columns.

    Per column: <col>_count (training rows naming that person in any of the columns, once per row;
    0 when unseen) and <col>_missing. Pooled: <prefix>_listed and <prefix>_frequent, the sorted
    array of names with at least `min_count` training rows.
    """

    def __init__(self, prefix: str, cols: Sequence[str], row_id: str, *, min_count: int = 10):
        super().__init__()
        self.prefix, self.cols, self.row_id = prefix, list(cols), row_id
        self.min_count = min_count

    def _fit(self, df: DataFrame) -> PeopleEncoderModel:
        counts = df.select(F.explode(name_set(self.cols)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
        return PeopleEncoderModel({"prefix": self.prefix, "cols": self.cols, "row_id": self.row_id,
                                   "min_count": self.min_count}, {"counts": stored(counts, "counts")})


SCALING = ("standard", "minimal", "log_amount", "passthrough")


class PopulationScalerModel(StateModel):
    def held(self) -> PopulationScalerModel:
        """The same model with its one row of state computed once and held by the plan itself."""
        moments = self.state["moments"]
        row = moments.sparkSession.createDataFrame([moments.first()], moments.schema)
        return PopulationScalerModel(self.config, {**self.state, "moments": row})

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.config
        out = df.withColumns({x: F.log1p(col(x).cast("double")) for x in c["logged"]}) if c["logged"] else df
        if not c["scaled"]:
            return out
        out = with_state(out, self.state["moments"], "_m")
        scale = lambda x: F.coalesce(F.nullif(F.col(f"_m.{x}_std"), F.lit(0.0)), F.lit(1.0))
        return out.withColumns({x: (col(x).cast("double") - F.col(f"_m.{x}_mean")) / scale(x)
                                for x in c["scaled"]}).drop("_m")


class PopulationScaler(Estimator):
    """Standardise with training mean and population standard deviation.

    strategy: 'standard' scales all columns, 'minimal' only `minimal_cols`, 'log_amount' takes
    log1p of `log_cols` before scaling everything, 'passthrough' scales nothing.
    A constant column is centred and left unscaled. `seen` names further aggregates of the rows it is fitted on, kept in
    its state beside their number (see `suites.seen_rows`).
    """

    def __init__(self, cols: Sequence[str], strategy: str = "standard", *, minimal_cols: Sequence[str] = (),
                 log_cols: Sequence[str] = (), seen: Mapping[str, Column] | None = None):
        super().__init__()
        if strategy not in SCALING:
            raise ValueError(f"unknown strategy {strategy!r}; expected one of {SCALING}")
        self.cols, self.strategy = list(cols), strategy
        self.minimal_cols, self.log_cols = list(minimal_cols), list(log_cols)
        self.seen = dict(seen or {})

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        logged = self.log_cols if self.strategy == "log_amount" else []
        scaled = {"passthrough": [], "minimal": self.minimal_cols}.get(self.strategy, self.cols)
        x = lambda c: F.log1p(col(c).cast("double")) if c in logged else col(c).cast("double")
        seen = [c.alias(name) for name, c in self.seen.items()]
        moments = df.agg(F.count(F.lit(1)).alias("n_seen"), *seen, *[e for c in scaled for e in (
            F.avg(x(c)).alias(f"{c}_mean"), F.stddev_pop(x(c)).alias(f"{c}_std"))])
        return PopulationScalerModel({"logged": logged, "scaled": scaled, "features": self.cols}, {"moments": moments})


def imputation_plan(df: DataFrame, plan: dict[str, str], substantial_pct: float = 5.0) -> DataFrame:
    """Missing share per column next to its declared handling."""
    from tabulon.operators.profile import missing_table
    names = F.create_map(*[F.lit(x) for pair in plan.items() for x in pair])
    return missing_table(df, list(plan)).withColumn("strategy", names[F.col("column")]).withColumn(
        "substantial", F.col("missing_pct") > substantial_pct)
