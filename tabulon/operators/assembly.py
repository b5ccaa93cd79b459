"""Feature groups assembled into sparse vectors of any width.

A group is an encoder. Its features are fixed columns, whose names are known, and indicators of the tokens of its
vocabulary, which is a table. Fitting numbers all features in one order (groups as given, fixed columns and tokens in the
encoder's order, tokens by code point): tokens are range-partitioned and counted on from the ranges before, so a vocabulary
never visits the driver. Transforming explodes the tokens of all groups of a row once, joins them with the index, which
scatters the rows of frequent tokens, and gathers each row's positions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.numeric import col
from tabulon.operators.encode import MultiHotModel, PeopleEncoderModel, StateModel
from tabulon.operators.ordered import running_totals
from tabulon.operators.skew import attach
from tabulon.session import scratch_path, stored


def _blocks(model: StateModel) -> list[tuple[str, object]]:
    """What an encoder contributes, in order: ("columns", names) or ("tokens", (array column, name prefix, table of token, n))."""
    c = model.config
    if isinstance(model, MultiHotModel):
        tokens = model.state["vocabulary"].select("token", "n")
        return [("tokens", (f"{c['col']}_tokens", c["col"], tokens)), ("columns", [f"{c['col']}_missing", f"{c['col']}_count"])]
    if isinstance(model, PeopleEncoderModel):
        tokens = model.state["counts"].where(F.col("n") >= c["min_count"]).select(F.col("name").alias("token"), "n")
        return [("columns", model.fixed_names()), ("tokens", (f"{c['prefix']}_frequent", c["prefix"], tokens))]
    return [("columns", model.feature_names())]


class FeatureAssembly:
    """Fitted groups and the index of their features."""

    def __init__(self, models: Mapping[str, StateModel], row_id: str):
        self.models, self.row_id = dict(models), row_id
        self.blocks = [(group, *block) for group, model in self.models.items() for block in _blocks(model)]
        names = [(slot, group, name, i) for slot, (group, kind, value) in enumerate(self.blocks) if kind == "columns" for i, name in enumerate(value)]
        vocabularies = [(slot, group, value) for slot, (group, kind, value) in enumerate(self.blocks) if kind == "tokens"]
        spark = next(iter(next(iter(self.models.values())).state.values())).sparkSession
        self.tokens = self._number(vocabularies, spark)
        widths = {r["slot"]: r["width"] for r in self.tokens.groupBy("slot").agg(F.count(F.lit(1)).alias("width")).collect()} if vocabularies else {}
        self.starts, at = [], 0
        for slot, (_, kind, value) in enumerate(self.blocks):  # a row per block, whatever the vocabularies hold
            self.starts.append(at)
            at += len(value) if kind == "columns" else widths.get(slot, 0)
        self.width = at
        self.columns = {name: self.starts[slot] + i for slot, _, name, i in names}
        fixed = spark.createDataFrame([(g, n, self.starts[s] + i) for s, g, n, i in names], "group string, feature string, position long")
        start = F.create_map(*[F.lit(x) for s, v in enumerate(self.starts) for x in (s, v)])
        owner = F.create_map(*[F.lit(x) for s, b in enumerate(self.blocks) for x in (s, b[0])])
        prefix = F.create_map(*[F.lit(x) for s, _, v in vocabularies for x in (s, v[1])]) if vocabularies else F.create_map()
        self.tokens = self.tokens.withColumn("position", F.col("number") + start[F.col("slot")])
        #: (group, feature, position) of every feature.
        self.index = fixed.unionByName(self.tokens.select(owner[F.col("slot")].alias("group"), F.concat_ws("=", prefix[F.col("slot")], "token").alias("feature"), "position")) \
            if vocabularies else fixed

    @staticmethod
    def _number(vocabularies, spark) -> DataFrame:
        """(slot, token, n, number) with the tokens of a slot numbered from 0 in their order."""
        schema = "slot int, token string, n long"
        rows = spark.createDataFrame([], schema)
        for slot, _, (_, _, table) in vocabularies:
            rows = rows.unionByName(table.select(F.lit(slot).alias("slot"), "token", F.col("n").cast("long").alias("n")))
        numbered = running_totals(rows.withColumn("one", F.lit(1)), ["slot"], "token", ["one"])
        return stored(numbered.select("slot", "token", "n", (F.col("cum_one") - 1).alias("number")), "features")

    def encoded(self, df: DataFrame) -> DataFrame:
        """`df` with all encoders' fixed columns and token arrays, but no column per token."""
        for model in self.models.values():
            df = model.with_tokens(df) if isinstance(model, MultiHotModel) else model.transform(df)
        return df

    def postings(self, encoded: DataFrame) -> DataFrame:
        """(row_id, position) of every indicator that is 1."""
        slots = [(slot, value[0]) for slot, (_, kind, value) in enumerate(self.blocks) if kind == "tokens"]
        marked = lambda slot: lambda token: F.struct(F.lit(slot).alias("slot"), token.alias("token"))
        arrays = [F.transform(F.coalesce(col(c), F.array().cast("array<string>")), marked(slot)) for slot, c in slots]
        each = encoded.select(self.row_id, F.explode(F.concat(*arrays)).alias("_t")).select(self.row_id, "_t.slot", "_t.token")
        # n rows of the training data have the token: a good guide to the frequent ones of any data
        found = attach(each, self.tokens.select("slot", "token", "n", "position"), ["slot", "token"], rows="n", spread=self.row_id, null_keys=False)
        return found.where(F.col("position").isNotNull()).select(self.row_id, "position")

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """(row_id, <keep>, positions, values): the features of a row that are not zero, by position. Missing values of
        fixed columns are NaN."""
        encoded = stored(self.encoded(df), "encoded")
        sparse = [kind for _, kind, _ in self.blocks if kind == "tokens"]
        fixed = [F.struct(F.lit(p).cast("long").alias("position"), F.coalesce(col(c).cast("double"), F.lit(float("nan"))).alias("value")) for c, p in self.columns.items()]
        own = F.filter(F.array(*fixed), lambda x: x["value"] != 0) if fixed else F.array().cast("array<struct<position:bigint,value:double>>")
        if sparse:
            gathered = self.postings(encoded).groupBy(col(self.row_id).alias("_row")).agg(F.collect_list(F.struct("position", F.lit(1.0).alias("value"))).alias("_flags"))
            encoded = encoded.join(gathered, col(self.row_id) == F.col("_row"), "left")
            own = F.concat(own, F.coalesce("_flags", F.array().cast("array<struct<position:bigint,value:double>>")))
        out = encoded.select(self.row_id, *keep, F.array_sort(own).alias("_x"))
        return out.select(self.row_id, *keep, F.transform("_x", lambda x: x["position"]).alias("positions"), F.transform("_x", lambda x: x["value"]).alias("values"))

    def vectors(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        """`transform` as a column of sparse `pyspark.ml` vectors. Written once and read with the vector type, which has
        the layout of the struct written."""
        rows = self.transform(df, keep)
        raw = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"), F.col("positions").cast("array<int>").alias("indices"), F.col("values"))
        out = rows.select(self.row_id, *keep, raw.alias(output))
        path = scratch_path(df.sparkSession, "vectors")
        out.write.parquet(path)
        schema = T.StructType([*out.schema.fields[:-1], T.StructField(output, VectorUDT())])
        return df.sparkSession.read.schema(schema).parquet(path)


class FeatureAssembler:
    """Unfitted feature groups by name, in order; `selected` takes some of them."""

    def __init__(self, groups: Mapping[str, Estimator], row_id: str, *, selected: Sequence[str] | None = None):
        unknown = [g for g in selected or () if g not in groups]
        if unknown:
            raise ValueError(f"unknown feature groups {unknown}; expected some of {list(groups)}")
        self.groups = {g: e for g, e in groups.items() if selected is None or g in selected}
        if not self.groups:
            raise ValueError("no feature group is selected")
        self.row_id = row_id

    def fit(self, train: DataFrame) -> FeatureAssembly:
        return FeatureAssembly({g: e.fit(train) for g, e in self.groups.items()}, self.row_id)
