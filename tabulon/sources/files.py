"""Reading raw tables under a contract, record sources, result sinks and model bundles."""

from __future__ import annotations

import json
import platform
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.numeric import col, count_if
from tabulon.operators.contracts import Contract, ContractError, fingerprint, require
from tabulon.operators.dedupe import dedupe_first


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, *, encoding: str = "UTF-8",
             contract: Contract | None = None, strict: bool = False, row_id: str | None = None, **options) -> DataFrame:
    """CSV with a declared schema; `options` are Spark's. strict=True fails on malformed lines.

    With a `row_id` exact duplicates over the other columns are dropped, first copy kept.
    """
    df = (spark.read.schema(schema).option("header", True).option("encoding", encoding)
          .option("mode", "FAILFAST" if strict else "PERMISSIVE").option("enforceSchema", False).options(**options).csv(path))
    if contract is not None:
        df = require(df, contract)
    if row_id is not None:
        df = dedupe_first(df, [c for c in df.columns if c != row_id], row_id)
    return df


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"the file has no column {', '.join(missing)}")
    return df


def read_records(df: DataFrame, text: str, schema: str, *, name: str = "record") -> DataFrame:
    """JSON text column to a struct column; text that is not a JSON object gives `corrupt` = true."""
    parsed = F.from_json(col(text), f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    out = df.withColumn(name, parsed)
    return out.withColumn("corrupt", F.col(name).isNull() | F.col(f"{name}._corrupt").isNotNull())


def parse_number_record(text: str | Column, fields: list[str]) -> Column:
    """JSON object or delimited numbers (commas / newlines) to an array of raw text cells.

    Null when the number of cells is wrong; cells are validated afterwards with `number_rules`.
    """
    t = F.trim(col(text))
    as_map = F.from_json(t, "map<string,string>")
    from_object = F.array(*[as_map.getItem(f) for f in fields])
    cells = F.filter(F.transform(F.split(F.regexp_replace(t, "\n", ","), ","), lambda x: F.trim(x)), lambda x: x != "")
    from_list = F.when(F.size(cells) == len(fields), cells)
    return F.when(t.startswith("{"), from_object).otherwise(from_list)


def write_results(df: DataFrame, path: str, fmt: str = "csv", *, digits: int = 10) -> str:
    """Write a result table. CSV doubles get a fixed number of decimals; only small tables belong here."""
    if fmt == "csv":
        fixed = [F.format_string(f"%.{digits}f", col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                 else col(f.name) for f in df.schema.fields]
        fixed = [F.when(col(f.name).isNotNull(), c).alias(f.name) for f, c in zip(df.schema.fields, fixed, strict=True)]
        df.select(*fixed).write.option("header", True).csv(path)
    elif fmt == "json":
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
    elif fmt == "parquet":
        df.write.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return path


#: Version of the layout of a bundle; others are refused.
BUNDLE_FORMAT = 1


def training_summary(train: DataFrame, features: Sequence[str], label: str) -> dict:
    """Rows, class counts (labels 0/1, else none) and the range of every feature, from one aggregation."""
    y = col(label)
    one = train.agg(F.count(F.lit(1)).alias("rows"), count_if(y == 1).alias("pos"), count_if(y == 0).alias("neg"),
                    *[e for i, c in enumerate(features) for e in (F.min(col(c).cast("double")).alias(f"lo{i}"), F.max(col(c).cast("double")).alias(f"hi{i}"))]).first()
    binary = one["pos"] + one["neg"] == one["rows"]
    return {"rows": one["rows"], "classes": {"1": one["pos"], "0": one["neg"]} if binary else None,
            "ranges": {c: [one[f"lo{i}"], one[f"hi{i}"]] for i, c in enumerate(features)}}


def _stages(model: PipelineModel) -> list[dict]:
    """Class and settings of every stage, in order."""
    out = []
    for s in model.stages:
        settings = s.config if hasattr(s, "config") else {p.name: v for p, v in s.extractParamMap().items()}
        out.append({"class": type(s).__name__, "params": json.loads(json.dumps(settings, default=str, sort_keys=True))})
    return out


def _parts_digest(spark: SparkSession, path: str) -> dict:
    """Number and digest of the files of the saved pipeline: Spark hashes each by its place and content."""
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/model")
    named = parts.select(F.regexp_extract("path", "/model/(.*)$", 1).alias("place"), F.sha2("content", 256).alias("sha"))
    one = fingerprint(named).first()
    return {"files": one["rows"], "low": one["low"], "high": one["high"]}


def save_bundle(model: PipelineModel, metadata: dict, path: str, spark: SparkSession) -> str:
    """Fitted pipeline plus one metadata row: what is given (features in order, threshold, label, `training_summary`), and
    a manifest of format, versions, stages with their settings, and the digest of the saved parts."""
    check_metadata(metadata)
    check_features(model, metadata["features"])
    model.write().overwrite().save(f"{path}/model")
    manifest = {"format": BUNDLE_FORMAT, "versions": {"spark": spark.version, "python": platform.python_version()},
                "stages": _stages(model), "parts": _parts_digest(spark, path)}
    text = json.dumps({**metadata, "manifest": manifest})
    spark.createDataFrame([(text,)], "metadata string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def check_metadata(metadata: dict) -> dict:
    missing = [k for k in ("features", "threshold", "label") if k not in metadata]
    if missing:
        raise ContractError(f"bundle metadata lacks {missing}")
    if not 0 < metadata["threshold"] < 1:
        raise ContractError(f"threshold must lie in (0, 1), got {metadata['threshold']}")
    if len(set(metadata["features"])) != len(metadata["features"]):
        raise ContractError("feature names repeat")
    absent = sorted(set(metadata["features"]) ^ set(metadata.get("ranges") or metadata["features"]))
    if absent:
        raise ContractError(f"features and ranges differ in {absent}")
    return metadata


def check_features(model: PipelineModel, features: Sequence[str]) -> None:
    """The features, in this order, are those that the stages read."""
    for s in model.stages:
        if isinstance(s, VectorAssembler) and list(s.getInputCols()) != list(features):
            raise ContractError(f"the pipeline assembles {list(s.getInputCols())}, the bundle lists {list(features)}")
        width = getattr(s, "numFeatures", None)
        if isinstance(width, int) and width != len(features):
            raise ContractError(f"the learner reads {width} features, the bundle lists {len(features)}")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """Pipeline and metadata, after their format, files, stages and features were found to agree."""
    metadata = bundle_metadata(spark, path)
    manifest = metadata.get("manifest")
    if manifest is None or manifest.get("format") != BUNDLE_FORMAT:
        raise ContractError(f"bundle format {manifest and manifest.get('format')!r}; expected {BUNDLE_FORMAT}")
    found = _parts_digest(spark, path)
    if found != manifest["parts"]:
        raise ContractError(f"saved parts changed: {found} instead of {manifest['parts']}")
    model = PipelineModel.load(f"{path}/model")
    if _stages(model) != manifest["stages"]:
        raise ContractError("stages or their settings differ from the manifest")
    check_features(model, metadata["features"])
    return model, metadata


def bundle_metadata(spark: SparkSession, path: str) -> dict:
    return check_metadata(json.loads(spark.read.text(f"{path}/metadata").first()["value"]))
