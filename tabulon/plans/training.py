"""Training, cross-validation, search and importance on top of `pyspark.ml`.

A `Recipe` is an unfitted configuration. Scaling and resampling are fitted inside `fit`, so they
only ever see the rows handed to it: the training split, or the training part of one fold.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, astuple, dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabulon.functions.draws import digest
from tabulon.functions.numeric import col, count_if
from tabulon.operators import linear
from tabulon.operators.encode import PopulationScaler, PopulationScalerModel
from tabulon.operators.metrics import decide, evaluate, regression_metrics
from tabulon.operators.ordered import hash_numbering
from tabulon.operators.reshape import rows_from
from tabulon.operators.resample import STRATEGIES, resample, with_class_weights
from tabulon.operators.suites import seen_rows
from tabulon.session import stored

#: Bytes of a shuffle that one task of an importance reads.
TASK_BYTES = 64 * 1024 * 1024
#: Bytes of the rows that one shuffle of an importance holds; repeats beyond it wait until the shuffles before are gone.
REPEAT_BYTES = 256 * 1024 * 1024
#: Fits of a cross-validation that run at the same time.
AT_ONCE = 4

CLASSIFIERS = ("logistic_regression", "random_forest")
REGRESSORS = ("linear", "ridge", "lasso", "forest", "boosting")


@dataclass(frozen=True)
class Recipe:
    """One configuration: model family, scaling, imbalance strategy and parameters. With scaling 'sparse' (ridge only) the
    features are vector columns that stay as they are, and the learner divides by the deviations of its training rows."""

    name: str
    model: str
    features: tuple[str, ...]
    label: str
    row_id: str
    strategy: str = "none"
    scaling: str = "standard"
    minimal_cols: tuple[str, ...] = ()
    log_cols: tuple[str, ...] = ()
    params: Mapping[str, object] = field(default_factory=dict)
    seed: int = 42

    def __post_init__(self):
        if self.model not in CLASSIFIERS + REGRESSORS:
            raise ValueError(f"unknown model {self.model!r}; expected one of {CLASSIFIERS + REGRESSORS}")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {self.strategy!r}; expected one of {STRATEGIES}")
        if self.label in self.features:
            raise ValueError(f"label {self.label!r} is among the features")
        if self.scaling == "sparse" and (self.model != "ridge" or self.strategy != "none"):
            raise ValueError("sparse scaling is for the ridge without resampling")

    @property
    def is_classifier(self) -> bool:
        return self.model in CLASSIFIERS


def estimator(recipe: Recipe, rows: int):
    """The `pyspark.ml` learner of a recipe; penalties are converted to Spark's per-row scale."""
    p = dict(recipe.params)
    base = {"featuresCol": "_features", "labelCol": recipe.label}
    if recipe.model == "logistic_regression":
        c, penalty = float(p.pop("C", 1.0)), p.pop("penalty", "l2")
        return LogisticRegression(**base, regParam=1.0 / (c * max(rows, 1)), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                                  standardization=False, maxIter=int(p.pop("maxIter", 100)), tol=float(p.pop("tol", 1e-4)), **p)
    if recipe.model == "random_forest":
        return RandomForestClassifier(**base, **{"numTrees": 100, "seed": recipe.seed, "maxDepth": 12, **p})
    if recipe.model == "linear":
        return LinearRegression(**base, regParam=0.0, solver="normal", **p)
    if recipe.model == "ridge":
        return LinearRegression(**base, regParam=float(p.pop("alpha", 1.0)) / max(rows, 1), elasticNetParam=0.0,
                                standardization=recipe.scaling == "sparse", **p)
    if recipe.model == "lasso":
        return LinearRegression(**base, regParam=float(p.pop("alpha", 0.01)), elasticNetParam=1.0, standardization=False, **p)
    if recipe.model == "forest":
        return RandomForestRegressor(**base, **{"numTrees": 300, "seed": recipe.seed, "maxDepth": 12, "minInstancesPerNode": 3,
                                                "featureSubsetStrategy": "0.33", **p})
    return GBTRegressor(**base, **{"maxIter": 100, "stepSize": 0.05, "maxDepth": 4, "minInstancesPerNode": 10,
                                   "subsamplingRate": 0.8, "seed": recipe.seed, **p})


@dataclass(frozen=True)
class FitRecord:
    """What a fit read and learned from: rows handed to it and the digest of their ids, then rows and classes after
    resampling (null for regressors), and how long scaling, resampling and learning took."""

    rows_seen: int
    seen_digest: int
    rows_fitted: int
    positives_fitted: int | None
    negatives_fitted: int | None
    fit_seconds: float


def fit(recipe: Recipe, train: DataFrame) -> PipelineModel:
    """Scale -> resample or weight -> learn, all from `train` alone. Scoring skips resampling."""
    return fit_recorded(recipe, train)[0]


def fit_recorded(recipe: Recipe, train: DataFrame) -> tuple[PipelineModel, FitRecord]:
    """`fit`, and what it saw. The counts come from the two aggregations that a fit runs anyway."""
    return _fit_alike([recipe], train, _fitted_scaler(recipe, train), map)[0]


def _scaling_of(recipe: Recipe) -> tuple:
    """Recipes with equal values here have equal scalers."""
    return recipe.row_id, tuple(recipe.features), recipe.scaling, tuple(recipe.minimal_cols), tuple(recipe.log_cols)


def _rows_of(recipe: Recipe) -> tuple:
    """Recipes with equal values here learn from equal rows."""
    return *_scaling_of(recipe), recipe.label, recipe.strategy, recipe.seed


def _fitted_scaler(recipe: Recipe, train: DataFrame) -> tuple[PopulationScalerModel, Row, float]:
    """The scaler of a recipe, what it saw, and the seconds it took."""
    start = time.perf_counter()
    scaling = "passthrough" if recipe.scaling == "sparse" else recipe.scaling
    scaler = PopulationScaler(list(recipe.features), scaling, minimal_cols=recipe.minimal_cols, log_cols=recipe.log_cols,
                              seen=seen_rows(recipe.row_id)).fit(train).held()
    seen = scaler.state["moments"].select("n_seen", "seen_digest").first()
    return scaler, seen, time.perf_counter() - start


def _fit_alike(recipes: Sequence[Recipe], train: DataFrame, scaled: tuple[PopulationScalerModel, Row, float],
               run: Callable) -> list[tuple[PipelineModel, FitRecord]]:
    """Fits of recipes of equal `_rows_of`: their rows are scaled, resampled and held once. `run` maps the fits."""
    start = time.perf_counter()
    recipe, features, (scaler, seen, seconds) = recipes[0], list(recipes[0].features), scaled
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    rows = scaler.transform(train).select(recipe.row_id, recipe.label, *features)
    weight = {}
    if recipe.strategy == "smote":
        vectors = rows.select(recipe.row_id, recipe.label, F.array(*[col(c).cast("double") for c in features]).alias("_x"))
        made = resample(vectors, recipe.label, "smote", recipe.row_id, vector="_x", seed=recipe.seed)
        prepared = made.withColumn("_features", array_to_vector("_x"))
    else:
        changed = resample(rows, recipe.label, recipe.strategy, recipe.row_id, seed=recipe.seed)
        if recipe.strategy == "class_weight":
            changed = with_class_weights(changed, recipe.label, "_weight")
            weight = {"weightCol": "_weight"}
        prepared = assembler.transform(changed)
    prepared = prepared.select(col(recipe.label).cast("double").alias(recipe.label), "_features", *weight.values())
    prepared = prepared.persist()
    try:
        y = col(recipe.label)
        n = prepared.agg(F.count(F.lit(1)).alias("rows"), count_if(y == 1).alias("pos"), count_if(y == 0).alias("neg")).first()
        seconds += time.perf_counter() - start

        def learn(r: Recipe) -> tuple[PipelineModel, FitRecord]:
            begin = time.perf_counter()
            model = estimator(replace(r, params={**r.params, **weight}), n["rows"]).fit(prepared)
            classes = (n["pos"], n["neg"]) if r.is_classifier else (None, None)
            record = FitRecord(seen["n_seen"], seen["seen_digest"], n["rows"], *classes, seconds + time.perf_counter() - begin)
            return PipelineModel([scaler, assembler, model]), record

        return list(run(learn, recipes))
    finally:
        prepared.unpersist()


def _fit_folds(recipes: Sequence[Recipe], inside: Mapping[int, DataFrame]) -> dict[tuple[int, int], tuple[PipelineModel, FitRecord]]:
    """The fits of all recipes on all training parts, by (place of the recipe, fold). A fit is a row of short jobs that wait
    for each other, so AT_ONCE of them run at the same time; at most as many training tables are held."""
    spark = next(iter(inside.values())).sparkSession
    first, alike = {}, {}
    for j, r in enumerate(recipes):
        for i in inside:
            first.setdefault((i, _scaling_of(r)), r)
            alike.setdefault((i, _rows_of(r)), []).append(j)
    with ThreadPoolExecutor(AT_ONCE) as tables, ThreadPoolExecutor(AT_ONCE) as fits:
        def on(pool: ThreadPoolExecutor, f: Callable, items: Iterable) -> list:
            return list(pool.map(inheritable_thread_target(spark)(f), items))

        scalers = dict(zip(first, on(tables, lambda x: _fitted_scaler(x[1], inside[x[0][0]]), first.items()), strict=True))

        def group(x: tuple) -> list:
            (i, _), members = x
            some = [recipes[j] for j in members]
            return _fit_alike(some, inside[i], scalers[i, _scaling_of(some[0])], lambda f, items: on(fits, f, items))

        made = on(tables, group, alike.items())
    return {(j, i): one for ((i, _), members), found in zip(alike.items(), made, strict=True) for j, one in zip(members, found, strict=True)}


def fit_table(records: Sequence[tuple[str, int, FitRecord]], spark) -> DataFrame:
    """(config, fold, what the fit saw): one row per fit."""
    return spark.createDataFrame([(c, f, *astuple(r)) for c, f, r in records], "config string, fold int, rows_seen bigint, "
                                 "seen_digest bigint, rows_fitted bigint, positives_fitted bigint, negatives_fitted bigint, fit_seconds double")


def score(model: PipelineModel, df: DataFrame, recipe: Recipe, keep: Sequence[Column] = ()) -> DataFrame:
    """(row_id, label, score): probability of class 1, or the regression prediction; then `keep`, of columns that are no features."""
    raw = model.transform(df)
    value = vector_to_array("probability")[1] if recipe.is_classifier else F.col("prediction")
    return raw.select(recipe.row_id, col(recipe.label).alias("label"), value.alias("score"), *keep)


def predict_batch(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, threshold: float) -> DataFrame:
    """Input plus score and predicted class; refuses input that carries the label. Works on streams."""
    if label in df.columns:
        raise ValueError(f"rows to be scored hold the label {label!r}")
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"scoring input lacks {missing}")
    keep = df.select(F.struct(*df.columns).alias("_in"), *[col(c).cast("double").alias(c) for c in features])
    raw = model.transform(keep).withColumn("score", vector_to_array("probability")[1])
    return raw.select("_in.*", "score", decide("score", threshold).cast("int").alias("pred"))


def metrics_of(recipe: Recipe, scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    if recipe.is_classifier:
        return evaluate(scored, "label", "score", by, threshold=0.5, strict=True)
    return regression_metrics(scored, "label", "score", by)


def run_experiment(recipe: Recipe, train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit on train, then metrics on both parts and what the fit saw: one row per part."""
    model, record = fit_recorded(recipe, train)
    both = score(model, train, recipe).withColumn("part", F.lit("train")).unionByName(
        score(model, test, recipe).withColumn("part", F.lit("test")))
    saw = [F.lit(v).cast("double" if n == "fit_seconds" else "bigint").alias(n) for n, v in asdict(record).items()]
    return metrics_of(recipe, both, ["part"]).select(F.lit(recipe.name).alias("config"), "*", *saw)


def results_table(recipes: Sequence[Recipe], train: DataFrame, test: DataFrame, part: str = "test") -> DataFrame:
    out = None
    for r in recipes:
        one = run_experiment(r, train, test).where(F.col("part") == part).drop("part")
        out = one if out is None else out.unionByName(one)
    return out


def cross_validate(df: DataFrame, recipes: Sequence[Recipe], fold: str, k: int, *, train_scores: bool = False,
                   records: list[tuple[str, int, FitRecord]] | None = None) -> DataFrame:
    """Out-of-fold scores (config, fold, row_id, label, score): every row once per configuration,
    scored by the only model that did not see it. With train_scores=True each model also scores
    its own training rows (`part` = 'train'). What each fit saw is appended to `records`."""
    fitted = _fit_folds(recipes, {i: df.where(col(fold) != i) for i in range(1, k + 1)})
    out = None
    for j, r in enumerate(recipes):
        for i in range(1, k + 1):
            model, record = fitted[j, i]
            if records is not None:
                records.append((r.name, i, record))
            valid = col(fold) == i
            rows = df.where(valid | ~valid if train_scores else valid)  # a row without fold is in no part
            part = F.when(valid, F.lit("valid")).otherwise(F.lit("train")).alias("part")
            one = score(model, rows, r, [part]).select(F.lit(r.name).alias("config"), F.lit(i).alias("fold"), "part", r.row_id, "label", "score")
            out = one if out is None else out.unionByName(one)
    return out


def _solution(recipe: Recipe, moments: linear.Moments) -> linear.Solution:
    alpha = float(recipe.params.get("alpha", {"ridge": 1.0, "lasso": 0.01}.get(recipe.model, 0.0)))
    return linear.solve(moments, recipe.model, recipe.features, alpha=alpha, scaling=recipe.scaling, minimal_cols=recipe.minimal_cols)


def cross_validate_linear(df: DataFrame, recipes: Sequence[Recipe], fold: str) -> DataFrame:
    """`cross_validate` for the linear family: all recipes and folds from the sums of one scan, and scored in one more."""
    first = recipes[0]
    if any((r.label, r.row_id) != (first.label, first.row_id) or r.strategy != "none" for r in recipes):
        raise ValueError("recipes solved together share label and row id, and resample nothing")
    moments = linear.fold_moments(df, sorted({f for r in recipes for f in r.features}), first.label, fold)
    whole = linear.total(moments)
    solutions = {(r.name, k): _solution(r, whole - m) for r in recipes for k, m in moments.items()}
    scored = linear.score(df, solutions, first.row_id, first.label, fold)
    return scored.select("config", "fold", F.lit("valid").alias("part"), first.row_id, "label", "score")


def linear_coefficients(df: DataFrame, recipe: Recipe) -> DataFrame:
    """(feature, coefficient, is_zero) of scaled features, intercept included, from the sums of one scan."""
    s = _solution(recipe, linear.total(linear.fold_moments(df, recipe.features, recipe.label)))
    rows = [(f, float(v)) for f, v in zip(s.features, s.scaled, strict=True)] + [("(intercept)", s.scaled_intercept)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double").withColumn("is_zero", F.col("coefficient") == 0)


def expand_grid(base: Recipe, grid: Mapping[str, Sequence], n_iter: int | None = None, seed: int = 42) -> list[Recipe]:
    """All parameter combinations, or `n_iter` of them in a replayable hash order."""
    import hashlib
    names = list(grid)
    combos = [dict(zip(names, values, strict=True)) for values in itertools.product(*grid.values())]
    if n_iter is not None:
        combos = sorted(combos, key=lambda c: hashlib.md5(f"{seed}|{sorted(c.items())}".encode()).hexdigest())[:n_iter]
    label = lambda c: ",".join(f"{k}={v}" for k, v in c.items())
    return [replace(base, name=f"{base.name}[{label(c)}]", params={**base.params, **c}) for c in combos]


def search(df: DataFrame, base: Recipe, grid: Mapping[str, Sequence], fold: str, k: int, *, n_iter: int | None = None,
           train_scores: bool = False) -> DataFrame:
    """Cross-validated metrics of every candidate: one row per (config, part, fold)."""
    recipes = expand_grid(base, grid, n_iter)
    oof = cross_validate(df, recipes, fold, k, train_scores=train_scores)
    return metrics_of(base, oof, ["config", "part", "fold"])


def ablation(df: DataFrame, base: Recipe, groups: Mapping[str, Sequence[str]], fold: str, k: int) -> DataFrame:
    """Feature groups added one at a time: out-of-fold scores per step."""
    recipes, used = [], []
    for i, (name, cols) in enumerate(groups.items(), start=1):
        used += list(cols)
        recipes.append(replace(base, name=f"{i}:+{name}", features=tuple(used)))
    if base.model in linear.FAMILIES and base.scaling in linear.SCALINGS and base.strategy == "none":
        return cross_validate_linear(df, recipes, fold)
    return cross_validate(df, recipes, fold, k)


def permuted(df: DataFrame, cols: Sequence[str], row_id: str, seed: int) -> DataFrame:
    """The columns (moved together) swapped between rows by a replayable permutation."""
    ids = df.select(row_id)
    a = hash_numbering(ids.withColumn("_h", digest(f"{seed}-to", row_id)), "_h", row_id).drop("_h")
    b = hash_numbering(df.select(col(row_id).alias("_src"), *[col(c).alias(f"_p_{c}") for c in cols])
                       .withColumn("_h", digest(f"{seed}-from", "_src")), "_h", "_src").drop("_h", "_src")
    swapped = a.join(b, "number").drop("number").withColumnRenamed(row_id, "_rid")
    out = df.join(swapped, col(row_id) == F.col("_rid"))
    return out.withColumns({c: F.col(f"_p_{c}") for c in cols}).drop("_rid", *[f"_p_{c}" for c in cols])


def permutation_importance(model: PipelineModel, df: DataFrame, recipe: Recipe, groups: Mapping[str, Sequence[str]],
                           metric: str, *, repeats: int = 1) -> DataFrame:
    """(feature_group, repeat, base, permuted, drop): loss of the metric when a group is shuffled."""
    scored = score(model, df, recipe).withColumn("feature_group", F.lit("")).withColumn("repeat", F.lit(0))
    for g, cols in groups.items():
        for r in range(1, repeats + 1):
            mixed = permuted(df, cols, recipe.row_id, recipe.seed * 1000 + r)
            scored = scored.unionByName(score(model, mixed, recipe).withColumn("feature_group", F.lit(g)).withColumn("repeat", F.lit(r)))
    m = metrics_of(recipe, scored, ["feature_group", "repeat"]).select("feature_group", "repeat", col(metric).alias("permuted"))
    base = m.where(F.col("repeat") == 0).select("permuted").scalar()
    return m.withColumn("base", base).where(F.col("repeat") > 0).withColumn("drop", F.col("base") - F.col("permuted"))


def linear_importance(df: DataFrame, recipe: Recipe, groups: Mapping[str, Sequence[str]], fold: str, *, repeats: int = 5) -> DataFrame:
    """(feature_group, fold, repeat, base_rmse, permuted_rmse, worse): how much the out-of-fold error of a linear model grows
    when the columns of a group trade places, together, among the rows of a fold.

    The models come from the sums of one scan. One join hands every row, in every repeat, the features of another row of its
    fold; a group's score is the row's own score plus its weights times the differences, so all groups are scored by that
    one join and one aggregation. Repeats are taken together as far as their rows fill REPEAT_BYTES, one after another at
    least, and only their errors are kept. The permutations are replayable. Rows with a null label or feature are left out.
    """
    unknown = sorted({c for cols in groups.values() for c in cols} - set(recipe.features))
    if unknown:
        raise ValueError(f"groups name {unknown}, which the recipe does not use")
    features = list(recipe.features)
    rows = df.select(col(recipe.row_id).alias("_id"), col(fold).cast("int").alias("fold"), col(recipe.label).cast("double").alias("_y"),
                     *[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]).dropna()
    moments = linear.fold_moments(df, features, recipe.label, fold)
    if not moments:
        return df.sparkSession.createDataFrame([], "feature_group string, fold int, repeat int, base_rmse double, permuted_rmse double, worse double")
    whole = linear.total(moments)
    solutions = {k: _solution(recipe, whole - m) for k, m in moments.items()}
    models = df.sparkSession.createDataFrame([(k, s.intercept, [float(w) for w in s.weights]) for k, s in solutions.items()], "fold int, _b double, _w array<double>")
    # A row of a shuffle has an id, a hash, three numbers and the features, 8 bytes each.
    width = 8 * (6 + len(features))
    together, out = max(1, int(REPEAT_BYTES // (whole.rows * width))), None
    for low in range(1, repeats + 1, together):
        high = min(low + together - 1, repeats)
        again = rows.withColumn("repeat", F.explode(F.sequence(F.lit(low), F.lit(high))))
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-whole.rows * (high - low + 1) * width // TASK_BYTES))
        one = _permuted_errors(again, recipe, groups, models, parts)
        one = one if high == repeats else stored(one, "importance", clean=True)
        out = one if out is None else out.unionByName(one)
    return rows_from(out, ["fold", "repeat", "base_rmse"], [{"feature_group": F.lit(g), "permuted_rmse": F.col(f"_g{j}"), "worse": F.col(f"_g{j}") - F.col("base_rmse")}
                                                            for j, g in enumerate(groups)])


def _permuted_errors(again: DataFrame, recipe: Recipe, groups: Mapping[str, Sequence[str]], models: DataFrame, parts: int) -> DataFrame:
    """(fold, repeat, base_rmse, _g0, _g1, ...): errors of the models in each repeat of `again`, with each group permuted."""
    features = list(recipe.features)
    numbered = lambda order, frame: hash_numbering(frame.withColumn("_h", digest(f"{recipe.seed}-{order}", "repeat", "_id")), "_h", "_id", by=["repeat", "fold"], parts=parts)
    to = numbered("to", again).drop("_h", "_id")
    source = numbered("from", again).select("repeat", "fold", "number", *[F.col(f"_x{i}").alias(f"_p{i}") for i in range(len(features))])
    w = lambda i: F.col("_w")[i]
    error = sum((w(i) * F.col(f"_x{i}") for i in range(len(features))), F.col("_b")) - F.col("_y")
    moved = [sum((w(features.index(c)) * (F.col(f"_p{features.index(c)}") - F.col(f"_x{features.index(c)}")) for c in cols), F.lit(0.0))
             for cols in groups.values()]
    meet = ["repeat", "fold", "number"]
    spread = lambda frame: frame.repartition(parts, *meet)
    pairs = spread(to).join(spread(source), meet).join(models, "fold").withColumn("_e", error)
    return pairs.groupBy("fold", "repeat").agg(F.sqrt(F.avg(F.col("_e") ** 2)).alias("base_rmse"),
                                               *[F.sqrt(F.avg((F.col("_e") + m) ** 2)).alias(f"_g{j}") for j, m in enumerate(moved)])


def importance_summary(per: DataFrame) -> DataFrame:
    """Per group: mean, sample deviation and number of folds that got worse, each fold being the mean of its repeats."""
    folds = per.groupBy("feature_group", "fold").agg(F.avg("worse").alias("_w"))
    return folds.groupBy("feature_group").agg(F.count(F.lit(1)).alias("folds"), F.avg("_w").alias("mean_worse"), F.stddev_samp("_w").alias("std_worse"),
                                              count_if(F.col("_w") > 0).alias("folds_worse"))


def impurity_importance(model: PipelineModel, recipe: Recipe, group_of: Callable[[str], str], spark) -> DataFrame:
    """Impurity importance of the fitted trees summed per feature group."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(group_of(f), f, float(v)) for f, v in zip(recipe.features, values, strict=True)]
    table = spark.createDataFrame(rows, "feature_group string, feature string, importance double")
    return table.groupBy("feature_group").agg(F.sum("importance").alias("importance"), F.count("feature").alias("features"))


def coefficients(model: PipelineModel, recipe: Recipe, spark) -> DataFrame:
    """(feature, coefficient, is_zero) of a linear model, intercept included."""
    m = model.stages[-1]
    rows = [(f, float(v)) for f, v in zip(recipe.features, m.coefficients.toArray(), strict=True)] + [("(intercept)", float(m.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double").withColumn("is_zero", F.col("coefficient") == 0)


def people_sensitivity(df: DataFrame, prefix: str, cols: Sequence[str], label: str, row_id: str, fold: str, k: int,
                       min_counts: Sequence[int]) -> DataFrame:
    """Out-of-fold scores of a ridge model for several `min_count` settings of the people encoder,
    the encoder being refitted on the training part of every fold.

    The names of a row stay a sparse vector, which the learner scales, so no row is ever as wide as the list of names.
    """
    from tabulon.operators.encode import PeopleEncoder
    from tabulon.session import stored  # looked up at each call
    out = None
    for n in min_counts:
        for i in range(1, k + 1):
            encoder = PeopleEncoder(prefix, cols, row_id, min_count=n).fit(df.where(col(fold) != i))
            names, fixed = encoder.frequent_names(), encoder.fixed_names()
            stages = [VectorAssembler(inputCols=fixed, outputCol="_people")]
            if names:
                stages = [CountVectorizerModel.from_vocabulary(names, f"{prefix}_frequent", "_hot").setBinary(True),
                          VectorAssembler(inputCols=[*fixed, "_hot"], outputCol="_people")]
            rows = PipelineModel(stages).transform(encoder.transform(df.where(col(fold).isNotNull())))
            encoded = stored(rows.select(row_id, label, fold, "_people"), "encoded")
            recipe = Recipe(f"min_count={n}", "ridge", ("_people",), label, row_id, scaling="sparse")
            one = score(fit(recipe, encoded.where(col(fold) != i)), encoded.where(col(fold) == i), recipe).select(
                F.lit(recipe.name).alias("config"), F.lit(i).alias("fold"), F.lit(len(fixed) + len(names)).alias("features"), row_id, "label", "score")
            out = one if out is None else out.unionByName(one)
    return out
