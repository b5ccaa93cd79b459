"""Queries: splits, folds, encoders fitted on train, class weights and resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numeric import col, count_if
from tabulon.functions.text import group_key
from tabulon.operators import encode as E
from tabulon.operators import resample as B
from tabulon.operators import splits as L
from tabulon.operators.assembly import FeatureAssembler
from tabulon.operators.contracts import Check, Contract, fingerprint, run_checks, sql_fingerprint
from tabulon.operators.profile import describe
from tabulon.operators.relate import compare_counts
from tabulon.operators.suites import MODULUS, preprocessor_checks, resampling_checks, seen_rows
from tabulon.plans import preparation as prep
from tabulon.plans.q_relate import sql_split
from tabulon.plans.registry import query, r, union
from tabulon.plans.tables import LINE_NUMERIC, SQL_RATED, SQL_TRANSACTIONS, Tables, sql_digest
from tabulon.session import scratch_path, stored


def sql_folds(table: str, key: str, k: int, seed: int = 42, strata: str = "", keep: str = "*") -> str:
    part = f"PARTITION BY {strata}" if strata else ""
    rn = f"row_number() OVER ({part} ORDER BY {sql_digest(str(seed), key)}, {key})"
    steps = " + ".join(f"({rn} > round(count(*) OVER ({part}) * {i / k}))::BIGINT" for i in range(1, k))
    return f"(SELECT {keep}, 1 + {steps} AS fold FROM {table})"


@query("l1_random_split", "SELECT o_orderkey, split FROM " + sql_split("orders", "o_orderkey"))
def _(t: Tables):
    return L.split(t.orders.select("o_orderkey"), "o_orderkey").frame


@query("l2_stratified_split", "SELECT doc_id, toxic::BIGINT AS toxic, split FROM " + sql_split("labels", "doc_id", strata="toxic"))
def _(t: Tables):
    return L.split(t.labels, "doc_id", stratify="toxic").frame.select("doc_id", "toxic", "split")


_GROUPS = "(SELECT DISTINCT o_custkey FROM orders)"


@query("l3_group_split", "SELECT o_orderkey, o_custkey, split FROM orders JOIN " + sql_split(_GROUPS, "o_custkey") + " USING (o_custkey)")
def _(t: Tables):
    return L.split(t.orders, "o_orderkey", group="o_custkey").frame.select("o_orderkey", "o_custkey", "split")


@query("l3_group_overlap", "SELECT count(*) AS keys, 0::BIGINT AS shared_keys FROM " + _GROUPS)
def _(t: Tables):
    return L.overlap(L.split(t.orders, "o_orderkey", group="o_custkey").frame, "o_custkey", "split")


@query("l4_k_folds", "SELECT o_orderkey, fold FROM " + sql_folds("orders", "o_orderkey", 5))
def _(t: Tables):
    return L.folds(t.orders.select("o_orderkey"), "o_orderkey", 5)


@query("l5_stratified_folds", "SELECT doc_id, toxic::BIGINT AS toxic, fold FROM " + sql_folds("labels", "doc_id", 5, strata="toxic"))
def _(t: Tables):
    return L.folds(t.labels, "doc_id", 5, stratify="toxic").select("doc_id", "toxic", "fold")


@query("l5_stratified_fold_report", "WITH f AS (SELECT * FROM " + sql_folds("labels", "doc_id", 5, strata="toxic") + f""")
SELECT fold, (SELECT count(*) FROM f) - count(*) AS train_rows, count(*) AS valid_rows, ((SELECT sum(toxic) FROM f) - sum(toxic))::BIGINT AS train_positives, sum(toxic)::BIGINT AS valid_positives,
 {r('100.0*sum(toxic)/count(*)')} AS valid_positive_pct, count(DISTINCT quality) AS valid_groups FROM f GROUP BY 1""")
def _(t: Tables):
    return L.fold_report(L.folds(t.labels, "doc_id", 5, stratify="toxic"), F.col("toxic"), group="quality")


@query("l6_group_folds", "SELECT o_orderkey, fold FROM orders JOIN " + sql_folds(_GROUPS, "o_custkey", 5) + " USING (o_custkey)")
def _(t: Tables):
    return L.folds(t.orders, "o_orderkey", 5, group="o_custkey").select("o_orderkey", "fold")


@query("l7_repeated_folds", "SELECT o_orderkey, a.fold AS fold_r1, b.fold AS fold_r2 FROM " + sql_folds("orders", "o_orderkey", 5, 42001) + " a JOIN " + sql_folds("orders", "o_orderkey", 5, 42002) + " b USING (o_orderkey)")
def _(t: Tables):
    return L.repeated_folds(t.orders.select("o_orderkey"), "o_orderkey", 5, 2)


@query("l9_fold_signature", sql_fingerprint(sql_folds("orders", "o_orderkey", 5), {"o_orderkey": "whole", "fold": "whole"}))
def _(t: Tables):
    return fingerprint(L.folds(t.orders.select("o_orderkey"), "o_orderkey", 5), ["o_orderkey", "fold"]).drop("exact")


@query("l10_unstratified_drift", union(f"SELECT {s}::BIGINT AS seed, sum(toxic)::BIGINT AS test_positives, count(*) AS test_rows FROM {sql_split('labels', 'doc_id', seed=s)} WHERE split='test'" for s in (1, 2, 3, 4)))
def _(t: Tables):
    out = None
    for s in (1, 2, 3, 4):
        one = L.split(t.labels, "doc_id", seed=s).test.agg(F.sum("toxic").alias("test_positives"), F.count(F.lit(1)).alias("test_rows")).select(F.lit(s).alias("seed"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("l11_split_summary", "WITH s AS " + sql_split("labels", "doc_id", strata="toxic") + f""" SELECT split, count(*) AS rows, {r('count(*) * 1.0 / (SELECT count(*) FROM labels)')} AS share, sum(toxic)::BIGINT AS positives, sum(1-toxic)::BIGINT AS negatives,
 {r('100.0*sum(toxic)/count(*)')} AS positive_pct, {r('sum(1-toxic)/sum(toxic)')} AS imbalance_ratio FROM s GROUP BY 1""")
def _(t: Tables):
    return L.split_summary(L.split(t.labels, "doc_id", stratify="toxic").frame, F.col("toxic"))


@query("l12_target_by_split", "WITH s AS " + sql_split("orders", "o_orderkey") + f""" SELECT split, 'o_totalprice' AS "column", count(*) AS n, {r('avg(o_totalprice)', 4)} AS mean, {r('stddev_samp(o_totalprice)', 4)} AS std, {r('min(o_totalprice)', 4)} AS min,
 {r('max(o_totalprice)', 4)} AS max, {r('quantile_cont(o_totalprice, 0.5)', 4)} AS p50 FROM s GROUP BY 1""", 4)
def _(t: Tables):
    return describe(L.split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey").frame, ["o_totalprice"], [.5], ["split"])


@query("v11_split_validation", "WITH s AS " + sql_split("labels", "doc_id", strata="toxic") + f""", c AS (SELECT (abs(100*avg(toxic) FILTER (split='train') - 100*avg(toxic)) > 0.05)::BIGINT AS tr, (abs(100*avg(toxic) FILTER (split='test') - 100*avg(toxic)) > 0.05)::BIGINT AS te FROM s)
SELECT unnest(['rows outside train and test','label outside 0/1','classes in the table','classes in train','classes in test','test size off by more than one','train rate off','test rate off','row ids used twice']) AS "check",
 unnest([0,0,2,2,2,0,tr,te,0])::BIGINT AS observed, unnest([0,0,2,2,2,0,0,0,0])::BIGINT AS expected, unnest([true,true,true,true,true,true,tr=0,te=0,true]) AS passed FROM c""")
def _(t: Tables):
    return L.validate_split(L.split(t.labels, "doc_id", stratify="toxic").frame, "doc_id", "toxic")


# ---------------------------------------------------------------- encoders

def _rated(t: Tables) -> L.Split:
    frame = prep.modelling_frame(t.titles, "row_id", "rating").drop("genre_list")
    return L.split(stored(frame, "rated"), "row_id").saved(scratch_path(t.spark, "rated-split"))


_SPLIT_RATED = "WITH " + SQL_RATED + ", s AS " + sql_split("rated", "row_id")


@query("e1_group_median_imputer", _SPLIT_RATED + """, g AS (SELECT quantile_cont(year, 0.5) AS ym, quantile_cont(duration_min, 0.5) AS dm FROM s WHERE split='train'),
b AS (SELECT floor(coalesce(year, ym)/10)*10 AS bucket, quantile_cont(duration_min, 0.5) AS med FROM s, g WHERE split='train' AND duration_min IS NOT NULL GROUP BY 1 HAVING count(*) >= 30)
SELECT row_id, coalesce(year, ym) AS year, coalesce(duration_min, med, dm) AS duration_min, (duration_min IS NULL)::BIGINT AS duration_min_missing
FROM s JOIN g ON true LEFT JOIN b ON floor(coalesce(year, ym)/10)*10 = bucket WHERE split='test'""")
def _(t: Tables):
    parts = _rated(t)
    model = E.GroupMedianImputer("year", "duration_min").fit(parts.train)
    return model.transform(parts.test).select("row_id", "year", "duration_min", "duration_min_missing")


@query("e2_multi_hot", _SPLIT_RATED + """, v AS (SELECT token, count(DISTINCT row_id) AS n FROM (SELECT row_id, unnest(tokens_all) AS token FROM s WHERE split='train') GROUP BY 1)
SELECT row_id, (list_contains(tokens_all, 'FURNITURE') IS TRUE)::BIGINT AS furniture, (list_contains(tokens_all, 'LOW') IS TRUE)::BIGINT AS low, (tokens_all IS NULL)::BIGINT AS genre_missing,
 coalesce(len(list_distinct(tokens_all)), 0)::BIGINT AS genre_count, (SELECT count(*) FROM v) AS vocabulary FROM s WHERE split='test'""")
def _(t: Tables):
    parts = _rated(t)
    model = E.MultiHotEncoder("genre").fit(parts.train)
    vocabulary = model.state["vocabulary"].agg(F.count(F.lit(1))).scalar()
    return model.transform(parts.test).select("row_id", col("genre=FURNITURE").alias("furniture"), col("genre=LOW").alias("low"), "genre_missing",
                                              "genre_count", vocabulary.alias("vocabulary"))


@query("e3_people_encoder", _SPLIT_RATED + """, u AS (SELECT DISTINCT row_id, unnest([actor_1, actor_2, actor_3]) AS name FROM s WHERE split='train'), c AS (SELECT name, count(*) AS n FROM u WHERE name IS NOT NULL GROUP BY 1),
x AS (SELECT row_id, coalesce(a.n, 0) AS c1, coalesce(b.n, 0) AS c2, coalesce(d.n, 0) AS c3, actor_1, actor_2, actor_3 FROM s LEFT JOIN c a ON actor_1 = a.name LEFT JOIN c b ON actor_2 = b.name LEFT JOIN c d ON actor_3 = d.name WHERE split='test')
SELECT row_id, c1 AS actor_1_count, c2 AS actor_2_count, c3 AS actor_3_count, (actor_3 IS NULL)::BIGINT AS actor_3_missing,
 ((actor_1 IS NOT NULL)::INT + (actor_2 IS NOT NULL)::INT + (actor_3 IS NOT NULL)::INT)::BIGINT AS actor_listed,
 coalesce(array_to_string(list_sort(list_distinct(list_filter([CASE WHEN c1 >= 25 THEN actor_1 END, CASE WHEN c2 >= 25 THEN actor_2 END, CASE WHEN c3 >= 25 THEN actor_3 END], lambda z: z IS NOT NULL))), ';'), '') AS frequent FROM x""")
def _(t: Tables):
    parts = _rated(t)
    model = E.PeopleEncoder("actor", ["actor_1", "actor_2", "actor_3"], "row_id", min_count=25).fit(parts.train)
    return model.transform(parts.test).select("row_id", "actor_1_count", "actor_2_count", "actor_3_count", "actor_3_missing", "actor_listed",
                                              F.array_join("actor_frequent", ";").alias("frequent"))


FEATURE_GROUPS = {"numeric": E.GroupMedianImputer("year", "duration_min"), "genre": E.MultiHotEncoder("genre"), "director": E.PeopleEncoder("director", ["director"], "row_id", min_count=10),
                  "actor": E.PeopleEncoder("actor", ["actor_1", "actor_2", "actor_3"], "row_id", min_count=20)}
_FIXED = [(0, "numeric", ["year", "duration_min", "duration_min_missing"]), (2, "genre", ["genre_missing", "genre_count"]), (3, "director", ["director_count", "director_missing"]),
          (5, "actor", ["actor_1_count", "actor_2_count", "actor_3_count", "actor_1_missing", "actor_2_missing", "actor_3_missing", "actor_listed"])]
_ACTORS = "unnest([actor_1, actor_2, actor_3])"
SQL_FEATURES = _SPLIT_RATED + """, g AS (SELECT quantile_cont(year, 0.5) AS ym, quantile_cont(duration_min, 0.5) AS dm FROM s WHERE split='train'),
b AS (SELECT floor(coalesce(year, ym)/10)*10 AS bucket, quantile_cont(duration_min, 0.5) AS med FROM s, g WHERE split='train' AND duration_min IS NOT NULL GROUP BY 1 HAVING count(*) >= 30),
dc AS (SELECT director AS name, count(*) AS n FROM s WHERE split='train' AND director IS NOT NULL GROUP BY 1),
ac AS (SELECT name, count(*) AS n FROM (SELECT DISTINCT row_id, """ + _ACTORS + """ AS name FROM s WHERE split='train') WHERE name IS NOT NULL GROUP BY 1),
names AS (SELECT *, row_number() OVER (ORDER BY slot, k, token) - 1 AS position FROM (
 SELECT DISTINCT 1 AS slot, 'genre' AS "group", 0 AS k, token, 'genre=' || token AS feature FROM (SELECT unnest(tokens_all) AS token FROM s WHERE split='train')
 UNION ALL SELECT 4, 'director', 0, name, 'director=' || name FROM dc WHERE n >= 10 UNION ALL SELECT 6, 'actor', 0, name, 'actor=' || name FROM ac WHERE n >= 20
 UNION ALL """ + " UNION ALL ".join(f"SELECT {slot}, '{g}', {k}, '', '{f}'" for slot, g, fs in _FIXED for k, f in enumerate(fs)) + "))"


@query("e4_feature_assembly", SQL_FEATURES + """, f AS (SELECT row_id, coalesce(year, ym) AS year, coalesce(duration_min, med, dm) AS duration_min, (duration_min IS NULL)::INT AS duration_min_missing,
 (tokens_all IS NULL)::INT AS genre_missing, coalesce(len(list_distinct(tokens_all)), 0) AS genre_count, coalesce(d.n, 0) AS director_count, (director IS NULL)::INT AS director_missing,
 coalesce(a1.n, 0) AS actor_1_count, coalesce(a2.n, 0) AS actor_2_count, coalesce(a3.n, 0) AS actor_3_count, (actor_1 IS NULL)::INT AS actor_1_missing, (actor_2 IS NULL)::INT AS actor_2_missing,
 (actor_3 IS NULL)::INT AS actor_3_missing, (actor_1 IS NOT NULL)::INT + (actor_2 IS NOT NULL)::INT + (actor_3 IS NOT NULL)::INT AS actor_listed, tokens_all, director, actor_1, actor_2, actor_3
 FROM s JOIN g ON true LEFT JOIN b ON floor(coalesce(year, ym)/10)*10 = bucket LEFT JOIN dc d ON director = d.name LEFT JOIN ac a1 ON actor_1 = a1.name LEFT JOIN ac a2 ON actor_2 = a2.name LEFT JOIN ac a3 ON actor_3 = a3.name WHERE split='test'),
x AS (""" + " UNION ALL ".join(f"SELECT row_id, '{n}' AS feature, {n}::DOUBLE AS value FROM f" for _, _, fs in _FIXED for n in fs) + """
 UNION ALL SELECT DISTINCT row_id, 'genre=' || token, 1.0 FROM (SELECT row_id, unnest(tokens_all) AS token FROM f) UNION ALL SELECT row_id, 'director=' || director, 1.0 FROM f
 UNION ALL SELECT DISTINCT row_id, 'actor=' || name, 1.0 FROM (SELECT row_id, """ + _ACTORS + f""" AS name FROM f))
SELECT row_id, (SELECT count(*) FROM names) AS width, count(*) FILTER (value <> 0) AS nonzeros, {r('sum(value * (position + 1))')} AS checksum FROM x JOIN names USING (feature) GROUP BY 1""")
def _(t: Tables):
    parts = _rated(t)
    model = FeatureAssembler(FEATURE_GROUPS, "row_id").fit(parts.train)
    out = model.transform(parts.test)
    products = F.zip_with("positions", "values", lambda p, v: (p + 1) * v)
    return out.select("row_id", F.lit(model.width).alias("width"), F.size("positions").alias("nonzeros"), F.aggregate(products, F.lit(0.0), lambda a, x: a + x).alias("checksum"))


_Z = lambda c: f"({c} - avg({c}) FILTER (tr) OVER ()) / stddev_pop({c}) FILTER (tr) OVER ()"
_LINES = "(SELECT *, l_linestatus = 'F' AS tr FROM lineitem)"


def _scaled_sums(df: DataFrame, cols) -> DataFrame:
    return df.groupBy("l_returnflag").agg(*[F.avg(c).alias(c) for c in cols], *[F.sum(col(c) * col(c)).alias(f"{c}_sq") for c in cols])


def _scaled_sql(exprs: dict[str, str]) -> str:
    inner = ", ".join(f"{e} AS {c}" for c, e in exprs.items())
    outer = ", ".join([f"{r(f'avg({c})', 4)} AS {c}" for c in exprs] + [f"{r(f'sum({c}*{c})', 4)} AS {c}_sq" for c in exprs])
    return f"SELECT l_returnflag, {outer} FROM (SELECT l_returnflag, {inner} FROM (SELECT *, ln(1 + l_extendedprice) AS lp FROM {_LINES})) GROUP BY 1"


def _scaled(t: Tables, strategy: str, **kw) -> DataFrame:
    model = E.PopulationScaler(LINE_NUMERIC, strategy, **kw).fit(t.lineitem.where("l_linestatus = 'F'"))
    return _scaled_sums(model.transform(t.lineitem), LINE_NUMERIC)


@query("e5_standardise", _scaled_sql({c: _Z(c) for c in LINE_NUMERIC}), 4)
def _(t: Tables):
    return _scaled(t, "standard")


@query("e6_minimal_scaling", _scaled_sql({**{c: c for c in LINE_NUMERIC}, "l_extendedprice": _Z("l_extendedprice"), "l_quantity": _Z("l_quantity")}), 4)
def _(t: Tables):
    return _scaled(t, "minimal", minimal_cols=["l_extendedprice", "l_quantity"])


@query("e7_log_scaling", _scaled_sql({**{c: _Z(c) for c in LINE_NUMERIC}, "l_extendedprice": _Z("lp")}), 4)
def _(t: Tables):
    return _scaled(t, "log_amount", log_cols=["l_extendedprice"])


@query("e8_passthrough", _scaled_sql({c: c for c in ("l_quantity", "l_discount", "l_tax")}), 4)
def _(t: Tables):
    cols = ["l_quantity", "l_discount", "l_tax"]
    return _scaled_sums(E.PopulationScaler(cols, "passthrough").fit(t.lineitem).transform(t.lineitem), cols)


@query("e9_apply_to_test_rows", "WITH s AS " + sql_split("orders", "o_orderkey") + f", m AS (SELECT avg(o_totalprice) AS a, stddev_pop(o_totalprice) AS d FROM s WHERE split='train') SELECT o_orderkey, {r('(o_totalprice - a)/d')} AS o_totalprice FROM s, m WHERE split='test'")
def _(t: Tables):
    parts = L.split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    return E.PopulationScaler(["o_totalprice"]).fit(parts.train).transform(parts.test).select("o_orderkey", "o_totalprice")


@query("e11_leak_proof", "WITH s AS " + sql_split("orders", "o_orderkey") + """ SELECT 'o_totalprice' AS feature, true AS fitted_on_train, abs(avg(o_totalprice) - avg(o_totalprice) FILTER (split='train')) > 0 AS differs_from_all, true AS saw_train_rows_only FROM s""")
def _(t: Tables):
    parts = L.split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    model = E.PopulationScaler(["o_totalprice"]).fit(parts.train)
    return prep.leak_proof(parts.frame, model.state["moments"], ["o_totalprice"])


@query("e12_prepare_flow", "WITH " + SQL_TRANSACTIONS + ", s AS " + sql_split("tx", "event_id", strata="label") + f""", m AS (SELECT avg(amount) AS a, stddev_pop(amount) AS d, avg(k) AS ka, stddev_pop(k) AS kd FROM s WHERE split='train')
SELECT event_id, split, {r('(amount - a)/d')} AS amount, {r('(k - ka)/kd')} AS k FROM s, m""")
def _(t: Tables):
    contract = Contract(["event_id", "amount", "k", "label"], numeric=["amount", "k"], not_null=["amount", "k", "label"], finite=["amount"], domains={"label": [0, 1]})
    p = prep.prepare(t.transactions.select("event_id", "amount", "k", "label"), contract, ["amount", "k"], "label", "event_id", stratify=True)
    return p.train.unionByName(p.test).select("event_id", "split", "amount", "k")


@query("e13_feature_names", SQL_FEATURES + """ SELECT "group", feature, position, (count(*) OVER (PARTITION BY "group"))::BIGINT AS group_width FROM names""")
def _(t: Tables):
    index = FeatureAssembler(FEATURE_GROUPS, "row_id").fit(_rated(t).train).index
    widths = index.groupBy(F.col("group").alias("_g")).agg(F.count(F.lit(1)).alias("group_width"))
    return index.join(widths, F.col("group") == F.col("_g")).drop("_g")


@query("e4_selected_groups", SQL_FEATURES + """ SELECT "group", feature, row_number() OVER (ORDER BY position) - 1 AS position FROM names WHERE "group" IN ('numeric', 'director')""")
def _(t: Tables):
    return FeatureAssembler(FEATURE_GROUPS, "row_id", selected=["numeric", "director"]).fit(_rated(t).train).index


@query("e14_imputation_plan", "WITH " + SQL_RATED + " " + union(f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, {r(f'100.0*(count(*)-count({c}))/count(*)')} AS missing_pct, '{s}' AS strategy, 100.0*(count(*)-count({c}))/count(*) > 5 AS substantial FROM rated"""
                                                               for c, s in [("year", "median"), ("duration_min", "bucket median"), ("director", "indicator")]))
def _(t: Tables):
    frame = prep.modelling_frame(t.titles, "row_id", "rating")
    return E.imputation_plan(frame, {"year": "median", "duration_min": "bucket median", "director": "indicator"})


@query("v12_preprocessor_validation", "WITH s AS " + sql_split("orders", "o_orderkey") + """ SELECT unnest(['rows in train','scaler saw other rows than train','missing cells']) AS "check", unnest([count(*) FILTER (split='train'), 0, 0])::BIGINT AS observed,
 unnest([count(*) FILTER (split='train'), 0, 0])::BIGINT AS expected, unnest([true, true, true]) AS passed FROM s""")
def _(t: Tables):
    parts = L.split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    model = E.PopulationScaler(["o_totalprice"]).fit(parts.train)
    n = model.state["moments"].first()["n_seen"]
    scaled = model.transform(parts.train)
    return run_checks(scaled, [Check("rows in train", F.count(F.lit(1)), n), Check("scaler saw other rows than train", F.count(F.lit(1)) - n),
                               Check("missing cells", count_if(F.col("o_totalprice").isNull()))])


SQL_SEEN = lambda key: f"(sum({sql_digest('seen', key)}) % {MODULUS})::BIGINT"
_CONTRACT = Contract(["event_id", "amount", "k", "label"], numeric=["amount", "k"], not_null=["amount", "k", "label"], finite=["amount"], domains={"label": [0, 1]})


def sql_checks(checks: dict[str, tuple[str, int]], source: str) -> str:
    """SQL of a check table: name -> (aggregate, expected)."""
    return union(f"""SELECT '{n}' AS "check", (0 * count(*) + {e})::BIGINT AS observed, {want}::BIGINT AS expected, (0 * count(*) + {e})::BIGINT = {want} AS passed FROM {source}""" for n, (e, want) in checks.items())


@query("e12_v12_preprocessor_suite", "WITH " + SQL_TRANSACTIONS + ", s AS " + sql_split("tx", "event_id", strata="label") + f""", m AS (SELECT avg(amount) AS a, stddev_pop(amount) AS d, avg(k) AS ka, stddev_pop(k) AS kd, count(*) AS n, {SQL_SEEN('event_id')} AS h FROM s WHERE split='train'),
z AS (SELECT s.*, (amount - a)/d AS za, (k - ka)/kd AS zk, n, h FROM s, m) """ + sql_checks({
    "columns in one part only": ("0", 0), "columns gained or lost": ("0", 0), "a scaler was fitted": ("1", 1),
    "train rows gained or lost": ("abs(count(za) FILTER (split='train') - count(*) FILTER (split='train'))", 0),
    "test rows gained or lost": ("abs(count(za) FILTER (split='test') - count(*) FILTER (split='test'))", 0),
    "missing cells": ("count(*) FILTER (za IS NULL OR isnan(za)) + count(*) FILTER (zk IS NULL OR isnan(zk))", 0),
    "infinite cells": ("count(*) FILTER (isinf(za)) + count(*) FILTER (isinf(zk))", 0),
    "scalers fitted on other rows than train": (f"(any_value(n) <> count(*) FILTER (split='train') OR any_value(h) <> (SELECT {SQL_SEEN('event_id')} FROM s WHERE split='train'))::INT", 0)}, "z"))
def _(t: Tables):
    return prep.prepare(t.transactions.select("event_id", "amount", "k", "label"), _CONTRACT, ["amount", "k"], "label", "event_id", stratify=True).checks


@query("v12_scaler_fitted_on_other_rows", "WITH s AS " + sql_split("orders", "o_orderkey") + f""", h AS (SELECT {SQL_SEEN('o_orderkey')} AS seen FROM s WHERE o_orderkey > (SELECT min(o_orderkey) FROM s WHERE split='test') OR split = 'test') """ + sql_checks({
    "columns in one part only": ("0", 0), "columns gained or lost": ("0", 0), "a scaler was fitted": ("1", 1), "train rows gained or lost": ("0", 0), "test rows gained or lost": ("0", 0),
    "missing cells": ("count(*) - count(o_totalprice)", 0), "infinite cells": ("0", 0),
    "scalers fitted on other rows than train": (f"((SELECT any_value(seen) FROM h) <> (SELECT {SQL_SEEN('o_orderkey')} FROM s WHERE split='train'))::INT", 0)}, "s"))
def _(t: Tables):
    parts = L.split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey").saved(scratch_path(t.spark, "orders-split"))
    first = parts.test.agg(F.min("o_orderkey")).scalar()
    other = parts.frame.where((F.col("o_orderkey") > first) | (F.col("split") == "test"))
    scaler = E.PopulationScaler(["o_totalprice"], seen=seen_rows("o_orderkey")).fit(other).held()
    return preprocessor_checks(parts.frame, scaler.transform(parts.train), scaler.transform(parts.test), ["o_totalprice"], "o_orderkey", [scaler])


@query("v13_resampling_suite", "WITH s AS " + sql_split("labels", "doc_id", strata="toxic") + """, c AS (SELECT toxic, count(*) FILTER (split='train') AS train, count(*) FILTER (split='test') AS test FROM s GROUP BY 1),
g AS (SELECT toxic, train, test, max(train) OVER () AS over_n, min(train) OVER () AS under_n FROM c), x AS (SELECT strategy, g.*, CASE strategy WHEN 'oversample' THEN over_n WHEN 'undersample' THEN under_n ELSE train END AS made FROM g, (SELECT unnest(['none', 'oversample', 'undersample']) AS strategy)),
k AS (SELECT strategy, unnest(['test rows gained or lost', 'test classes with another count', 'training classes changed', 'classes in the resampled rows']) AS "check",
 unnest([0, 0, max((made <> train)::INT), count(*) FILTER (made > 0)])::BIGINT AS observed, unnest([0, 0, (strategy <> 'none')::INT, 2])::BIGINT AS expected FROM x GROUP BY strategy)
SELECT *, observed = expected AS passed FROM k""")
def _(t: Tables):
    parts = L.split(t.labels.select("doc_id", "toxic"), "doc_id", stratify="toxic").saved(scratch_path(t.spark, "labels-split"))
    rows, out = parts.train.select("doc_id", "toxic"), None
    for s in ("none", "oversample", "undersample"):
        one = resampling_checks(rows, B.resample(rows, "toxic", s, "doc_id"), t.labels.join(parts.test.select("doc_id"), "doc_id", "left_semi"), parts.test, "toxic",
                                changes=s != "none").select(F.lit(s).alias("strategy"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- class imbalance

@query("b1_class_weights", f"SELECT toxic::BIGINT AS toxic, count(*) AS n, {r('(SELECT count(*) FROM labels) / (2.0 * count(*))')} AS weight FROM labels GROUP BY 1")
def _(t: Tables):
    return B.class_weights(t.labels, "toxic")


@query("b1_weighted_rows", f"SELECT toxic::BIGINT AS toxic, {r('count(*) * (SELECT count(*) FROM labels) / (2.0 * count(*))')} AS total_weight FROM labels GROUP BY 1")
def _(t: Tables):
    return B.with_class_weights(t.labels, "toxic").groupBy("toxic").agg(F.sum("weight").alias("total_weight"))


_DRAWS = f"""p AS (SELECT *, row_number() OVER (ORDER BY {sql_digest('42-order', '{id}')}, {{id}}) - 1 AS number FROM {{minor}}), c AS (SELECT count(*) AS n_min, (SELECT count(*) FROM {{major}}) AS n_maj FROM {{minor}}),
d AS (SELECT draw, {sql_digest('42-pick', 'draw')} % n_min AS number FROM c, LATERAL (SELECT unnest(range(1, n_maj - n_min + 1)) AS draw))"""


@query("b2_oversample", "WITH mi AS (SELECT * FROM labels WHERE toxic = 1), ma AS (SELECT * FROM labels WHERE toxic = 0), " + _DRAWS.format(id="doc_id", minor="mi", major="ma") +
       " SELECT doc_id, toxic::BIGINT AS toxic, 0::BIGINT AS draw FROM labels UNION ALL SELECT doc_id, toxic::BIGINT, draw FROM d JOIN p USING (number)")
def _(t: Tables):
    return B.oversample(t.labels.select("doc_id", "toxic"), "toxic", "doc_id")


_RARE = "(SELECT vec_id, embedding, (label = 3)::INT AS rare FROM embeddings)"


@query("b3_smote", f"""WITH e AS {_RARE}, mi AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM e WHERE rare = 1), ma AS (SELECT * FROM e WHERE rare = 0), {_DRAWS.format(id='vec_id', minor='mi', major='ma')},
nb AS (SELECT a.vec_id AS vec_id, b.v AS y, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rk FROM mi a JOIN mi b ON a.vec_id <> b.vec_id),
m AS (SELECT draw, p.v AS x, y, {sql_digest('42-u', 'draw')}::DOUBLE / 1152921504606846976.0 AS u FROM d JOIN p USING (number) JOIN nb ON nb.vec_id = p.vec_id AND rk = {sql_digest('42-near', 'draw')} % 5 + 1)
SELECT vec_id, rare::BIGINT AS rare, 0::BIGINT AS draw, {r('list_sum(embedding::DOUBLE[])')} AS total FROM e
UNION ALL SELECT NULL, 1, draw, {r('list_sum(x) + u * (list_sum(y) - list_sum(x))')} FROM m""")
def _(t: Tables):
    e = t.embeddings.select("vec_id", "embedding", (F.col("label") == 3).cast("int").alias("rare"))
    made = B.smote(e, "rare", "vec_id", "embedding")
    return made.select("vec_id", "rare", "draw", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("b4_undersample", f"""SELECT doc_id, toxic::BIGINT AS toxic FROM labels WHERE toxic = 1 UNION ALL
(SELECT doc_id, toxic::BIGINT FROM labels WHERE toxic = 0 ORDER BY {sql_digest('42', 'doc_id')}, doc_id LIMIT (SELECT count(*) FROM labels WHERE toxic = 1))""")
def _(t: Tables):
    return B.undersample(t.labels.select("doc_id", "toxic"), "toxic", "doc_id")


@query("b5_b7_resampling_summary", f"""WITH c AS (SELECT sum(toxic)::BIGINT AS p, sum(1-toxic)::BIGINT AS n FROM labels), x AS (SELECT 'none' AS strategy, p, n FROM c UNION ALL SELECT 'class_weight', p, n FROM c
UNION ALL SELECT 'oversample', n, n FROM c UNION ALL SELECT 'undersample', p, p FROM c)
SELECT strategy, p + n AS rows, p AS positives, n AS negatives, {r('100.0*least(p,n)/(p+n)')} AS minority_pct, {r('greatest(p,n)/least(p,n)')} AS ratio FROM x""")
def _(t: Tables):
    rows = t.labels.select("doc_id", "toxic")
    return B.resampling_summary({s: B.resample(rows, "toxic", s, "doc_id") for s in ("none", "class_weight", "oversample", "undersample")}, "toxic")


@query("v13_resampling_validation", "WITH s AS " + sql_split("labels", "doc_id", strata="toxic") + """ SELECT toxic::BIGINT AS toxic, count(*) FILTER (split='train') AS left_n, min(count(*) FILTER (split='train')) OVER () AS right_n FROM s GROUP BY 1""")
def _(t: Tables):
    parts = L.split(t.labels, "doc_id", stratify="toxic")
    n = F.count(F.lit(1)).alias("n")
    after = B.resample(parts.train.select("doc_id", "toxic"), "toxic", "undersample", "doc_id")
    return compare_counts(parts.train.groupBy("toxic").agg(n), after.groupBy("toxic").agg(n), ["toxic"])


@query("l3_group_split_by_title", "WITH " + SQL_RATED + r""", k AS (SELECT row_id, CASE WHEN name IS NULL THEN 'no title|' || row_id::VARCHAR ELSE lower(regexp_replace(name, '\s+', ' ', 'g')) || '|' || coalesce(year::INT::VARCHAR, 'NA') END AS group_id FROM rated)
SELECT row_id, split FROM k JOIN """ + sql_split("(SELECT DISTINCT group_id FROM k)", "group_id") + " USING (group_id)")
def _(t: Tables):
    frame = prep.modelling_frame(t.titles, "row_id", "rating").select("row_id", group_key("name", "year", "row_id").alias("group_id"))
    return L.split(stored(frame, "title-groups"), "row_id", group="group_id").frame.select("row_id", "split")
