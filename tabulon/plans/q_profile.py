"""Queries: column profiles, distributions, associations, outliers, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.numeric import band, bucket_floor, col, count_if
from tabulon.functions.text import group_key, split_tokens
from tabulon.operators import dedupe as D
from tabulon.operators import outliers as O
from tabulon.operators import profile as P
from tabulon.operators.contracts import conflicting_labels
from tabulon.operators.ordered import quantiles
from tabulon.operators.reshape import reindex
from tabulon.plans import preparation as prep
from tabulon.plans.registry import query, r, union
from tabulon.plans.tables import (LINE_NUMERIC, SQL_CLEAN, SQL_RATED, SQL_TITLES, SQL_TRANSACTIONS, TITLE_COLUMNS, Tables)

_PROFILED = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string"}


@query("a1_profile", union(f"""SELECT '{c}' AS "column", '{k}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
 {r(f"100.0*(count(*) - count({c}))/count(*)")} AS null_pct, count(DISTINCT {c}) AS distinct_values, min({c})::VARCHAR AS min_value,
 max({c})::VARCHAR AS max_value FROM lineitem""" for c, k in _PROFILED.items()))
def _(t: Tables):
    return P.profile(t.lineitem, list(_PROFILED))


@query("a1_profile_approximate")
def _(t: Tables):
    return P.profile(t.lineitem, list(_PROFILED), exact=False)


@query("a2_missing_table", "WITH " + SQL_TITLES + " " + union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, {r(f'100.0*(count(*) - count({c}))/count(*)')} AS missing_pct FROM titles"
    for c in TITLE_COLUMNS))
def _(t: Tables):
    return P.missing_table(t.titles, TITLE_COLUMNS).orderBy(F.desc("missing_pct"), "column")


@query("a2_missing_totals", """WITH j AS (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) AS rows, sum((quality IS NULL)::INT + (toxic IS NULL)::INT)::BIGINT AS missing_cells, count(*) FILTER (quality IS NULL OR toxic IS NULL) AS rows_any_missing,
 count(*) FILTER (quality IS NULL AND toxic IS NULL AND doc_id IS NULL) AS rows_all_missing FROM j""")
def _(t: Tables):
    return P.missing_totals(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), ["doc_id", "quality", "toxic"])


def _describe_sql(source: str, cols, probs, by: str = "", where: str = "") -> str:
    from tabulon.operators.ordered import quantile_label
    lead = f"{by}, " if by else ""
    qs = ", ".join(f"{r(f'quantile_cont({{c}}, {q})')} AS {quantile_label(q)}" for q in probs)
    return union((f"SELECT {lead}'{{c}}' AS \"column\", count({{c}}) AS n, {r('avg({c})')} AS mean, {r('stddev_samp({c})')} AS std, {r('min({c})')} AS min, "
                  f"{r('max({c})')} AS max, {qs} FROM {source} {where}" + (f" GROUP BY {by}" if by else "")).replace("{c}", c) for c in cols)


@query("a3_describe", _describe_sql("lineitem", LINE_NUMERIC, (.25, .5, .75)))
def _(t: Tables):
    return P.describe(t.lineitem, LINE_NUMERIC)


@query("a4_moments", union(f"""SELECT '{c}' AS "column", {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'skewness({c})')} AS skewness,
 {r(f'kurtosis({c})')} AS kurtosis FROM lineitem""" for c in LINE_NUMERIC))
def _(t: Tables):
    return P.moments(t.lineitem, LINE_NUMERIC)


_NINE = (.01, .05, .10, .25, .50, .75, .90, .95, .99)


@query("a5_quantile_list", "SELECT " + ", ".join(f"{r(f'quantile_cont(l_extendedprice, {q})')} AS p{int(q * 100)}" for q in _NINE) + " FROM lineitem")
def _(t: Tables):
    return quantiles(t.lineitem, "l_extendedprice", _NINE)


@query("a5_quantiles_range_partitioned", "SELECT l_returnflag, " + ", ".join(
    f"{r(f'quantile_cont(l_extendedprice, {q})')} AS p{int(q * 100)}" for q in _NINE) + " FROM lineitem GROUP BY 1")
def _(t: Tables):
    return quantiles(t.lineitem, "l_extendedprice", _NINE, ["l_returnflag"])


@query("a6_group_aggregation", f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {r('avg(l_extendedprice)')} AS mean_price, {r('quantile_cont(l_extendedprice, 0.5)')} AS median_price,
 {r('quantile_cont(l_extendedprice, 0.95)')} AS p95_price, {r('stddev_samp(l_extendedprice)')} AS std_price, {r('max(l_extendedprice)')} AS max_price FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    by = ["l_returnflag", "l_linestatus"]
    d = P.describe(t.lineitem, ["l_extendedprice"], [.5, .95], by)
    return d.select(*by, "n", F.col("mean").alias("mean_price"), F.col("p50").alias("median_price"), F.col("p95").alias("p95_price"),
                    F.col("std").alias("std_price"), F.col("max").alias("max_price"))


@query("a7_by_missingness", "WITH " + SQL_CLEAN + f""" SELECT duration_min IS NULL AS is_missing, count(*) AS n, {r('avg(rating)')} AS mean_rating,
 {r('quantile_cont(rating, 0.5)')} AS median_rating FROM clean GROUP BY 1""")
def _(t: Tables):
    df = prep.clean_titles(t.titles).withColumn("is_missing", F.col("duration_min").isNull())
    d = P.describe(df, ["rating"], [.5], ["is_missing"])
    sizes = df.groupBy("is_missing").agg(F.count(F.lit(1)).alias("n"))
    return d.drop("n").join(sizes, "is_missing").select("is_missing", "n", F.col("mean").alias("mean_rating"), F.col("p50").alias("median_rating"))


@query("a8_decade_groups", "WITH " + SQL_CLEAN + f""" SELECT (floor(year/10)*10)::BIGINT AS decade, count(*) AS n, count(duration_min) AS known,
 {r('100.0*(count(*)-count(duration_min))/count(*)')} AS missing_pct, {r('quantile_cont(duration_min, 0.5)')} AS median_min,
 {r('quantile_cont(duration_min, 0.75) - quantile_cont(duration_min, 0.25)')} AS iqr_min FROM clean GROUP BY 1""")
def _(t: Tables):
    df = prep.clean_titles(t.titles).withColumn("decade", bucket_floor("year", 10))
    d = P.describe(df, ["duration_min"], [.25, .5, .75], ["decade"]).withColumnRenamed("n", "known").alias("d")
    sizes = df.groupBy("decade").agg(F.count(F.lit(1)).alias("n")).alias("s")
    return d.join(sizes, F.col("d.decade").eqNullSafe(F.col("s.decade"))).select(
        "s.decade", "n", "known", (100 * (F.col("n") - F.col("known")) / F.col("n")).alias("missing_pct"), F.col("p50").alias("median_min"),
        (F.col("p75") - F.col("p25")).alias("iqr_min"))


@query("a9_size_vs_count", "WITH " + SQL_TITLES + " SELECT genre, count(*) AS titles, count(rating) AS rated FROM titles GROUP BY 1")
def _(t: Tables):
    return t.titles.groupBy("genre").agg(F.count(F.lit(1)).alias("titles"), F.count("rating").alias("rated"))


@query("a10_value_counts", f"SELECT p_brand, count(*) AS n, {r('count(*) * 1.0 / sum(count(*)) OVER ()')} AS share FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 15")
def _(t: Tables):
    counts = P.value_counts(t.part, ["p_brand"])
    return counts.withColumn("share", F.col("n") / t.part.agg(F.count(F.lit(1))).scalar()).orderBy(F.desc("n"), "p_brand").limit(15)


@query("a11_frequency_of_frequencies", "SELECT n AS times, count(*) AS values FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1")
def _(t: Tables):
    return P.freq_of_freq(t.orders, "o_custkey")


@query("a12_categorical_summary", union(f"""SELECT '{c}' AS "column", count(*) AS distinct_values, arg_min({c}, (-n, {c})) AS mode, max(n) AS mode_count,
 {r('count(*) * 1.0 / sum(n)')} AS unique_ratio FROM (SELECT {c}, count(*) AS n FROM part GROUP BY 1)""" for c in ("p_name", "p_brand", "p_type")))
def _(t: Tables):
    return P.categorical_summary(t.part, ["p_name", "p_brand", "p_type"])


@query("a13_pooled_counts", "WITH " + SQL_CLEAN + """ SELECT value, count(*) AS n FROM (SELECT unnest([actor_1, actor_2, actor_3]) AS value FROM clean)
WHERE value IS NOT NULL GROUP BY 1""")
def _(t: Tables):
    return P.value_counts(P.pooled(prep.clean_titles(t.titles), ["actor_1", "actor_2", "actor_3"]), ["value"])


@query("a14_values_in_several_slots", "WITH " + SQL_CLEAN + """, s AS (SELECT actor_1 AS value, 1 AS slot FROM clean UNION ALL SELECT actor_2, 2 FROM clean UNION ALL SELECT actor_3, 3 FROM clean)
SELECT value, count(DISTINCT slot) AS slots FROM s WHERE value IS NOT NULL GROUP BY 1 HAVING count(DISTINCT slot) > 1""")
def _(t: Tables):
    pool = P.pooled(prep.clean_titles(t.titles), ["actor_1", "actor_2", "actor_3"])
    return pool.groupBy("value").agg(F.count_distinct("slot").alias("slots")).where("slots > 1")


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("a15_contingency", "SELECT hour(ts)::BIGINT AS hour, " + ", ".join(f"count(*) FILTER (event_type = '{x}') AS {x}" for x in _TYPES) + " FROM events GROUP BY 1")
def _(t: Tables):
    return P.contingency(t.events, F.hour("ts").alias("hour"), "event_type", _TYPES)


@query("a16_null_patterns", "WITH " + SQL_TITLES + """ SELECT year IS NULL AS year_missing, duration IS NULL AS duration_missing, rating IS NULL AS rating_missing,
 director IS NULL AS director_missing, count(*) AS n FROM titles GROUP BY ALL""")
def _(t: Tables):
    return P.null_patterns(t.titles, ["year", "duration", "rating", "director"])


@query("a17_token_stats", f"""WITH x AS (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS token, p_retailprice AS v FROM part)
SELECT token, count(*) AS n, {r('avg(v)')} AS mean, {r('stddev_samp(v)')} AS std, {r('quantile_cont(v, 0.5)')} AS median FROM x GROUP BY 1 HAVING count(*) >= 50""")
def _(t: Tables):
    return P.token_stats(t.part.withColumn("tokens", split_tokens("p_name", " ")), "tokens", "p_retailprice", 50)


@query("a18_binned_frequency", """WITH c AS (SELECT count(*) AS n FROM orders GROUP BY o_custkey), l AS (SELECT unnest(['1','2-5','6-10','11-20','21-50','>50']) AS bin)
SELECT l.bin, count(c.n) AS customers FROM l LEFT JOIN c ON l.bin = CASE WHEN n <= 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20'
 WHEN n <= 50 THEN '21-50' ELSE '>50' END GROUP BY 1""")
def _(t: Tables):
    labels = ["1", "2-5", "6-10", "11-20", "21-50", ">50"]
    per = P.value_counts(t.orders, ["o_custkey"])
    binned = per.groupBy(band("n", [0, 1, 5, 10, 20, 50, float("inf")], labels, right=True).alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
    return reindex(binned, "bin", labels, {"customers": 0}).select("bin", "customers")


_KS = (2, 3, 5, 10, 15, 20, 30)


@query("a19_coverage", "WITH c AS (SELECT count(*) AS n FROM orders GROUP BY o_custkey) " + union(
    f"SELECT {k}::BIGINT AS min_count, count(*) FILTER (n >= {k}) AS values_kept, coalesce(sum(n) FILTER (n >= {k}), 0)::BIGINT AS rows_covered, "
    f"{r(f'100.0 * coalesce(sum(n) FILTER (n >= {k}), 0) / sum(n)')} AS pct_covered FROM c" for k in _KS))
def _(t: Tables):
    return P.coverage(P.value_counts(t.orders, ["o_custkey"]), _KS)


@query("a19_slot_coverage", "WITH " + SQL_CLEAN + """, p AS (SELECT DISTINCT row_id, unnest([actor_1, actor_2, actor_3]) AS v FROM clean), q AS (SELECT * FROM p WHERE v IS NOT NULL),
c AS (SELECT v, count(*) AS n FROM q GROUP BY 1), b AS (SELECT row_id, max(n) AS n FROM q JOIN c USING (v) GROUP BY 1) """ + union(
    f"SELECT {k}::BIGINT AS min_count, (SELECT count(*) FILTER (n >= {k}) FROM c) AS values_kept, count(*) FILTER (n >= {k}) AS rows_covered FROM b" for k in (10, 50, 100)))
def _(t: Tables):
    return P.slot_coverage(prep.clean_titles(t.titles), ["actor_1", "actor_2", "actor_3"], "row_id", (10, 50, 100))


@query("a20_duplicate_stats", """WITH g AS (SELECT l_quantity, l_discount, l_tax, l_returnflag, count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS f FROM lineitem GROUP BY ALL)
SELECT sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS extra_copies, sum(n) FILTER (n > 1)::BIGINT AS rows_in_groups, count(*) FILTER (n > 1) AS groups, max(n) AS largest_group,
 (sum(f) FILTER (n > 1))::BIGINT AS flagged_in_groups, sum(f)::BIGINT AS flagged_rows, """ + r("100.0 * sum(f) FILTER (n > 1) / sum(f)") + """ AS flagged_share FROM g""")
def _(t: Tables):
    return D.duplicate_stats(t.lineitem, ["l_quantity", "l_discount", "l_tax", "l_returnflag"], F.col("l_linestatus") == "F")


@query("a20_group_sizes", "SELECT n AS group_size, count(*) AS groups FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_quantity) GROUP BY 1")
def _(t: Tables):
    return D.group_size_distribution(t.lineitem, ["l_partkey", "l_quantity"])


@query("a21_conflicting_labels", """WITH g AS (SELECT count(*) AS n, count(DISTINCT l_linestatus) AS d FROM lineitem GROUP BY l_partkey, l_linenumber)
SELECT count(*) AS feature_groups, count(*) FILTER (d > 1) AS conflicting_groups, coalesce(sum(n) FILTER (d > 1), 0)::BIGINT AS conflicting_rows FROM g""")
def _(t: Tables):
    return conflicting_labels(t.lineitem, ["l_partkey", "l_linenumber"], "l_linestatus")


_PAIRS = [(a, b) for j, a in enumerate(LINE_NUMERIC) for b in LINE_NUMERIC[j + 1:]]


@query("a22_correlations", union(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM lineitem" for a, b in _PAIRS))
def _(t: Tables):
    return P.correlations(t.lineitem, LINE_NUMERIC)


@query("a22_strongest_pairs", "SELECT * FROM (" + union(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM lineitem" for a, b in _PAIRS)
       + ") ORDER BY abs(r) DESC, a, b LIMIT 2")
def _(t: Tables):
    c = P.correlations(t.lineitem, LINE_NUMERIC).withColumn("r", F.round("r", 6))
    return c.orderBy(F.abs("r").desc(), "a", "b").limit(2)


_SPEARMAN = f"""WITH x AS (SELECT l_quantity AS a, l_tax + l_discount AS b FROM lineitem),
k AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1)/2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1)/2.0 AS rb FROM x)
SELECT count(*) AS n, {r('corr(ra, rb)')} AS rho FROM k"""


@query("a23_spearman", _SPEARMAN)
def _(t: Tables):
    return P.spearman(t.lineitem.withColumn("s", F.col("l_tax") + F.col("l_discount")), "l_quantity", "s")


@query("a23_spearman_range_partitioned", _SPEARMAN)
def _(t: Tables):
    return P.spearman(t.lineitem.withColumn("s", F.col("l_tax") + F.col("l_discount")), "l_quantity", "s")


@query("a25_class_separation", union(f"""SELECT '{c}' AS "column", count(*) FILTER (y=0) AS n_0, {r(f'avg({c}) FILTER (y=0)')} AS mean_0, {r(f'quantile_cont({c}, 0.5) FILTER (y=0)')} AS p50_0,
 {r(f'stddev_samp({c}) FILTER (y=0)')} AS std_0, count(*) FILTER (y=1) AS n_1, {r(f'avg({c}) FILTER (y=1)')} AS mean_1, {r(f'quantile_cont({c}, 0.5) FILTER (y=1)')} AS p50_1,
 {r(f'stddev_samp({c}) FILTER (y=1)')} AS std_1, {r(f'(avg({c}) FILTER (y=1) - avg({c}) FILTER (y=0)) / sqrt(((count(*) FILTER (y=0) - 1) * var_samp({c}) FILTER (y=0) + (count(*) FILTER (y=1) - 1) * var_samp({c}) FILTER (y=1)) / (count(*) - 2))')} AS std_mean_diff
 FROM (SELECT *, (l_linestatus = 'F')::INT AS y FROM lineitem)""" for c in LINE_NUMERIC))
def _(t: Tables):
    return P.class_separation(t.lineitem, LINE_NUMERIC, F.col("l_linestatus") == "F")


@query("a26_scale_audit", f"""WITH x AS (SELECT 'price' AS feature_group, 'p' AS c, l_extendedprice AS v FROM lineitem UNION ALL SELECT 'rates', 'd', l_discount FROM lineitem
UNION ALL SELECT 'rates', 't', l_tax FROM lineitem UNION ALL SELECT 'quantity', 'q', l_quantity FROM lineitem)
SELECT feature_group, count(DISTINCT c) AS columns, {r('min(v)')} AS min, {r('max(v)')} AS max, {r('max(v)-min(v)')} AS range, {r('avg(v)')} AS mean, {r('stddev_pop(v)')} AS std FROM x GROUP BY 1""")
def _(t: Tables):
    return P.scale_audit(t.lineitem, {"price": ["l_extendedprice"], "rates": ["l_discount", "l_tax"], "quantity": ["l_quantity"]})


_FENCE = "quantile_cont({c}, 0.25) - 1.5*(quantile_cont({c}, 0.75)-quantile_cont({c}, 0.25)) AS lo, quantile_cont({c}, 0.75) + 1.5*(quantile_cont({c}, 0.75)-quantile_cont({c}, 0.25)) AS hi"


@query("a27_iqr_audit", "WITH " + SQL_TRANSACTIONS + " " + union(f"""SELECT '{c}' AS "column", {r('any_value(lo)')} AS lower, {r('any_value(hi)')} AS upper, count(*) FILTER ({c} < lo) AS below,
 count(*) FILTER ({c} > hi) AS above, {r(f'100.0 * count(*) FILTER ({c} < lo OR {c} > hi) / count(*)')} AS outlier_pct FROM tx, (SELECT {_FENCE.replace('{c}', c)} FROM tx)""" for c in ("amount", "k")))
def _(t: Tables):
    return O.iqr_audit(t.transactions, ["amount", "k"])


@query("a28_flagged_by_class", "WITH " + SQL_TRANSACTIONS + f""", f AS (SELECT {_FENCE.replace('{c}', 'amount')} FROM tx)
SELECT label::BIGINT AS label, count(*) AS rows, count(*) FILTER (amount < lo OR amount > hi) AS flagged, {r('100.0 * count(*) FILTER (amount < lo OR amount > hi) / count(*)')} AS flagged_pct
FROM tx, f GROUP BY 1""")
def _(t: Tables):
    return O.flagged_by_class(O.flag_iqr(t.transactions, ["amount"]), "is_outlier", "label")


@query("a29_z_outliers", union(f"""SELECT '{c}' AS "column", count(*) FILTER (abs(({c} - m)/s) > {z}) AS outliers FROM {tbl}, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM {tbl})"""
                              for c, z, tbl in [("value", 3, "events"), ("event_id", 3, "events")]))
def _(t: Tables):
    return O.z_audit(t.events, ["value", "event_id"])


@query("a30_hourly_by_class", "WITH " + SQL_TRANSACTIONS + """ SELECT floor(time/3600)::BIGINT AS hour, count(*) FILTER (label=0) AS class_0, count(*) FILTER (label=1) AS class_1 FROM tx GROUP BY 1""")
def _(t: Tables):
    c = P.contingency(t.transactions, F.floor(F.col("time") / 3600).alias("hour"), "label", [0, 1])
    return c.select("hour", col("0").alias("class_0"), col("1").alias("class_1"))


@query("a30_busiest_hour", "WITH " + SQL_TRANSACTIONS + """, h AS (SELECT floor(time/3600)::BIGINT AS hour, count(*) AS n FROM tx GROUP BY 1)
SELECT arg_min(hour, (n, hour)) AS quietest, min(n) AS quietest_n, arg_max(hour, (n, -hour)) AS busiest, max(n) AS busiest_n FROM h""")
def _(t: Tables):
    h = t.transactions.groupBy(F.floor(F.col("time") / 3600).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return h.agg(F.min_by("hour", F.struct("n", "hour")).alias("quietest"), F.min("n").alias("quietest_n"),
                 F.max_by("hour", F.struct(F.col("n"), -F.col("hour"))).alias("busiest"), F.max("n").alias("busiest_n"))


@query("a31_class_histogram", "WITH " + SQL_TRANSACTIONS + f""", e AS (SELECT least(quantile_cont(amount, 0.001), quantile_cont(amount, 0.01) FILTER (label=1)) AS lo,
 greatest(quantile_cont(amount, 0.999), quantile_cont(amount, 0.99) FILTER (label=1)) AS hi FROM tx),
h AS (SELECT label, least(floor((amount - lo)/((hi-lo)/60)), 59)::BIGINT AS bin, count(*) AS n, any_value((hi-lo)/60) AS w FROM tx, e WHERE amount BETWEEN lo AND hi GROUP BY 1, 2)
SELECT label::BIGINT AS label, bin, n, {r('n / (sum(n) OVER (PARTITION BY label) * w)')} AS density FROM h""")
def _(t: Tables):
    tx = t.transactions
    return P.histogram(tx, "amount", P.class_histogram_limits(tx, "amount", "label"), 60, ["label"])


@query("a32_fixed_histogram", f"""WITH h AS (SELECT least(floor((l_quantity - 0)/2.5), 19)::BIGINT AS bin, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1)
SELECT bin, n, {r('n / (sum(n) OVER () * 2.5)')} AS density FROM h""")
def _(t: Tables):
    return P.histogram(t.lineitem, "l_quantity", t.lineitem.agg(F.lit(0.0).alias("lo"), F.lit(50.0).alias("hi")), 20)


_ECDF = "WITH " + SQL_TRANSACTIONS + f""", h AS (SELECT label, amount, count(*) AS n FROM tx GROUP BY 1, 2)
SELECT label::BIGINT AS label, amount, n, {r('sum(n) OVER (PARTITION BY label ORDER BY amount) / sum(n) OVER (PARTITION BY label)')} AS ecdf FROM h"""


@query("a33_ecdf", _ECDF)
def _(t: Tables):
    return P.ecdf(t.transactions, "amount", ["label"])


@query("a33_ecdf_range_partitioned", _ECDF)
def _(t: Tables):
    return P.ecdf(t.transactions, "amount", ["label"])


@query("a34_linear_fit", union(f"SELECT '{c}' AS feature, {r(f'regr_slope(l_extendedprice, {c})', 4)} AS slope, {r(f'regr_intercept(l_extendedprice, {c})', 4)} AS intercept FROM lineitem"
                               for c in ("l_quantity", "l_discount", "l_tax")), 4)
def _(t: Tables):
    return P.linear_fit(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@query("a35_box_stats", f"""WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM events GROUP BY 1),
w AS (SELECT e.event_type, min(value) AS lo, max(value) AS hi FROM events e JOIN q USING (event_type) WHERE value BETWEEN a - 1.5*(c-a) AND c + 1.5*(c-a) GROUP BY 1)
SELECT event_type, n, {r('a')} AS p25, {r('b')} AS p50, {r('c')} AS p75, {r('lo')} AS whisker_low, {r('hi')} AS whisker_high FROM q JOIN w USING (event_type)""")
def _(t: Tables):
    return O.box_stats(t.events, "value", "event_type")


@query("a36_monotonic", """SELECT count(*) AS rows, count(*) FILTER (ts < p) AS descents, count(*) FILTER (ts < p) = 0 AS is_monotonic
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS p FROM events)""")
def _(t: Tables):
    return P.monotonic(t.events, "event_id", "ts")


@query("a36_monotonic_values", """SELECT count(*) AS rows, count(*) FILTER (value < p) AS descents, count(*) FILTER (value < p) = 0 AS is_monotonic
FROM (SELECT value, lag(value) OVER (ORDER BY event_id) AS p FROM events)""")
def _(t: Tables):
    return P.monotonic(t.events, "event_id", "value")


@query("a37_class_balance", f"""SELECT count(*) AS rows, count(*) FILTER (toxic=1) AS positives, count(*) FILTER (toxic=0) AS negatives, {r('100.0*sum(toxic)/count(*)')} AS positive_pct,
 {r('greatest(sum(toxic), count(*)-sum(toxic)) / least(sum(toxic), count(*)-sum(toxic))')} AS imbalance_ratio, {r('count(*)/sum(toxic)')} AS one_in,
 {r('greatest(sum(toxic), count(*)-sum(toxic))/count(*)')} AS majority_accuracy FROM labels""")
def _(t: Tables):
    return P.class_balance(t.labels, F.col("toxic"))


@query("a41_constant_and_rank", None)
def _(t: Tables):
    df = t.lineitem.withColumn("twice", 2 * F.col("l_quantity")).withColumn("fixed", F.lit(1.0))
    cols = ["l_quantity", "l_tax", "twice", "fixed"]
    return P.constant_columns(df, cols).withColumn("matrix_rank", F.lit(P.gram_rank(df, cols)))


@query("a42_constant_columns", """SELECT unnest(['l_quantity','l_tax','fixed']) AS "column", unnest([min(l_quantity)=max(l_quantity), min(l_tax)=max(l_tax), true]) AS is_constant FROM lineitem""")
def _(t: Tables):
    return P.constant_columns(t.lineitem.withColumn("fixed", F.lit(1)), ["l_quantity", "l_tax", "fixed"])


# ---------------------------------------------------------------- duplicates and identity

@query("d1_duplicate_flags", "WITH " + SQL_TITLES + f""" SELECT row_id, count(*) OVER w AS copies, row_id <> min(row_id) OVER w AS is_extra, count(*) OVER w > 1 AS in_duplicate_group
FROM titles WINDOW w AS (PARTITION BY {', '.join(TITLE_COLUMNS)})""")
def _(t: Tables):
    return D.duplicate_flags(t.titles, TITLE_COLUMNS, "row_id").select("row_id", "copies", "is_extra", "in_duplicate_group")


@query("d1_duplicate_flags_hot_keys", "SELECT o_orderkey, count(*) OVER w AS copies, o_orderkey <> min(o_orderkey) OVER w AS is_extra FROM orders WINDOW w AS (PARTITION BY o_orderstatus, o_orderpriority)")
def _(t: Tables):
    return D.duplicate_flags(t.orders, ["o_orderstatus", "o_orderpriority"], "o_orderkey").select("o_orderkey", "copies", "is_extra")


@query("d2_dedupe_first", "WITH " + SQL_TITLES + f" SELECT min(row_id) AS row_id FROM titles GROUP BY {', '.join(TITLE_COLUMNS)}")
def _(t: Tables):
    return D.dedupe_first(t.titles, list(TITLE_COLUMNS), "row_id").select("row_id")


@query("d2_dedupe_first_subset", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders GROUP BY o_custkey, o_orderstatus)")
def _(t: Tables):
    return D.dedupe_first(t.orders, ["o_custkey", "o_orderstatus"], "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("d3_duplicates_with_target", "WITH " + SQL_TITLES + f""" SELECT count(*) FILTER (row_id <> f) AS extra_copies, count(*) FILTER (row_id <> f AND rating IS NOT NULL) AS extra_with_target
FROM (SELECT row_id, rating, min(row_id) OVER (PARTITION BY {', '.join(TITLE_COLUMNS)}) AS f FROM titles)""")
def _(t: Tables):
    f = D.duplicate_flags(t.titles, TITLE_COLUMNS, "row_id")
    return f.agg(count_if(F.col("is_extra")).alias("extra_copies"), count_if(F.col("is_extra") & F.col("rating").isNotNull()).alias("extra_with_target"))


@query("d4_repeat_flags", "SELECT p_partkey, count(*) OVER (PARTITION BY p_name, p_size) > 1 AS repeated FROM part")
def _(t: Tables):
    f = D.duplicate_flags(t.part.select("p_partkey", "p_name", "p_size"), ["p_name", "p_size"], "p_partkey")
    return f.select("p_partkey", F.col("in_duplicate_group").alias("repeated"))


@query("d5_group_key", "WITH " + SQL_RATED + r""" SELECT row_id, CASE WHEN name IS NULL THEN 'no title|' || row_id::VARCHAR
 ELSE lower(regexp_replace(name, '\s+', ' ', 'g')) || '|' || coalesce(year::INT::VARCHAR, 'NA') END AS group_id FROM rated""")
def _(t: Tables):
    return prep.modelling_frame(t.titles, "row_id", "rating").select("row_id", group_key("name", "year", "row_id").alias("group_id"))


@query("d6_row_id_unique", "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders")
def _(t: Tables):
    one = t.orders.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("ids"))
    return one.withColumn("is_unique", F.col("rows") == F.col("ids"))


