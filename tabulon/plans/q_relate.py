"""Queries: joins, windows, top-k, set comparisons, reshaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import text as X
from tabulon.functions.numeric import bucket_floor, count_if
from tabulon.operators import relate as R
from tabulon.operators import reshape as H
from tabulon.operators.errors import with_residuals
from tabulon.operators.metrics import decide
from tabulon.operators.neighbours import nearest_neighbours
from tabulon.operators.ordered import average_ranks, quantiles, running_totals
from tabulon.operators.skew import attach
from tabulon.operators.splits import split
from tabulon.plans import preparation as prep
from tabulon.plans.registry import query, r, union
from tabulon.plans.tables import SQL_CLEAN, SQL_PREDICTED, SQL_SCORED, SQL_TITLES, SQL_TRANSACTIONS, Tables, sql_digest



def sql_split(table: str, key: str, share: float = 0.2, seed: int = 42, strata: str = "", keep: str = "*") -> str:
    """The split rule in SQL: smallest hashes form the test part."""
    part = f"PARTITION BY {strata}" if strata else ""
    return (f"(SELECT {keep}, CASE WHEN row_number() OVER ({part} ORDER BY {sql_digest(str(seed), key)}, {key}) <= "
            f"round(count(*) OVER ({part}) * {share}) THEN 'test' ELSE 'train' END AS split FROM {table})")


# ---------------------------------------------------------------- joins

@query("j1_left_join_results_to_rows", f"""WITH e AS (SELECT l_orderkey, {r('sum(l_extendedprice)', 2)} AS line_total, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_totalprice, line_total, lines FROM orders LEFT JOIN e ON o_orderkey = l_orderkey""")
def _(t: Tables):
    per = t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("line_total"), F.count(F.lit(1)).alias("lines"))
    return t.orders.join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_totalprice", "line_total", "lines")


@query("j2_lookup_with_default", "WITH s AS " + sql_split("part", "p_partkey") + """, c AS (SELECT p_name AS k, count(*) AS n FROM s WHERE split='train' AND p_size > 25 GROUP BY 1)
SELECT p_partkey, coalesce(n, 0)::BIGINT AS train_count FROM s LEFT JOIN c ON p_name = k WHERE split = 'test'""")
def _(t: Tables):
    parts = split(t.part, "p_partkey")
    counts = parts.train.where("p_size > 25").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    return R.lookup(parts.test, counts, "p_name", "n", default=0, rows="n", spread="p_partkey", name="train_count").select("p_partkey", "train_count")


@query("j3_lookup_two_level_fallback", f"""WITH m AS (SELECT date_trunc('month', l_shipdate) AS mon, quantile_cont(l_extendedprice, 0.5) AS med FROM lineitem WHERE l_discount > 0.02 GROUP BY 1 HAVING count(*) >= 100),
g AS (SELECT quantile_cont(l_extendedprice, 0.5) AS gm FROM lineitem WHERE l_discount > 0.02)
SELECT date_trunc('month', l_shipdate)::DATE::VARCHAR AS month, {r('avg(coalesce(CASE WHEN l_discount > 0.02 THEN l_extendedprice END, med, gm))', 4)} AS mean_price
FROM lineitem LEFT JOIN m ON date_trunc('month', l_shipdate) = mon, g GROUP BY 1""", 4)
def _(t: Tables):
    df = t.lineitem.select(F.date_format("l_shipdate", "yyyy-MM-01").alias("month"), "l_orderkey",
                           F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("price"))
    known = df.where(F.col("price").isNotNull())
    sizes = known.groupBy("month").agg(F.count(F.lit(1)).alias("n")).where("n >= 100")
    med = quantiles(known, "price", [.5], ["month"], names=["med"]).join(sizes, "month")
    overall = quantiles(known, "price", [.5], names=["m"]).select("m").scalar()
    out = attach(df, med, ["month"], rows="n", spread="l_orderkey")
    return out.groupBy("month").agg(F.avg(F.coalesce("price", "med", overall)).alias("mean_price"))


@query("j4_semi_join", "SELECT count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def _(t: Tables):
    big = t.lineitem.where("l_quantity > 45").select("l_orderkey").distinct()
    return t.orders.join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").agg(F.count(F.lit(1)).alias("n"))


@query("j5_anti_join_unseen_names", "WITH s AS " + sql_split("orders", "o_orderkey", 0.4) + """ SELECT DISTINCT o_custkey FROM s WHERE split='test' AND o_custkey NOT IN (SELECT o_custkey FROM s WHERE split='train')""")
def _(t: Tables):
    parts = split(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", test=0.4)
    return parts.test.select("o_custkey").distinct().join(parts.train.select("o_custkey").distinct(), "o_custkey", "left_anti")


@query("j6_compare_count_tables", "WITH " + SQL_TITLES + """, a AS (SELECT year, count(*) AS n FROM titles WHERE rating > 5 GROUP BY 1), b AS (SELECT year, count(*) AS n FROM titles WHERE rating <= 5 AND duration IS NOT NULL GROUP BY 1)
SELECT coalesce(a.year, b.year) AS year, coalesce(a.n, 0) AS left_n, coalesce(b.n, 0) AS right_n FROM a FULL OUTER JOIN b ON a.year IS NOT DISTINCT FROM b.year""")
def _(t: Tables):
    n = F.count(F.lit(1)).alias("n")
    a = t.titles.where("rating > 5").groupBy("year").agg(n)
    b = t.titles.where(F.col("rating").isNotNull() & (F.col("rating") <= 5) & F.col("duration").isNotNull()).groupBy("year").agg(n)
    return R.compare_counts(a, b, ["year"])


@query("j7_side_by_side", """WITH a AS (SELECT p_brand, count(*) AS x FROM part WHERE p_size > 40 GROUP BY 1), b AS (SELECT p_brand, count(*) AS y FROM part WHERE p_type = 'LARGE' GROUP BY 1)
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(x, 0)::BIGINT AS x, coalesce(y, 0)::BIGINT AS y FROM a FULL OUTER JOIN b ON a.p_brand = b.p_brand""")
def _(t: Tables):
    a = t.part.where("p_size > 40").groupBy("p_brand").agg(F.count(F.lit(1)).alias("x"))
    b = t.part.where("p_type = 'LARGE'").groupBy("p_brand").agg(F.count(F.lit(1)).alias("y"))
    return a.join(b, "p_brand", "full_outer").na.fill(0, ["x", "y"])


@query("j8_rows_by_replicates", f"""SELECT b AS replicate, count(*) AS draws, {r('avg(u)', 4)} AS mean_u FROM
 (SELECT b, {sql_digest('9', 'b', 'event_id')}::DOUBLE / 1152921504606846976.0 AS u FROM events, (SELECT unnest(range(1, 6)) AS b)) GROUP BY 1""", 4)
def _(t: Tables):
    from tabulon.functions.draws import uniform
    reps = t.events.select("event_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("replicate"))
    return reps.groupBy("replicate").agg(F.count(F.lit(1)).alias("draws"), F.avg(uniform(9, "replicate", "event_id")).alias("mean_u"))


_KNN = """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings {w}), d AS (SELECT a.vec_id AS row_id, b.vec_id AS neighbour_id, list_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbour_id) AS rank FROM d)"""


@query("j9_nearest_neighbours", _KNN.replace("{w}", "") + f" SELECT row_id, rank, neighbour_id, {r('distance')} AS distance FROM k WHERE rank <= 5")
def _(t: Tables):
    return nearest_neighbours(t.embeddings, "vec_id", "embedding", 5)


@query("j10_paired_folds", "WITH " + SQL_SCORED + f""", m AS (SELECT config, fold, sqrt(avg((label - score)^2)) AS rmse FROM scored GROUP BY 1, 2)
SELECT a.config, count(*) AS folds, {r('avg(a.rmse - b.rmse)')} AS mean_diff, {r('stddev_samp(a.rmse - b.rmse)')} AS std_diff, count(*) FILTER (a.rmse < b.rmse) AS folds_better, count(*) FILTER (a.rmse > b.rmse) AS folds_worse
FROM m a JOIN m b ON a.fold = b.fold AND b.config = 'mix' GROUP BY 1""")
def _(t: Tables):
    from tabulon.operators.choose import paired_folds
    from tabulon.operators.metrics import regression_metrics
    return paired_folds(regression_metrics(t.scored, "label", "score", ["config", "fold"]), "config", "fold", "rmse", "mix")


# ---------------------------------------------------------------- windows

@query("w1_average_ranks", "SELECT l_quantity, count(*) AS n, min(rk) AS first_rank, " + r("min(rk) + (count(*) - 1)/2.0") + """ AS avg_rank
FROM (SELECT l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rk FROM lineitem) GROUP BY 1""")
def _(t: Tables):
    return average_ranks(t.lineitem, "l_quantity", descending=True)


@query("w1_rank_results", "SELECT p_brand, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS rank_min, " +
       r("rank() OVER (ORDER BY count(*) DESC) + (count(*) OVER (PARTITION BY count(*)) - 1)/2.0") + " AS rank_avg FROM part GROUP BY 1")
def _(t: Tables):
    c = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return R.rank_results(R.rank_results(c, "n", name="rank_min"), "n", name="rank_avg", method="average")


@query("w2_monthly_delta", f"""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1)
SELECT month, {r('total', 2)} AS total, {r('total - lag(total) OVER (ORDER BY month)', 2)} AS delta FROM m""", 2)
def _(t: Tables):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.sum("o_totalprice").alias("total"))
    return R.step_delta(m, "month", "total")


@query("w3_error_positions", "WITH " + SQL_PREDICTED + f""", k AS (SELECT o_orderkey, abs(actual - p_mean) AS e, row_number() OVER (ORDER BY round(abs(actual - p_mean), 9) DESC, o_orderkey) AS position FROM pred)
SELECT o_orderkey, {r('e')} AS abs_error, position FROM k WHERE position <= 50""")
def _(t: Tables):
    from pyspark.sql import Window
    p = with_residuals(t.predicted, "actual", "p_mean").select("o_orderkey", F.round("abs_error", 9).alias("abs_error"))
    top = p.orderBy(F.desc("abs_error"), "o_orderkey").limit(50)
    return top.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("abs_error"), "o_orderkey")))


@query("w4_first_row_per_outcome", "SELECT event_type, event_id, " + r("value") + " AS value FROM events WHERE event_id IN (SELECT min(event_id) FROM events GROUP BY event_type)")
def _(t: Tables):
    return R.first_per(t.events, "event_type", "event_id", ["value"])


@query("w5_group_size_windows", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS customer_orders, o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) AS is_first FROM orders")
def _(t: Tables):
    g = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("customer_orders"), F.min("o_orderkey").alias("_f"))
    out = attach(t.orders.select("o_orderkey", "o_custkey"), g, ["o_custkey"], rows="customer_orders", spread="o_orderkey")
    return out.select("o_orderkey", "customer_orders", (F.col("o_orderkey") == F.col("_f")).alias("is_first"))


@query("w6_running_totals", "WITH " + SQL_SCORED + """, h AS (SELECT config, score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scored GROUP BY 1, 2)
SELECT config, """ + r('score') + """ AS score, pos, neg, sum(pos) OVER w::BIGINT AS cum_pos, sum(neg) OVER w::BIGINT AS cum_neg, sum(pos) OVER (PARTITION BY config)::BIGINT AS tot_pos, sum(neg) OVER (PARTITION BY config)::BIGINT AS tot_neg
FROM h WINDOW w AS (PARTITION BY config ORDER BY score DESC)""")
def _(t: Tables):
    h = t.scored.groupBy("config", "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    return running_totals(h, ["config"], "score", ["pos", "neg"], descending=True)


# ---------------------------------------------------------------- sort and top-k

@query("k1_sort_mixed_directions", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 25")
def _(t: Tables):
    return R.top_k(t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice"), [F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


@query("k2_top_k", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20")
def _(t: Tables):
    return R.top_k(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 20)


@query("k3_top_tenth", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.9) FROM orders)")
def _(t: Tables):
    cut = quantiles(t.orders, "o_totalprice", [.9], names=["cut"]).select("cut").scalar()
    return t.orders.where(F.col("o_totalprice") >= cut).select("o_orderkey", "o_totalprice")


@query("k4_arg_max", """SELECT arg_max(p_brand, (n, p_brand)) AS most, arg_min(p_brand, (n, p_brand)) AS least, max(n) AS most_n, min(n) AS least_n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)""")
def _(t: Tables):
    c = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct("n", "p_brand")
    return c.agg(F.max_by("p_brand", key).alias("most"), F.min_by("p_brand", key).alias("least"), F.max("n").alias("most_n"), F.min("n").alias("least_n"))


@query("k6_edge_of_grid", f"""WITH g AS (SELECT l_linenumber::BIGINT AS setting, round(avg(l_extendedprice), 6) AS metric FROM lineitem GROUP BY 1)
SELECT setting, {r('metric')} AS metric, setting = (SELECT min(setting) FROM g) AS at_lower_edge, setting = (SELECT max(setting) FROM g) AS at_upper_edge FROM g ORDER BY g.metric, setting LIMIT 1""")
def _(t: Tables):
    g = t.lineitem.groupBy(F.col("l_linenumber").alias("setting")).agg(F.round(F.avg("l_extendedprice"), 6).alias("metric"))
    return R.edge_of_grid(g.orderBy("metric", "setting").limit(1), g, "setting")


# ---------------------------------------------------------------- sets

@query("u1_stack_results", f"""SELECT 'mean' AS model, {r('avg(abs(o_totalprice - m))', 4)} AS mae FROM orders, (SELECT avg(o_totalprice) AS m FROM orders)
UNION ALL SELECT 'zero', {r('avg(abs(o_totalprice))', 4)} FROM orders""", 4)
def _(t: Tables):
    m = t.orders.agg(F.avg("o_totalprice")).scalar()
    a = t.orders.agg(F.avg(F.abs(F.col("o_totalprice") - m)).alias("mae")).select(F.lit("mean").alias("model"), "mae")
    b = t.orders.agg(F.avg(F.abs("o_totalprice")).alias("mae")).select("mae", F.lit("zero").alias("model"))
    return a.unionByName(b)


@query("u2_key_overlap", """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus='F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority='1-URGENT')
SELECT (SELECT count(*) FROM a) AS left_keys, (SELECT count(*) FROM b) AS right_keys, (SELECT count(*) FROM a JOIN b USING (k)) AS both,
 (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS only_left, (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS only_right""")
def _(t: Tables):
    return R.key_overlap(t.orders.where("o_orderstatus = 'F'"), t.orders.where("o_orderpriority = '1-URGENT'"), "o_custkey")


@query("u3_set_difference", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity = 50 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity < 5")
def _(t: Tables):
    k = lambda condition: t.lineitem.where(condition).select("l_partkey").distinct()
    return k("l_quantity = 50").subtract(k("l_quantity < 5"))


@query("u4_missed_set_overlap", "WITH " + SQL_SCORED + """, m AS (SELECT config, row_id FROM scored WHERE label = 1 AND score < 0.5) """ + union(
    f"""SELECT '{a}' AS config_a, '{b}' AS config_b, count(DISTINCT row_id) FILTER (config='{a}') AS size_a, count(DISTINCT row_id) FILTER (config='{b}') AS size_b,
 (SELECT count(*) FROM m x JOIN m y ON x.row_id=y.row_id WHERE x.config='{a}' AND y.config='{b}') AS common,
 {r(f"(SELECT count(*) FROM m x JOIN m y ON x.row_id=y.row_id WHERE x.config='{a}' AND y.config='{b}') * 1.0 / count(DISTINCT row_id)")} AS jaccard, false AS identical
 FROM m WHERE config IN ('{a}','{b}')""" for a, b in [("amount", "key"), ("amount", "mix"), ("key", "mix")]))
def _(t: Tables):
    missed = t.scored.where((F.col("label") == 1) & ~decide("score", 0.5))
    return R.membership_overlap(missed, "config", "row_id", ["amount", "key", "mix"])


@query("u5_frame_equality", """SELECT count(*) FILTER (l_tax = 0)::BIGINT AS only_left, count(*) FILTER (l_tax = 0)::BIGINT AS only_right, false AS equal FROM lineitem""")
def _(t: Tables):
    from tabulon.operators.contracts import same_rows
    changed = t.lineitem.withColumn("l_tax", F.when(F.col("l_tax") == 0, F.lit(1.0)).otherwise(F.col("l_tax")))
    return same_rows(t.lineitem, changed)


# ---------------------------------------------------------------- reshape

@query("h1_wide_to_long", "SELECT \"column\", count(*) AS n, " + r("sum(value)", 2) + """ AS total FROM (SELECT 'l_tax' AS "column", l_tax AS value FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem
UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem) GROUP BY 1""", 2)
def _(t: Tables):
    long = H.to_long(t.lineitem.select("l_tax", "l_discount", "l_quantity"), [], ["l_tax", "l_discount", "l_quantity"])
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("h2_long_to_wide", "SELECT user_id, " + ", ".join(r(f"sum(value) FILTER (event_type='{x}')", 2) + f" AS {x}" for x in _TYPES) + " FROM events GROUP BY 1", 2)
def _(t: Tables):
    return H.to_wide(t.events, ["user_id"], "event_type", _TYPES, F.sum("value"))


@query("h3_transpose", union(f"SELECT '{s}' AS statistic, " + ", ".join(r(f"{e} FILTER (l_returnflag='{f}')", 4) + f" AS \"{f}\"" for f in "ANR") + " FROM lineitem"
                             for s, e in [("mean", "avg(l_extendedprice)"), ("biggest", "max(l_extendedprice)")]), 4)
def _(t: Tables):
    g = t.lineitem.groupBy("l_returnflag").agg(F.avg("l_extendedprice").alias("mean"), F.max("l_extendedprice").alias("biggest"))
    return H.transpose_stats(g, "l_returnflag", ["mean", "biggest"], ["A", "N", "R"])


@query("h4_explode_tokens", "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY 1")
def _(t: Tables):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("h5_flatten_params", "SELECT k, count(*) AS n, " + r("avg(value)") + " AS mean_value FROM (SELECT json_extract_string(props, '$.k')::BIGINT AS k, value FROM events) GROUP BY 1")
def _(t: Tables):
    flat = t.events.select("value", F.from_json("props", "k int").alias("params")).select("value", "params.*")
    return flat.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))


@query("h6_reindex", """SELECT l.lang, (row_number() OVER () - 1)::BIGINT AS lang_order, coalesce(n, 0)::BIGINT AS n FROM (SELECT unnest(['xx','en','de','fr','es','zz']) AS lang) l
LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) d USING (lang)""".replace("(row_number() OVER () - 1)", "list_position(['xx','en','de','fr','es','zz'], l.lang) - 1"))
def _(t: Tables):
    return H.reindex(t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", ["xx", "en", "de", "fr", "es", "zz"], {"n": 0})


# ---------------------------------------------------------------- scalar functions

@query("f1_f3_parsers", "WITH " + SQL_CLEAN + " SELECT row_id, year, duration_min, votes_num FROM clean")
def _(t: Tables):
    return t.titles.select("row_id", X.parse_year("year").alias("year"), X.parse_minutes("duration").alias("duration_min"),
                           X.parse_grouped_int("votes").alias("votes_num"))


@query("f4_split_tokens", "WITH " + SQL_CLEAN + """, u AS (SELECT row_id, unnest(tokens_all) AS token, generate_subscripts(tokens_all, 1) AS p FROM clean),
d AS (SELECT row_id, token, min(p) AS p FROM u GROUP BY 1, 2), g AS (SELECT row_id, string_agg(token, ';' ORDER BY p) AS tokens FROM d GROUP BY 1)
SELECT row_id, tokens FROM clean LEFT JOIN g USING (row_id)""")
def _(t: Tables):
    return t.titles.select("row_id", F.array_join(X.split_tokens("genre"), ";").alias("tokens"))


@query("f5_f7_text_flags", "WITH " + SQL_TITLES + """ SELECT row_id, nullif(trim(name), '') AS name, (votes IS NOT NULL AND votes LIKE '$%') AS malformed, coalesce(replace(duration, ' min', '')::INT < 40, false) AS short
FROM titles""")
def _(t: Tables):
    df = t.titles.select("row_id", X.clean_text("name").alias("name"), "votes", X.parse_grouped_int("votes").alias("v"), X.parse_minutes("duration").alias("d"))
    return df.select("row_id", "name", X.malformed("votes", "v").alias("malformed"), X.flag_below("d", 40).alias("short"))


@query("f8_f9_lenient_inputs", """WITH x AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '(' || year(o_orderdate) || ')' WHEN 'O' THEN ' ' || year(o_orderdate) || '.0 ' ELSE year(o_orderdate) || 'x' END AS y,
 year(o_orderdate)::DOUBLE AS yy, o_orderstatus AS s, floor(o_totalprice/2500) AS m FROM orders)
SELECT o_orderkey, CASE WHEN s IN ('F','O') THEN yy END AS year, CASE WHEN s IN ('F','O') THEN m::DOUBLE END AS minutes FROM x""")
def _(t: Tables):
    s, y, m = F.col("o_orderstatus"), F.year("o_orderdate").cast("string"), F.floor(F.col("o_totalprice") / 2500).cast("string")
    year = F.when(s == "F", F.concat(F.lit("("), y, F.lit(")"))).when(s == "O", F.concat(F.lit(" "), y, F.lit(".0 "))).otherwise(F.concat(y, F.lit("x")))
    mins = F.when(s == "F", F.concat(m, F.lit(" min"))).when(s == "O", F.concat(m, F.lit(".9"))).otherwise(F.concat(m, F.lit(" hours")))
    df = t.orders.select("o_orderkey", year.alias("y"), mins.alias("m"))
    return df.select("o_orderkey", X.lenient_year("y").alias("year"), X.lenient_minutes("m").alias("minutes"))


@query("f10_f12_buckets_and_logs", "WITH " + SQL_TRANSACTIONS + f""" SELECT event_id, (floor((amount - 250)/50)*50)::BIGINT AS bucket, {r('ln(1 + amount)')} AS log1p, {r('log10(nullif(amount, 0))')} AS log10, {r('sqrt(amount)')} AS root,
 {r('time/3600', 2)} AS hours, floor(time/3600)::BIGINT AS hour FROM tx""")
def _(t: Tables):
    return t.transactions.select("event_id", bucket_floor(F.col("amount") - 250, 50).alias("bucket"), F.log1p("amount").alias("log1p"),
                                 F.log10("amount").alias("log10"), F.sqrt("amount").alias("root"), F.round(F.col("time") / 3600, 2).alias("hours"),
                                 F.floor(F.col("time") / 3600).alias("hour"))


@query("f13_regex_tests", r"""SELECT lang, count(*) FILTER (regexp_matches(text, '\d{3}')) AS three_digits, count(*) FILTER (starts_with(text, 'Th')) AS starts_th, count(*) FILTER (contains(text, 'http')) AS has_link,
 count(*) FILTER (regexp_full_match(text, '[\s\S]*\.')) AS ends_with_dot FROM documents GROUP BY 1""")
def _(t: Tables):
    x = F.col("text")
    return t.documents.groupBy("lang").agg(count_if(x.rlike(r"\d{3}")).alias("three_digits"), count_if(x.startswith("Th")).alias("starts_th"),
                                           count_if(x.contains("http")).alias("has_link"), count_if(x.rlike(r"\A[\s\S]*\.\z")).alias("ends_with_dot"))


@query("f14_strict_numbers", """WITH x AS (SELECT event_id, json_extract_string(props, '$.k')::INT AS k, value FROM events)
SELECT event_id, CASE WHEN k < 20 THEN NULL WHEN k < 40 THEN k * 1.0::DOUBLE WHEN k < 60 THEN -k * 1000.0::DOUBLE ELSE value END AS number FROM x""")
def _(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    text = (F.when(k < 10, F.lit("true")).when(k < 20, F.lit("1,5")).when(k < 40, F.concat(F.lit("+"), k.cast("string")))
            .when(k < 60, F.concat(F.lit("-"), k.cast("string"), F.lit("e3"))).otherwise(F.col("value").cast("string")))
    return t.events.select("event_id", X.strict_number(text).alias("number"))


@query("f15_f16_name_sets", "WITH " + SQL_CLEAN + """, u AS (SELECT row_id, unnest([actor_1, actor_2, actor_3]) AS v FROM clean), g AS (SELECT row_id, string_agg(DISTINCT v, ';' ORDER BY v) AS names, count(v) > count(DISTINCT v) AS repeats FROM u GROUP BY 1)
SELECT row_id, names, repeats FROM g""")
def _(t: Tables):
    cols = ["actor_1", "actor_2", "actor_3"]
    return t.titles.select("row_id", F.array_join(X.name_set(cols), ";").alias("names"), X.repeats_a_name(cols).alias("repeats"))


@query("f18_percentage_error", "WITH " + SQL_PREDICTED + f" SELECT o_orderkey, {r('100*abs((actual - p_prio)/actual)')} AS pct_error, printf('%.1f%%', round(100*abs((actual - p_prio)/actual), 1)) AS share_text FROM pred WHERE actual > 0.5")
def _(t: Tables):
    p = with_residuals(t.predicted, "actual", "p_prio").where("actual > 0.5")
    return p.select("o_orderkey", "pct_error", F.format_string("%.1f%%", F.round("pct_error", 1)).alias("share_text"))


@query("f19_group_mapping", "SELECT feature_group, count(*) AS cells, " + r("sum(v)", 2) + " AS total FROM (SELECT 'money' AS feature_group, l_extendedprice AS v FROM lineitem UNION ALL SELECT 'rate', l_tax FROM lineitem UNION ALL SELECT 'rate', l_discount FROM lineitem) GROUP BY 1", 2)
def _(t: Tables):
    groups = F.create_map(*[F.lit(x) for x in ("l_extendedprice", "money", "l_tax", "rate", "l_discount", "rate")])
    long = H.to_long(t.lineitem.select("l_extendedprice", "l_tax", "l_discount"), [], ["l_extendedprice", "l_tax", "l_discount"])
    return long.groupBy(groups[F.col("column")].alias("feature_group")).agg(F.count(F.lit(1)).alias("cells"), F.sum("value").alias("total"))


@query("f20_json_scalars", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def _(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).where("k IS NOT NULL")


@query("m23_prepare_records", "WITH " + SQL_TITLES + """ SELECT row_id, CASE WHEN year LIKE '(%' THEN substr(year, 2, 4)::DOUBLE ELSE year::DOUBLE END AS year, replace(duration, ' min', '')::DOUBLE AS duration_min,
 nullif(trim(genre), '') AS genre, trim(director) AS director, trim(actor_2) AS actor_2, year IS NOT NULL AS usable FROM titles""")
def _(t: Tables):
    return prep.prepare_records(t.titles).select("row_id", "year", "duration_min", "genre", "director", "actor_2", "usable")


