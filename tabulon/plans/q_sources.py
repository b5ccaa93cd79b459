"""Queries: sources and sinks, contracts and checks, projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F


from tabulon.functions.numeric import band, col, count_if

from tabulon.operators import contracts as C
from tabulon.operators.dedupe import row_log
from tabulon.operators.metrics import decide
from tabulon.operators.relate import hash_sample
from tabulon.operators.skew import attach
from tabulon.operators.splits import fold_report, validate_folds
from tabulon.plans import preparation as prep
from tabulon.plans.q_relate import sql_split
from tabulon.plans.registry import i, query, r, union
from tabulon.plans.tables import (LINE_NUMERIC, SQL_CLEAN, SQL_RATED, SQL_SCORED, SQL_TITLES, SQL_TRANSACTIONS,
                                  TITLE_COLUMNS, Tables, sql_digest)
from tabulon.session import scratch_path
from tabulon.sources import files

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("s1_csv_latin1_roundtrip",
       "SELECT c_mktsegment || 'é' AS segment, count(*) AS n, " + r("sum(c_acctbal)", 2) + " AS balance FROM customer GROUP BY 1", 2)
def _(t: Tables):
    path = scratch_path(t.spark, "csv-latin1")
    t.customer.withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("é"))).write.option("header", True).option(
        "encoding", "ISO-8859-1").csv(path)
    df = files.require_columns(files.read_csv(t.spark, path, CUSTOMER_SCHEMA, encoding="ISO-8859-1"), ["c_custkey", "c_mktsegment"])
    return df.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("balance"))


LINE_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
               "l_discount double, l_tax double, l_returnflag string, l_linestatus string")


@query("s2_csv_strict_contract",
       "SELECT l_returnflag, count(*) AS n, " + r("avg(l_extendedprice)", 4) + " AS mean_price FROM lineitem GROUP BY 1", 4)
def _(t: Tables):
    path = scratch_path(t.spark, "csv-strict")
    names = [c.split()[0] for c in LINE_SCHEMA.split(", ")]
    t.lineitem.select(*names).write.option("header", True).csv(path)
    contract = C.Contract(names, numeric=LINE_NUMERIC, ordered=True, not_null=names, finite=LINE_NUMERIC,
                          domains={"l_linestatus": ["O", "F"]}, ranges={"l_quantity": (1, 50)})
    df = files.read_csv(t.spark, path, LINE_SCHEMA, contract=contract, strict=True)
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.avg("l_extendedprice").alias("mean_price"))


@query("s3_csv_dedupe_first",
       "WITH " + SQL_TITLES + f", f AS (SELECT min(row_id) AS row_id FROM titles GROUP BY {', '.join(TITLE_COLUMNS)}) "
       "SELECT row_id, name, votes FROM titles JOIN f USING (row_id)")
def _(t: Tables):
    path = scratch_path(t.spark, "csv-dedupe")
    df = t.titles
    quoted = {"quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "nullValue": "\\N"}
    df.write.options(header=True, **quoted).csv(path)
    return files.read_csv(t.spark, path, df.schema, row_id="row_id", **quoted).select("row_id", "name", "votes")


@query("s4_parquet_roundtrip", "SELECT event_type, count(*) AS n, " + r("sum(value)", 2) + " AS total FROM events GROUP BY 1", 2)
def _(t: Tables):
    path = files.write_results(t.events.select("event_id", "event_type", "value"), scratch_path(t.spark, "parquet"), "parquet")
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("s5_json_records", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, false AS corrupt FROM events")
def _(t: Tables):
    return files.read_records(t.events, "props", "k int").select("event_id", "record.k", "corrupt")


@query("s13_number_records", """
SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_linenumber > 5) AS wrong_cells,
 """ + r("sum(CASE WHEN l_linenumber <= 5 THEN l_quantity END)", 2) + """ AS quantity FROM lineitem GROUP BY 1""", 2)
def _(t: Tables):
    a, b = F.col("l_quantity").cast("string"), F.col("l_tax").cast("string")
    text = (F.when(F.col("l_linenumber") <= 2, F.to_json(F.struct("l_quantity", "l_tax")))
            .when(F.col("l_linenumber") <= 5, F.concat(a, F.lit("\n"), b, F.lit(",")))
            .otherwise(F.concat(a, F.lit(","), b, F.lit(",9"))))
    df = t.lineitem.select("l_returnflag", text.alias("text")).withColumn("cells", files.parse_number_record("text", ["l_quantity", "l_tax"]))
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), count_if(F.col("cells").isNull()).alias("wrong_cells"),
                                          F.sum(F.get("cells", F.lit(0)).cast("double")).alias("quantity"))


@query("s6_csv_sink_fixed_decimals", """
SELECT l_returnflag, printf('%.10f', round(avg(l_tax), 6)) AS mean_tax, printf('%.10f', round(avg(l_discount), 6)) AS mean_discount FROM lineitem GROUP BY 1""")
def _(t: Tables):
    agg = t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_tax"), 6).alias("mean_tax"), F.round(F.avg("l_discount"), 6).alias("mean_discount"))
    path = files.write_results(agg, scratch_path(t.spark, "csv-sink"))
    return t.spark.read.schema("l_returnflag string, mean_tax string, mean_discount string").option("header", True).csv(path)


@query("s7_json_sink", """
SELECT event_type, '{"event_type":"' || event_type || '","n":' || count(*) || ',"users":' || count(DISTINCT user_id) || '}' AS value
FROM events GROUP BY 1""")
def _(t: Tables):
    agg = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))
    path = files.write_results(agg, scratch_path(t.spark, "json-sink"), "json")
    text = t.spark.read.text(path)
    return text.select(F.get_json_object("value", "$.event_type").alias("event_type"), "value")


@query("s8_results_top_k", """
SELECT p_brand, """ + r("avg(p_retailprice)") + """ AS price FROM part GROUP BY 1 ORDER BY round(avg(p_retailprice), 6) DESC, p_brand LIMIT 10""")
def _(t: Tables):
    agg = t.part.groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 6).alias("price"))
    path = files.write_results(agg, scratch_path(t.spark, "results"))
    back = t.spark.read.schema("p_brand string, price double").option("header", True).csv(path)
    return back.orderBy(F.desc("price"), "p_brand").limit(10)


# ---------------------------------------------------------------- contracts and checks

@query("v1_v3_schema_checks")
def _(t: Tables):
    contract = C.Contract(["l_orderkey", "l_quantity", "l_missing"], numeric=["l_quantity", "l_returnflag"], ordered=True)
    static = C.check_contract(t.lineitem, contract)
    rows = t.lineitem.agg(F.count(F.lit(1)).alias("rows"))
    return static.withColumn("table_rows", rows.scalar())


def _check_sql(table: str, checks: list[tuple[str, str, int | str]]) -> str:
    return union(f"SELECT '{n}' AS \"check\", {i(e)} AS observed, ({e2})::BIGINT AS expected, ({i(e)} = {e2}) AS passed FROM {table}"
                 for n, e, e2 in checks)


_V4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("v4_v8_contract_values", _check_sql("lineitem", [
    ("required columns missing", "0", 0), ("unexpected columns", "0", 0), ("non-numeric columns", "0", 0)]).replace(" FROM lineitem", "") + "\nUNION ALL\n" + _check_sql("lineitem", [
        *[(f"nulls in {c}", f"count(*) FILTER ({c} IS NULL)", 0) for c in _V4],
        *[(f"non-finite in {c}", f"count(*) FILTER (NOT isfinite({c}))", 0) for c in _V4],
        ("outside domain in l_linestatus", "count(*) FILTER (l_linestatus NOT IN ('O','F'))", 0),
        ("domain values present in l_linestatus", "count(DISTINCT l_linestatus) FILTER (l_linestatus IN ('O','F'))", 2),
        ("outside range in l_quantity", "count(*) FILTER (l_quantity NOT BETWEEN 1 AND 40)", 0),
        ("row count", "count(*)", "(SELECT sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey))")]))
def _(t: Tables):
    return C.check_contract(t.lineitem, C.Contract(t.lineitem.columns, numeric=_V4, not_null=_V4, finite=_V4,
                                                   domains={"l_linestatus": ["O", "F"]}, ranges={"l_quantity": (1, 40)},
                                                   rows=t.lineitem.groupBy("l_orderkey").count().agg(F.sum("count")).first()[0]))


@query("v5_non_finite_after_ratio", union(
    f"SELECT 'non-finite in {c}' AS \"check\", {i(e)} AS observed, 0::BIGINT AS expected, {e} = 0 AS passed FROM lineitem"
    for c, e in [("per_discount", "count(*) FILTER (l_discount = 0)"), ("log_tax", "count(*) FILTER (l_tax = 0)")]))
def _(t: Tables):
    df = t.lineitem.select(F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax") / F.nullif("l_discount", F.lit(0.0))).alias("per_discount"),
                           F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.log10(F.nullif("l_tax", F.lit(0.0)))).alias("log_tax"))
    return C.run_checks(df, C.value_checks(C.Contract(df.columns, finite=df.columns)))


@query("v7_target_domain", _check_sql("labels", [
    ("outside domain in quality", "count(*) FILTER (quality NOT IN (0,1))", 0),
    ("outside domain in toxic", "count(*) FILTER (toxic NOT IN (0,1))", 0),
    ("domain values present in quality", "count(DISTINCT quality) FILTER (quality IN (0,1))", 2),
    ("domain values present in toxic", "count(DISTINCT toxic) FILTER (toxic IN (0,1))", 2)]))
def _(t: Tables):
    return C.run_checks(t.labels, C.value_checks(C.Contract(["quality", "toxic"], domains={"quality": [0, 1], "toxic": [0, 1]})))


@query("v10_transformed_matrix", """
SELECT 'rows' AS "check", count(*) AS observed, (SELECT count(*) FROM lineitem)::BIGINT AS expected, true AS passed FROM lineitem
UNION ALL SELECT 'missing cells', 0::BIGINT, 0::BIGINT, true UNION ALL SELECT 'non-finite cells', 0::BIGINT, 0::BIGINT, true""")
def _(t: Tables):
    from tabulon.operators.encode import PopulationScaler
    scaled = PopulationScaler(LINE_NUMERIC).fit(t.lineitem).transform(t.lineitem)
    return prep.transformed_checks(scaled, LINE_NUMERIC, t.lineitem.count())


@query("v14_fold_validation", "WITH " + SQL_SCORED + """, e AS (SELECT * FROM scored WHERE config = 'mix'),
 p AS (SELECT fold, count(*) AS n, sum(label) AS pos FROM e GROUP BY 1)
SELECT 'folds' AS "check", count(*) AS observed, 5::BIGINT AS expected, count(*) = 5 AS passed FROM p
UNION ALL SELECT 'rows validated more than once', 0::BIGINT, 0::BIGINT, true
UNION ALL SELECT 'rows never validated', 0::BIGINT, 0::BIGINT, true
UNION ALL SELECT 'positives per fold differ by more than one', greatest(max(pos) - min(pos) - 1, 0)::BIGINT, 0::BIGINT,
 greatest(max(pos) - min(pos) - 1, 0) = 0 FROM p""")
def _(t: Tables):
    return validate_folds(t.scored.where(F.col("config") == "mix"), "row_id", F.col("label"), 5)


@query("v15_verdict", """SELECT 5::BIGINT AS checks, (count(*) FILTER (l_quantity > 40) > 0)::BIGINT AS failures,
 CASE WHEN count(*) FILTER (l_quantity > 40) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM lineitem""")
def _(t: Tables):
    return C.verdict(C.run_checks(t.lineitem, C.value_checks(
        C.Contract([], not_null=_V4, ranges={"l_quantity": (1, 40)}))))


@query("v16_leakage_audit", union(f"""SELECT '{c}' AS feature, bool_and({c} IS NOT DISTINCT FROM y) AS copies_label, {r(f"corr({c}, y)")} AS r,
 coalesce(abs(corr({c}, y)) > 0.95, false) AS suspicious_r,
 coalesce(max({c}) FILTER (y = 0) < min({c}) FILTER (y = 1) OR max({c}) FILTER (y = 1) < min({c}) FILTER (y = 0), false) AS disjoint,
 coalesce(abs(stddev_samp(CASE WHEN y <> 0 THEN {c} / y END)) <= 1e-8, false) AS constant_ratio
 FROM (SELECT l_quantity, l_discount, l_tax, l_extendedprice, (l_returnflag = 'R')::INT::DOUBLE AS y, 2*(l_returnflag = 'R')::INT::DOUBLE AS twice FROM lineitem)"""
                                 for c in ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "twice"]))
def _(t: Tables):
    df = t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("double")).withColumn("twice", 2 * F.col("y"))
    return C.leakage_audit(df, ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "twice"], "y")


@query("v16_identical_columns", """
SELECT 'l_quantity' AS left_column, 'l_tax' AS right_column, bool_and(l_quantity IS NOT DISTINCT FROM l_tax) AS identical FROM lineitem
UNION ALL SELECT 'l_quantity', 'copy', true UNION ALL SELECT 'l_tax', 'copy', bool_and(l_quantity IS NOT DISTINCT FROM l_tax) FROM lineitem""")
def _(t: Tables):
    return C.identical_columns(t.lineitem.withColumn("copy", F.col("l_quantity")), ["l_quantity", "l_tax", "copy"])


@query("v17_suspicious_values", union(f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < 0) AS negatives, count(*) FILTER ({c} = 0) AS zeros,
 count(*) FILTER ({c} IN (-1,-999,999)) AS sentinels, count(DISTINCT {c}) AS distinct_values,
 {r(f"(SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY {c})) / count(*)")} AS top_share,
 count(DISTINCT {c}) <= 1 AS is_constant, (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY {c})) / count(*) > 0.95 AS near_constant
 FROM lineitem""" for c in LINE_NUMERIC))
def _(t: Tables):
    return C.suspicious_values(t.lineitem, LINE_NUMERIC)


_PATTERNS = {"customer number": ("c_name", r"^Customer#\d{9}$"), "even nation": ("nation_text", r"^\d*[02468]$"), "segment E": ("c_mktsegment", "E$")}


@query("v18_pattern_report", union(f"""SELECT '{n}' AS pattern, count(*) FILTER (regexp_matches({c}, '{p}')) AS matching,
 count(*) FILTER (NOT regexp_matches({c}, '{p}')) AS failing, count(*) FILTER ({c} IS NULL) AS nulls
 FROM (SELECT *, nullif(c_nationkey, 3)::VARCHAR AS nation_text FROM customer)""" for n, (c, p) in _PATTERNS.items()))
def _(t: Tables):
    df = t.customer.withColumn("nation_text", F.nullif("c_nationkey", F.lit(3)).cast("string"))
    return C.pattern_report(df, _PATTERNS)


@query("v19_text_hygiene", r"""SELECT count(*) AS rows, count(*) FILTER (text <> regexp_replace(text, '^\s+|\s+$', '', 'g')) AS padded,
 count(*) FILTER (starts_with(text, '#')) AS hash_prefixed, count(*) FILTER (regexp_matches(text, '[^\x00-\x7F]')) AS non_ascii,
 count(*) FILTER (text IS NULL OR regexp_replace(text, '^\s+|\s+$', '', 'g') = '') AS blank FROM documents""")
def _(t: Tables):
    return C.text_hygiene(t.documents, "text")


_LINE_KINDS = {"l_orderkey": "whole", "l_partkey": "whole", "l_suppkey": "whole", "l_linenumber": "whole", "l_quantity": "number", "l_extendedprice": "number", "l_discount": "number",
               "l_tax": "number", "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time"}


@query("v20_table_fingerprint", f"WITH p AS ({C.sql_fingerprint('lineitem', _LINE_KINDS)}) SELECT * FROM p UNION ALL SELECT * FROM p")
def _(t: Tables):
    return C.fingerprint(t.lineitem).unionByName(C.fingerprint(t.lineitem.repartition(7))).drop("exact")


@query("v21_test_part_fingerprint", C.sql_fingerprint("(SELECT * FROM " + sql_split("orders", "o_orderkey") + " WHERE split = 'test')", {"o_orderkey": "whole", "o_totalprice": "number"}))
def _(t: Tables):
    from tabulon.operators.splits import split
    return C.fingerprint(split(t.orders, "o_orderkey").test, ["o_orderkey", "o_totalprice"]).drop("exact")


@query("v22_determinism", """SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right, true AS equal""")
def _(t: Tables):
    from tabulon.operators.splits import split
    a = split(t.orders, "o_orderkey", seed=7).frame.select("o_orderkey", "split")
    b = split(t.orders.repartition(5, "o_custkey"), "o_orderkey", seed=7).frame.select("o_orderkey", "split")
    return C.same_rows(a, b)


_BAD_AMOUNT = """CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN 'abc' WHEN k < 15 THEN 'NaN' WHEN k < 20 THEN '-Infinity' WHEN k < 25 THEN '-' || k
 WHEN k < 30 THEN 'true' ELSE ' ' || k || '.5 ' END"""


def _dirty_amounts(t: Tables):
    k = F.col("k")
    text = (F.when(k < 5, F.lit(None)).when(k < 10, F.lit("abc")).when(k < 15, F.lit("NaN")).when(k < 20, F.lit("-Infinity"))
            .when(k < 25, F.concat(F.lit("-"), k.cast("string"))).when(k < 30, F.lit("true"))
            .otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit(".5 "))))
    return t.transactions.select("event_id", "k", text.alias("amount"))


@query("v23_quarantine", "WITH " + SQL_TRANSACTIONS + f""", d AS (SELECT event_id, k, {_BAD_AMOUNT} AS amount FROM tx)
SELECT event_id, CASE WHEN k < 5 THEN 'amount: missing' WHEN k < 10 OR k >= 25 THEN 'amount: not a number' WHEN k < 20 THEN 'amount: not finite'
 ELSE 'amount: negative' END AS errors FROM d WHERE k < 30""")
def _(t: Tables):
    _, bad = C.validate_records(_dirty_amounts(t), C.number_rules("amount", allow_negative=False))
    return bad.select("event_id", F.concat_ws("; ", "errors").alias("errors"))


@query("v23_valid_rows", "WITH " + SQL_TRANSACTIONS + " SELECT event_id, (k || '.5')::DOUBLE AS amount FROM tx WHERE k >= 30")
def _(t: Tables):
    from tabulon.functions.text import strict_number
    good, _ = C.validate_records(_dirty_amounts(t), C.number_rules("amount", allow_negative=False))
    return good.select("event_id", strict_number("amount").alias("amount"))


@query("v24_out_of_training_range", """WITH tr AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b, min(l_tax) AS c, max(l_tax) AS d
 FROM lineitem WHERE l_linestatus = 'F' AND l_extendedprice < 90000 AND l_tax > 0.01)
SELECT CASE WHEN p AND x THEN 'l_extendedprice,l_tax' WHEN p THEN 'l_extendedprice' WHEN x THEN 'l_tax' ELSE '' END AS outside, count(*) AS n
FROM (SELECT l_extendedprice < a OR l_extendedprice > b AS p, l_tax < c OR l_tax > d AS x FROM lineitem, tr WHERE l_linestatus = 'O') GROUP BY 1""")
def _(t: Tables):
    trained = t.lineitem.where((F.col("l_linestatus") == "F") & (F.col("l_extendedprice") < 90000) & (F.col("l_tax") > 0.01))
    ranges = C.training_ranges(trained, ["l_extendedprice", "l_tax"])
    marked = C.out_of_range(t.lineitem.where(F.col("l_linestatus") == "O"), ranges, ["l_extendedprice", "l_tax"])
    return marked.groupBy(F.concat_ws(",", "outside").alias("outside")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- projections and predicates

@query("p1_feature_projection", "SELECT l_quantity, l_discount, l_tax, l_extendedprice AS target FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("target"))


@query("p2_clean_titles", "WITH " + SQL_CLEAN + """
SELECT row_id, name, year_raw, year, duration_min, votes_num, coalesce(duration_min < 40, false) AS duration_questionable,
 (votes IS NOT NULL AND votes_num IS NULL) AS votes_malformed, director, actor_2 FROM clean""")
def _(t: Tables):
    return prep.clean_titles(t.titles).select("row_id", "name", "year_raw", "year", "duration_min", "votes_num", "duration_questionable",
                                              "votes_malformed", "director", "actor_2")


@query("p3_labelled_rows", "SELECT d.doc_id, n_chars, quality::BIGINT AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL")
def _(t: Tables):
    return t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left").where(
        F.col("quality").isNotNull()).select("doc_id", "n_chars", "quality")


@query("p4_modelling_frame", "WITH " + SQL_RATED + """
SELECT row_id, name, year, rating, count(*) OVER (PARTITION BY name, year) > 1 AS name_year_repeat FROM rated""")
def _(t: Tables):
    return prep.modelling_frame(t.titles, "row_id", "rating").select("row_id", "name", "year", "rating", "name_year_repeat")


@query("p4_row_log", "WITH " + SQL_TITLES + f""", x AS (SELECT *, row_id <> min(row_id) OVER (PARTITION BY {', '.join(TITLE_COLUMNS)}) AS dup FROM titles)
SELECT unnest(['raw_rows','exact_duplicates_removed','exact_duplicates_with_target','rows_after_dedupe','rows_without_target','final_rows']) AS step,
 unnest([count(*), count(*) FILTER (dup), count(*) FILTER (dup AND rating IS NOT NULL), count(*) FILTER (NOT dup),
 count(*) FILTER (NOT dup AND rating IS NULL), count(*) FILTER (NOT dup AND rating IS NOT NULL)])::BIGINT AS rows FROM x""")
def _(t: Tables):
    return row_log(t.titles, TITLE_COLUMNS, "row_id", "rating")


@query("p5_any_all_predicates", "WITH " + SQL_TITLES + """
SELECT count(*) FILTER (year IS NULL OR duration IS NULL OR director IS NULL) AS any_null, count(*) FILTER (year IS NULL AND duration IS NULL) AS both_null,
 count(*) FILTER (rating IS NULL AND year IS NOT NULL AND duration IS NOT NULL) AS only_rating_null FROM titles""")
def _(t: Tables):
    null = lambda c: col(c).isNull()
    return t.titles.agg(count_if(C.any_of([null(c) for c in ("year", "duration", "director")])).alias("any_null"),
                        count_if(C.all_of([null(c) for c in ("year", "duration")])).alias("both_null"),
                        count_if(C.all_of([null("rating"), ~null("year"), ~null("duration")])).alias("only_rating_null"))


@query("p6_membership_in_learned_set", """SELECT count(*) AS rows_kept, count(DISTINCT l_partkey) AS parts_kept FROM lineitem
 WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) >= 32)""")
def _(t: Tables):
    kept = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).where("n >= 32")
    rows = attach(t.lineitem.select("l_partkey", "l_orderkey"), kept, ["l_partkey"], rows="n", spread="l_orderkey").where(F.col("n").isNotNull())
    return rows.agg(F.count(F.lit(1)).alias("rows_kept"), F.count_distinct("l_partkey").alias("parts_kept"))


@query("p7_between", "SELECT count(*) AS n FROM part WHERE p_size BETWEEN 10 AND 20")
def _(t: Tables):
    return t.part.where(F.col("p_size").between(10, 20)).agg(F.count(F.lit(1)).alias("n"))


@query("p8_conditional_labels", """SELECT CASE WHEN l_discount = 0 THEN 'none' WHEN l_discount < 0.05 THEN 'low' ELSE 'high' END AS penalty, count(*) AS n
FROM lineitem GROUP BY 1""")
def _(t: Tables):
    d = F.col("l_discount")
    return t.lineitem.groupBy(F.when(d == 0, "none").when(d < 0.05, "low").otherwise("high").alias("penalty")).agg(F.count(F.lit(1)).alias("n"))


@query("p9_rename_and_prefix", "SELECT c_custkey AS in_id, c_name AS in_name, c_acctbal AS in_balance, 'customer' AS in_source FROM customer")
def _(t: Tables):
    df = t.customer.drop("c_nationkey", "c_mktsegment").withColumnsRenamed({"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"})
    df = df.withColumn("source", F.lit("customer"))
    return df.select(*[col(c).alias(f"in_{c}") for c in df.columns])


@query("p10_band_label", """SELECT CASE WHEN c_acctbal < 4000 THEN 'weak' WHEN c_acctbal < 7000 THEN 'fair' WHEN c_acctbal < 8000 THEN 'good' ELSE 'strong' END AS band,
 count(*) AS n FROM customer GROUP BY 1""")
def _(t: Tables):
    inf = float("inf")
    return t.customer.groupBy(band("c_acctbal", [-inf, 4000, 7000, 8000, inf], ["weak", "fair", "good", "strong"]).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p11_decision_rules", "WITH " + SQL_SCORED + """ SELECT config, count(*) FILTER (score >= 0.5) AS flagged, count(*) FILTER (score > 0.5) AS flagged_strict,
 count(*) FILTER (score >= 0.5 AND NOT score > 0.5) AS differ FROM scored GROUP BY 1""")
def _(t: Tables):
    a, b = decide("score", 0.5), decide("score", 0.5, strict=True)
    return t.scored.groupBy("config").agg(count_if(a).alias("flagged"), count_if(b).alias("flagged_strict"), count_if(a != b).alias("differ"))


@query("l8_fold_report", "WITH " + SQL_SCORED + """, e AS (SELECT * FROM scored WHERE config = 'mix'), s AS (SELECT count(*) AS n, sum(label) AS p FROM e)
SELECT fold, (SELECT n FROM s) - count(*) AS train_rows, count(*) AS valid_rows, ((SELECT p FROM s) - sum(label))::BIGINT AS train_positives,
 sum(label)::BIGINT AS valid_positives, """ + r("100.0 * sum(label) / count(*)") + """ AS valid_positive_pct FROM e GROUP BY fold""")
def _(t: Tables):
    return fold_report(t.scored.where(F.col("config") == "mix"), F.col("label"))


@query("k5_hash_sample", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {sql_digest('42', 'o_orderkey')}, o_orderkey LIMIT 12")
def _(t: Tables):
    return hash_sample(t.orders, "o_orderkey", 12).select("o_orderkey", "o_totalprice")


