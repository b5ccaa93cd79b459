"""Input tables and the working tables derived from them (with the same derivation in SQL).

The derived tables give the operators inputs of the shapes they are made for: a dirty text table
with a half-missing target, an imbalanced transaction table, a long score table and a table of
regression predictions. All of them grow with their source tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.draws import digest
from tabulon.functions.numeric import elapsed_seconds
from tabulon.operators.skew import attach_few
from tabulon.session import one_row

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
         "pages", "benchmark", "labels", "conversations")
TITLE_COLUMNS = ("name", "year", "duration", "genre", "rating", "votes", "director", "actor_1", "actor_2", "actor_3")
LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def sql_digest(seed: str, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in keys]])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in NAMES:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        raise AttributeError(name)

    @cached_property
    def titles(self) -> DataFrame:
        """Dirty metadata rows, urgent ones present twice under another row id."""
        o, c = self.orders, self.customer
        base = o.join(c, o.o_custkey == c.c_custkey)
        price, status, prio = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
        once = base.select(
            F.col("o_orderkey").alias("row_id"),
            F.when(price < 4000, F.lit("  ")).otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit("  "), "c_name", F.lit(" "))).alias("name"),
            F.when((status == "P") & (prio == "5-LOW"), F.lit(None)).when(price > 490000, F.year("o_orderdate").cast("string"))
            .otherwise(F.concat(F.lit("("), F.year("o_orderdate").cast("string"), F.lit(")"))).alias("year"),
            F.when(prio != "4-NOT SPECIFIED", F.concat(F.floor(price / 2500).cast("string"), F.lit(" min"))).alias("duration"),
            F.when((status == "P") & (prio == "1-URGENT"), F.lit(" , ")).otherwise(
                F.concat("c_mktsegment", F.lit(", "), F.substring(prio, 3, 20), F.lit(" ,"), "c_mktsegment", F.lit(", "), status)).alias("genre"),
            F.when(status != "O", F.round(1 + 9 * price / 500000, 1)).alias("rating"),
            F.when(price > 400000, F.concat(F.lit("$"), F.floor(price / 10000).cast("string"), F.lit("K")))
            .otherwise(F.format_number(F.floor(price), 0)).alias("votes"),
            F.when(~((status == "F") & (prio == "3-MEDIUM")), F.concat(F.lit("Director "), F.pmod("o_custkey", F.lit(211)).cast("string"))).alias("director"),
            F.concat(F.lit("Actor "), F.pmod("o_custkey", F.lit(307)).cast("string")).alias("actor_1"),
            F.concat(F.lit(" Actor "), F.pmod("o_orderkey", F.lit(401)).cast("string")).alias("actor_2"),
            F.when(prio != "2-HIGH", F.concat(F.lit("Actor "), F.pmod(F.col("o_custkey") + F.col("o_orderkey"), F.lit(307)).cast("string"))).alias("actor_3"),
            F.when(prio == "1-URGENT", 2).otherwise(1).alias("_copies"))
        copies = once.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
        return copies.select((F.col("row_id") + F.col("_copy") * F.lit(1000000000000)).alias("row_id"), *TITLE_COLUMNS)

    @cached_property
    def transactions(self) -> DataFrame:
        """event_id, time (seconds since the first event), amount, k, label (1 = error)."""
        e = self.events
        start = one_row(e.agg(F.min("ts").alias("t0")))["t0"]
        return e.select("event_id", "user_id", "event_type", elapsed_seconds("ts", start).alias("time"), F.col("value").alias("amount"),
                        F.get_json_object("props", "$.k").cast("int").alias("k"), (F.col("event_type") == "error").cast("int").alias("label"))

    @cached_property
    def scored(self) -> DataFrame:
        """(config, fold, row_id, label, score, amount): three scores per event, five folds."""
        k = F.get_json_object("props", "$.k").cast("int")
        e = self.events.select(F.col("event_id").alias("row_id"), (F.pmod(digest("fold", "event_id"), F.lit(5)) + 1).cast("int").alias("fold"),
                               (F.col("event_type") == "error").cast("int").alias("label"), F.col("value").alias("amount"),
                               F.least(F.col("value") / 500, F.lit(1.0)).alias("a"), (k / 100.0).alias("b"))
        options = F.array(F.struct(F.lit("amount").alias("config"), F.col("a").alias("score")),
                          F.struct(F.lit("key").alias("config"), F.col("b").alias("score")),
                          F.struct(F.lit("mix").alias("config"), (F.floor((F.col("a") + F.col("b")) / 2 * 1000) / 1000.0).alias("score")))
        return e.select("row_id", "fold", "label", "amount", F.inline(options)).select("config", "fold", "row_id", "label", "score", "amount")

    @cached_property
    def predicted(self) -> DataFrame:
        """Order totals (scaled to 0..10) with three group-mean predictions."""
        o = self.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("yr"),
                               (F.col("o_totalprice") / 50000).alias("actual"))
        n = F.count(F.lit(1)).alias("_n")
        by_prio = o.groupBy("o_orderpriority").agg(F.avg("actual").alias("p_prio"), n)
        by_year = o.groupBy("yr", "o_orderstatus").agg(F.avg("actual").alias("p_year"), n)
        out = attach_few(o, by_prio, ["o_orderpriority"], rows="_n", spread="o_orderkey").drop("_n")
        out = attach_few(out, by_year, ["yr", "o_orderstatus"], rows="_n", spread="o_orderkey").drop("_n")
        return out.withColumn("p_mean", o.agg(F.avg("actual")).scalar())


SQL_TITLES = """titles AS (
 SELECT o_orderkey + g.n * 1000000000000 AS row_id,
  CASE WHEN o_totalprice < 4000 THEN '  ' ELSE ' ' || c_mktsegment || '  ' || c_name || ' ' END AS name,
  CASE WHEN o_orderstatus='P' AND o_orderpriority='5-LOW' THEN NULL WHEN o_totalprice > 490000 THEN year(o_orderdate)::VARCHAR
       ELSE '(' || year(o_orderdate)::VARCHAR || ')' END AS year,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN floor(o_totalprice/2500)::BIGINT::VARCHAR || ' min' END AS duration,
  CASE WHEN o_orderstatus='P' AND o_orderpriority='1-URGENT' THEN ' , '
       ELSE c_mktsegment || ', ' || substr(o_orderpriority,3,20) || ' ,' || c_mktsegment || ', ' || o_orderstatus END AS genre,
  CASE WHEN o_orderstatus <> 'O' THEN round(1 + 9*o_totalprice/500000, 1) END AS rating,
  CASE WHEN o_totalprice > 400000 THEN '$' || floor(o_totalprice/10000)::BIGINT::VARCHAR || 'K'
       ELSE format('{:,}', floor(o_totalprice)::BIGINT) END AS votes,
  CASE WHEN NOT (o_orderstatus='F' AND o_orderpriority='3-MEDIUM') THEN 'Director ' || (o_custkey % 211)::VARCHAR END AS director,
  'Actor ' || (o_custkey % 307)::VARCHAR AS actor_1, ' Actor ' || (o_orderkey % 401)::VARCHAR AS actor_2,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN 'Actor ' || ((o_custkey + o_orderkey) % 307)::VARCHAR END AS actor_3
 FROM orders JOIN customer ON o_custkey = c_custkey
 JOIN (SELECT 0 AS n UNION ALL SELECT 1) g ON g.n = 0 OR o_orderpriority = '1-URGENT')"""

SQL_CLEAN = SQL_TITLES + """, clean AS (
 SELECT row_id, nullif(trim(name),'') AS name, year AS year_raw,
  nullif(regexp_extract(year, '^\\((\\d{4})\\)$', 1),'')::DOUBLE AS year,
  nullif(regexp_extract(duration, '^(\\d+) min$', 1),'')::DOUBLE AS duration_min, nullif(trim(genre),'') AS genre, rating, votes,
  CASE WHEN regexp_full_match(votes, '\\d{1,3}(,\\d{3})*') THEN replace(votes, ',', '')::DOUBLE END AS votes_num,
  nullif(trim(director),'') AS director, nullif(trim(actor_1),'') AS actor_1, nullif(trim(actor_2),'') AS actor_2,
  nullif(trim(actor_3),'') AS actor_3,
  CASE WHEN len(list_filter(list_transform(string_split(genre, ','), lambda x: trim(x)), lambda x: x <> '')) > 0
       THEN list_filter(list_transform(string_split(genre, ','), lambda x: trim(x)), lambda x: x <> '') END AS tokens_all
 FROM titles)"""

SQL_RATED = SQL_CLEAN + f""", firsts AS (
 SELECT min(row_id) AS row_id FROM titles GROUP BY {', '.join(TITLE_COLUMNS)}),
rated AS (SELECT c.* FROM clean c JOIN firsts USING (row_id) WHERE rating IS NOT NULL)"""

SQL_TRANSACTIONS = """tx AS (
 SELECT event_id, user_id, event_type, date_diff('microsecond', (SELECT min(ts) FROM events), ts)::DOUBLE / 1e6 AS time,
  value AS amount, json_extract_string(props, '$.k')::INT AS k, (event_type = 'error')::INT AS label FROM events)"""

SQL_SCORED = f"""base AS (
 SELECT event_id AS row_id, ({sql_digest('fold', 'event_id')} % 5 + 1)::BIGINT AS fold, (event_type = 'error')::INT AS label,
  value AS amount, least(value/500, 1.0) AS a, json_extract_string(props, '$.k')::INT / 100.0 AS b FROM events),
scored AS (SELECT 'amount' AS config, fold, row_id, label, a::DOUBLE AS score, amount FROM base
 UNION ALL SELECT 'key', fold, row_id, label, b::DOUBLE, amount FROM base
 UNION ALL SELECT 'mix', fold, row_id, label, floor((a + b)/2*1000)/1000.0::DOUBLE, amount FROM base)"""

SQL_PREDICTED = """pred AS (
 SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) AS yr, o_totalprice/50000 AS actual,
  avg(o_totalprice/50000) OVER (PARTITION BY o_orderpriority) AS p_prio,
  avg(o_totalprice/50000) OVER (PARTITION BY year(o_orderdate), o_orderstatus) AS p_year,
  avg(o_totalprice/50000) OVER () AS p_mean FROM orders)"""


