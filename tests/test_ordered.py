"""Range-partitioned plans give the results of the single-window plans, whatever the layout."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import ordered as O
from tabulon.operators import profile as P
from tabulon.operators.skew import attach, attach_few


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(1)
    # Two thirds of the rows share one value of one group.
    rows = [("hot", 7.0)] * 600 + [(rng.choice("ab"), round(rng.gauss(0, 3), 1)) for _ in range(300)] + [("c", None)]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_quantiles_match_numpy(values, parts):
    got = {r["g"]: r for r in O.quantiles(values.repartition(parts), "v", [.05, .5, .9], ["g"]).collect()}
    pdf = values.dropna().toPandas()
    for g, s in pdf.groupby("g")["v"]:
        assert [got[g][n] for n in ("p5", "p50", "p90")] == pytest.approx(list(np.quantile(s, [.05, .5, .9])))
    assert "c" not in got


def test_running_totals_descending(values):
    h = O.histogram_of(values.where("v is not null"), ["g"], "v")
    got = {(r["g"], r["v"]): (r["cum_n"], r["tot_n"]) for r in O.running_totals(h, ["g"], "v", ["n"], descending=True, ranges=9).collect()}
    want, rows = {}, h.collect()
    for g in {r["g"] for r in rows}:
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: -r["v"])
        for i, r in enumerate(mine):
            want[(g, r["v"])] = sum(x["n"] for x in mine[:i + 1]), sum(x["n"] for x in mine)
    assert got == want


def test_running_totals_with_null_group(spark):
    h = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("x", 1.0, 5)], "g string, v double, n int")
    got = {(r["g"], r["v"]): (r["cum_n"], r["tot_n"]) for r in O.running_totals(h, ["g"], "v", ["n"]).collect()}
    assert got == {(None, 1.0): (2, 5), (None, 2.0): (5, 5), ("x", 1.0): (5, 5)}


def test_spearman_matches_pandas(spark):
    rng = random.Random(3)
    rows = [(float(rng.randint(0, 8)), float(rng.randint(0, 5))) for _ in range(300)]
    rows = [(x, y + x / 3) for x, y in rows]
    got = P.spearman(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()
    ranked = pd.DataFrame(rows, columns=["x", "y"]).rank()
    assert got["rho"] == pytest.approx(ranked["x"].corr(ranked["y"]))


def test_describe_and_moments(values):
    pdf = values.toPandas()["v"].dropna()
    r = P.describe(values, ["v"]).first()
    assert (r["n"], r["mean"], r["std"]) == (len(pdf), pytest.approx(pdf.mean()), pytest.approx(pdf.std()))
    m = P.moments(values, ["v"]).first()
    assert m["skewness"] == pytest.approx(pdf.skew()) and m["kurtosis"] == pytest.approx(pdf.kurt())


def test_hash_numbering_is_a_permutation(spark):
    from tabulon.functions.draws import digest
    ids = spark.range(1000).withColumn("h", digest(1, "id"))
    a = {r["id"]: r["number"] for r in O.hash_numbering(ids, "h", "id").collect()}
    b = {r["id"]: r["number"] for r in O.hash_numbering(ids.repartition(13), "h", "id").collect()}
    assert a == b and sorted(a.values()) == list(range(1000))


@pytest.mark.parametrize("join", [attach, attach_few])
def test_attach_with_hot_and_null_keys(spark, join):
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string")
    t = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = join(df, t, ["k"], rows="n", spread="id").collect()
    sizes = pd.Series([k for _, k in rows]).value_counts(dropna=False).to_dict()
    sizes = {None if not isinstance(k, str) else k: v for k, v in sizes.items()}
    assert len(got) == 3000 and all(r["n"] == sizes[r["k"]] for r in got)


def test_attach_without_null_keys_keeps_rows(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "id int, k string")
    t = spark.createDataFrame([("a", 5), ("b", 1)], "k string, n int")
    got = attach(df, t, ["k"], rows="n", spread="id", null_keys=False).collect()
    assert len(got) == 100 and sum(r["n"] == 5 for r in got) == 50


def test_monotonic_across_ranges(spark):
    up = spark.range(500).withColumn("v", F.col("id") * 2)
    assert P.monotonic(up.repartition(5), "id", "v", ranges=16).first()["is_monotonic"]
    down = up.withColumn("v", F.when(F.col("id") == 250, -1).otherwise(F.col("v")))
    assert P.monotonic(down, "id", "v", ranges=16).first()["descents"] == 1


def test_profile_exact_and_approximate(spark):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5), (2, "b", None)], "i int, s string, d double")
    exact = {r["column"]: r for r in P.profile(df).collect()}
    assert (exact["i"]["distinct_values"], exact["s"]["nulls"], exact["d"]["max_value"]) == (2, 1, "2.5")
    rough = {r["column"]: r for r in P.profile(df, exact=False).collect()}
    assert {c: r["distinct_values"] for c, r in exact.items()} == {c: r["distinct_values"] for c, r in rough.items()}


def test_gram_rank(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), F.pmod("id", F.lit(7)).cast("double").alias("c"))
    assert P.gram_rank(df, ["a", "b", "c"]) == 2
