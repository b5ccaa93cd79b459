"""Split and fold properties: exact sizes, disjointness, replay under any layout."""

import pytest
from pyspark.sql import functions as F

from tabulon.operators import contracts as C
from tabulon.operators import splits as L
from tabulon.operators.relate import key_overlap


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1003).select(F.col("id"), (F.col("id") % 50 == 0).cast("int").alias("y"), F.floor(F.sqrt("id")).alias("g"))


def assignment(df, c):
    return {r["id"]: r[c] for r in df.select("id", c).collect()}


def test_split_sizes_and_replay(rows):
    want = assignment(L.split(rows, "id").frame, "split")
    assert sum(v == "test" for v in want.values()) == round(1003 * .2)
    for parts in (1, 4, 17):
        assert assignment(L.split(rows.repartition(parts), "id").frame, "split") == want
    assert assignment(L.split(rows, "id", seed=43).frame, "split") != want


def test_folds_do_not_depend_on_the_layout(rows):
    for kw in ({}, {"stratify": "y"}, {"group": "g"}):
        assert assignment(L.folds(rows.repartition(7), "id", 4, **kw), "fold") == assignment(L.folds(rows, "id", 4, **kw), "fold")


def test_stratified_counts(rows):
    per = {(r["y"], r["split"]): r["n"] for r in L.split(rows, "id", stratify="y").frame.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert per[(1, "test")] == round(21 * .2) and per[(0, "test")] == round(982 * .2)


def test_null_stratum_is_a_stratum(spark):
    df = spark.range(100).withColumn("y", F.when(F.col("id") < 50, F.lit(1)))
    per = {(r["y"], r["split"]): r["n"] for r in L.split(df, "id", stratify="y").frame.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert per == {(1, "test"): 10, (1, "train"): 40, (None, "test"): 10, (None, "train"): 40}


def test_groups_never_cross(rows):
    parts = L.split(rows, "id", group="g")
    assert L.overlap(parts.frame, "g", "split").first()["shared_keys"] == 0
    assert key_overlap(parts.train, parts.test, "g").first()["both"] == 0
    assert parts.test.select("g").distinct().count() == round(32 * .2)


def test_folds_balanced(rows):
    sizes = [r["n"] for r in L.folds(rows, "id", 5).groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1
    folded = L.folds(rows, "id", 5, stratify="y")
    checks = L.validate_folds(folded, "id", F.col("y"), 5)
    assert C.verdict(checks).first()["verdict"] == "PASS"
    broken = folded.unionByName(folded.limit(3))
    assert C.verdict(L.validate_folds(broken, "id", F.col("y"), 5)).first()["verdict"] == "FAIL"


def test_repeats_differ(rows):
    df = L.repeated_folds(rows, "id", 5, 2)
    assert df.where("fold_r1 <> fold_r2").count() > 500


def test_split_saved_prunes_by_part(rows, tmp_path):
    parts = L.split(rows, "id").saved(str(tmp_path / "s"))
    assert parts.train.count() + parts.test.count() == 1003
    assert "PartitionFilters: [isnotnull(split" in parts.test._jdf.queryExecution().toString()


def test_tiny_inputs(spark):
    one = spark.range(1)
    assert L.split(one, "id").frame.first()["split"] == "train"
    assert L.folds(spark.range(2), "id", 5).select("fold").distinct().count() == 2
    assert L.split(spark.range(0), "id").frame.count() == 0


def test_stratify_and_group_exclude_each_other(rows):
    with pytest.raises(ValueError):
        L.split(rows, "id", stratify="y", group="g")


def test_validate_split_reports_a_bad_split(rows):
    bad = rows.withColumn("split", F.when(F.col("y") == 1, "test").otherwise("train"))
    failed = {r["check"] for r in L.validate_split(bad, "id", "y").where("not passed").collect()}
    assert {"classes in train", "classes in test", "train rate off"} <= failed
