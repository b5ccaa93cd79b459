"""Duplicates, contracts, record validation, sources and sinks."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabulon.operators import contracts as C
from tabulon.operators import dedupe as D
from tabulon.operators import relate as R
from tabulon.operators import reshape as H
from tabulon.plans import preparation as prep
from tabulon.sources import files


@pytest.fixture(scope="module")
def copies(spark):
    return spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", 1.0), (4, "a", 1.0), (5, None, None), (6, None, None)],
                                 "id int, k string, v double")


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_first_copy_survives(copies, parts):
    assert sorted(r["id"] for r in D.dedupe_first(copies.repartition(parts), ["k", "v"], "id").collect()) == [1, 2, 4, 5]
    assert sorted(r["id"] for r in D.dedupe_first(copies.repartition(parts), ["k"], "id").collect()) == [1, 2, 5]


def test_row_id_is_required(copies):
    with pytest.raises(ValueError):
        D.dedupe_first(copies.drop("id"), ["k"], "id")


def test_flags(copies):
    got = {r["id"]: (r["copies"], r["is_extra"], r["in_duplicate_group"]) for r in D.duplicate_flags(copies, ["k", "v"], "id").collect()}
    assert got == {1: (2, False, True), 3: (2, True, True), 2: (1, False, False), 4: (1, False, False), 5: (2, False, True), 6: (2, True, True)}


def test_fingerprint_tells_nulls_and_borders(spark):
    f = lambda *rows: C.fingerprint(spark.createDataFrame(list(rows), "a string, b string, x double")).first()[:]
    tables = [f(("p|v1:q", "r", 1.0)), f(("p", "q|v1:r", 1.0)), f((None, "q", 1.0)), f(("", "q", 1.0)), f(("q", None, 1.0)), f(("n", "q", 1.0)), f(("q", "q", None)), f(("q", "q", float("nan"))), f(("q", "q", float("inf")))]
    assert len({t[1:3] for t in tables}) == len(tables)
    assert f(("q", "q", 1.0))[:3] == f(("q", "q", 1.0 + 1e-9))[:3] and f(("q", "q", 1.0)) != f(("q", "q", 1.0 + 1e-9))


def test_fingerprint_ignores_layout_but_not_values(copies):
    a = C.fingerprint(copies).first()
    assert a == C.fingerprint(copies.repartition(5)).first()
    assert a != C.fingerprint(copies.withColumn("id", F.col("id") + 1)).first()
    doubled = copies.unionByName(copies.where("id = 1"))  # one doubled row in place of another
    other = copies.unionByName(copies.where("id = 2"))
    assert C.fingerprint(doubled).first()[:] != C.fingerprint(other).first()[:] and C.fingerprint(doubled).first()["low"] != C.fingerprint(other).first()["low"]
    assert C.same_rows(copies, copies.repartition(3)).first()["equal"]
    assert not C.same_rows(copies, copies.unionByName(copies.limit(1))).first()["equal"]


CONTRACT = C.Contract(["a", "b"], numeric=["a"], not_null=["a"], finite=["a"], domains={"b": [0, 1]}, ranges={"a": (0, 10)})


@pytest.mark.parametrize("rows,schema,bad", [
    ([(1.0, 0), (2.0, 1)], "a double, b int", set()),
    ([(1.0,)], "a double", {"required columns missing"}),
    ([(1.0, 0, 1), (1.0, 1, 1)], "a double, b int, c int", {"unexpected columns"}),
    ([("x", 0), ("y", 1)], "a string, b int", {"non-numeric columns"}),
    ([(None, 0), (2.0, 1)], "a double, b int", {"nulls in a"}),
    ([(float("inf"), 0), (2.0, 1)], "a double, b int", {"non-finite in a", "outside range in a"}),
    ([(float("nan"), 0), (2.0, 1)], "a double, b int", {"non-finite in a", "outside range in a"}),
    ([(1.0, 2), (2.0, 1)], "a double, b int", {"outside domain in b", "domain values present in b"}),
    ([(-1.0, 0), (2.0, 1)], "a double, b int", {"outside range in a"}),
])
def test_contract_violations(spark, rows, schema, bad):
    contract = CONTRACT if "string" not in schema else C.Contract(["a", "b"], numeric=["a"])
    df = spark.createDataFrame(rows, schema)
    assert {r["check"] for r in C.check_contract(df, contract).where("not passed").collect()} == bad
    if bad:
        with pytest.raises(C.ContractError):
            C.require(df, contract)
    else:
        assert C.require(df, contract) is df


def test_column_order(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    ordered = C.Contract(["a", "b"], ordered=True)
    assert [r["check"] for r in C.check_contract(df, ordered).where("not passed").collect()] == ["columns out of order"]


def test_quarantine_and_fail_fast(spark):
    df = spark.createDataFrame([(1, "5"), (2, None), (3, "x"), (4, "-1"), (5, "NaN"), (6, ""), (7, "true"), (8, "inf")], "id int, v string")
    rules = C.number_rules("v", allow_negative=False)
    good, bad = C.validate_records(df, rules)
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: r["errors"] for r in bad.collect()} == {
        2: ["v: missing"], 3: ["v: not a number"], 4: ["v: negative"], 5: ["v: not finite"], 6: ["v: missing"], 7: ["v: not a number"], 8: ["v: not finite"]}
    with pytest.raises(PySparkException):
        C.validate_records(df, rules, fail_fast=True)[0].collect()
    assert C.validate_records(df.where("id = 1"), rules, fail_fast=True)[0].count() == 1


def test_out_of_range_names(spark):
    df = spark.createDataFrame([(1.0, 5.0), (9.0, 5.0), (9.0, -5.0), (None, 5.0)], "a double, b double")
    ranges = C.training_ranges(spark.createDataFrame([(0.0, 0.0), (5.0, 9.0)], "a double, b double"), ["a", "b"])
    assert [r["outside"] for r in C.out_of_range(df, ranges, ["a", "b"]).collect()] == [[], ["a"], ["a", "b"], []]


def test_leakage_audit_finds_planted_leaks(spark):
    rows = [(float(i % 7), float(i % 2), float(i % 2) * 3, float(i % 2) + 10 * (i % 2), float(i % 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "ok double, copy double, ratio double, apart double, y double")
    got = {r["feature"]: r for r in C.leakage_audit(df, ["ok", "copy", "ratio", "apart"], "y").collect()}
    assert not got["ok"]["suspicious_r"] and not got["ok"]["disjoint"]
    assert got["copy"]["copies_label"] and got["copy"]["suspicious_r"]
    assert got["ratio"]["constant_ratio"] and got["apart"]["disjoint"]


def test_suspicious_values(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (0.0, 5.0), (999.0, 5.0)], "a double, b double")
    got = {r["column"]: r for r in C.suspicious_values(df, ["a", "b"]).collect()}
    assert (got["a"]["negatives"], got["a"]["zeros"], got["a"]["sentinels"]) == (1, 1, 2)
    assert got["b"]["is_constant"] and got["b"]["near_constant"]


def test_clean_titles_and_flow(spark):
    cols = "row_id long, name string, year string, duration string, genre string, rating double, votes string, director string, actor_1 string, actor_2 string, actor_3 string"
    rows = [(1, " A ", "(2000)", "39 min", "Drama, , Drama", 5.0, "12345", "d", "x", "x", None),
            (2, " A ", "(2000)", "39 min", "Drama, , Drama", 5.0, "12345", "d", "x", "x", None),
            (3, "A", "(2000)", "40 min", ",", 6.0, "1,234,567", None, " x", "y", "z"),
            (4, " ", None, "2 min", None, None, "$5.16M", "d", None, None, None)]
    raw = spark.createDataFrame(rows, cols)
    frame = {r["row_id"]: r for r in prep.modelling_frame(raw, "row_id", "rating").collect()}
    assert sorted(frame) == [1, 3] and frame[1]["name_year_repeat"] and frame[3]["genre_list"] is None
    assert frame[1]["duration_questionable"] and not frame[3]["duration_questionable"]
    assert frame[1]["votes_malformed"] and frame[3]["votes_num"] == 1234567.0
    log = {r["step"]: r["rows"] for r in D.row_log(raw, [c for c in raw.columns if c != "row_id"], "row_id", "rating").collect()}
    assert log == {"raw_rows": 4, "exact_duplicates_removed": 1, "exact_duplicates_with_target": 1, "rows_after_dedupe": 3, "rows_without_target": 1, "final_rows": 2}


def test_prepare_records_needs_a_year(spark):
    out = prep.prepare_records(spark.createDataFrame([("2024.0", "x", 9.9)], "year string, director string, rating double")).first()
    assert out["year"] == 2024.0 and out["genre"] is None and out["usable"] and "rating" not in out.asDict()
    with pytest.raises(ValueError):
        prep.prepare_records(spark.createDataFrame([("x",)], "director string"))


def test_number_records(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "2"}',), ("1,\n2",), ("1 2",), ("1,2,3",)], "t string")
    assert [r[0] for r in df.select(files.parse_number_record("t", ["a", "b"])).collect()] == [["1", "2"], ["1", "2"], None, None]


def test_corrupt_json_is_marked(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("oops",), (None,)], "t string")
    got = files.read_records(df, "t", "k int").select("record.k", "corrupt").collect()
    assert [tuple(r) for r in got] == [(1, False), (None, True), (None, True)]


def test_strict_csv_fails_and_results_round_trip(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|Malformed"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), "a int, b int", strict=True).collect()
    path = files.write_results(spark.createDataFrame([("x", 0.1), ("y", None)], "k string, v double").coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text().splitlines()
    assert path and text == ["k,v", "x,0.1000000000", "y,"]
    with pytest.raises(ValueError):
        files.write_results(spark.range(1), str(tmp_path / "z"), "xml")


def test_latin1_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("name,n\ncaf\xe9,1\n".encode("latin-1"))
    df = files.read_csv(spark, str(tmp_path / "l.csv"), "name string, n int", encoding="ISO-8859-1")
    assert df.first()["name"] == "café"
    with pytest.raises(C.ContractError):
        files.require_columns(df, ["name", "year"])


def test_bundle_metadata_is_checked():
    good = {"features": ["a"], "threshold": .5, "label": "y"}
    assert files.check_metadata(good) == good
    for change in ({"threshold": 1.0}, {"features": ["a", "a"]}):
        with pytest.raises(C.ContractError):
            files.check_metadata({**good, **change})
    with pytest.raises(C.ContractError):
        files.check_metadata(json.loads('{"threshold": 0.5}'))


def test_set_and_rank_helpers(spark):
    long = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 3)], "c string, i int")
    got = {(r["config_a"], r["config_b"]): (r["common"], r["identical"]) for r in R.membership_overlap(long, "c", "i", ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): (2, True), ("a", "c"): (0, False), ("b", "c"): (0, False)}
    ranks = R.rank_results(spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "i int, v int"), "v", method="average")
    assert {r["i"]: r["rank"] for r in ranks.collect()} == {1: 1.5, 2: 1.5, 3: 3.0}
    wide = H.reindex(spark.createDataFrame([("b", 2)], "k string, n int"), "k", ["a", "b"], {"n": 0})
    assert [(r["k"], r["n"]) for r in wide.orderBy("k_order").collect()] == [("a", 0), ("b", 2)]


def test_fingerprint_numbers_and_sums(spark):
    import hashlib
    from decimal import Decimal, ROUND_HALF_UP
    numbers = [0.0, -0.0, 0.5e-6, -0.5e-6, 1.4999999e-6, -2.5e-6, 0.49999999999999994e-6, 123.4567895, -99999.9999995, 9007199254.740993, -1e20, 1e25, None]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    whole = lambda x: str(int(Decimal(repr(x * 1e6)).quantize(Decimal(1), ROUND_HALF_UP)) + 0) if x * 1e6 < 1e28 and x * 1e6 > -1e28 else str(int(Decimal(repr(x * 1e6))))
    texts = ["n" if x is None else f"v{len(whole(x))}:{whole(x)}" for x in numbers]
    digests = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    assert sorted(r["text"] for r in C.row_digests(df).collect()) == sorted(digests)
    got = C.fingerprint(df).first()
    assert (got["low"], got["high"]) == tuple(sum(int(h[a:a + 12], 16) for h in digests) % 2 ** 48 for a in (0, 12))
    assert got["exact"] == sum(r["values"] for r in C.row_digests(df).collect()) % 2 ** 62
    plan = C.fingerprint(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan[plan.index("Aggregate"):plan.index("Project")].lower()  # sums are of whole numbers
