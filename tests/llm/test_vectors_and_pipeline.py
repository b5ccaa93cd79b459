"""Embedding near-duplicates, connected components, the pipeline and the registered queries."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tabulon.llm import common, line_dedup, mixing, packing, quality, simhash, vectors

FOLDER = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def brute_vectors(rows, threshold=0.9):
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ids = range(len(rows))
    parent, links = list(ids), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in ids:
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if usable(a) and usable(b) and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i in ids:
        least[find(i)] = min(least.get(find(i), 1 << 60), rows[i][0])
    return sorted((rows[i][0], links[i], least[find(i)], least[find(i)] == rows[i][0]) for i in ids)


@pytest.mark.parametrize("block", [2048, 5])
def test_vectors_against_brute_force(spark, block):
    r = np.random.default_rng(4)
    centers = r.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + r.normal(size=16) * (0.05 if i % 5 else 0.25)).tolist()) for i in range(120)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, []), (204, [0.0] * 16), (205, [float("nan")] * 16), (206, [None] + [1.0] * 15), (207, [1.0, 2.0]), (208, [1.0, 2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cid", "2 AS key", "3 AS label")
    got = sorted(tuple(x) for x in vectors.near_vectors(df, block=block, shared=1).collect())
    assert got == brute_vectors(rows)
    default = sorted(tuple(x) for x in vectors.near_vectors(df, block=block).collect())
    assert sum(x[1] for x in default) >= 0.9 * sum(x[1] for x in got) and all(a[1] <= b[1] for a, b in zip(default, got))


def test_vectors_empty_and_unusable(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, vectors.near_vectors(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert vectors.near_vectors(df.limit(0)).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 130)] + [(5, 5), (None, 3), (200, 201), (203, 201)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 130)} | {201: 200, 203: 200}
    assert {k: v for k, v in got.items() if k != v} == want
    assert common.components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_stages_follow_each_other(spark, docs_of, prose, tmp_path):
    """run() against the same steps in plain Python over a small table."""
    shared = prose(900, 12)
    rows = [(i, prose(i, 90) + ("\n" + shared if i % 4 == 0 else ""), "en", "ab"[i % 2], 0) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "c", 0) for i in range(5)] + [(200, "too short", "en", "a", 0), (201, None, "en", "a", 0)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= set(range(60))  # copies lose all their lines, the rest is too short
    once = set(range(60))
    left = {i: ("\n".join(x for x in t.split("\n") if x != shared) if i else t) for i, t, *_ in rows if i in once}
    sizes = {i: len(t.split()) for i, t in left.items()}
    copies = {i: sum(1 for r in out if r["doc_id"] == i and r["piece"] == 0) for i in once}
    for source, share in ((0, 5), (1, 2)):
        words = sum(sizes[i] * copies[i] for i in once if i % 2 == source)
        assert abs(words - sum(sizes.values()) * share / 7) <= 0.02 * sum(sizes.values())
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_file("word_bpe_49k.json"))
    for r in out:
        assert r["length"] == len(tokenizer.encode(left[r["doc_id"]], add_special_tokens=False).ids) + 1


def test_stage_list():
    assert [f for _, f in corpus_pipeline.STAGES] == [corpus_pipeline.quality_rules, corpus_pipeline.line_duplicates, corpus_pipeline.near_duplicates, corpus_pipeline.mixture, corpus_pipeline.packed]
    assert quality and line_dedup and simhash and mixing


@here
@pytest.mark.parametrize("name", ["op6_vectors", "op9_licences", "op12_middle"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for f in sorted(os.listdir(FOLDER)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    df = entry.queries()[name](spark, FOLDER)
    picked = ", ".join(f'"{c}"' for c in df.columns)
    want = con.execute(f"SELECT {picked} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


@here
def test_every_number_is_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
