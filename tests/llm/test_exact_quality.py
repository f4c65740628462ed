"""Exact duplicates and the quality classifier."""

import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from lineage_spark.llm import exact_dedup, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op4_line_dedup"])
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.sql(entry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    assert rows(df.select(*order)) == sorted(rel.select(", ".join(order)).fetchall(), key=repr)


def test_exact_edge_cases(spark):
    data = [(1, "A b"), (2, "a B"), (3, "É"), (4, "é"), (5, None), (6, ""), (None, ""), (7, "x"), (7, "x"), (8, "long " * 50000)]
    df = spark.createDataFrame([(a, b, "digest", 1) for a, b in data], "doc_id long, text string, digest string, __key int")
    out = exact_dedup.exact_duplicates(df, keep="max").collect()
    assert len(out) == len(data)
    by = {}
    for r in out:
        by.setdefault(r["text_sha256"], []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 and g[0]["group_size"] == len(g) for g in by.values())
    kept = {r["doc_id"]: r for r in out if r["kept"]}
    assert set(kept) == {2, 3, 4, 6, 7, 8}
    assert {r["keep_id"] for r in out if r["doc_id"] in (5, None)} == {6}
    left = exact_dedup.drop_exact_duplicates(df, keep="max")
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6, 7, 8]


def test_exact_smallest_and_empty(spark):
    df = spark.createDataFrame([(3, "a"), (1, "A"), (2, "a")], "doc_id long, text string")
    assert {r["keep_id"] for r in exact_dedup.exact_duplicates(df).collect()} == {1}
    empty = df.where("false")
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("runs,fan_in", [(1, 2), (5, 2), (64, 4)])
def test_merge_rounds_do_not_change_the_result(spark, runs, fan_in):
    df = spark.range(0, 400, 1, 16).selectExpr("id AS doc_id", "concat('t', id % 37) AS text")
    out = exact_dedup.exact_duplicates(df, fan_in=fan_in, n_runs=runs).collect()
    assert all(r["keep_id"] == r["doc_id"] % 37 and r["kept"] == (r["doc_id"] < 37) for r in out)


def test_quality_held_out_accuracy(spark):
    out = entry.queries()["op7_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().merge(out, on="doc_id")
    assert len(out) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and ((out.score >= 0.3) == (out.predicted == 1)).all()
    held = labels[labels.held_out]
    assert (held.predicted == held.quality).mean() >= 0.95
    assert held[held.quality == 1].predicted.mean() >= 0.97


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "good words here"), (2, "BAD!! BAD!!"), (3, None), (4, ""), (None, " \n"), (5, "word " * 100000)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality.scored(docs, model).collect()}
    assert scores[1] > 0.5 > scores[2]
    assert scores[3] == scores[4] == scores[None]
    blank = quality.train(docs, labels.where("false"))
    assert {r["score"] for r in quality.scored(docs, blank).collect()} == {0.5}
    assert quality.scored(docs.where("false"), model).count() == 0


def test_quality_is_the_sparse_dot_product():
    model = quality.fit_ftrl(["a b c", "X!! Y!!"], [1, 0])
    cache = quality._Words()
    dense = np.zeros(1 << model.bits)
    for idx in quality.features("a b X!!", model.bits, cache):
        np.add.at(dense, idx, quality.SCALE / len(idx))
    z = model.bias + float(dense @ model.weights)
    assert model.score("a b X!!", cache) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)


def test_the_training_bound_holds_on_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(3000)] + [(2, "other"), (3, None)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    assert quality.train(docs, labels, max_labelled=2).weights.shape == (1 << quality.BITS,)
    for n in (1, 2, 3):
        rows = quality.sample_of(docs, labels, "text", "doc_id", "quality", n).collect()
        assert len(rows) == n and len({r["__key"] for r in rows}) == n
