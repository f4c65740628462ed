"""Operators on empty inputs return empty (or default) results instead of failing."""

from pyspark.sql import functions as F

from lineage_spark.operators import compare, lineage, ordering, textlines
from lineage_spark.operators.textlines import Rule

T_SCHEMA = "name string, idx int, output_rid string, inputs array<struct<pos:int, arg:string, rid:string>>"


def test_empty_ordered_operators(spark):
    df = spark.createDataFrame([], "k int, t int, v int")
    assert ordering.global_index(df, ["k", "t"]).count() == 0
    s = ordering.ordered_scan(df, ["k"], ["t"], sums={"r": F.col("v")}, last={"p": (F.col("v") > 0, F.col("t"))},
                              previous={"prev_t": "t"}, following={"next_t": "t"}, row="rn", size="n")
    assert s.count() == 0
    assert ordering.ordered_join(df, ["k"], "t", "v", ",", "s").count() == 0


def test_empty_graph(spark):
    t = spark.createDataFrame([], T_SCHEMA)
    resolved, stuck = lineage.topological_passes(t)
    assert resolved.count() == 0 and stuck.count() == 0
    assert lineage.topological_order(t).count() == 0
    assert lineage.unsatisfiable(t).count() == 0
    assert lineage.step_manifest(t).count() == 0


def test_empty_compare_and_rewrite(spark):
    e = spark.createDataFrame([], "a int, b double")
    assert compare.row_diff(e, e).count() == 0
    assert compare.diff_counts(e, e).first()["only_left"] == 0
    assert compare.verify_report(spark, []).count() == 0
    assert compare.hash_list(spark, []).count() == 0
    lines = spark.createDataFrame([], "doc_id long, line_no int, line string")
    assert textlines.rewrite(lines, [Rule(1, "x", "drop")]).count() == 0
