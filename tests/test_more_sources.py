"""Format-dispatching loader, step-script source, call-argument extraction."""

import os

from pyspark.sql import functions as F

from lineage_spark.functions import text as tx
from lineage_spark.operators import compare
from lineage_spark.sources import files
from lineage_spark.sources.lines import step_scripts


def test_load_dataset_dispatch(spark, tmpdir_fresh):
    pq = os.path.join(tmpdir_fresh, "pq")
    spark.createDataFrame([(1,)], "v int").write.parquet(os.path.join(pq, "x"))
    with open(os.path.join(pq, "notes.csv"), "w") as fh:
        fh.write("a\n1\n")
    fmt, df = files.load_dataset(spark, pq)
    assert fmt == "parquet" and df.collect()[0]["v"] == 1

    csv = os.path.join(tmpdir_fresh, "csv")
    os.makedirs(csv)
    with open(os.path.join(csv, "t.csv"), "w") as fh:
        fh.write("gene,count\nA,3\n")
    fmt, df = files.load_dataset(spark, csv)
    assert fmt == "csv" and df.columns == ["gene", "count"]

    h5 = os.path.join(tmpdir_fresh, "h5")
    os.makedirs(h5)
    for n in ("a.h5", "b.h5"):
        open(os.path.join(h5, n), "wb").write(b"x")
    fmt, df = files.load_dataset(spark, h5)
    assert fmt == "h5" and sorted(r["name"] for r in df.collect()) == ["a.h5", "b.h5"]


def test_step_scripts(spark):
    run = [
        "#!/bin/bash",
        'run_workbook_template template_Process_1 1 7',
        "echo done",
        'run_workbook_template template_Process_2 2 7 template_Process_2.R',
    ]
    lines = spark.createDataFrame([(1, i + 1, l) for i, l in enumerate(run)], "doc long, line_no int, line string")
    out = step_scripts(lines, "template_", prefix="template_", suffix=".R").orderBy("seq").collect()
    assert [(r["seq"], r["call"], r["script"], r["name"]) for r in out] == [
        (1, "run_workbook_template", "7", "7"),
        (2, "run_workbook_template", "template_Process_2.R", "Process_2"),
    ]


def test_call_arguments(spark):
    df = spark.createDataFrame([('library(dplyr); library("Seurat", character.only=TRUE)',)], "t string")
    assert df.select(tx.call_arguments("t", "library").alias("a")).first()["a"] == ["dplyr", "Seurat"]


def test_two_way_read_write_replace(spark):
    # R8: a read line and a write line get different replacements by content
    from lineage_spark.operators import textlines
    from lineage_spark.operators.textlines import Rule

    # replacements are Java regex replacements: a literal $ is written \$
    rules = [Rule(1, "readRDS", "substitute", r"readRDS(args\$input)", target=r"readRDS\([^)]*\)"),
             Rule(2, "saveRDS", "substitute", r"saveRDS(out, args\$output)", target=r"saveRDS\([^)]*\)")]
    lines = spark.createDataFrame([(1, 1, "x <- readRDS('a.rds')"), (1, 2, "saveRDS(out, 'b.rds')")],
                                  "doc long, line_no int, line string")
    got = [r["line"] for r in textlines.rewrite(lines, rules).orderBy("line_no").collect()]
    assert got == ["x <- readRDS(args$input)", "saveRDS(out, args$output)"]


def test_diff_of_shuffled_copy_is_empty(spark):
    # property: diff(x, shuffle(x)) is empty, for a few random tables
    import random

    for seed in range(3):
        rnd = random.Random(seed)
        rows = [(rnd.randint(0, 5), rnd.choice(["a", "b", None]), rnd.random()) for _ in range(200)]
        x = spark.createDataFrame(rows, "k int, s string, f double")
        y = spark.createDataFrame(rnd.sample(rows, len(rows)), "k int, s string, f double").select("f", "k", "s")
        assert compare.row_diff(x, y).count() == 0
        z = y.withColumn("f", F.when(F.col("k") == 0, F.col("f") + 1.0).otherwise(F.col("f")))
        n0 = sum(1 for r in rows if r[0] == 0)
        assert compare.row_diff(x, z).count() == 2 * len({r for r in rows if r[0] == 0}) or n0 == 0


def test_environment_documents_from_files(spark, tmpdir_fresh):
    import json as _json

    from lineage_spark.operators import packages
    from lineage_spark.sources import jsonsrc

    req = {"condaEnvironmentDefinition": {"packageMatchSpecs": ["r-base", "r-dplyr", "python"]}}
    res = {"resolvedCondaEnvironment": {"packageSpecs": [{"name": "r-dplyr", "version": "0.8.5"}]}}
    for name, obj in (("env.json", req), ("resolved.json", res)):
        with open(os.path.join(tmpdir_fresh, name), "w") as fh:
            fh.write(_json.dumps(obj, indent=2))  # pretty-printed: many lines per document
    docs_req = jsonsrc.read_documents(spark, os.path.join(tmpdir_fresh, "env.json"))
    docs_res = jsonsrc.read_documents(spark, os.path.join(tmpdir_fresh, "resolved.json"))
    assert docs_req.count() == 1
    env = packages.environment(jsonsrc.requested_specs(docs_req), jsonsrc.resolved_specs(docs_res), "R")
    assert [r["spec"] for r in env.orderBy("pos").collect()] == ["r-base", "r-biocmanager", "r-dplyr=0.8.5", "r-renv"]


def test_parse_several_script_files(spark, tmpdir_fresh):
    from lineage_spark.operators import lineage
    from lineage_spark.sources.lines import read_text_lines
    from lineage_spark.sources.workbook_script import transforms_from_lines

    texts = {
        "a.R": ["@t(", '  Output(rid="o1"),', '  x=Input(rid="e1"),', ")", "A1 <- function(x) {", "}",
                "@t(", '  Output(rid="o2"),', '  A1=Input(rid="o1"),', ")", "A2 <- function(A1) {", "}"],
        "b.R": ["@t(", '  Output(rid="p1"),', ")", "B1 <- function() {", "}"],
    }
    for name, lines in texts.items():
        with open(os.path.join(tmpdir_fresh, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    lines = read_text_lines(spark, os.path.join(tmpdir_fresh, "*.R")).withColumnRenamed("path", "doc_id")
    t = transforms_from_lines(lines)
    got = {(r["doc_id"].rsplit("/", 1)[-1], r["name"]): r["idx"] for r in t.collect()}
    assert got == {("a.R", "A1"): 1, ("a.R", "A2"): 2, ("b.R", "B1"): 1}
    a = t.filter(F.col("doc_id").endswith("a.R"))
    assert {r["step"]: r["pass"] for r in lineage.topological_passes(a)[0].collect()} == {"A1": 1, "A2": 1}
