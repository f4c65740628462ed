"""Package tables: prefix modes, version resolution, constants, library order."""

import json

from pyspark.sql import functions as F

from lineage_spark.operators import packages
from lineage_spark.sources import jsonsrc

REQUESTED = {"condaEnvironmentDefinition": {"packageMatchSpecs": [
    "r-base", "r-dplyr", "bioconductor-limma", "python", "bioconductor-edger=3.24.3", "r-seurat"]}}
RESOLVED = {"resolvedCondaEnvironment": {"packageSpecs": [
    {"name": "r-base", "version": "3.5.1"}, {"name": "r-dplyr", "version": "0.8.5"},
    {"name": "bioconductor-limma", "version": "3.38.3"}, {"name": "python", "version": "3.6.10"},
    {"name": "r-seurat", "version": "3.1.0"}]}}


def docs(spark, obj):
    return spark.createDataFrame([(json.dumps(obj),)], "json string")


def env(spark, mode):
    req = jsonsrc.requested_specs(docs(spark, REQUESTED))
    res = jsonsrc.resolved_specs(docs(spark, RESOLVED))
    kept = packages.prefix_mode(req, "spec", mode)
    resolved = packages.resolve_versions(kept, res.select("name", "version"))
    if mode != "Python":
        return packages.append_sorted(resolved.select("resolved"), "resolved")
    return resolved


def test_r_mode_environment(spark):
    out = env(spark, "R").orderBy("pos").collect()
    assert [r["resolved"] for r in out] == [
        "bioconductor-edger=3.24.3", "bioconductor-limma=3.38.3", "r-base=3.5.1", "r-biocmanager",
        "r-dplyr=0.8.5", "r-renv", "r-seurat=3.1.0"]
    assert [r["pos"] for r in out] == list(range(1, 8))


def test_python_and_all_modes(spark):
    assert [r["resolved"] for r in env(spark, "Python").collect()] == ["python=3.6.10"]
    req = jsonsrc.requested_specs(docs(spark, REQUESTED))
    assert packages.prefix_mode(req, "spec", "All").count() == 6


def test_library_order_untranslated_first(spark):
    specs = env(spark, "R").select("pos", packages.package_name(F.col("resolved")).alias("name"))
    out = packages.library_order(specs, "name", "pos").orderBy("seq").collect()
    assert [r["library"] for r in out] == ["edger", "limma", "dplyr", "renv", "BiocManager", "Seurat"]
    assert [r["translated"] for r in out] == [False] * 4 + [True] * 2


def test_library_order_with_translation_table(spark):
    specs = spark.createDataFrame([(1, "seurat"), (2, "ggplot2"), (3, "base")], "pos int, name string")
    table = spark.createDataFrame(list(packages.TRANSLATION.items()), "name string, library string")
    out = packages.library_order(specs, "name", "pos", table=table).orderBy("seq").collect()
    assert [r["library"] for r in out] == ["ggplot2", "Seurat"]


def test_last_wins_and_translate(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, pos int, v string")
    assert {r["k"]: r["v"] for r in packages.last_wins(df, "k", "v", "pos").collect()} == {"a": "y", "b": "z"}
    t = df.select(packages.translate(F.col("v"), {"x": "X"}).alias("t")).collect()
    assert sorted(r["t"] for r in t) == ["X", "y", "z"]


def test_case_insensitive_first_match(spark):
    vals = spark.createDataFrame([("seurat",), ("MAST",), ("nope",)], "pkg string")
    lookup = spark.createDataFrame([(1, "Seurat"), (2, "SEURAT"), (3, "mast")], "pos int, name string")
    got = {r["pkg"]: r["matched"] for r in packages.ci_first_match(vals, "pkg", lookup).collect()}
    assert got == {"seurat": "Seurat", "MAST": "mast", "nope": None}
    assert [r["pkg"] for r in packages.unmatched(vals, "pkg", lookup).collect()] == ["nope"]


def test_environment_and_libraries_entry_points(spark):
    req = jsonsrc.requested_specs(docs(spark, REQUESTED))
    res = jsonsrc.resolved_specs(docs(spark, RESOLVED))
    env_r = packages.environment(req, res, "R").orderBy("pos").collect()
    assert [r["spec"] for r in env_r] == [
        "bioconductor-edger=3.24.3", "bioconductor-limma=3.38.3", "r-base=3.5.1", "r-biocmanager",
        "r-dplyr=0.8.5", "r-renv", "r-seurat=3.1.0"]
    env_py = packages.environment(req, res, "Python").collect()
    assert [(r["pos"], r["spec"]) for r in env_py] == [(1, "python=3.6.10")]
    libs = packages.libraries(packages.environment(req, res, "R")).orderBy("seq").collect()
    assert [r["library"] for r in libs] == ["edger", "limma", "dplyr", "renv", "BiocManager", "Seurat"]
