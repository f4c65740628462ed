"""Workbook runner: lazy resolution, coercion, cycles, order."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lineage_spark.plans.workbook import Workbook, as_table


def small_wb(spark):
    wb = Workbook(spark)
    wb.dataset("raw", spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, g string"))

    @wb.transform(output="filtered", inputs=["raw"])
    def filtered(raw):
        return raw.filter(F.col("id") > 1)

    @wb.transform(output="counts", inputs=["filtered"], materialize=True)
    def counts(f):
        return f.groupBy("g").count()

    @wb.transform(output="as_pandas", inputs=["counts"])
    def as_pandas(c):
        return pd.DataFrame({"n": [1, 2]})

    return wb


def test_resolve_builds_only_what_is_needed(spark):
    wb = small_wb(spark)
    got = {r["g"]: r["count"] for r in wb.resolve("counts").collect()}
    assert got == {"a": 1, "b": 1}
    assert "as_pandas" not in wb._cache
    assert wb.resolve("as_pandas").count() == 2


def test_order_and_errors(spark):
    wb = small_wb(spark)
    order = [r["step"] for r in wb.order().orderBy("seq").collect()]
    assert order == ["filtered", "counts", "as_pandas"]
    with pytest.raises(KeyError):
        wb.resolve("missing")
    with pytest.raises(ValueError):
        wb.transform(output="counts")(lambda: None)


def test_cycle_detected(spark):
    wb = Workbook(spark)

    @wb.transform(output="a", inputs=["b"])
    def a(b):
        return b

    @wb.transform(output="b", inputs=["a"])
    def b(a):
        return a

    with pytest.raises(ValueError, match="cycle"):
        wb.resolve("a")


def test_tabular_coercion(spark):
    assert as_table(spark, [(1, "x")]).count() == 1
    assert as_table(spark, 5).columns == ["value"]
    with pytest.raises(TypeError):
        as_table(spark, object())


def test_verify_against_targets(spark):
    wb = small_wb(spark)
    good = spark.createDataFrame([("a", 1), ("b", 1)], "g string, count long")
    bad = spark.createDataFrame([("a", 2), ("b", 1)], "g string, count long")
    rep = {r["dataset"]: (r["status"], r["only_left"], r["only_right"])
           for r in wb.verify({"counts": good, "filtered": bad.select("g"), "unknown": good}).collect()}
    assert rep["counts"] == ("equal", 0, 0)
    assert rep["filtered"] == ("schema differs", None, None)
    assert rep["unknown"] == ("no comparison", None, None)
    wrong = wb.verify({"counts": bad}).first()
    assert (wrong["status"], wrong["only_left"], wrong["only_right"]) == ("rows differ", 1, 1)


def test_one_function_for_several_outputs(spark):
    wb = Workbook(spark)
    wb.dataset("a", spark.range(3))
    same = lambda df: df
    for out, src in (("c", "b"), ("b", "a"), ("d", "c")):
        wb.transform(output=out, inputs=[src])(same)
    assert [r["idx"] for r in wb.order().orderBy("seq").collect()] == [2, 1, 3]


def test_arguments_bind_by_name(spark):
    wb = Workbook(spark)
    wb.dataset("a", spark.range(3))
    wb.dataset("b", spark.range(5))

    @wb.transform(output="listed", inputs=["b", "a"])
    def listed(a, b):
        return a.select(F.lit(b.count()).alias("n_b"))

    @wb.transform(output="mapped", inputs={"right": "a", "left": "b"})
    def mapped(left, right, extra=None):
        return left.select(F.lit(right.count()).alias("n_right"))

    @wb.transform(output="mixed", inputs=["listed", "b"])
    def mixed(b, first):
        return b.crossJoin(first.limit(1))

    @wb.transform(output="starred", inputs=["a", "b"])
    def starred(*frames):
        return frames[1]

    assert wb.resolve("listed").first()["n_b"] == 5 and wb.resolve("listed").count() == 3
    assert wb.resolve("mapped").first()["n_right"] == 3 and wb.resolve("mapped").count() == 5
    assert wb.resolve("mixed").columns == ["id", "n_b"] and wb.resolve("mixed").count() == 5
    assert wb.resolve("starred").count() == 5
    rows = {r["output_rid"]: [(i["arg"], i["rid"]) for i in r["inputs"]] for r in wb.transforms_table().collect()}
    assert rows["mapped"] == [("left", "b"), ("right", "a")] and rows["mixed"] == [("b", "b"), ("first", "listed")]


@pytest.mark.parametrize("inputs", [["a"], ["a", "b", "c"], {"x": "a", "z": "b"}, {"x": "a"}])
def test_unbound_arguments_are_errors(spark, inputs):
    with pytest.raises(ValueError):
        Workbook(spark).transform(output="o", inputs=inputs)(lambda x, y: x)


def test_own_output_is_an_error_at_registration(spark):
    with pytest.raises(ValueError, match="own output"):
        Workbook(spark).transform(output="a", inputs=["a"])(lambda a: a)


def test_coercion_of_factors_and_empty_rows(spark):
    frame = pd.DataFrame({"f": pd.Categorical([1, 2, None]), "n": [1, 2, 3]})
    df = as_table(spark, frame)
    assert dict(df.dtypes)["f"] == "string" and [r["f"] for r in df.orderBy("n").collect()] == ["1", "2", None]
    assert as_table(spark, [], "x int, y string").columns == ["x", "y"]
    with pytest.raises(ValueError, match="schema"):
        as_table(spark, [])


def test_a_shared_step_is_computed_once(spark):
    wb, ran = Workbook(spark), []
    counter = spark.sparkContext.accumulator(0)

    def seen(rows):
        for r in rows:
            counter.add(1)
            yield r

    wb.dataset("raw", spark.range(100))

    @wb.transform(output="shared", inputs=["raw"])
    def shared(raw):
        ran.append(1)
        return spark.createDataFrame(raw.rdd.mapPartitions(seen), "id long")

    for name in ("x", "y", "z"):
        wb.transform(output=name, inputs=["shared"])(lambda shared, name=name: shared.withColumn("name", F.lit(name)))
    assert wb.shared(["x", "y", "z"]) == {"shared"} and wb.shared(["x"]) == set() and wb.shared(["x", "shared"]) == {"shared"}
    assert all(df.count() == 100 for df in wb.resolve_all(["x", "y", "z"]).values())
    assert counter.value == 100 and len(ran) == 1
    report = wb.verify({n: spark.range(100).withColumn("name", F.lit(n)) for n in ("x", "y", "z")} | {"shared": spark.range(99)})
    assert {r["dataset"]: r["status"] for r in report.collect()} == {"x": "equal", "y": "equal", "z": "equal", "shared": "rows differ"}
    assert counter.value == 100


def test_a_failing_shared_step_costs_its_own_rows_only(spark):
    wb = Workbook(spark)
    wb.dataset("raw", spark.range(3))
    wb.transform(output="bad", inputs=["raw"])(lambda raw: raw.select(F.raise_error("no").cast("long").alias("id")))
    for name in ("x", "y"):
        wb.transform(output=name, inputs=["bad"])(lambda bad: bad)
    wb.transform(output="good", inputs=["raw"])(lambda raw: raw)
    got = {r["dataset"]: r["status"] for r in wb.verify({n: spark.range(3) for n in ("x", "y", "good")}).collect()}
    assert got == {"x": "no comparison", "y": "no comparison", "good": "equal"}
