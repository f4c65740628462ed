"""Dataset comparison: the FIXTURES comparison pairs."""

from pyspark.sql import functions as F

from lineage_spark.operators import compare

ROWS = [(1, "a", 1.5, 10), (2, "b", 2.25, 20), (3, "c", None, 30)]
SCHEMA = "id long, name string, x double, n int"


def frames(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def counts(t, n):
    r = compare.diff_counts(t, n).first()
    return r["only_left"], r["only_right"]


def test_shuffled_rows_and_columns_are_equal(spark):
    t = frames(spark)
    n = spark.createDataFrame(list(reversed(ROWS)), SCHEMA).select("n", "x", "name", "id")
    assert counts(t, n) == (0, 0)


def test_tiny_noise_vanishes_and_small_change_shows(spark):
    t = frames(spark)
    noisy = t.withColumn("x", F.col("x") + F.lit(1e-9))
    assert counts(t, noisy) == (0, 0)
    changed = t.withColumn("x", F.when(F.col("id") == 2, F.col("x") + 1e-3).otherwise(F.col("x")))
    d = compare.row_diff(t, changed).collect()
    assert sorted((r["id"], r["side"], r["n_copies"]) for r in d) == [(2, "only_left", 1), (2, "only_right", 1)]


def test_repeated_row_is_a_count_difference(spark):
    t = frames(spark)
    n = t.unionByName(t.filter("id = 1"))
    d = compare.row_diff(t, n).collect()
    assert [(r["id"], r["side"], r["n_copies"]) for r in d] == [(1, "only_right", 1)]


def test_dotted_names_are_cleaned_on_the_new_side(spark):
    t = spark.createDataFrame([(1, 2)], "a_b long, c int")
    n = spark.createDataFrame([(1, 2)], "`a.b` long, c int")
    assert compare.schema_diff(t, n) == []
    assert counts(t, n) == (0, 0)
    from lineage_spark.functions.names import clean_name

    assert clean_name("a.b-c") == "a_b.c"


def test_extra_column_and_type_mismatch_are_schema_differences(spark):
    t = frames(spark)
    assert compare.schema_diff(t, t.withColumn("extra", F.lit(1))) == [("extra", "only_right")]
    assert compare.schema_diff(t, t.withColumn("n", F.col("n").cast("string"))) == [("n", "type_mismatch")]
    # numeric types are compatible and widened
    assert compare.schema_diff(t, t.withColumn("n", F.col("n").cast("double"))) == []
    assert counts(t, t.withColumn("n", F.col("n").cast("double"))) == (0, 0)


def test_nulls_and_nan_and_negative_zero_compare_equal(spark):
    t = spark.createDataFrame([(None, float("nan"), 0.0)], "a string, b double, c double")
    n = spark.createDataFrame([(None, float("nan"), -0.0)], "a string, b double, c double")
    assert counts(t, n) == (0, 0)


def test_report_statuses(spark):
    t = frames(spark)
    rep = compare.verify_report(spark, [
        ("same", t, t.select("n", "x", "name", "id")),
        ("diff", t, t.filter("id < 3")),
        ("schema", t, t.withColumn("z", F.lit(1))),
        ("none", t, None),
        ("notatable", "some/path.rds", t),
    ])
    got = {r["dataset"]: (r["status"], r["only_left"], r["only_right"]) for r in rep.collect()}
    assert got == {
        "same": ("equal", 0, 0),
        "diff": ("rows differ", 1, 0),
        "schema": ("schema differs", None, None),
        "none": ("no comparison", None, None),
        "notatable": ("Not a dataframe, skipping", None, None),
    }


def test_digest_is_order_free(spark):
    t = frames(spark).withColumn("g", F.lit("k"))
    a = compare.dataset_digest(t, ["g"], ["id", "name", "n"]).first()
    b = compare.dataset_digest(t.orderBy(F.desc("id")).repartition(3), ["g"], ["id", "name", "n"]).first()
    assert a == b and a["n_rows"] == 3


def test_positional_diff(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c")], "doc long, line_no int, line string")
    right = spark.createDataFrame([(1, 1, "a"), (1, 2, "B")], "doc long, line_no int, line string")
    d = compare.positional_diff(left, right, ["doc", "line_no"], "line").orderBy("line_no").collect()
    assert [(r["line_no"], r["left_line"], r["right_line"]) for r in d] == [(2, "b", "B"), (3, "c", None)]


def test_golden_hash_lists(spark):
    # a list of output hashes against its golden list, by position (V5)
    golden = [(1, "aa"), (2, "bb")] + [(i, "cc") for i in range(3, 10)]
    same = spark.createDataFrame(golden, "pos int, md5 string")
    assert compare.positional_diff(same, same, ["pos"], "md5").count() == 0
    changed = spark.createDataFrame(golden[:4] + [(5, "dd")] + golden[5:], "pos int, md5 string")
    d = compare.positional_diff(same, changed, ["pos"], "md5").collect()
    assert [(r["pos"], r["left_md5"], r["right_md5"]) for r in d] == [(5, "cc", "dd")]
    shorter = spark.createDataFrame(golden[:8], "pos int, md5 string")
    d = compare.positional_diff(same, shorter, ["pos"], "md5").collect()
    assert [(r["pos"], r["right_md5"]) for r in d] == [(9, None)]


def test_long_and_decimal_compare_exactly(spark):
    a = spark.createDataFrame([(9007199254740993,)], "v long")
    b = spark.createDataFrame([(9007199254740992,)], "v long").select(F.col("v").cast("decimal(20,0)").alias("v"))
    assert sorted(r["side"] for r in compare.row_diff(a, b).collect()) == ["only_left", "only_right"]
    assert compare.row_diff(a, a.select(F.col("v").cast("decimal(20,0)").alias("v"))).count() == 0


def test_digest_tells_fields_apart(spark):
    rows = [[("a|b", "c")], [("a", "b|c")], [("a", None)], [("a", "N")], [("a", "\\N")], [(None, "a")], [("1:a", "")], [("1", "a")]]
    frames = [spark.createDataFrame(r, "x string, y string").withColumn("g", F.lit(1)) for r in rows]
    digests = [compare.dataset_digest(f, ["g"], ["x", "y"]).first()["digest"] for f in frames]
    assert len(set(digests)) == len(rows)
    assert all(len(d.split("-")) == 4 for d in digests)


def test_one_failing_dataset_keeps_the_default_status(spark):
    t = spark.createDataFrame([(1, "x")], "id int, name string")
    broken = t.withColumn("id", F.raise_error("no").cast("int"))

    def never():
        raise ValueError("no such step")

    got = {r["dataset"]: (r["status"], r["only_left"]) for r in compare.verify_report(
        spark, [("run", t, broken), ("make", t, never), ("good", t, lambda: t)]).collect()}
    assert got == {"run": (compare.STATUS_DEFAULT, None), "make": (compare.STATUS_DEFAULT, None), "good": (compare.STATUS_EQUAL, 0)}


def test_golden_diff(spark):
    produced = spark.createDataFrame([("a", "1"), ("b", "2"), ("n", None), ("x", None)], "dataset string, digest string")
    golden = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4"), ("n", None)], "dataset string, digest string")
    got = sorted((r["dataset"], r["status"]) for r in compare.golden_diff(produced, golden).collect())
    assert got == [("b", "changed"), ("c", "missing"), ("x", "extra")]


def _text(spark, kind, value):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(compare.row_text(df).alias("t")).first()["t"]


def test_value_texts_never_collide(spark):
    nan, inf = float("nan"), float("inf")
    families = {
        "array<string>": [["a, b"], ["a", "b"], ["null"], [None], [], None, [""], ["a,b"], ["1:a"], ["a", ""], ["", "a"]],
        "array<array<string>>": [[["a"], ["b"]], [["a", "b"]], [[], ["a", "b"]], [["a", "b"], []], [None, ["a"]], [[None], ["a"]]],
        "double": [nan, None, inf, -inf, 0.0, 1.0, 1e33, -1e33, 1e308, 1.0000001e33, 2.0 ** 60, 2.0 ** 60 + 256, 1e18, 999999999999999872.0, 0.5, 1e-6],
        "map<string,string>": [{"a": "b"}, {"b": "a"}, {"a": None}, {}, None, {"a": "b", "c": "d"}, {"a": "bc", "": "d"}],
        "struct<x:string,y:string>": [("a", "b"), ("b", "a"), (None, "a"), ("a", None), (None, None), None, ("ab", "")],
        "binary": [bytearray(b"ab"), bytearray(b"AB"), bytearray(b""), None, bytearray(b"6162")],
        "array<double>": [[nan], [None], [inf], [1e33], [0.0], []],
        "boolean": [True, False, None],
        "string": ["N", None, "1:N", "", "null", "NaN"],
    }
    for kind, values in families.items():
        texts = [_text(spark, kind, v) for v in values]
        assert len(set(texts)) == len(values), kind
    assert _text(spark, "double", -0.0) == _text(spark, "double", 0.0)
    assert _text(spark, "map<string,int>", {"a": 1, "b": 2}) == _text(spark, "map<string,int>", {"b": 2, "a": 1})
    assert _text(spark, "double", 0.1 + 0.2) == _text(spark, "double", 0.3)


def test_digest_of_any_type(spark):
    from decimal import Decimal

    rows = [(1, [1.5, float("nan")], {"k": [b"x"]}, 1e33, (2, None)), (2, [], None, -1e300, None)]
    df = spark.createDataFrame(rows, "id int, xs array<double>, m map<string,array<binary>>, d double, s struct<a:int,b:string>")
    once = compare.hash_list(spark, [("t", df)]).first()
    again = compare.hash_list(spark, [("t", df.orderBy(F.desc("id")))]).first()
    other = compare.hash_list(spark, [("t", df.withColumn("d", F.col("d") * 2))]).first()
    assert once["digest"] == again["digest"] != other["digest"]
    big = spark.createDataFrame([(Decimal(10 ** 37),)], "v decimal(38,0)")
    assert compare.hash_list(spark, [("t", big)]).first()["n_rows"] == 1


def test_comparisons_run_at_the_same_time(spark):
    import threading

    seen, most, lock = set(), [0], threading.Lock()
    real = compare.diff_counts

    def counted(*a, **k):
        with lock:
            seen.add(threading.get_ident())
            most[0] = max(most[0], len(seen))
        try:
            return real(*a, **k)
        finally:
            with lock:
                seen.discard(threading.get_ident())

    compare.diff_counts = counted
    try:
        df = spark.range(1000).withColumn("v", F.col("id") * 2)
        out = compare.verify_report(spark, [(f"d{i}", df, df) for i in range(6)], concurrent=3).collect()
    finally:
        compare.diff_counts = real
    assert [(r["dataset"], r["status"]) for r in out] == [(f"d{i}", compare.STATUS_EQUAL) for i in range(6)] and 1 < most[0] <= 3
    assert compare.verify_report(spark, []).count() == 0
