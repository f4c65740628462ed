"""Node mapping, image export, requirement checks and distributed ordering."""

import base64
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from lineage_spark.operators import lookups, ordering

PNG = base64.b64encode(b"\x89PNG fake").decode()


def test_two_hop_node_mapping(spark):
    display = spark.createDataFrame([("L1", "D1"), ("L2", "D2"), ("L3", "D9")], "logic_node_id string, data_node_id string")
    data = spark.createDataFrame([("D1", "A1"), ("D2", "A2")], "data_id string, alias_id string")
    alias = spark.createDataFrame([("A1", "counts"), ("A2", "metadata")], "alias_id string, alias string")
    j = lookups.two_hop(display, data, alias, "data_node_id", "data_id", "alias_id")
    assert {r["logic_node_id"]: r["alias"] for r in j.collect()} == {"L1": "counts", "L2": "metadata"}


def test_image_rows_first_png_only(spark):
    items = "array<struct<type:string, data:string>>"
    vis = spark.createDataFrame([
        ("empty", []),
        ("svg", [("svg", "PHN2Zz4=")]),
        ("two", [("base64Png", PNG), ("base64Png", "AAAA")]),
    ], f"name string, items {items}")
    out = lookups.image_rows(vis, "name", "items", prefix="wb_").collect()
    assert [(r["file_name"], bytes(r["image"])) for r in out] == [("wb_two.png", b"\x89PNG fake")]


def test_unmet_requirements_and_report(spark):
    texts = spark.createDataFrame([("uses a.R and b.csv",), ("c.txt",)], "text string")
    miss = lookups.unmet_requirements(texts, "text", ["a.R", "b.csv", "zz.h5", "yy.rds"])
    assert sorted(r["pattern"] for r in miss.collect()) == ["yy.rds", "zz.h5"]
    assert lookups.missing_report(miss, "pattern").first()["missing"] == "yy.rds, zz.h5"


def test_ordered_list(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "g int, pos int, v string")
    got = {r["g"]: r["items"] for r in lookups.ordered_list(df, ["g"], "pos", "v").collect()}
    assert got == {1: "a,b", 2: "c"}


def _random_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    # one hot key with a third of the rows
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 50), i, rnd.choice([None, 1, 2, 3])) for i in range(n)]
    return spark.createDataFrame(rows, "k int, t int, v int")


def test_global_index_matches_row_number(spark):
    df = _random_frame(spark)
    got = {(r["k"], r["t"]): r["seq"] for r in ordering.global_index(df, ["k", "t"]).collect()}
    w = Window.orderBy("k", "t")
    exp = {(r["k"], r["t"]): r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == exp


def _scan_and_windows(df):
    mark = F.col("v") == 2
    s = ordering.ordered_scan(
        df, ["k"], ["t"], sums={"run": F.col("v")}, last={"lt": (mark, F.col("t")), "lv": (F.col("t") % 5 == 0, F.col("v"))},
        previous={"prev_t": "t", "prev_v": "v"}, following={"next_t": "t"}, row="rn", size="n")
    w = Window.partitionBy("k").orderBy("t")
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    e = df.select(
        "*", F.sum(F.coalesce("v", F.lit(0))).over(wr).alias("run"),
        F.last(F.when(mark, F.col("t")), ignorenulls=True).over(wr).alias("lt"),
        F.last(F.when(F.col("t") % 5 == 0, F.struct("v")), ignorenulls=True).over(wr)["v"].alias("lv"),
        F.lag("t").over(w).alias("prev_t"), F.lag("v").over(w).alias("prev_v"), F.lead("t").over(w).alias("next_t"),
        F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"),
    )
    cols = ["k", "t", "v", "run", "lt", "lv", "prev_t", "prev_v", "next_t", "rn", "n"]
    return sorted((tuple(r) for r in s.select(*cols).collect()), key=repr), sorted((tuple(r) for r in e.select(*cols).collect()), key=repr)


def test_group_scan_matches_windows(spark):
    got, want = _scan_and_windows(_random_frame(spark))
    assert got == want


def test_null_keys_are_groups(spark):
    df = _random_frame(spark).withColumn("k", F.nullif(F.col("k"), F.lit(0)))
    got, want = _scan_and_windows(df)
    assert got == want and sum(r[0] is None for r in got) == 1000


def test_few_rows_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(None, 1, 2), (None, 2, None), (1, 3, 2), (2, 4, 1), (2, 5, None), (2, 6, None), (2, 7, 2)]
        got, want = _scan_and_windows(spark.createDataFrame(rows, "k int, t int, v int"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == want


@pytest.mark.parametrize("parts", [1, 3, 8, 40])
def test_ordered_join_does_not_depend_on_partitions(spark, parts):
    df = _random_frame(spark, n=600).withColumn("k", F.nullif(F.col("k"), F.lit(0)))
    df = df.union(spark.createDataFrame([(99, 1, None), (99, 2, None), (98, 1, None), (98, 2, 7)], df.schema))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for order in ("t", "ts"):
            ds = df.withColumn("ts", F.format_string("%06d", "t"))
            got = {r["k"]: r["s"] for r in ordering.ordered_join(ds, ["k"], order, "v", ",", "s").collect()}
            want = {}
            for r in sorted(ds.collect(), key=lambda r: r["t"]):
                want.setdefault(r["k"], []).extend([str(r["v"])] if r["v"] is not None else [])
            assert got == {k: ",".join(v) for k, v in want.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_joined_values_of_equal_order_are_sorted(spark):
    df = spark.createDataFrame([(1, 5, v) for v in "dbca"] * 50, "k int, t int, v string").repartition(7)
    got = ordering.ordered_join(df, ["k"], "t", "v", "", "s").first()["s"]
    assert got == "a" * 50 + "b" * 50 + "c" * 50 + "d" * 50


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_sums_stay_in_their_group_and_type(spark, coalesce):
    from decimal import Decimal

    nan = float("nan")
    values = {"a": [1e17] * 20, "b": [0.25] * 30, "c": [1.0, nan, 2.0], "d": [0.5, None, 0.5], None: [2.0 ** 60, -2.0 ** 60, 1.0]}
    rows = [(k, i, v, Decimal(i) + Decimal("0.75"), 2 ** 62 if i % 2 == 0 else -2 ** 62) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, t int, v double, d decimal(10,2), n long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        s = ordering.ordered_scan(df, ["k"], ["t"], sums={"total": F.col("v"), "exact": F.col("d"), "whole": F.col("n")}, size="n_rows")
        assert dict(s.dtypes)["exact"] == "decimal(20,2)" and dict(s.dtypes)["whole"] == "bigint"
        got = {(r["k"], r["t"]): r for r in s.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k, vs in values.items():
        total, exact = 0.0, Decimal(0)
        for i, v in enumerate(vs):
            total, exact = total + (v or 0.0), exact + Decimal(i) + Decimal("0.75")
            r = got[k, i]
            assert r["total"] == total or (total != total and r["total"] != r["total"])
            assert r["exact"] == exact and r["n_rows"] == len(vs) and r["whole"] == (2 ** 62 if i % 2 == 0 else 0)


def test_scan_is_linear_in_one_partition(spark):
    import time

    def seconds(n):
        df = spark.range(n).select((F.col("id") % 2).alias("k"), F.col("id").alias("t")).coalesce(1)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        t0 = time.time()
        ordering.ordered_scan(df, ["k"], ["t"], row="r", size="n", following={"f": "t"}).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seconds(1000)
        small, large = seconds(10_000), seconds(160_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert large < 16 * small + 5  # a frame that starts anew for each row would take 256 times as long


PATTERNS = ["", "e", "zz", "abc", "abcdefg", "abcdefgh", "needle in the hay", "needle in the straw", "a.b*c(d)[e]", "new\nline in it", "ümlaut ünd", "x" * 300, None,
            "tail of a very long text"]


@pytest.mark.parametrize("k", [3, 8])
def test_unmet_patterns_match_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(lookups, "PIECE", 50)
    monkeypatch.setattr(lookups, "FIRST_TESTS", 1)
    r = random.Random(k)
    texts = ["".join(r.choices("abcdefgh .\n", k=r.choice([0, 3, 40, 400]))) for _ in range(300)] + [None, "", "😀😀 needle in the hay 😀"]
    texts += ["a needle in the " + "".join(r.choices("abc", k=5)) for _ in range(60)] + ["w " * 3000 + "tail of a very long text", "x" * 299, "new\nline in it", "a.b*c(d)[e]"]
    texts += texts[:50]
    patterns = PATTERNS + ["".join(r.choices("abcdefgh", k=r.choice([2, 4, 9, 12]))) for _ in range(300)] + ["abc"]
    tdf = spark.createDataFrame([(t, 1) for t in texts], "body string, pattern int").repartition(4)
    pdf = spark.createDataFrame([(p, 2) for p in patterns], "p string, gram int")
    got = sorted(x["pattern"] for x in lookups.unmet_patterns(tdf, "body", pdf, "p", k=k).collect())
    assert got == sorted({p for p in patterns if p is not None and not any(p in t for t in texts if t is not None)})


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_unmet_patterns_sent_or_joined(spark, monkeypatch, sent):
    """Pattern tables below and above the bound, in one or more blocks, give what brute force gives."""
    monkeypatch.setattr(lookups, "SENT_BYTES", sent)
    monkeypatch.setattr(lookups, "BLOCK_BYTES", 900)
    r = random.Random(9)
    texts = ["".join(r.choices("ab\u00fc \n", k=r.choice([0, 1, 7, 30]))) for _ in range(60)] + [None, "same prefix 17 and more", "x" * 40]
    patterns = PATTERNS + ["".join(r.choices("ab\u00fc", k=r.randrange(1, 10))) for _ in range(150)] + [f"same prefix {i} and" for i in range(30)] + ["x" * 39, "x" * 41]
    tdf = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    got = sorted(x["pattern"] for x in lookups.unmet_patterns(tdf, "t", spark.createDataFrame([(p,) for p in patterns], "p string"), "p").collect())
    assert got == sorted({p for p in patterns if p is not None and not any(p in t for t in texts if t is not None)})


def test_patterns_are_sent_to_the_texts(spark, monkeypatch):
    """A small pattern table costs one pass over the texts: no grams of the texts are written or joined."""
    monkeypatch.setattr(lookups, "_grams", None)
    texts = spark.createDataFrame([("a needle in the hay",)], "t string")
    patterns = spark.createDataFrame([("needle in the",), ("dle",), ("needle in the straw",), ("zz",)], "p string")
    got = sorted(r["pattern"] for r in lookups.unmet_patterns(texts, "t", patterns, "p").collect())
    assert got == ["needle in the straw", "zz"]


@pytest.mark.parametrize("slice_bytes", [8, 13, 1 << 20])
def test_wanted_patterns_across_slices(monkeypatch, slice_bytes):
    monkeypatch.setattr(lookups, "SLICE", slice_bytes)
    r = random.Random(slice_bytes)
    texts = [bytes(r.choices(b"abc", k=r.choice([0, 1, 5, 60]))) for _ in range(50)] + [b"\xff\xfe odd"]
    patterns = {bytes(r.choices(b"abc", k=r.randrange(1, 14))) for _ in range(400)} | {b"\xfe o", b"\xff\xfe", b"\xff\xff"}
    wanted, got = lookups._Wanted(sorted(patterns)), []
    for lo in range(0, len(texts), 7):
        got += wanted.met(texts[lo:lo + 7])
    assert sorted(got) == sorted(p for p in patterns if any(p in t for t in texts))


def test_unmet_patterns_of_empty_tables(spark):
    texts, patterns = spark.createDataFrame([("a",)], "t string"), spark.createDataFrame([("",), ("b",), (None,)], "p string")
    assert lookups.unmet_patterns(texts, "t", patterns.where("false"), "p").count() == 0
    got = [r["pattern"] for r in lookups.unmet_patterns(texts.where("false"), "t", patterns, "p").collect()]
    assert sorted(got) == ["", "b"]


def test_hot_key_is_split_across_range_partitions(spark):
    # a third of the rows share one group key and one order value: the range
    # partitions of an ordered scan stay balanced anyway
    n = 6000
    rows = [(0, 0) if i % 3 == 0 else (1 + i % 97, i) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t int")
    # AQE would merge these tiny partitions (far below its advisory size, as it
    # never would at scale); look at the range partitioner itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tagged = ordering.range_tagged(df, ["k", "t"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["c"] for r in tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("c")).collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) >= parts // 2
    assert max(sizes) <= 2.5 * (n / len(sizes))
    # and the hot group's rows really are spread over several partitions
    hot = tagged.filter("k = 0").select("__pid").distinct().count()
    assert hot >= 2
