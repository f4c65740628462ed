"""Sources and snapshots: FIXTURES section 2 cases and loaders."""

import datetime
import os

from pyspark.sql import functions as F

from lineage_spark.sources import files, snapshots
from lineage_spark.sources.lines import explode_lines, read_text_lines

T = datetime.datetime


def test_latest_committed_cases(spark):
    tx = spark.createDataFrame([
        ("ds1", "master", "t1", "COMMITTED", T(2024, 1, 1, 10)),
        ("ds1", "master", "t2", "OPEN", T(2024, 1, 1, 11)),
        ("ds2", "master", "t3", "COMMITTED", T(2024, 1, 1, 9)),
        ("ds2", "master", "t4", "COMMITTED", T(2024, 1, 1, 12)),
        ("ds2", "dev", "t5", "COMMITTED", T(2024, 1, 2)),
    ], snapshots.TXN_SCHEMA)
    got = {(r["dataset_rid"], r["branch"]): r["txn_rid"] for r in snapshots.latest_committed(tx).collect()}
    assert got == {("ds1", "master"): "t1", ("ds2", "master"): "t4", ("ds2", "dev"): "t5"}


def test_snapshot_files_skip_empty_and_last_basename_wins(spark):
    latest = spark.createDataFrame([("ds2", "t4")], "dataset_rid string, txn_rid string")
    fl = spark.createDataFrame([
        ("ds2", "t4", "z/part-0.parquet", 100, 1),
        ("ds2", "t4", "b/part-0.parquet", 200, 2),
        ("ds2", "t4", "c/empty.parquet", 0, 3),
        ("ds2", "t3", "old/part-9.parquet", 50, 4),
    ], "dataset_rid string, txn_rid string, logical_path string, size long, position int")
    got = {r["basename"]: r["logical_path"] for r in snapshots.snapshot_files(fl, latest).collect()}
    assert got == {"part-0.parquet": "b/part-0.parquet"}


def test_publish_then_read_latest_committed(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "store")
    mk = lambda v: spark.createDataFrame([(v,)], "v int")
    snapshots.publish(mk(1), root, "d")
    snapshots.publish(mk(2), root, "d")
    snapshots.publish(mk(3), root, "d", commit=False)
    assert [r["v"] for r in snapshots.read_latest(spark, root, "d").collect()] == [2]


def test_load_parts_skips_empty_and_unions_by_name(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "ds")
    spark.createDataFrame([(1, "a")], "id int, s string").write.parquet(os.path.join(root, "p1"))
    spark.createDataFrame([("b", 2)], "s string, id int").write.parquet(os.path.join(root, "p2"))
    open(os.path.join(root, "zero.parquet"), "wb").close()
    df = files.load_parts(spark, root)
    assert sorted((r["id"], r["s"]) for r in df.collect()) == [(1, "a"), (2, "b")]
    empty = os.path.join(tmpdir_fresh, "empty")
    os.makedirs(empty)
    open(os.path.join(empty, "zero.parquet"), "wb").close()
    assert files.load_parts(spark, empty, schema="id int").count() == 0


def test_format_precedence(spark):
    rows = [("A", "x.parquet"), ("A", "y.csv"), ("B", "one.csv"), ("C", "a.csv"), ("C", "b.csv"),
            ("D", "data.rds"), ("E", "f.h5"), ("F", "readme.txt"), ("G", "fileabc"), ("G", "z.rds")]
    f = spark.createDataFrame(rows, "ds string, name string")
    got = {r["ds"]: r["format"] for r in files.classify_format(f, "ds").collect()}
    assert got == {"A": "parquet", "B": "csv", "C": "paths", "D": "rds", "E": "h5", "F": "paths", "G": "abc"}


def test_delimited_header_kept_verbatim(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "t.csv")
    with open(p, "w") as fh:
        fh.write("gene id,log.FC,count\nA,1.5,3\nB,-2,4\n")
    df = files.read_delimited(spark, p)
    assert df.columns == ["gene id", "log.FC", "count"]
    assert dict(df.dtypes)["count"] == "int"


def test_path_table_and_guarded_save(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1,)], "v int")
    path = os.path.join(tmpdir_fresh, "saved")
    files.save_dataset(df, path)
    try:
        files.save_dataset(df, path)
        raise AssertionError("second save without force must fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "path_already_exists" in str(e).lower()
    files.save_dataset(df, path, force=True)
    names = {r["name"] for r in files.path_table(spark, path).collect()}
    assert any(n.endswith(".parquet") for n in names)


def test_lines_sources(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, "a\n\nb\n")], "id long, text string")
    got = [(r["line_no"], r["line"]) for r in explode_lines(df, "id", "text").orderBy("line_no").collect()]
    assert got == [(1, "a"), (2, ""), (3, "b"), (4, "")]
    p = os.path.join(tmpdir_fresh, "s.R")
    with open(p, "w") as fh:
        fh.write("x <- 1\ny <- 2\nz <- 3")
    got = [(r["line_no"], r["line"]) for r in read_text_lines(spark, p).collect()]
    assert sorted(got) == [(1, "x <- 1"), (2, "y <- 2"), (3, "z <- 3")]


def test_csv_dialect_and_empty_folder(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "q.csv")
    with open(p, "w") as fh:
        fh.write('id,text\n1,"say ""hi"", ok"\n2,"two\nlines"\n')
    rows = files.read_delimited(spark, p, multiline=True).orderBy("id").collect()
    assert [(r["id"], r["text"]) for r in rows] == [(1, 'say "hi", ok'), (2, "two\nlines")]
    empty = os.path.join(tmpdir_fresh, "nothing")
    os.makedirs(empty)
    fmt, df = files.load_dataset(spark, empty)
    assert fmt == "paths" and df.count() == 0
    both = spark.createDataFrame([("d", "x.csv"), ("d", "y.rds"), ("e", "x.csv")], "ds string, name string")
    assert {r["ds"]: r["format"] for r in files.classify_format(both, "ds").collect()} == {"d": "rds", "e": "csv"}


def test_lines_of_a_file_read_by_splits(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "big.txt")
    want = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    with open(p, "w") as fh:
        fh.write("\n".join(want))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = [r["line"] for r in read_text_lines(spark, p).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_branches_keep_their_own_files(spark):
    latest = spark.createDataFrame([("d", "master", "t1"), ("d", "dev", "t2"), ("d", "same", "t2")], "dataset_rid string, branch string, txn_rid string")
    listed = spark.createDataFrame([
        ("d", "t1", "x/part-0.parquet", 10, 1), ("d", "t2", "y/part-0.parquet", 10, 2), ("d", "t2", "z/part-1.parquet", 10, 3), ("d", "t0", "w/part-2.parquet", 10, 4),
    ], "dataset_rid string, txn_rid string, logical_path string, size long, position int")
    got = sorted((r["branch"], r["basename"], r["logical_path"]) for r in snapshots.snapshot_files(listed, latest).collect())
    assert got == [("dev", "part-0.parquet", "y/part-0.parquet"), ("dev", "part-1.parquet", "z/part-1.parquet"), ("master", "part-0.parquet", "x/part-0.parquet"),
                   ("same", "part-0.parquet", "y/part-0.parquet"), ("same", "part-1.parquet", "z/part-1.parquet")]


def test_log_numbers_order_commits_whatever_the_clock_says(spark, tmpdir_fresh, monkeypatch):
    root = os.path.join(tmpdir_fresh, "store")

    class Stopped(datetime.datetime):
        @classmethod
        def now(cls, tz=None):
            return cls(2024, 1, 1, tzinfo=tz)

    monkeypatch.setattr(snapshots.datetime, "datetime", Stopped)
    for v in range(4):
        snapshots.publish(spark.createDataFrame([(v,)], "v int"), root, "d", branch="a/b" if v % 2 else "master")
    assert [r["v"] for r in snapshots.read_latest(spark, root, "d").collect()] == [2]
    assert [r["v"] for r in snapshots.read_latest(spark, root, "d", "a/b").collect()] == [3]
    log = snapshots.transactions(spark, root).collect()
    assert len({r["close_time"] for r in log}) == 1
    assert sorted(r["seq"] for r in log if r["branch"] == "a/b") == [1, 2, 3, 4]


def test_publishers_at_the_same_time_get_numbers_of_their_own(spark, tmpdir_fresh):
    from concurrent.futures import ThreadPoolExecutor

    root = os.path.join(tmpdir_fresh, "store")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: snapshots._append(spark, root, "d", "master", f"t{i}", snapshots.COMMITTED), range(40)))
    assert sorted(numbers) == list(range(1, 41))
    log = {r["txn_rid"]: r["seq"] for r in snapshots.transactions(spark, root).collect()}
    assert log == {f"t{i}": n for i, n in enumerate(numbers)}
    assert not [f for f in os.listdir(os.path.join(root, "_log", "d", "master")) if "tmp" in f]


def test_row_files_are_written_whole_or_not_at_all(spark, tmpdir_fresh):
    from lineage_spark.sources import rowfiles

    path = os.path.join(tmpdir_fresh, "images")
    df = spark.createDataFrame([(f"f{i}.bin", bytes([i % 256]) * i, 1) for i in range(200)], "n string, c binary, path int").repartition(4)
    rowfiles.save_files(df, path, "n", "c")
    back = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
    assert {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in back} == {f"f{i}.bin": bytes([i % 256]) * i for i in range(1, 200)}
    assert "_temporary" not in os.listdir(path)
    assert sorted(f for _, _, names in os.walk(path) for f in names if f.endswith(".bin")) == sorted(f"f{i}.bin" for i in range(200))  # the reader skips empty files

    failed = os.path.join(tmpdir_fresh, "failed")
    broken = df.withColumn("c", F.when(F.col("n") == "f150.bin", F.raise_error("broken image").cast("binary")).otherwise(F.col("c")))
    for bad in (broken, df.withColumn("n", F.lit("same")), df.withColumn("n", F.lit("../up"))):
        try:
            rowfiles.save_files(bad, failed, "n", "c")
            raise SystemExit("must fail")
        except Exception:  # noqa: BLE001
            pass
    assert not os.path.exists(failed) or not [f for f in os.listdir(failed) if f.startswith("part")]
    assert not [f for _, _, files_ in os.walk(failed) for f in files_ if f.endswith(".bin")]
    rowfiles.save_files(df.where("false"), os.path.join(tmpdir_fresh, "none"), "n", "c")


def test_load_parts_of_many_kinds(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "ds")
    spark.createDataFrame([(1, "a")], "id int, s string").write.parquet(os.path.join(root, "x", "p1"))
    spark.createDataFrame([(2.5, "b", 2)], "more double, s string, id int").write.parquet(os.path.join(root, "y", "z", "p2"))
    for name in ("zero.parquet", "notes.txt", "x/zero.parquet"):
        open(os.path.join(root, name), "wb").close()
    with open(os.path.join(root, "readme.txt"), "w") as f:
        f.write("no part")
    df = files.load_parts(spark, root)
    assert sorted((r["id"], r["s"], r["more"]) for r in df.collect()) == [(1, "a", None), (2, "b", 2.5)]
    given = files.load_parts(spark, root, schema="s string, id int")
    assert given.columns == ["s", "id"] and given.count() == 2
    empty = os.path.join(tmpdir_fresh, "none")
    os.makedirs(empty)
    for _ in range(2):
        try:
            files.load_parts(spark, empty)
            raise SystemExit("must fail")
        except ValueError:
            open(os.path.join(empty, "zero.parquet"), "wb").close()
