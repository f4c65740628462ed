"""Versioned datasets: transactions, latest committed snapshot, snapshot files and
publishing.

Tables: ``transactions(dataset_rid, branch, txn_rid, status, close_time)`` and
``files(dataset_rid, txn_rid, logical_path, size)``. A dataset on disk is a root
folder with one ``txn=<id>`` folder per transaction and, per dataset and branch, a log of numbered entries. A
write becomes visible only when its ``COMMITTED`` entry is there, so readers never see a half-written snapshot. An
entry is made whole under the next free number or not at all: of two publishers one gets the number, and the other takes the
next. The number, not a clock, orders commits.
"""

from __future__ import annotations

import datetime
import json
import os
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.functions.text import basename

# Fixed values.
COMMITTED = "COMMITTED"
OPEN = "OPEN"
TXN_SCHEMA = "dataset_rid string, branch string, txn_rid string, status string, close_time timestamp"
DIGITS = 20


def latest_committed(transactions: DataFrame, keys=("dataset_rid", "branch"), txn: str = "txn_rid",
                     time: str = "close_time", status: str = "status") -> DataFrame:
    """Per dataset and branch the committed transaction with the latest ``time`` (a close time, ties broken by
    transaction id, or the number of the log entry, which has no ties): ``keys + [txn, time]``. A partial aggregate
    (``max_by``), so a dataset with a huge history is still one row per task."""
    order = F.struct(F.col(time), F.col(txn))
    return (
        transactions.filter(F.col(status) == COMMITTED)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(F.col(txn).alias(txn), F.col(time).alias(time)), order).alias("__t"))
        .select(*keys, f"__t.{txn}", f"__t.{time}")
    )


def snapshot_files(files: DataFrame, latest: DataFrame, keys=("dataset_rid", "branch"), txn: str = "txn_rid",
                   position: str = "position") -> DataFrame:
    """Files of the chosen snapshots, per dataset and branch: non-empty, and per basename the last listed one (greatest
    ``position``) wins, as a download of that branch into one folder would.

    ``files`` names the transaction of a file; the branch is that of the snapshot, so a transaction that two branches show
    is listed for both. Files that carry a branch of their own belong to that branch only.
    """
    keys = [k for k in keys if k in latest.columns]
    shown = latest.select(*keys, txn)
    f = files.filter(F.col("size") > 0).join(shown, [k for k in (*keys, txn) if k in files.columns])
    f = f.withColumn("basename", basename(F.col("logical_path")))
    rest = [c for c in f.columns if c not in (*keys, "basename")]
    return f.groupBy(*keys, "basename").agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(position)).alias("__f")
    ).select(*keys, "basename", "__f.*")


def last_by_basename(df: DataFrame, path: str, position: str) -> DataFrame:
    """Rows deduplicated by the basename of ``path``, the greatest ``position`` wins."""
    d = df.withColumn("basename", basename(F.col(path)))
    others = [c for c in d.columns if c != "basename"]
    return d.groupBy("basename").agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.col(position)).alias("__r")
    ).select("basename", "__r.*")


def _log_folder(root: str, dataset: str, branch: str) -> str:
    return f"{root}/_log/{quote(dataset, safe='')}/{quote(branch, safe='')}"


def _append(spark: SparkSession, root: str, dataset: str, branch: str, txn: str, status: str) -> int:
    """Add an entry under the next free number; returns the number.

    The entry is written beside the log and then given its name, which fails if the name is taken: by a hard link on a local
    file system, by a rename that does not overwrite elsewhere.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    folder = path(_log_folder(root, dataset, branch))
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    entry = {"dataset_rid": dataset, "branch": branch, "txn_rid": txn, "status": status,
             "close_time": datetime.datetime.now(datetime.timezone.utc).isoformat()}
    temp = path(folder, f"_{uuid.uuid4().hex}.tmp")  # readers skip names that start with an underscore
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    number = max([int(f.getPath().getName()[:DIGITS]) for f in fs.listStatus(folder) if not f.getPath().getName().startswith(("_", "."))], default=0)
    while True:
        number += 1
        if _named(jvm, conf, fs, temp, path(folder, f"{number:0{DIGITS}d}.json")):
            fs.delete(temp, False)
            return number


def _named(jvm, conf, fs, temp, target) -> bool:
    """Give ``temp`` the name ``target`` unless another file has it."""
    if fs.getScheme() == "file":
        try:
            os.link(temp.toUri().getPath(), target.toUri().getPath())
            return True
        except FileExistsError:
            return False
    never = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    never[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(temp, target, never)
        return True
    except Exception:  # noqa: BLE001
        if fs.exists(target):
            return False
        raise


def transactions(spark: SparkSession, root: str) -> DataFrame:
    """The log of all datasets and branches below ``root``: the columns of an entry and its number ``seq``."""
    rows = spark.read.schema(TXN_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{root}/_log")
    return rows.withColumn("seq", F.substring(F.col("_metadata.file_name"), 1, DIGITS).cast("long"))


def publish(df: DataFrame, root: str, dataset: str, branch: str = "master", commit: bool = True) -> str:
    """Write ``df`` as a new transaction of ``dataset`` and (optionally) commit it.

    The data lands in ``root/<dataset>/txn=<id>``; the log of the dataset and branch gets an
    ``OPEN`` entry before the write and a ``COMMITTED`` entry after it. Returns the
    transaction id.
    """
    spark = df.sparkSession
    txn = uuid.uuid4().hex
    _append(spark, root, dataset, branch, txn, OPEN)
    df.write.mode("errorifexists").parquet(f"{root}/{dataset}/txn={txn}")
    if commit:
        _append(spark, root, dataset, branch, txn, COMMITTED)
    return txn


def read_latest(spark: SparkSession, root: str, dataset: str, branch: str = "master") -> DataFrame:
    """Rows of the latest committed snapshot of ``dataset`` on ``branch``."""
    log = transactions(spark, root).filter((F.col("dataset_rid") == dataset) & (F.col("branch") == branch))
    latest = latest_committed(log, time="seq").collect()  # one row: the chosen transaction id
    if not latest:
        raise ValueError(f"no committed transaction for {dataset} on {branch}")
    return spark.read.parquet(f"{root}/{dataset}/txn={latest[0]['txn_rid']}")
