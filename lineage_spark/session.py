"""Session helpers: local builder for tests and the shared scratch location.

On a cluster the scratch location is the folder named by ``spark.checkpoint.dir``
(a shared file system such as HDFS or an object store). It is read from the
session; only a ``local[...]`` session with no such setting gets a fresh folder of
its own, which is the test situation.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lineage_spark") -> SparkSession:
    """A local session configured the way the tests and the bench run."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # checkpoints of finished rounds/numberings are deleted once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set up if it is unset.

    Order: the context's checkpoint dir, then the ``spark.checkpoint.dir`` setting,
    then (local master only) a fresh folder under the system temp dir. A cluster
    session with neither setting is an error: a machine-local folder is not
    visible to the other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the setting
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running lineage jobs")
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running lineage jobs")
        conf = tempfile.mkdtemp(prefix="lineage-spark-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote below :func:`scratch_path`, when its results are no longer read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the application's Python workers, once: they then import it wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lineage-spark-ship-"), f"{os.path.basename(here)}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
