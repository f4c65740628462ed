"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import re
import string
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.session import cut_lineage, scratch_path

# a word is a maximal run of characters other than ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
# sides measured below this many bytes are broadcast; larger ones are shuffled
BROADCAST_BYTES = 8 << 20
# bytes of rows that a Python worker is sent at once. Spark's default of 10,000 rows or 64 MB is 20 to 50 MB of texts or arrays, held several
# times over (buffers that double, the worker's copy, its objects), and neither the executor nor a worker that is used again gives that back
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_UPPER_TO_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def lower_ascii(text: str) -> str:
    """``text`` with A-Z (only) lower-cased."""
    return text.lower() if text.isascii() else text.translate(_UPPER_TO_LOWER)


def words_of(text: str | None) -> list[str]:
    """The lower-cased (A-Z) words of a text; none for null."""
    return WORD_RE.findall(lower_ascii(text)) if text else []


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64 for ``i < n``."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        steps = [np.full(size, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        for s in steps:
            s[0] = 1
        _powers = tuple(np.multiply.accumulate(s) for s in steps)
    return _powers


def _piece_hashes(b: np.ndarray) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[b], [True]])))
    first, last = edge[::2], edge[1::2]
    power, inverse = _power_table(len(b) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b + np.uint64(1)) * power[:len(b)], dtype=np.uint64)])
    h = (sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each lower-cased (A-Z) word of a text, in order, computed on the bytes of the whole text at once.

    A polynomial in the word's bytes modulo 2**64, mixed with its length. Very long texts go in pieces cut at white space.
    """
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    b = np.frombuffer(raw, np.uint8)
    if len(b) <= _PIECE:
        return _piece_hashes(b)
    out, at = [], 0
    while at < len(b):
        end = at + _PIECE
        while end < len(b) and not _SPACE[b[end]]:
            end += 1
        out.append(_piece_hashes(b[at:end]))
        at = end
    return np.concatenate(out)


def lower_ascii_col(col: Column) -> Column:
    """SQL twin of :func:`lower_ascii`."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(col: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts lineage, compressed.

    Loops use this rather than a checkpoint: the size Spark assumes of it is that of its files, while a checkpoint
    keeps the estimate of the plan it came from, which multiplies with every join of a loop.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the folders of frames made by :func:`written` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark) -> None:
    """Let Spark drop the shuffle files of plans that are gone: it does so when the driver's JVM collects its garbage, which a loop with
    little work on the driver hardly ever makes it do."""
    gc.collect()
    spark._jvm.System.gc()


def limit_batches(spark: SparkSession) -> str:
    """From now on the session's plans send rows to Python workers in batches of about ``BATCH_BYTES``; which rows, and their order, stay
    the same. Returns the setting before."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """:func:`limit_batches` for the plans that are run inside."""
    before = limit_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def union_of(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def tagged(df: DataFrame, row: str = "__row") -> DataFrame:
    """``df`` with a row number that stays the same when tasks are run again (written out)."""
    return cut_lineage(df.withColumn(row, F.monotonically_increasing_id()))


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already written out) hinted for broadcast if its measured size is below ``limit``.

    The hint changes the join's way, never its result; above the limit the join is
    left to Catalyst and AQE (shuffle, skewed partitions split).
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def packed(df: DataFrame, *identity: Column) -> DataFrame:
    """``__doc`` (a struct of all columns of ``df``, so that no name clashes) and the given columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__doc"), *identity)


def same_identity(left: DataFrame, right: DataFrame, identity: list[str]) -> list[Column]:
    """Null-safe equality of the identity columns."""
    return [left[c].eqNullSafe(right[c]) for c in identity]


def one_row_each(rows: DataFrame, repeated: DataFrame, identity: list[str]) -> DataFrame:
    """``__doc`` of ``rows``, with one row for each identity listed in ``repeated`` (written out, usually empty)."""
    if repeated.isEmpty():
        return rows.select("__doc")
    match = same_identity(rows, repeated, identity)
    one = rows.join(repeated, match, "left_anti").select("__doc")
    many = rows.join(repeated, match, "left_semi").groupBy(*identity).agg(F.min("__doc").alias("__doc"))
    return one.union(many.select("__doc"))


def one_task_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already written out) in one partition if its measured size is below ``limit``.

    What follows then needs no shuffle; above the limit it is shuffled. The result is the same.
    """
    return df.coalesce(1) if df.count() * row_bytes <= limit else df


def hash_sample(df: DataFrame, n: int, *keys: Column) -> DataFrame:
    """At most ``n`` rows of ``df``: those of smallest hash of ``keys`` (the same rows in every run).

    The hash that ``n`` rows stay below is found on hashes alone, so no more than about ``n`` whole rows move.
    """
    h = F.xxhash64(*keys)
    top = df.select(h.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if top is None:
        return df.where("false")
    return df.where(h <= F.lit(top)).orderBy(h, *keys).limit(n)
