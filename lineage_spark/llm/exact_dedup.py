"""Exact duplicates: a tree-merge of sorted digest runs, DataFrame operations only.

Every input partition is one run of ``(digest, largest or smallest id, count)`` rows. In each round ``fan_in``
neighbouring runs meet and are merged (a sort-based aggregate on run and digest, combined before the
shuffle), until one run is left. Only digests and ids move, so a text copied into a third of
all rows is one row per run from the first round on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import lower_ascii_col, one_row_each, packed, tagged
from lineage_spark.session import cut_lineage

RUNS = 64
FAN_IN = 4
_PARTITION_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def normalised(text: Column) -> Column:
    """The compared text: A-Z lower-cased, null as empty."""
    return lower_ascii_col(F.coalesce(text, F.lit("")))


def merge_runs(runs: DataFrame, keep: str = "min", fan_in: int = FAN_IN, n_runs: int = RUNS) -> DataFrame:
    """One row ``(digest, check, bytes, best, group_size)`` per text from ``(run, digest, check, bytes, best)`` rows.

    Rows meet only if SHA-256, a 64-bit xxHash and the byte length all agree, so a digest is verified at
    every level. ``best`` is the least or greatest ``(id, row)`` struct.
    """
    pick = F.max if keep == "max" else F.min
    level = runs.withColumn("group_size", F.lit(1).cast("long"))
    while True:
        n_runs = -(-n_runs // fan_in)
        level = (
            level.withColumn("run", F.floor(F.col("run") / F.lit(fan_in)))
            .groupBy("run", "digest", "check", "bytes")
            .agg(pick("best").alias("best"), F.sum("group_size").alias("group_size"))
        )
        if n_runs == 1:
            return level.drop("run")


def _groups(rows: DataFrame, keep: str, fan_in: int, n_runs: int) -> DataFrame:
    runs = rows.select(
        (F.shiftright("__row", _PARTITION_BITS) % F.lit(n_runs)).alias("run"),
        "digest", "check", "bytes", F.struct(F.col("__key"), F.col("__row")).alias("best"),
    )
    # written out so that the join below sees two plain shuffles and can split a hot digest
    return cut_lineage(merge_runs(runs, keep, fan_in, n_runs))


def _digests(df: DataFrame, text: str, key: str) -> list[Column]:
    norm = normalised(df[text])
    return [
        df[key].alias("__key"), F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
        F.xxhash64(norm).alias("check"), F.octet_length(norm).alias("bytes"),
    ]


def _marked(rows: DataFrame, keep: str, fan_in: int, n_runs: int) -> DataFrame:
    same = ["digest", "check", "bytes"]
    return rows.join(_groups(rows, keep, fan_in, n_runs), same)


def exact_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "min",
                     fan_in: int = FAN_IN, n_runs: int = RUNS) -> DataFrame:
    """One row per input row: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Exactly one row of a group
    has ``kept``: the one with the largest (``keep='max'``) or smallest id; a null id orders below
    every other, and of rows with equal ids the one later (earlier) in the input stays. Other columns of
    ``df``, whatever their names, are ignored. An empty table gives an empty result.
    """
    rows = tagged(df.select(*_digests(df, text, key)))
    return _marked(rows, keep, fan_in, n_runs).select(
        F.col("__key").alias(key), F.col("best.__key").alias("keep_id"), "group_size",
        (F.col("best.__row") == F.col("__row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "min",
                          fan_in: int = FAN_IN, n_runs: int = RUNS) -> DataFrame:
    """The rows of ``df`` that stay, with the columns of ``df`` unchanged.

    Rows are told apart by ``(key, digest)`` plus the row chosen among those equal in both: repeated rows with the
    same id and text leave one row.
    """
    rows = tagged(df.select(*_digests(df, text, key)))
    same = ["digest", "check", "bytes"]
    groups = _groups(rows, keep, fan_in, n_runs).select(*same, F.col("best.__key").alias("__keep"))
    left = packed(df, *_digests(df, text, key)).join(groups, same).where(F.col("__key").eqNullSafe(F.col("__keep")))
    # several rows may share the kept id and text; those rare ones are reduced to one row
    identity = ["__key", *same]
    repeated = cut_lineage(rows.groupBy(*identity).count().where("count > 1").drop("count"))
    return one_row_each(left, repeated, identity).select("__doc.*")
