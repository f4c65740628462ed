"""Line sources: a text column as an ordered table of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineage_spark.operators import ordering


def explode_lines(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """``(id, line_no, line)`` with ``line_no`` from 1, made at the source by position.

    Splitting is on ``\\n`` only, keeping empty lines (also a trailing one). The
    work is per row, so it spreads with the input partitions; the lines of one
    text stay together only as far as later operators key on ``id``.
    """
    keep = keep or []
    return df.select(
        id_col, *keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line")
    ).select(id_col, *keep, (F.col("pos") + 1).cast("int").alias("line_no"), "line")


def read_text_lines(spark, path: str) -> DataFrame:
    """Files as ``(path, line_no, line)``, ``line_no`` from 1.

    A file is read by its splits: lines are ordered by split start and place in the split, and numbered by one ordered
    scan, so a file of any size is spread over many tasks. Lines end at ``\n``; a last line without one counts.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__place"), F.col("value").alias("line"))
    numbered = ordering.ordered_scan(raw, ["path"], ["__block", "__place"], row="line_no")
    return numbered.select("path", F.col("line_no").cast("int").alias("line_no"), "line")


def step_scripts(lines: DataFrame, marker: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """Steps of a run script: the lines containing ``marker``, in line order.

    ``(id, seq, call, script, name)``: ``call`` is the first token, ``script`` the
    last one, ``name`` the script with ``prefix`` and ``suffix`` removed. ``seq``
    numbers the kept lines within each script id, by line number.
    """
    from pyspark.sql import Window

    id_col = lines.columns[0]
    toks = F.split(F.trim(F.col("line")), " +")
    kept = lines.filter(F.col("line").contains(marker)).select(
        id_col,
        "line_no",
        F.try_element_at(toks, F.lit(1)).alias("call"),
        F.try_element_at(toks, F.lit(-1)).alias("script"),
    )
    name = F.col("script")
    if prefix:
        name = F.regexp_replace(name, "^" + _quote(prefix), "")
    if suffix:
        name = F.regexp_replace(name, _quote(suffix) + "$", "")
    w = Window.partitionBy(id_col).orderBy("line_no")
    return kept.select(id_col, F.row_number().over(w).cast("long").alias("seq"), "call", "script", name.alias("name"))


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"
