"""Exported workbook scripts as transform tables.

An exported workbook is one text of sections. Each section starts with a marker
line (``@...``); its header lists the step's output and inputs, one per line::

    @transform(
        Output(rid="<output rid>"),
        <var>=Input(rid="<input rid>"),
    )
    <name> <- function(<arg>, <arg>) {
        ...

The header ends at the first line starting with ``)``; the step's signature is
the first line after it that contains ``<-``. Arguments bind, in signature
order, to the header input with the same variable name (an argument without
one has no declared dataset).

:func:`transforms_from_lines` turns ``lines(doc_id, line_no, line)`` into the
transform table of :mod:`lineage_spark.operators.lineage`, with ``idx`` the
section's position in the text. Every step is a DataFrame operation: marker
sections as a running count over the distributed ordered scan (a script of any
length is spread over many tasks), the header end and signature as ``min_by``
aggregates per section, and the binding as an equi-join on (section, name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineage_spark.operators import ordering
from lineage_spark.operators.lineage import EMPTY_PARAMETER
from lineage_spark.session import scratch_path

# The export format's markers and patterns.
SECTION_MARKER = "@"
HEADER_END = ")"
INPUT_TAG = "Input"
OUTPUT_TAG = "Output"
RID_PATTERN = r'rid="([^"]*)"'
VAR_PATTERN = r"^\s*([^=\s]+)\s*="
SIGNATURE_TAG = "<-"
NAME_PATTERN = r"^\s*([^ <]+)"
ARGS_PATTERN = r"\(([^)]*)\)"


def transforms_from_lines(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``(doc_id, name, idx, output_rid, inputs)`` for every section of every text.

    ``inputs`` is ``array<struct<pos, arg, rid>>`` in signature order; ``rid`` is
    null for an argument with no header input. When a header names several
    outputs the last one counts. Sections without a signature are left out. An empty
    parameter of a signature stays as an argument without a dataset, so its step can
    never run and is reported by ``lineage.unsatisfiable``.
    """
    line = F.col("line")
    tests = {
        "marker": line.startswith(SECTION_MARKER), "close": line.startswith(HEADER_END), "input": line.contains(INPUT_TAG),
        "output": line.contains(OUTPUT_TAG), "signature": line.contains(SIGNATURE_TAG),
    }
    # only the lines that say something about a step are ordered and written: bodies stay behind. They are written once before,
    # as the ranges are found by a pass of their own
    telling = lines.select(doc, "line_no", "line", *[t.alias(f"__{n}") for n, t in tests.items()])
    telling = _written(telling.where(" or ".join(f"__{n}" for n in tests)), "lines")
    scanned = ordering.ordered_scan(
        telling, [doc], ["line_no"], sums={"idx": F.col("__marker").cast("int")})
    kept = [F.col(c) for c in (doc, "line_no", "line", "__close", "__input", "__output", "__signature")]
    marked = _written(scanned.where("idx > 0").select(*kept, F.col("idx").cast("int").alias("idx")), "sections")
    key = [doc, "idx"]

    at = F.col("line_no")
    ends = marked.where("__close").groupBy(*key).agg(F.min("line_no").alias("close_no"))
    m = marked.where("__input or __output or __signature").join(ends, key)
    header = F.col("line_no") < F.col("close_no")
    inputs = m.where(header & F.col("__input")).select(
        *key,
        "line_no",
        F.regexp_extract("line", VAR_PATTERN, 1).alias("arg"),
        F.nullif(F.regexp_extract("line", RID_PATTERN, 1), F.lit("")).alias("rid"),
    )
    # one aggregate: the last output of the header and the first signature after it
    sigs = m.groupBy(*key).agg(
        F.max_by(F.regexp_extract("line", RID_PATTERN, 1), F.when(header & F.col("__output"), at)).alias("output_rid"),
        F.min_by("line", F.when((at > F.col("close_no")) & F.col("__signature"), at)).alias("sig"),
    ).where(F.col("sig").isNotNull())
    sigs = sigs.select(
        *key,
        "output_rid",
        F.regexp_extract("sig", NAME_PATTERN, 1).alias("name"),
        F.split(F.regexp_extract("sig", ARGS_PATTERN, 1), ",").alias("args"),
    )
    args = (
        sigs.select(*key, F.size("args").alias("n"), F.posexplode("args").alias("p", "a"))
        .select(*key, "n", (F.col("p") + 1).cast("int").alias("pos"), F.trim("a").alias("arg"))
        # ``()`` has no parameter; any other empty one is kept, without a dataset, so that the step is reported
        .filter((F.col("arg") != "") | (F.col("n") > 1))
        .withColumn("arg", F.when(F.col("arg") == "", F.lit(EMPTY_PARAMETER)).otherwise(F.col("arg")))
        .drop("n")
    )
    # one rid per declared variable (the last declaration wins)
    declared = inputs.groupBy(*key, "arg").agg(F.max_by("rid", "line_no").alias("rid"))
    bound = args.join(declared, [*key, "arg"], "left").groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("pos", "arg", "rid"))).alias("inputs")
    )
    return (
        sigs.join(bound, key, "left")
        .select(
            doc,
            "name",
            "idx",
            "output_rid",
            F.coalesce("inputs", F.array().cast("array<struct<pos:int,arg:string,rid:string>>")).alias("inputs"),
        )
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: each branch reads only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
