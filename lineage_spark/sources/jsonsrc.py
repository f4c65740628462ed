"""Nested JSON sources: parse with a schema, explode arrays of strings/structs,
and assemble JSON documents from rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas of the environment documents (fixed by the platform's export format).
ENV_SCHEMA = "condaEnvironmentDefinition struct<packageMatchSpecs: array<string>>"
RESOLVED_SCHEMA = "resolvedCondaEnvironment struct<packageSpecs: array<struct<name: string, version: string>>>"


def parse(df: DataFrame, col: str, schema: str, out: str = "doc") -> DataFrame:
    return df.withColumn(out, F.from_json(F.col(col), schema))


def requested_specs(docs: DataFrame, col: str = "json") -> DataFrame:
    """``(<other columns>, pos, spec)`` from environment definition documents
    (1-based positions within each document; the document's other columns are
    kept so several documents can share one frame)."""
    keep = [c for c in docs.columns if c != col]
    p = parse(docs, col, ENV_SCHEMA)
    return p.select(*keep, F.posexplode("doc.condaEnvironmentDefinition.packageMatchSpecs").alias("pos", "spec")).select(
        *keep, (F.col("pos") + 1).alias("pos"), "spec"
    )


def resolved_specs(docs: DataFrame, col: str = "json") -> DataFrame:
    """``(<other columns>, pos, name, version)`` from resolved environment documents."""
    keep = [c for c in docs.columns if c != col]
    p = parse(docs, col, RESOLVED_SCHEMA)
    return p.select(*keep, F.posexplode("doc.resolvedCondaEnvironment.packageSpecs").alias("pos", "s")).select(
        *keep, (F.col("pos") + 1).alias("pos"), "s.name", "s.version"
    )


# Schemas of the workbook's node documents (fixed by the platform's export format).
DISPLAY_SCHEMA = ("nodes array<struct<displaySpec: struct<collapsed: struct<logicNode: struct<logicNodeId: string>, "
                  "dataNode: struct<dataNodeId: string>>>>>")
DATA_SCHEMA = "nodes array<struct<alias: string, id: string>>"


def display_nodes(docs: DataFrame, col: str = "json") -> DataFrame:
    """``(logic_id, data_id)`` from documents of display nodes."""
    spec = parse(docs, col, DISPLAY_SCHEMA).select(F.explode("doc.nodes").alias("n")).select("n.displaySpec.collapsed.*")
    return spec.select(F.col("logicNode.logicNodeId").alias("logic_id"), F.col("dataNode.dataNodeId").alias("data_id"))


def data_nodes(docs: DataFrame, col: str = "json") -> DataFrame:
    """``(data_id, alias)`` from documents of data nodes."""
    return parse(docs, col, DATA_SCHEMA).select(F.explode("doc.nodes").alias("n")).select(
        F.col("n.id").alias("data_id"), "n.alias")


def json_field(col: str, schema: str, field: str) -> Column:
    return F.from_json(F.col(col), schema)[field]


def to_json_document(*fields: tuple[str, Column]) -> Column:
    """A JSON object text from named columns, in the given field order."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields]))


def read_documents(spark, path: str) -> DataFrame:
    """JSON documents stored one per file: ``(path, json)`` (each file read whole,
    so a pretty-printed document spanning many lines stays one value)."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("json")
    )
