"""Package and version tables: prefix modes, version resolution, name translation,
constant append and the two-key library order.

Inputs are tables: ``requested(pos, spec)``, ``resolved(name, version)`` (e.g.
exploded from the environment JSON with :mod:`lineage_spark.sources.jsonsrc`) and
``translation(name, library)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineage_spark.operators.ordering import global_index

# Fixed values.
R_PREFIXES = ("r-", "bioconductor-")
MODES = ("R", "Python", "All")
R_EXTRAS = ("r-renv", "r-biocmanager")
DROPPED_LIBRARY = "base"
# package name -> library name used in library() calls
TRANSLATION = {
    "seurat": "Seurat",
    "complexheatmap": "ComplexHeatmap",
    "genomeinfodbdata": "GenomeInfoDbData",
    "mast": "MAST",
    "rcolorbrewer": "RColorBrewer",
    "gridbase": "grid",
    "gridextra": "grid",
    "singler": "SingleR",
    "biocmanager": "BiocManager",
    "geomxtools": "GeomxTools",
    "rtsne": "Rtsne",
    "nanostringnctools": "NanoStringNCTools",
}


def has_prefix(col: Column, prefixes=R_PREFIXES) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | col.startswith(p)
    return cond


def prefix_mode(df: DataFrame, col: str, mode: str, prefixes=R_PREFIXES) -> DataFrame:
    """``R`` keeps names with one of the prefixes, ``Python`` the others, ``All`` all."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "All":
        return df
    cond = has_prefix(F.col(col), prefixes)
    return df.filter(cond if mode == "R" else ~cond)


def resolve_versions(requested: DataFrame, resolved: DataFrame, key: str = "spec",
                     name: str = "name", version: str = "version") -> DataFrame:
    """``key=version`` when the key is resolved, else the key as written.

    A left equi-join. Give the resolved side one row per name (for a list where
    a later entry overrides, build it with :func:`last_wins`); the join then keeps
    one row per requested entry.
    """
    r = resolved.select(F.col(name).alias("__n"), F.col(version).alias("__v"))
    j = requested.join(r, requested[key] == r["__n"], "left")
    return j.withColumn(
        "resolved", F.coalesce(F.concat(F.col(key).cast("string"), F.lit("="), F.col("__v").cast("string")),
                               F.col(key).cast("string"))
    ).drop("__n", "__v")


def last_wins(df: DataFrame, key: str, value: str, order) -> DataFrame:
    """Dictionary build where a later entry overwrites an earlier one:
    ``max_by(value, order)`` per key (partial aggregation, skew-safe)."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def translate(col: Column, mapping: dict[str, str]) -> Column:
    """Dictionary lookup with the input as default (a literal map: no join)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, col), col)


def translate_table(df: DataFrame, col: str, table: DataFrame, key: str = "name", value: str = "library") -> DataFrame:
    """Dictionary lookup against a table (left join), input kept when absent."""
    t = table.select(F.col(key).alias("__k"), F.col(value).alias("__t"))
    return df.join(t, df[col] == t["__k"], "left").withColumn(
        "translated", F.coalesce("__t", col)
    ).drop("__k", "__t")


def ci_first_match(values: DataFrame, col: str, lookup: DataFrame, name: str = "name", pos: str = "pos") -> DataFrame:
    """Case-insensitive lookup: for each value the lookup name with the smallest
    position among names equal ignoring case (null when none).

    The lookup is reduced to one row per lower-cased name first (``min_by``), so
    the join is many-to-one.
    """
    first = lookup.groupBy(F.lower(F.col(name)).alias("__low")).agg(F.min_by(name, pos).alias("matched"))
    return values.join(first, F.lower(values[col]) == first["__low"], "left").drop("__low")


def unmatched(values: DataFrame, col: str, lookup: DataFrame, name: str = "name") -> DataFrame:
    """Values with no case-insensitive match (anti join)."""
    low = lookup.select(F.lower(F.col(name)).alias("__low")).distinct()
    return values.join(low, F.lower(values[col]) == low["__low"], "left_anti")


def append_sorted(df: DataFrame, col: str, extras=R_EXTRAS) -> DataFrame:
    """Append constant entries, then number all entries in sorted order:
    ``(pos, col)``; the numbering is distributed (see :func:`global_index`)."""
    spark = df.sparkSession
    extra = spark.createDataFrame([(e,) for e in extras], f"{col} string")
    return global_index(df.select(F.col(col).cast("string").alias(col)).unionByName(extra), [col], "pos")


def package_name(spec: Column) -> Column:
    """``r-dplyr=0.8.5`` -> ``dplyr``: version cut, then the text between the
    first and second ``-``."""
    return F.split_part(F.split_part(spec, F.lit("="), F.lit(1)), F.lit("-"), F.lit(2))


def library_order(df: DataFrame, name: str, pos: str, mapping: dict[str, str] | None = None,
                  table: DataFrame | None = None) -> DataFrame:
    """Library list: ``base`` dropped, untranslated names first, then translated
    ones, each group in input order. Returns ``(seq, library, translated)``."""
    kept = df.filter(F.col(name) != DROPPED_LIBRARY)
    if table is not None:
        t = table.select(F.col("name").alias("__k"), F.col("library").alias("__lib"))
        kept = kept.join(t, kept[name] == t["__k"], "left").drop("__k")
    else:
        m = F.create_map(*[F.lit(x) for kv in (mapping or TRANSLATION).items() for x in kv])
        kept = kept.withColumn("__lib", F.try_element_at(m, F.col(name)))
    ranked = kept.select(
        F.col("__lib").isNotNull().alias("translated"),
        F.col(pos).alias("__pos"),
        F.coalesce("__lib", F.col(name)).alias("library"),
    )
    return global_index(ranked, ["translated", "__pos"], "seq").select("seq", "library", "translated")


def environment(requested: DataFrame, resolved: DataFrame, mode: str, spec: str = "spec",
                name: str = "name", version: str = "version", order: str | Column = "pos") -> DataFrame:
    """The environment's dependency list: ``(pos, spec)`` sorted by spec.

    Requested specs are kept by ``mode``, resolved ones get ``=version``, and for
    the ``R`` and ``All`` modes the fixed extras are appended before sorting. Of a name resolved more than once
    the version last in ``order`` (a column or expression of ``resolved``) counts.
    """
    kept = prefix_mode(requested.select(F.col(spec).alias("spec")), "spec", mode)
    entries = resolved.select(F.col(name).alias("name"), F.col(version).alias("version"), (F.col(order) if isinstance(order, str) else order).alias("__at"))
    specs = resolve_versions(kept, last_wins(entries, "name", "version", "__at"))
    specs = specs.select(F.col("resolved").alias("spec"))
    if mode != "Python":
        return append_sorted(specs, "spec")
    return global_index(specs, ["spec"], "pos")


def libraries(env: DataFrame, spec: str = "spec", pos: str = "pos", table: DataFrame | None = None) -> DataFrame:
    """Library calls of an environment list: ``(seq, library, translated)``
    (see :func:`package_name` and :func:`library_order`)."""
    named = env.select(F.col(pos).alias("pos"), package_name(F.col(spec)).alias("name"))
    return library_order(named, "name", "pos", table=table)
