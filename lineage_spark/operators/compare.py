"""Dataset verification: normalisation, schema diff, bag row diff, report, digest.

Row comparison ignores row and column order, compares numerics at a fixed number
of digits and counts repeats. It is one signed ``unionByName`` followed by one
``groupBy`` over every column, so each side is read once and shuffled once and
the aggregate is combined map-side (a value repeated a billion times costs one
partial row per task, not one row per copy).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineage_spark.functions.names import clean_column_names, quoted

# Fixed values of the comparison report.
DIGITS = 7
STATUS_DEFAULT = "no comparison"
STATUS_NOT_TABLE = "Not a dataframe, skipping"
STATUS_EQUAL = "equal"
STATUS_ROWS = "rows differ"
STATUS_SCHEMA = "schema differs"

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType) + _FRACTIONAL


def normalize_frame(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every fractional column (float, double, decimal) to ``digits``.

    Integral columns are left as they are (rounding them is the identity). Spark has
    no factor type (a pandas categorical arrives as a string), so the platform's
    factor-to-string rule needs no code here.
    """
    cols = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, _FRACTIONAL):
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(cols)


def schema_diff(target: DataFrame, new: DataFrame) -> list[tuple[str, str]]:
    """Column-level differences, column order ignored, ``new`` names cleaned.

    Returns ``(column_name, side)`` pairs with side ``only_left``, ``only_right``
    or ``type_mismatch`` (a string against a number; two numeric types are
    compatible and widened by :func:`row_diff`).
    """
    left = {f.name: f.dataType for f in target.schema.fields}
    right = {f.name: f.dataType for f in clean_column_names(new).schema.fields}
    out = [(c, "only_left") for c in left if c not in right]
    out += [(c, "only_right") for c in right if c not in left]
    for c in left:
        if c in right and not _compatible(left[c], right[c]):
            out.append((c, "type_mismatch"))
    return sorted(out)


def _compatible(a: T.DataType, b: T.DataType) -> bool:
    if a == b:
        return True
    return isinstance(a, _NUMERIC) and isinstance(b, _NUMERIC)


def _aligned(target: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean ``new`` names, order both by ``target``'s columns, widen numeric pairs."""
    new = clean_column_names(new)
    rtypes = {f.name: f.dataType for f in new.schema.fields}
    lcols, rcols = [], []
    for f in target.schema.fields:
        lt, rt = f.dataType, rtypes[f.name]
        lc, rc = quoted(f.name), quoted(f.name)
        if lt != rt and isinstance(lt, _NUMERIC) and isinstance(rt, _NUMERIC):
            if isinstance(lt, (T.FloatType, T.DoubleType)) or isinstance(rt, (T.FloatType, T.DoubleType)):
                lc, rc = lc.cast("double"), rc.cast("double")
            elif isinstance(lt, T.DecimalType) or isinstance(rt, T.DecimalType):
                # exact: no digit of a long or a decimal is lost
                scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (lt, rt))
                lc, rc = (c.cast(T.DecimalType(38, scale)) for c in (lc, rc))
            else:
                lc, rc = lc.cast("long"), rc.cast("long")
        lcols.append(lc.alias(f.name))
        rcols.append(rc.alias(f.name))
    return target.select(lcols), new.select(rcols)


def row_diff(target: DataFrame, new: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rows whose multiplicity differs between the two frames.

    Output: the compared columns plus ``side`` (``only_left`` when ``target`` has
    more copies, ``only_right`` when ``new`` has) and ``n_copies`` (how many more).
    Schemas must be compatible; see :func:`schema_diff`.
    """
    if schema_diff(target, new):
        raise ValueError("schemas differ; compare with schema_diff first")
    left, right = _aligned(target, new)
    left, right = normalize_frame(left, digits), normalize_frame(right, digits)
    cols = left.columns
    signed = left.withColumn("__sign", F.lit(1)).unionByName(right.withColumn("__sign", F.lit(-1)))
    counted = signed.groupBy([quoted(c) for c in cols]).agg(F.sum("__sign").alias("__net"))
    return counted.filter(F.col("__net") != 0).select(
        *[quoted(c) for c in cols],
        F.when(F.col("__net") > 0, F.lit("only_left")).otherwise(F.lit("only_right")).alias("side"),
        F.abs(F.col("__net")).cast("long").alias("n_copies"),
    )


def diff_counts(target: DataFrame, new: DataFrame, digits: int = DIGITS) -> DataFrame:
    """One row: ``only_left`` / ``only_right`` copy counts of :func:`row_diff`."""
    d = row_diff(target, new, digits)
    return d.agg(
        F.coalesce(F.sum(F.when(F.col("side") == "only_left", F.col("n_copies"))), F.lit(0)).cast("long").alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("side") == "only_right", F.col("n_copies"))), F.lit(0)).cast("long").alias("only_right"),
    )


REPORT_SCHEMA = "dataset string, status string, only_left long, only_right long"


# Comparisons of one report that run at a time.
CONCURRENT = 8


def _frames(target, new) -> tuple:
    """Both sides, made if they are functions; the status instead if there is nothing to compare."""
    target = target() if callable(target) else target
    new = new() if callable(new) else new
    if not isinstance(target, DataFrame):
        return STATUS_NOT_TABLE, None, None
    if new is None:
        return STATUS_DEFAULT, None, None
    if schema_diff(target, new):
        return STATUS_SCHEMA, None, None
    return None, target, new


def _compared(name: str, frames: tuple) -> tuple:
    status, target, new = frames
    if status:
        return (name, status, None, None)
    try:
        left, right = diff_counts(target, new).first()
    except Exception:  # noqa: BLE001  whatever one dataset does, the others are reported
        return (name, STATUS_DEFAULT, None, None)
    return (name, STATUS_EQUAL if left == right == 0 else STATUS_ROWS, left, right)


def verify_report(spark, pairs: list[tuple[str, object, object]], concurrent: int = CONCURRENT) -> DataFrame:
    """One summary row per dataset: ``(dataset, status, only_left, only_right)``.

    ``pairs`` holds ``(name, target, new)``; a frame may be given as a function that makes it. ``new`` may be
    ``None`` (nothing to compare against: the default status stays), a target that is not a DataFrame
    is skipped with its own status. Frames are made one after another; the comparisons then run as up to ``concurrent``
    jobs at a time, each counted (one row) on its own, so one that fails, when planned or when run, keeps the default
    status and the others are reported.
    """
    made = []
    for name, target, new in pairs:
        try:
            made.append((name, _frames(target, new)))
        except Exception:  # noqa: BLE001
            made.append((name, (STATUS_DEFAULT, None, None)))
    with ThreadPoolExecutor(max(1, concurrent)) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(_compared), *zip(*made))) if made else []
    return spark.createDataFrame(rows, REPORT_SCHEMA)


# Doubles from here on have no digits after the point; their shortest text tells them apart.
_WHOLE_DOUBLE = 1e18


def value_text(v: Column, kind: T.DataType, digits: int = DIGITS) -> Column:
    """Canonical text of a value of a known type; values that differ (at ``digits`` decimals) never share one.

    Null is ``N``; a plain value is its length, ``:`` and its text; a binary its bytes in hexadecimal; an array or map ``A`` or ``M``, its
    number of entries and their texts in brackets (a map's in the order of their texts); a struct its fields' texts in
    parentheses. Lengths and counts come first, so no text can be read in two ways. Doubles cover their whole range: NaN,
    infinities and numbers of 1e18 and more have texts of their own, and -0.0 is 0.0, as in the row comparison.
    """
    if isinstance(kind, T.ArrayType):
        items = F.transform(v, lambda x: value_text(x, kind.elementType, digits))
        return _or_null(v, F.concat(F.lit("A"), F.size(v).cast("string"), F.lit("["), F.array_join(items, ""), F.lit("]")))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.concat(value_text(e["key"], kind.keyType, digits), value_text(e["value"], kind.valueType, digits))
        items = F.array_sort(F.transform(F.map_entries(v), entry))
        return _or_null(v, F.concat(F.lit("M"), F.size(v).cast("string"), F.lit("["), F.array_join(items, ""), F.lit("]")))
    if isinstance(kind, T.StructType):
        fields = [value_text(v.getField(f.name), f.dataType, digits) for f in kind.fields]
        return _or_null(v, F.concat(F.lit("("), *fields, F.lit(")")))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        d = v.cast("double")
        small = F.when(F.abs(d) < F.lit(_WHOLE_DOUBLE), d).cast(T.DecimalType(38, digits)).cast("string")
        t = F.coalesce(small, d.cast("string"))
    elif isinstance(kind, T.DecimalType):
        # the whole digits of a type never change, so one column has one form
        whole = kind.precision - kind.scale
        if whole + digits <= 38:
            t = v.cast(T.DecimalType(38, digits)).cast("string")
        else:
            t = (F.round(v, digits) if kind.scale > digits else v).cast("string")
    elif isinstance(kind, T.BinaryType):
        t = F.hex(v)
    else:
        t = v.cast("string")
    return _or_null(t, F.concat(F.length(t).cast("string"), F.lit(":"), t))


def _or_null(v: Column, text: Column) -> Column:
    return F.when(v.isNull(), F.lit("N")).otherwise(text)


def row_text(df: DataFrame, cols: list[str] | None = None, digits: int = DIGITS) -> Column:
    """Canonical text of a row: its fields' texts (see :func:`value_text`) one after another."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.concat(*[value_text(quoted(c), kinds[c], digits) for c in cols or df.columns])


def dataset_digest(df: DataFrame, by: list[str], cols: list[str] | None = None) -> DataFrame:
    """Order-free content digest per group: ``by + (n_rows, digest)``.

    The whole md5 of each row's canonical text enters: its four 32-bit parts are read as numbers and summed
    separately per group, and the digest is the four sums. Two frames with the same rows in any
    order give the same digest.
    """
    md5 = F.md5(row_text(df, cols))
    parts = [F.conv(F.substring(md5, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = df.select(*[quoted(c) for c in by], *[p.alias(f"__h{i}") for i, p in enumerate(parts)])
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.concat_ws("-", *[F.sum(F.col(f"__h{i}").cast("decimal(20,0)")).cast("string") for i in range(4)]).alias("digest"),
    )


def positional_diff(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Lines that differ at the same position (a positional diff, not an LCS).

    ``left``/``right`` carry ``keys`` (e.g. doc and line number) and ``value``;
    output is ``keys + [left_<value>, right_<value>]`` for every position where the
    values are not null-safe equal, including positions present on one side only.
    """
    l = left.select(*keys, F.col(value).alias(f"left_{value}"))
    r = right.select(*keys, F.col(value).alias(f"right_{value}"))
    j = l.join(r, on=keys, how="full_outer")
    return j.filter(~F.col(f"left_{value}").eqNullSafe(F.col(f"right_{value}")))


def positional_diff_texts(left: DataFrame, right: DataFrame, key: str, text: str) -> DataFrame:
    """:func:`positional_diff` of the lines of two text columns: ``key, line_no, left_line, right_line``.

    The texts of a key are paired first, so only texts are shuffled and the lines are zipped inside the pair. A text
    without a partner has every line reported; ``key`` is unique on either side.
    """
    l = left.select(key, F.split(text, "\n").alias("__l"))
    r = right.select(key, F.split(text, "\n").alias("__r"))
    none = F.array().cast("array<string>")
    zipped = F.arrays_zip(F.coalesce("__l", none).alias("l"), F.coalesce("__r", none).alias("r"))
    lines = l.join(r, key, "full_outer").select(key, F.posexplode(zipped).alias("pos", "pair"))
    return lines.where(~F.col("pair.l").eqNullSafe(F.col("pair.r"))).select(
        key, (F.col("pos") + 1).cast("int").alias("line_no"), F.col("pair.l").alias("left_line"), F.col("pair.r").alias("right_line"))


def hash_list(spark, frames: list[tuple[str, DataFrame]], cols: dict[str, list[str]] | None = None) -> DataFrame:
    """One digest per dataset, in list order: ``(pos, dataset, n_rows, digest)``.

    Each entry is a one-row aggregate of :func:`dataset_digest` over the whole
    dataset; the list can be compared with a golden list by :func:`positional_diff`.
    """
    parts = []
    for i, (name, df) in enumerate(frames):
        use = (cols or {}).get(name) or df.columns
        d = dataset_digest(df.withColumn("__all", F.lit(1)), ["__all"], use)
        parts.append(d.select(F.lit(i + 1).alias("pos"), F.lit(name).alias("dataset"), "n_rows", "digest"))
    if not parts:
        return spark.createDataFrame([], "pos int, dataset string, n_rows long, digest string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def golden_diff(produced: DataFrame, golden: DataFrame, key: str = "dataset", value: str = "digest") -> DataFrame:
    """A produced list against a stored one: ``(key, produced, golden, status)`` of every entry that is
    ``changed``, ``missing`` (stored only) or ``extra`` (produced only)."""
    p = produced.select(key, F.col(value).alias("produced"), F.lit(True).alias("__p"))
    g = golden.select(key, F.col(value).alias("golden"), F.lit(True).alias("__g"))
    both = p.join(g, key, "full_outer")
    status = F.when(F.col("__p").isNull(), F.lit("missing")).when(F.col("__g").isNull(), F.lit("extra")).otherwise(F.lit("changed"))
    same = F.col("__p").isNotNull() & F.col("__g").isNotNull() & F.col("produced").eqNullSafe(F.col("golden"))
    return both.where(~same).select(key, "produced", "golden", status.alias("status"))
