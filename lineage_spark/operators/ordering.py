"""Ordered operators that stay distributed when one group is very large.

``ordered_scan`` range-partitions the rows on (group, order) once — the sampler cuts a hot group across
tasks — and writes them with their partition number. In a partition, neighbouring rows of one group are a run. Every
derived column (row number, group size, previous and next values, running sums, last marked value) is computed inside
its run, in time linear in the rows; only a partition's first and last run can go on in a neighbour, so a table of one row per
partition, the only broadcast, carries what they need: a segmented scan whose segments are the groups. Nothing of
one group ever enters another's value, so sums keep their own type and a NaN stays where it is. Group
borders are found by comparing neighbouring rows null-safely: there is no join on the group key, null keys are
groups of their own, and a group holding a third of all rows is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineage_spark.session import cut_lineage


def range_tagged(df: DataFrame, order_cols: list) -> DataFrame:
    """Rows range-partitioned and sorted on ``order_cols``, tagged with their
    partition (``__pid``) and in-partition id (``__mid``), checkpointed.

    A per-row tiebreaker is the last range key, so the partitioner can split even
    a run of identical keys (a third of all rows on one key); the order among such
    ties is arbitrary but fixed by the checkpoint.
    """
    cols = [c if isinstance(c, Column) else F.col(c) for c in order_cols]
    keyed = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*cols, F.col("__tie")]
    tagged = (
        keyed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id())
        .drop("__tie")
    )
    return cut_lineage(tagged)


def _carried(summary: DataFrame, carries: dict[str, Column]) -> DataFrame:
    """``__pid`` and the carries; ``summary`` has one row per partition, so the window is one small task."""
    return F.broadcast(summary.select("__pid", *[c.alias(n) for n, c in carries.items()]))


def _partitions():
    """A window over the partition table."""
    return Window.orderBy("__pid")


def _earlier():
    return _partitions().rowsBetween(Window.unboundedPreceding, -1)


def global_index(df: DataFrame, order_cols: list, out: str = "seq") -> DataFrame:
    """Append ``out`` = 1-based position of each row in the order of ``order_cols``.

    Ties are broken by whatever follows in ``order_cols``; give a unique key last
    for a deterministic result. The tagged frame is checkpointed to the shared
    folder so a lost executor cannot renumber rows.
    """
    tagged = range_tagged(df, order_cols)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = _carried(counts, {"__off": F.coalesce(F.sum("__n").over(_earlier()), F.lit(0))})
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (
        tagged.join(offsets, "__pid")
        .withColumn(out, F.col("__off") + local + F.lit(1))
        .drop("__pid", "__mid", "__off")
    )


def ordered_scan(df: DataFrame, group_cols: list[str], order_cols: list, *, sums: dict[str, Column] | None = None,
                 last: dict[str, tuple[Column, Column]] | None = None, previous: dict[str, str] | None = None,
                 following: dict[str, str] | None = None, size: str | None = None, row: str | None = None) -> DataFrame:
    """``df`` with ordered columns inside the groups of ``group_cols`` (rows in ``order_cols``), all from one shuffle:

    * ``sums``: name -> value; the sum up to and including the row, in the type that a sum of the value has (null values count as 0);
    * ``last``: name -> (mark, value); the value of the last row at or before this one whose mark is true, else null;
    * ``previous`` / ``following``: name -> column; the column one row back / ahead, null at the group's border;
    * ``row`` / ``size``: names for the row number and the number of rows of the group.

    A null key is a group like any other. ``__pos`` and ``__start`` (position of the row and of its group's first row)
    are added too.
    """
    sums, last, previous, following = sums or {}, last or {}, previous or {}, following or {}
    zero = {n: F.lit(0).cast(t) for n, t in df.select(*[v.alias(n) for n, v in sums.items()]).dtypes}
    kinds = dict(df.agg(*[F.sum(v).alias(n) for n, v in sums.items()]).dtypes) if sums else {}
    extra = {f"__v{i}": F.coalesce(v, zero[n]) for i, (n, v) in enumerate(sums.items())}
    extra |= {f"__m{i}": F.when(mark, F.struct(value.alias("v"))) for i, (mark, value) in enumerate(last.values())}
    tagged = range_tagged(df.withColumns(extra) if extra else df, [*group_cols, *order_cols])
    key = F.struct(*[F.col(c) for c in group_cols])
    boxed = lambda c: F.struct(F.col(c).alias("v"))  # noqa: E731  tells a null value from no value

    # runs: neighbouring rows of one group in a partition, numbered from 1
    inside = Window.partitionBy("__pid").orderBy("__mid")
    rows = tagged.withColumn("__new", (~F.lag(key).over(inside).eqNullSafe(key)).cast("long"))
    rows = rows.withColumn("__run", F.sum("__new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("__pid", "__run").orderBy("__mid")
    upto = run.rowsBetween(Window.unboundedPreceding, 0)
    local = {"__nth": F.row_number().over(run).cast("long")}
    if size:
        local["__rows"] = F.count(F.lit(1)).over(Window.partitionBy("__pid", "__run"))
    local |= {f"__s{i}": F.sum(f"__v{i}").over(upto) for i in range(len(sums))}
    local |= {f"__l{i}": F.last(f"__m{i}", ignorenulls=True).over(upto) for i in range(len(last))}
    local |= {f"__p{i}": F.lag(boxed(c)).over(run) for i, c in enumerate(previous.values())}
    local |= {f"__f{i}": F.lead(boxed(c)).over(run) for i, c in enumerate(following.values())}
    rows = rows.withColumns(local)

    # what a partition tells its neighbours: its border keys, the rows of its first run, the state at its last row
    final = {"__lastkey": key, "__runs": F.col("__run"), "__n_last": F.col("__nth")}
    final |= {f"__s{i}": F.col(f"__s{i}") for i in range(len(sums))} | {f"__l{i}": F.col(f"__l{i}") for i in range(len(last))}
    final |= {f"__p{i}": boxed(c) for i, c in enumerate(previous.values())}
    first = {"__firstkey": key} | {f"__f{i}": boxed(c) for i, c in enumerate(following.values())}
    edges = rows.groupBy("__pid").agg(
        F.max_by(F.struct(*[c.alias(n) for n, c in final.items()]), "__mid").alias("z"),
        F.min_by(F.struct(*[c.alias(n) for n, c in first.items()]), "__mid").alias("a"),
        F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__run") == 1).alias("__n_first")).select("__pid", "__n", "__n_first", "z.*", "a.*")

    # a segmented scan over the partitions, forwards and (for the size) backwards
    goes_on = F.coalesce(F.lag("__lastkey").over(_partitions()).eqNullSafe(F.col("__firstkey")) & F.lag("__pid").over(_partitions()).isNotNull(), F.lit(False))
    edges = edges.withColumn("__goes_on", goes_on)
    edges = edges.withColumn("__next_goes_on", F.coalesce(F.lead("__goes_on").over(_partitions()), F.lit(False)))
    several = F.col("__runs") > 1
    backwards = Window.orderBy(F.desc("__pid"))
    edges = edges.withColumns({
        "__chain": F.sum((several | ~F.col("__goes_on")).cast("int")).over(_partitions()),
        "__back": F.sum((several | ~F.col("__next_goes_on")).cast("int")).over(backwards)})
    chain = Window.partitionBy("__chain").orderBy("__pid").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("__back").orderBy(F.desc("__pid")).rowsBetween(Window.unboundedPreceding, 0)
    handed = {"__n_last": F.sum("__n_last").over(chain), "__n_first": F.sum("__n_first").over(back)}
    handed |= {f"__s{i}": F.sum(f"__s{i}").over(chain) for i in range(len(sums))}
    handed |= {f"__l{i}": F.last(f"__l{i}", ignorenulls=True).over(chain) for i in range(len(last))}
    edges = edges.withColumns(handed)

    def arrives(name):
        return F.when(F.col("__goes_on"), F.lag(name).over(_partitions()))

    carries = {"__off": F.coalesce(F.sum("__n").over(_earlier()), F.lit(0)), "__c_runs": F.col("__runs"),
               "__c_n": F.coalesce(arrives("__n_last"), F.lit(0)),
               "__c_rest": F.coalesce(F.when(F.col("__next_goes_on"), F.lead("__n_first").over(_partitions())), F.lit(0))}
    for prefix, of in (("__s", sums), ("__l", last), ("__p", previous)):
        carries |= {f"__c{prefix}{i}": arrives(f"{prefix}{i}") for i in range(len(of))}
    carries |= {f"__c__f{i}": F.when(F.col("__next_goes_on"), F.lead(f"__f{i}").over(_partitions())) for i in range(len(following))}
    rows = rows.join(_carried(edges, carries), "__pid")

    def in_first(c):
        return F.when(F.col("__run") == 1, c)

    nth = F.col("__nth") + F.coalesce(in_first(F.col("__c_n")), F.lit(0))
    pos = F.col("__off") + F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33) + F.lit(1)
    out = {n: (F.col(f"__s{i}") + F.coalesce(in_first(F.col(f"__c__s{i}")), zero[n])).cast(kinds[n]) for i, n in enumerate(sums)}
    out |= {n: F.coalesce(f"__l{i}", in_first(F.col(f"__c__l{i}")))["v"] for i, n in enumerate(last)}
    out |= {n: F.coalesce(f"__p{i}", in_first(F.col(f"__c__p{i}")))["v"] for i, n in enumerate(previous)}
    ends = F.col("__run") == F.col("__c_runs")
    out |= {n: F.coalesce(f"__f{i}", F.when(ends, F.col(f"__c__f{i}")))["v"] for i, n in enumerate(following)}
    if row:
        out[row] = nth
    if size:
        out[size] = F.col("__rows") + F.coalesce(in_first(F.col("__c_n")), F.lit(0)) + F.when(ends, F.col("__c_rest")).otherwise(F.lit(0))
    keep = [c for c in df.columns if c not in out]
    return rows.select(*keep, *[c.alias(n) for n, c in out.items()], pos.alias("__pos"), (pos - nth + F.lit(1)).alias("__start"))


def ordered_join(df: DataFrame, group: list[str], order: str, value: str, sep: str, out: str) -> DataFrame:
    """Per group, the non-null ``value``s joined by ``sep`` in ``order`` (ties by value): ``group + [out]``.

    The rows are range-partitioned on (group, order, value), so a hot group lies in many partitions; each joins the values
    it has of a group, and the pieces are joined by partition number. Nulls are left out wherever the partitions are cut, and a
    group of nulls gives an empty text. The result row holds the whole group's text: that is the requested output.
    """
    rows = df.select(*group, F.col(order).alias("__o"), F.col(value).cast("string").alias("__v"), F.monotonically_increasing_id().alias("__tie"))
    placed = rows.repartitionByRange(*group, "__o", "__v", "__tie").withColumn("__pid", F.spark_partition_id())

    def joined(frame, by, o, v):
        items = F.array_sort(F.collect_list(F.when(F.col(v).isNotNull(), F.struct(F.col(o).alias("o"), F.col(v).alias("v")))))
        text = F.array_join(F.transform(items, lambda s: s["v"]), sep)
        return frame.groupBy(*by).agg(F.when(F.size(items) > 0, text).alias(out))

    pieces = joined(placed, [*group, "__pid"], "__o", "__v").withColumnRenamed(out, "__piece")
    return joined(pieces, group, "__pid", "__piece").withColumn(out, F.coalesce(out, F.lit("")))
