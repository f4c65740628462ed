"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree, DataFrame operations only.

Documents are cut into blocks of ``block_words`` words. A source's target says how many whole passes over its blocks the mix
takes and where in its permuted block order the last, partial pass ends (inside a block, so the words match the
target). That gives an exact quota of block draws per source. A binary tree over the output shards then splits the
quotas: each node draws its left child's counts from the multivariate hypergeometric distribution, so every shard gets its
exact share of all draws and the sources are mixed as by one global permutation, without sorting the corpus. A shard draws
disjoint ranges of each source's permuted blocks and orders them by a hash of its own.

Positions in the permuted order come from two levels: blocks are dealt to buckets by the top of a 63-bit hash, buckets
are counted and summed, and only blocks of one bucket (about ``BUCKET_BLOCKS``) are ordered together. Only ids and
counts move, never texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineage_spark.llm.common import WORD, small_side, tagged
from lineage_spark.session import cut_lineage

BLOCK_WORDS = 1024
BUCKET_BLOCKS = 1024
SHARDS = 64
SEED = 20
WEIGHTS = (3.0, 1.0, 2.0)
_SPREAD = 12.0  # standard deviations of a draw that are searched: the rest has probability below 1e-30


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _uniform(*parts: Column) -> Column:
    """A hash of the parts as a number in (0, 1)."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def targets(sizes: DataFrame, total: float, cap: float, weights=WEIGHTS) -> DataFrame:
    """``sizes`` (``source``, ``source_size``; one row per source) with ``rank``, ``weight`` and ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``total`` times all sizes; a target stops at
    ``cap`` times its source's size and the excess is shared again by weight until none is above. Sorted by
    limit per weight, the sources that stop are a prefix, so one pass of running sums finds the level of the rest.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    limits = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(cycle, F.col("rank") % len(weights)))
        .withColumn("limit", F.col("source_size") * F.lit(cap))
        .withColumn("fill", F.col("limit") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(everything) * F.lit(total))
        .withColumn("full_before", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(onwards))
        .withColumn("stops", F.col("full_before") + F.col("fill") * F.col("weight_left") <= F.col("all"))
        .withColumn("level", (F.col("all") - F.sum(F.when(F.col("stops"), F.col("limit")).otherwise(0.0)).over(everything))
                    / F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything))
    )
    target = F.when(F.col("stops"), F.col("limit")).otherwise(F.col("level") * F.col("weight"))
    return limits.select("source", "source_size", "rank", "weight", target.alias("target"))


def _hypergeometric(total: Column, marked: Column, drawn: Column, *salt: Column) -> Column:
    """A random count of marked among ``drawn`` of ``total``: the largest of log-probability plus Gumbel noise."""
    one = F.greatest(total - 1, F.lit(1))
    p = marked / F.greatest(total, F.lit(1))
    mean = drawn * p
    spread = F.sqrt(mean * (1.0 - p) * (total - drawn) / one) * _SPREAD + 2.0
    lo = F.greatest(F.lit(0).cast("long"), drawn - (total - marked), F.floor(mean - spread).cast("long"))
    hi = F.least(marked, drawn, F.ceil(mean + spread).cast("long"))

    def step(acc: Column, k: Column) -> Column:
        ratio = ((marked - k).cast("double") * (drawn - k)) / ((k + 1).cast("double") * (total - marked - drawn + k + 1))
        score = acc["log"] - F.log(-F.log(_uniform(*salt, k)))
        better = score > acc["top"]
        return F.struct(
            F.coalesce(acc["log"] + F.log(ratio), F.lit(0.0)).alias("log"),
            F.when(better, score).otherwise(acc["top"]).alias("top"),
            F.when(better, k).otherwise(acc["k"]).alias("k"),
        )

    start = F.struct(F.lit(0.0).alias("log"), F.lit(float("-inf")).alias("top"), lo.alias("k"))
    return F.aggregate(F.sequence(lo, hi), start, step, lambda acc: acc["k"])


def _left_quotas(first: Column, last: Column, quotas: Column, total: Column, drawn: Column) -> Column:
    """Multivariate draw: source by source, each conditioned on what is left of the node and of its left child."""

    def step(acc: Column, q: Column) -> Column:
        k = _hypergeometric(acc["total"], q, acc["drawn"], F.lit(SEED), first, last, F.size(acc["out"]))
        return _let(k, lambda v: F.struct(
            (acc["total"] - q).alias("total"), (acc["drawn"] - v).alias("drawn"), F.concat(acc["out"], F.array(v)).alias("out")))

    start = F.struct(total.alias("total"), drawn.alias("drawn"), F.lit([]).cast("array<bigint>").alias("out"))
    return F.aggregate(quotas, start, step, lambda acc: acc["out"])


def split_quotas(root: DataFrame, shards: int) -> DataFrame:
    """``shard, quotas`` from one row ``quotas`` (block draws per source): each shard's exact counts.

    Shard ``i`` of ``n`` gets ``floor(all * (i + 1) / n) - floor(all * i / n)`` draws.
    """
    size = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
    nodes = root.select(F.lit(0).alias("first"), F.lit(shards).alias("last"), "quotas", size.alias("all"))

    def up_to(i: Column) -> Column:
        return F.floor(F.col("all") * i / F.lit(shards)).cast("long")

    for depth in range(max(1, math.ceil(math.log2(shards))) if shards > 1 else 0):
        if depth == 5:
            nodes = nodes.repartition("first")  # 32 subtrees: the deeper levels run in parallel
        first, last = F.col("first"), F.col("last")
        middle = F.floor((first + last) / 2).cast("int")
        left = _left_quotas(first, last, F.col("quotas"), up_to(last) - up_to(first), up_to(middle) - up_to(first))
        halves = nodes.withColumn("middle", middle).withColumn("left", F.when(last - first > 1, left))
        right = F.zip_with("quotas", "left", lambda q, k: q - k)
        nodes = halves.select("all", F.explode(
            F.when(F.col("left").isNull(), F.array(F.struct(first, last, F.col("quotas"))))
            .otherwise(F.array(
                F.struct(first, F.col("middle").alias("last"), F.col("left").alias("quotas")),
                F.struct(F.col("middle").alias("first"), last, right.alias("quotas"))))
        ).alias("node")).select("all", "node.*")
    return nodes.select(F.col("first").alias("shard"), "quotas")


def _ranked_blocks(docs: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """Every block with its place (``slot``) and the words before it in its source's permuted order."""
    n = F.ceil(F.col("size") / F.lit(block_words)).cast("long")
    blocks = docs.where("size > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("block"))
    start = F.col("block") * F.lit(block_words)
    place = F.when(F.col("key").isNull(), F.xxhash64(F.lit(SEED), F.col("row"), F.col("block"))).otherwise(
        F.xxhash64(F.lit(SEED), F.col("key"), F.col("block")))
    blocks = blocks.select(
        "row", "rank", "block", start.alias("start"), F.least(F.lit(block_words).cast("long"), F.col("size") - start).alias("words"),
        F.shiftrightunsigned(place, 1).alias("place"), "n_buckets",
    ).withColumn("bucket", F.floor(F.col("place") / F.lit(float(1 << 63)) * F.col("n_buckets")).cast("long"))
    sums = blocks.groupBy("rank", "bucket").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("c"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut_lineage(sums.select(
        "rank", "bucket", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("blocks_before")))
    inside = Window.partitionBy("rank", "bucket").orderBy("place", "row", "block")
    prior = inside.rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "*", F.row_number().over(inside).alias("nth"), F.coalesce(F.sum("words").over(prior), F.lit(0)).alias("in_bucket"),
    ).join(small_side(sums, 32), ["rank", "bucket"]).select(
        "row", "rank", "block", "start", "words",
        (F.col("blocks_before") + F.col("nth") - 1).alias("slot"), (F.col("words_before") + F.col("in_bucket")).alias("before"))


def _find_shard(ends: Column, slot: Column, shards: int) -> Column:
    """The first shard whose end is past ``slot``, by binary search in the non-decreasing ``ends``."""
    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        past = F.get(ends, middle) > slot
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & ~past, middle + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & past, middle).otherwise(acc["hi"]).alias("hi"))

    rounds = F.sequence(F.lit(1), F.lit(math.ceil(math.log2(shards)) + 1))
    start = F.struct(F.lit(0).alias("lo"), F.lit(shards - 1).alias("hi"))
    return F.aggregate(rounds, start, step, lambda acc: acc["lo"])


class Mix:
    """A planned mix of ``df``: ``documents`` (one row per input row) and ``draws`` (one row per drawn block).

    ``documents``: ``row``, ``key``, ``source``, ``size``, ``source_size``, ``target``. ``draws``: ``row``, ``rank`` (of the
    source), ``block``, ``pass``, ``start`` and ``taken`` (words), ``shard``, ``order`` (the shard's local shuffle).
    A null text has size 0 and draws nothing; a null source is a source of its own; repeated rows are documents of
    their own; other columns are ignored. An empty table gives empty results.
    """

    def __init__(self, df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", total: float = 1.5,
                 cap: float = 2.0, weights=WEIGHTS, shards: int = SHARDS, block_words: int = BLOCK_WORDS):
        docs = tagged(df.select(df[key].alias("key"), df[source].alias("source"), word_count(df[text]).alias("size")), "row")
        n_blocks = F.ceil(F.col("size") / F.lit(block_words))
        sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(n_blocks).cast("long").alias("n_blocks"))
        blocks_of = sizes.select(F.col("source").alias("s"), "n_blocks")
        plan = targets(sizes.drop("n_blocks"), total, cap, weights)
        words = F.round("target").cast("long")
        passes = F.least(F.floor(words / F.greatest(F.col("source_size"), F.lit(1))), F.lit(int(cap))).cast("long")
        self.sources = cut_lineage(
            plan.join(blocks_of, plan["source"].eqNullSafe(blocks_of["s"])).drop("s")
            .withColumn("passes", passes).withColumn("rest", words - F.col("passes") * F.col("source_size"))
            .withColumn("n_buckets", F.greatest(F.ceil(F.col("n_blocks") / F.lit(BUCKET_BLOCKS)), F.lit(1)).cast("long")))
        per = small_side(self.sources.withColumnRenamed("source", "s"), 256)
        self.documents = docs.join(per, docs["source"].eqNullSafe(per["s"])).drop("s")
        ranked = _ranked_blocks(self.documents.select("row", "key", "rank", "size", "n_buckets"), self.sources, block_words)
        per = small_side(self.sources.select("rank", "passes", "rest", "n_blocks"), 64)
        ranked = ranked.join(per, "rank")
        last = F.when(F.col("before") < F.col("rest"), F.col("passes")).otherwise(F.col("passes") - 1)
        drawn = cut_lineage(ranked.where(last >= 0).withColumn("last", last))
        quotas = self.sources.select("rank").join(
            drawn.groupBy("rank").agg(F.sum(F.col("last") + 1).alias("quota")), "rank", "left")
        root = quotas.agg(F.transform(F.array_sort(F.collect_list(
            F.struct("rank", F.coalesce("quota", F.lit(0).cast("long")).alias("quota")))), lambda s: s["quota"]).alias("quotas"))
        self.shares = cut_lineage(split_quotas(root, shards))
        upto = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
        ends = (
            self.shares.select("shard", F.posexplode("quotas").alias("rank", "quota"))
            .select("rank", "shard", F.sum("quota").over(upto).alias("end"))
            .groupBy("rank").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))), lambda s: s["end"]).alias("ends")))
        ends = small_side(cut_lineage(ends), 16 + 8 * shards)
        per_pass = drawn.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("pass"))
        taken = F.when(F.col("pass") < F.col("passes"), F.col("words")).otherwise(
            F.least(F.col("words"), F.col("rest") - F.col("before")))
        slot = F.col("pass") * F.col("n_blocks") + F.col("slot")
        placed = per_pass.withColumn("taken", taken).withColumn("slot", slot).join(ends, "rank")
        self.draws = placed.select("row", "rank", "block", "pass", "start", "taken",
                                   _find_shard(F.col("ends"), F.col("slot"), shards).alias("shard")) \
            .withColumn("order", F.xxhash64(F.lit(SEED), "shard", "rank", "row", "block", "pass"))
        self.n_shards = shards

    def shuffled(self) -> DataFrame:
        """The draws in output order: one partition per shard, each shuffled locally."""
        return self.draws.repartition(self.n_shards, "shard").sortWithinPartitions("shard", "order", "row", "block", "pass")

    def per_document(self) -> DataFrame:
        """``documents`` with ``taken`` (words the mix takes, repeats counted), ``n_draws`` and ``n_shards``."""
        sums = self.draws.groupBy("row").agg(
            F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n_draws"), F.size(F.collect_set("shard")).alias("n_shards"))
        return self.documents.join(sums, "row", "left").select(
            "key", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
            F.coalesce("n_draws", F.lit(0).cast("long")).alias("n_draws"), F.coalesce("n_shards", F.lit(0)).alias("n_shards"))
