"""Membership, id mapping and list assembly operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineage_spark.operators import ordering
from lineage_spark.session import scratch_path

# Fixed values of the image export.
IMAGE_TYPE = "base64Png"
IMAGE_SUFFIX = ".png"


def _keys(other: DataFrame, on) -> DataFrame:
    # one row per key on the lookup side (a partial aggregate): a key repeated a
    # third of all rows cannot skew the join, whose skew splitting covers only
    # the left side of a semi/anti join
    if isinstance(on, str):
        return other.select(on).distinct()
    if isinstance(on, (list, tuple)) and all(isinstance(c, str) for c in on):
        return other.select(*on).distinct()
    return other


def semi_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with a match in ``other`` (``x[x %in% y]``)."""
    return df.join(_keys(other, on), on, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (``x[!x %in% y]``)."""
    return df.join(_keys(other, on), on, "left_anti")


def two_hop(start: DataFrame, hop1: DataFrame, hop2: DataFrame, k0: str, k1: str, k2: str) -> DataFrame:
    """``start.k0 -> hop1 (k0 = k1 side) -> hop2``: two inner equi-joins, e.g.
    logic node -> data node -> alias. Both lookups are small per key, so Spark
    may broadcast them when its size estimate allows."""
    return start.join(hop1, start[k0] == hop1[k1]).join(hop2, k2)


def unmet_requirements(texts: DataFrame, text_col: str, patterns: list[str]) -> DataFrame:
    """Patterns contained in no text: ``(pattern)``.

    One pass over the large side: each text emits the patterns it contains (one
    ``contains`` test per literal pattern, unrolled at plan time so whole-stage
    codegen compiles it; no theta join), those are deduplicated (partial
    aggregate), and the pattern list is anti-joined against them. The pattern list
    is a fixed literal, so its size is known.
    """
    hits = F.array(*[F.when(F.col(text_col).contains(p), F.lit(p)) for p in patterns])
    found = (
        texts.select(F.explode(hits).alias("pattern"))
        .filter(F.col("pattern").isNotNull())
        .distinct()
    )
    spark = texts.sparkSession
    wanted = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    return wanted.join(found, "pattern", "left_anti")


# Characters of the grams that find a pattern's candidates, and of the pieces that long texts are cut into for that.
GRAM, PIECE = 8, 4096
# Texts that a pattern is tested on in the first round, and the factor from round to round.
FIRST_TESTS, MORE_TESTS = 4, 16
# Pattern tables of up to this many bytes are sent to the texts, in blocks of so many; larger ones meet them in a join on grams.
SENT_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20
# Bytes of texts that are looked at together.
SLICE = 1 << 20


class _Wanted:
    """The patterns of a block that no text met yet, by the numbers that some of their bytes make.

    A pattern of fewer than 8 bytes is such a number itself. A longer one is named by 8 of its bytes, of up to 8 places those
    that the fewest patterns share and that are rarest in the first texts, and compared where they stand: the choice decides the
    work, not what is found. No text holds the byte 255, which parts texts; a pattern with that byte (no UTF-8) is looked for in each text.
    """

    def __init__(self, patterns: list[bytes]):
        self.odd = [p for p in patterns if b"\xff" in p]
        self.plain = [p for p in patterns if b"\xff" not in p]
        # number of bytes -> number that they make -> patterns with the place of those bytes
        self.named: dict[int, dict[int, list[tuple[bytes, int]]]] = {}
        self._tables: dict[int, tuple[np.ndarray, np.ndarray, np.uint64]] = {}

    def _name(self, first: np.ndarray) -> None:
        """Names the patterns, given the numbers of 8 bytes in the first texts."""
        places = [sorted({(len(p) - 8) * j // 7 for j in range(8)}) if len(p) > 8 else [0] for p in self.plain]
        grams = [[int.from_bytes(p[i:i + 8], "little") for i in at] for p, at in zip(self.plain, places)]
        values, number, shared = np.unique(np.array([g for of in grams for g in of], np.uint64), return_inverse=True, return_counts=True)
        first = np.sort(first)
        work = (shared * (1 + np.searchsorted(first, values, "right") - np.searchsorted(first, values)))[number].tolist()
        start = 0
        for p, at, of in zip(self.plain, places, grams):
            best = min(range(len(at)), key=lambda i: work[start + i])
            start += len(at)
            self.named.setdefault(min(len(p), 8), {}).setdefault(of[best], []).append((p, at[best]))
        self.plain = []

    def _table(self, size: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """The sorted numbers of ``size`` bytes, and a table of bits of their hashes."""
        if size not in self._tables:
            numbers = np.sort(np.array(list(self.named[size]), np.uint64))
            bits = max(16, (16 * len(numbers)).bit_length())
            table = np.zeros(1 << bits, bool)
            table[(numbers * _MIX) >> np.uint64(64 - bits)] = True
            self._tables[size] = numbers, table, np.uint64(64 - bits)
        return self._tables[size]

    def _standing(self, number: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
        """The wanted numbers of ``size`` bytes among those of all places, with their places."""
        numbers, table, shift = self._table(size)
        number = number if size == 8 else number & np.uint64((1 << 8 * size) - 1)
        at = np.flatnonzero(table[(number * _MIX) >> shift])
        which = np.searchsorted(numbers, number[at])
        real = numbers[np.minimum(which, len(numbers) - 1)] == number[at]
        at, which = at[real], which[real]
        order = np.argsort(which, kind="stable")
        at, which = at[order], which[order]
        start = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(at) else []
        for k, places in zip(start, np.split(at, start[1:]) if len(at) else []):
            yield int(numbers[which[k]]), places

    def met(self, texts: list[bytes]) -> list[bytes]:
        """The wanted patterns that a text contains; they are wanted no more."""
        found = [p for p in self.odd if any(p in t for t in texts)]
        self.odd = [p for p in self.odd if p not in found]
        joined = b"\xff".join([*texts, b"\xff" * 15])
        end = len(joined) - 15
        for lo in range(0, end, SLICE):
            n = min(SLICE, end - lo)
            number = np.empty(-(-n // 8) * 8, np.uint64)
            for i in range(8):
                number[i::8] = np.frombuffer(joined, "<u8", count=len(number) // 8, offset=lo + i)
            if self.plain:
                self._name(number[:n])
            for size in list(self.named):
                for value, places in self._standing(number[:n], size):
                    here, left = self.named[size][value], []
                    for p, at in here:
                        # one search of everything, if that is less work than a comparison at every place
                        stands = len(p) <= 8 or (p in joined if 256 * len(places) > n else any(
                            joined.startswith(p, lo + x - at) for x in places.tolist() if lo + x >= at))
                        (found if stands else left).append(p if stands else (p, at))
                    if len(left) < len(here):
                        self._tables.pop(size, None)
                        self.named[size][value] = left
                        if not left:
                            del self.named[size][value]
                if not self.named[size]:
                    del self.named[size]
        return found


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _met_by_scan(texts: DataFrame, text: str, patterns: list[bytes]) -> DataFrame:
    """``pattern``: those of ``patterns`` that some text contains, from one pass over the texts (a row for each task that met it)."""
    sent = texts.sparkSession.sparkContext.broadcast(patterns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(sent.value)
        for batch in batches:
            held, size = [], 0
            column = batch.column(0)
            for i in range(len(column)):
                held.append(column[i].as_py())
                size += len(held[-1])
                if size >= SLICE or i == len(column) - 1:
                    yield pa.RecordBatch.from_pydict({"pattern": pa.array(wanted.met(held), pa.binary())})
                    held, size = [], 0

    return texts.select(F.col(text).cast("binary").alias("__text")).mapInArrow(scan, "pattern binary").select(F.col("pattern").cast("string"))


def _grams(texts: DataFrame, text: str, k: int) -> DataFrame:
    """``__tid, gram``: the distinct ``k``-character substrings of each piece of a text. Pieces overlap, so none is lost."""
    piece = rf"(?s)(?=(.{{1,{PIECE + k - 1}}})).{{1,{PIECE}}}"
    pieces = texts.select(F.xxhash64(text).alias("__tid"), F.explode(F.regexp_extract_all(F.col(text), F.lit(piece), F.lit(1))).alias("__piece"))
    grams = F.array_distinct(F.regexp_extract_all(F.col("__piece"), F.lit(rf"(?s)(?=(.{{{k}}}))"), F.lit(1)))
    return pieces.select("__tid", F.explode(grams).alias("gram"))


def unmet_patterns(texts: DataFrame, text: str, patterns: DataFrame, pattern: str, k: int = GRAM) -> DataFrame:
    """Patterns of a table contained in no text: ``(pattern)``, distinct.

    A gram index instead of one test per pattern in the plan, so the plan does not grow with the patterns. Patterns of up to
    :data:`SENT_BYTES` are sent to the texts in blocks, and each block takes one pass over them (:class:`_Wanted`). More patterns meet the
    texts in a join: there a pattern of fewer than ``k`` characters is contained where it is itself a gram of its length. A longer one names one of its ``k``-grams (that of least
    hash); only texts with that gram are candidates, and ``contains`` decides. A pattern is done with its first text, so
    candidates are tested in rounds, a few texts for each pattern and then more for those still unmet. A null text contains nothing, an
    empty pattern is in every other text, and null patterns are left out.
    """
    spark = texts.sparkSession
    texts = texts.select(F.col(text).alias("__text")).where("__text is not null")
    wanted = _written(patterns.select(F.col(pattern).cast("string").alias("pattern")).where("pattern is not null").distinct(), "patterns")
    n = F.length("pattern")
    met = []
    if not texts.isEmpty():
        wanted = wanted.where(n > 0)
    size = wanted.agg(F.sum(F.octet_length("pattern") + 8)).first()[0] or 0
    if size <= SENT_BYTES:
        left, blocks = wanted, -(-size // BLOCK_BYTES)
        for b in range(blocks):
            block = wanted.where((n > 0) & (F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b)).select(F.col("pattern").cast("binary")).collect()
            if block:
                left = left.join(_met_by_scan(texts, "__text", [bytes(r[0]) for r in block]).distinct(), "pattern", "left_anti")
        return left
    for size in sorted(r[0] for r in wanted.where((n > 0) & (n < k)).select(n).distinct().collect()):  # k - 1 at most
        some = wanted.where(n == size)
        met.append(some.join(_grams(texts, "__text", size).select(F.col("gram").alias("pattern")).distinct(), "pattern", "left_semi"))

    whole = F.regexp_extract_all(F.col("pattern"), F.lit(rf"(?s)(?=(.{{{k}}}))"), F.lit(1))
    least = F.array_min(F.transform(whole, lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))["g"]
    named = _written(wanted.where(n >= k).select("pattern", least.alias("gram")), "patterns")
    found = _grams(texts, "__text", k).join(named.select("gram").distinct(), "gram", "left_semi").distinct()
    # per gram its texts in an order of their own: ranks come from a window over the distinct (gram, text) pairs
    ranked = _written(ordering.ordered_scan(found, ["gram"], [F.xxhash64("gram", "__tid"), "__tid"], row="nth").select("gram", "__tid", "nth"), "candidates")
    left, first, many = named.join(ranked.select("gram").distinct(), "gram", "left_semi"), 0, FIRST_TESTS
    hits = []
    while True:
        chosen = left.join(ranked.where((F.col("nth") > first) & (F.col("nth") <= first + many)), "gram").select("__tid", "pattern")
        chosen = _written(chosen, "tests")
        if chosen.isEmpty():
            break
        tested = texts.withColumn("__tid", F.xxhash64("__text")).join(chosen, "__tid").where(F.contains("__text", "pattern"))
        hits.append(_written(tested.select("pattern").distinct(), "met"))
        left = _written(left.join(hits[-1], "pattern", "left_anti"), "patterns")
        first, many = first + many, many * MORE_TESTS
    for part in [*met, *hits]:
        wanted = wanted.join(part, "pattern", "left_anti")
    return wanted


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def missing_report(missing: DataFrame, col: str, sep: str = ", ") -> DataFrame:
    """One row: the missing names sorted and joined (the input is an anti-join
    result, i.e. a subset of a known name list)."""
    return missing.agg(F.array_join(F.array_sort(F.collect_set(col)), sep).alias("missing"))


def ordered_list(df: DataFrame, group: list[str], order: str, value: str, sep: str = ",",
                 out: str = "items") -> DataFrame:
    """Values of each group joined in ``order`` (signature order, id order); a
    very large group is joined piece by piece (see :func:`ordering.ordered_join`)."""
    return ordering.ordered_join(df, group, order, value, sep, out)


def first_image(items: Column) -> Column:
    """Decoded bytes of the first visualization item when it is a base64 PNG."""
    first = F.get(items, 0)  # null for an empty array
    return F.when(first["type"] == IMAGE_TYPE, F.unbase64(first["data"]))


def image_rows(df: DataFrame, name: str, items: str, prefix: str = "") -> DataFrame:
    """``(file_name, image)`` for every row whose first item is a PNG.

    The type test runs before decoding, so only kept rows are decoded (and the
    filter stays a plain column comparison in generated code).
    """
    first = df.select(F.col(name).alias("__name"), F.get(F.col(items), 0).alias("__first"))
    return first.filter(
        (F.col("__first.type") == IMAGE_TYPE) & F.col("__first.data").isNotNull()
    ).select(
        F.concat(F.lit(prefix), F.col("__name"), F.lit(IMAGE_SUFFIX)).alias("file_name"),
        F.unbase64(F.col("__first.data")).alias("image"),
    )
