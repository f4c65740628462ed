"""Repeated lines: two Bloom filters find the suspects, only suspects are shuffled and counted exactly.

1. The hashes of the line keys are built-in functions. Every task enters those of its documents (once per document and key) into a
   *once* and a *twice* Bloom filter (two bit positions per key). Filters are cut into slices of 65,536 bits, sent as bit positions, and merged slice by
   slice: a bit set in two tasks' once filters enters the twice filter. No key that two documents share is missed.
2. Every task tests its keys against the merged twice filter; the keys found there are the suspects.
3. Suspects are grouped by the key text itself, so false suspects go, and lines of keys in enough documents are dropped.

The filter has 16 bits per line up to ``max_bits`` (64 MB); beyond that more lines become suspects and are shuffled, with
the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import BROADCAST_BYTES, lower_ascii, lower_ascii_col, written
from lineage_spark.session import cut_lineage

BITS_PER_LINE = 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 29
SLICE_BITS = 16
_STRIP = " \t\n\x0b\x0c\r"
_BLOOM_SCHEMA = "slice int, once binary, twice binary"


def line_key(line: str) -> str:
    """A line without white space at its ends, A-Z lower-cased."""
    return lower_ascii(line.strip(_STRIP))


def line_hashes(text: Column, min_chars: int) -> Column:
    """Per line the 64-bit hash of its key, null for keys of fewer than ``min_chars`` code points."""
    keys = F.transform(F.split(text, "\n", -1), lambda line: lower_ascii_col(F.btrim(line, F.lit(_STRIP))))
    return F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, F.xxhash64(k)))


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two filter positions of each hash, shape (n, 2)."""
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask], axis=1)


def _slices(positions: np.ndarray) -> dict[int, bytes]:
    p = np.unique(positions)
    at = (p >> np.uint64(SLICE_BITS)).astype(np.int64)
    low = (p & np.uint64((1 << SLICE_BITS) - 1)).astype(np.uint16)
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], cut]) if len(p) else []
    return {int(at[i]): part.tobytes() for i, part in zip(first, np.split(low, cut))}


def _partial_filters(bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [b.column(0).flatten().drop_null().to_numpy().view(np.uint64) for b in batches]
        h, n = np.unique(np.concatenate(hashes or [np.empty(0, np.uint64)]), return_counts=True)
        once, twice = _slices(_positions(h, bits)), _slices(_positions(h[n > 1], bits))
        for lo in range(0, len(once), 512):
            some = list(once)[lo:lo + 512]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([once[s] for s in some], pa.binary()),
                                              pa.array([twice.get(s, b"") for s in some], pa.binary())], names=["slice", "once", "twice"])

    return build


def _merged_slice(rows: pd.DataFrame) -> pd.DataFrame:
    once, twice = np.zeros(1 << SLICE_BITS, bool), np.zeros(1 << SLICE_BITS, bool)
    for o, t in zip(rows["once"], rows["twice"]):
        at = np.frombuffer(o, np.uint16)
        twice[at[once[at]]] = True
        once[at] = True
        twice[np.frombuffer(t, np.uint16)] = True
    return pd.DataFrame({"slice": [int(rows["slice"].iloc[0])], "bits": [np.packbits(twice, bitorder="little").tobytes()]})


def twice_filter(texts: DataFrame, min_chars: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """The merged twice-seen filter as packed bits; ``texts`` has the one column ``__text``."""
    n = texts.agg(F.sum(F.length("__text") - F.length(F.replace("__text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = MIN_BITS
    while bits < min(n * BITS_PER_LINE, max_bits):
        bits <<= 1
    slices = (
        texts.select(F.array_distinct(line_hashes(F.col("__text"), min_chars))).mapInArrow(_partial_filters(bits), _BLOOM_SCHEMA)
        .groupBy("slice").applyInPandas(_merged_slice, "slice int, bits binary")
    )
    out = np.zeros(bits >> 3, np.uint8)
    step = 1 << (SLICE_BITS - 3)
    for row in slices.toLocalIterator():  # at most max_bits / 8 bytes in all
        out[row["slice"] * step:(row["slice"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    return out


def _suspect_lines(filter_bits, use_filter: bool):
    """From ``__a, __b, __text`` and the hashes of the lines, the keys that the filter has seen twice with their line numbers."""
    names = ["__a", "__b", "key", "lines"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = filter_bits.value
        bits = len(twice) << 3
        for batch in batches:
            lists = batch.column(3)
            ends = np.cumsum(lists.value_lengths().to_numpy())
            lines = lists.flatten()
            hit = lines.is_valid().to_numpy(zero_copy_only=False)
            if use_filter:
                at = np.flatnonzero(hit)
                p = _positions(lines.drop_null().to_numpy().view(np.uint64), bits)
                hit[at] = ((twice[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
            hits = np.flatnonzero(hit)
            doc = np.searchsorted(ends, hits, side="right")
            rows, keys, found = [], [], []
            for d, some in zip(*_runs(doc, hits)):
                first = int(ends[d - 1]) if d else 0
                text, by_key = batch.column(2)[int(d)].as_py().split("\n"), {}
                for i in some.tolist():
                    by_key.setdefault(line_key(text[i - first]), []).append(i - first)
                rows += [d] * len(by_key)
                keys += by_key.keys()
                found += by_key.values()
            ids = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(ids), batch.column(1).take(ids), pa.array(keys, pa.string()),
                                              pa.array(found, pa.list_(pa.int32()))], names=names)

    return find


def _runs(groups: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    """The distinct values of a sorted ``groups`` and what ``values`` each has."""
    if not len(groups):
        return [], []
    cut = np.flatnonzero(np.diff(groups)) + 1
    return groups[np.concatenate([[0], cut])].tolist(), np.split(values, cut)


def _identity(text: Column) -> list[Column]:
    """Two 64-bit hashes of a text: the result depends on the text alone, so equal texts share their drops."""
    return [F.xxhash64(text).alias("__a"), F.xxhash64(F.lit("second"), text).alias("__b")]


def dropped_lines(texts: DataFrame, min_docs: int, min_chars: int, max_bits: int = MAX_BITS) -> DataFrame:
    """``__a, __b, drops``: the numbers of the lines that go, for each text that loses any."""
    bits = twice_filter(texts, min_chars, max_bits) if min_docs > 1 else np.zeros(1, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits)
    found = texts.select(*_identity(F.col("__text")), "__text", line_hashes(F.col("__text"), min_chars)).mapInArrow(
        _suspect_lines(shared, min_docs > 1), "__a long, __b long, key string, lines array<int>")
    suspects = written(found, "suspect-lines")
    gone = cut_lineage(suspects.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("key"))
    size = gone.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    hits = suspects.join(F.broadcast(gone) if size <= BROADCAST_BYTES else gone, "key", "left_semi")
    # copies of one text bring the same line lists: the set is combined before the shuffle
    drops = hits.groupBy("__a", "__b").agg(F.flatten(F.collect_set("lines")).alias("drops"))
    return cut_lineage(drops)


def without_repeated_lines(df: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1,
                           max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with ``n_lines``, ``n_dropped`` and ``kept_text`` added.

    Lines are split at ``\\n``; null and empty texts are one empty line. A key (:func:`line_key`) of at least
    ``min_chars`` code points found in at least ``min_docs`` rows loses all its lines in every row; a row counts once
    however often it has the key, and repeated rows count each. Columns of ``df`` named like an added one are replaced.
    """
    added = ["n_lines", "n_dropped", "kept_text"]
    columns = [c for c in df.columns if c not in added]
    norm = F.coalesce(df[text], F.lit(""))
    drops = dropped_lines(df.select(norm.alias("__text")), min_docs, min_chars, max_bits)
    size = drops.agg(F.sum(F.size("drops") * 4 + 32)).first()[0] or 0
    docs = df.select(F.struct(*[df[c] for c in columns]).alias("__doc"), norm.alias("__text"), *_identity(norm))
    joined = docs.join(F.broadcast(drops) if size <= BROADCAST_BYTES else drops, ["__a", "__b"], "left")
    cut = joined.withColumn("__lines", F.split("__text", "\n", -1))
    n = F.size("__lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drops"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    return cut.select(
        "__doc.*", n.cast("long").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("__text")).otherwise(kept).alias("kept_text"),
    )
