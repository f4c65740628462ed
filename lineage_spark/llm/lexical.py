"""Ranked lexical search: an inverted index in document shards, searched by Block-Max MaxScore.

**Index.** A task turns its documents into shards of bounded size; a shard has one row per term with the postings
(document number and occurrences) in compressed blocks of 128, and one row with its documents' keys and lengths. No
posting is shuffled. A block keeps, in the open, its last document and what bounds any score in it whatever the
corpus statistics are: the shortest document with one occurrence, with two or three, and with four or more, and
the most occurrences.

**Search.** The statistics (documents, terms, document frequencies) come from the index rows. A task goes through
shards with one heap of the best ``k`` per item. Lists are ordered by their bound, the largest of their block
bounds. Lists whose bounds together stay below the heap's least score cannot lift a document on their own: they
are not essential, and only documents of the essential lists are candidates. On each further list the block maximum
decides first: a candidate that cannot reach the heap even with it is rejected before the block is decompressed.
All scores are exact integers, so pruning never changes a result; a document that ties with the least score is kept until
the keys are compared. The heaps of all tasks are merged by rank.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lineage_spark.llm.common import lower_ascii, small_side, tagged, written
from lineage_spark.session import scratch_path

# a term is a maximal run of ASCII letters and digits and of characters beyond ASCII
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_RE = re.compile(TERM)
BLOCK = 128
# a shard ends with the document that reaches one of these
SHARD_CHARS, SHARD_DOCS = 1 << 24, 1 << 16
# text of items that one pass over the index answers
ITEM_CHARS = 1 << 22
NONE = np.uint32(0xFFFFFFFF)

# per block: last document, start of its bytes, shortest document with 1, 2-3 and 4 or more occurrences, most occurrences, rows, widths
META = np.dtype([("last", "<u4"), ("at", "<u4"), ("n1", "<u4"), ("n2", "<u4"), ("n4", "<u4"), ("most", "<u4"),
                 ("rows", "u1"), ("wide_doc", "u1"), ("wide_tf", "u1")])


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term of a text (A-Z lower-cased); none for null."""
    return Counter(TERM_RE.findall(lower_ascii(text))) if text else Counter()


def coded(docs: np.ndarray, tfs: np.ndarray, lists: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block table, bytes and, per list, its first block (with the end) of postings sorted by (list, document).

    In a block come first the gaps between documents (one or two bytes each; from the block's first document, itself a gap from
    the list's block before), then the occurrences (one, two or four bytes).
    """
    n = len(docs)
    starts = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]])) if n else np.zeros(0, np.int64)
    within = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    heads = np.flatnonzero(within % BLOCK == 0)
    block = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
    gap = docs.astype(np.int64).copy()
    gap[1:] -= np.where(within[1:] > 0, docs[:-1], 0)

    meta = np.zeros(len(heads), META)
    if n:
        meta["rows"] = np.diff(np.append(heads, n))
        meta["last"] = docs[np.append(heads[1:], n) - 1]
        meta["wide_doc"] = np.where(np.maximum.reduceat(gap, heads) < 256, 1, 2)
        meta["most"] = most = np.maximum.reduceat(tfs, heads)
        meta["wide_tf"] = np.where(most < 256, 1, np.where(most < 65536, 2, 4))
        for name, low, high in (("n1", 1, 1), ("n2", 2, 3), ("n4", 4, NONE)):
            meta[name] = np.minimum.reduceat(np.where((tfs >= low) & (tfs <= high), lens, NONE), heads)
    size = meta["rows"].astype(np.int64) * (meta["wide_doc"].astype(np.int64) + meta["wide_tf"])
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    place = np.arange(n) - heads[block]
    for value, wide, first in ((gap, meta["wide_doc"], at), (tfs, meta["wide_tf"], at + meta["rows"].astype(np.int64) * meta["wide_doc"])):
        each = wide[block].astype(np.int64)
        to = first[block] + place * each
        for byte in range(4):
            some = each > byte
            out[to[some] + byte] = (value[some] >> (8 * byte)) & 0xFF
    first_block = np.append(block[starts], len(heads)) if n else np.zeros(1, np.int64)
    meta["at"] = at - np.repeat(at[first_block[:-1]], np.diff(first_block)) if n else at
    return meta, out, np.stack([first_block, np.append(at[first_block[:-1]], len(out))]) if n else np.zeros((2, 1), np.int64)


def _index_schema(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
        T.StructField("n_terms", T.LongType()), T.StructField("blocks", T.BinaryType()), T.StructField("postings", T.BinaryType()),
        T.StructField("keys", T.ArrayType(key)), T.StructField("lens", T.BinaryType())])


class Index:
    """A written index; ``folder`` can be opened again."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.rows = spark, spark.read.parquet(folder)
        self.key = self.rows.schema["keys"].dataType.elementType
        # documents with a term, terms of all documents
        n, total = self.rows.where("term is null").agg(F.sum("df"), F.sum("n_terms")).first()
        self.n_docs, self.n_terms = n or 0, total or 0


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None,
          shard_chars: int = SHARD_CHARS, shard_docs: int = SHARD_DOCS) -> Index:
    """Index every whole text of ``docs``. A row of null or empty text, or without a term, is in no list. Rows that repeat are
    documents of their own; other columns are not read and may have any name; an empty table gives an empty index."""
    if not 0 < shard_docs <= 1 << 16:
        raise ValueError("a shard has 1 to 65,536 documents")
    folder = folder or scratch_path(docs.sparkSession, "lexical-index")
    kind = docs.select(key).schema[0].dataType
    schema = _index_schema(kind)
    names, listed = schema.names, pa.list_(to_arrow_type(kind))

    def shard_rows(shard: int, keys: list, lens: list[int], per_doc: list, vocabulary: dict) -> Iterator[pa.RecordBatch]:
        lengths = np.array(lens, np.uint32)
        ids = np.concatenate([x[0] for x in per_doc])
        of = np.repeat(np.arange(len(keys), dtype=np.int64), [len(x[0]) for x in per_doc])
        tfs = np.concatenate([x[1] for x in per_doc]).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        ids, of, tfs = ids[order], of[order], tfs[order]
        meta, data, first = coded(of, tfs, ids, lengths[of])
        n = len(vocabulary)
        df = np.bincount(ids, minlength=n)

        def sliced(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])

        nothing = [pa.nulls(n, pa.int64()), pa.nulls(n, listed), pa.nulls(n, pa.binary())]
        rows = pa.RecordBatch.from_arrays([
            pa.array(np.full(n, shard)), pa.array(list(vocabulary)), pa.array(df.astype(np.int64)), nothing[0],
            sliced(meta, first[0] * META.itemsize), sliced(data, first[1]), *nothing[1:]], names=names)
        for at in range(0, n, 1 << 15):
            yield rows.slice(at, 1 << 15)
        yield pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.nulls(1, pa.string()), pa.array([len(keys)], pa.int64()),
            pa.array([sum(lens)], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
            pa.array([keys], listed), pa.array([lengths.tobytes()], pa.binary())], names=names)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        keys, lens, per_doc, chars, vocabulary = [], [], [], 0, _vocabulary()
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                counts = term_counts(t)
                if not counts:
                    continue
                n = len(counts)
                keys.append(k)
                lens.append(sum(counts.values()))
                per_doc.append((np.fromiter(map(vocabulary.__getitem__, counts), np.int32, n), np.fromiter(counts.values(), np.int64, n)))
                chars += len(t)
                if chars >= shard_chars or len(keys) >= shard_docs:
                    yield from shard_rows(shard, keys, lens, per_doc, vocabulary)
                    shard, keys, lens, per_doc, chars, vocabulary = shard + 1, [], [], [], 0, _vocabulary()
        if keys:
            yield from shard_rows(shard, keys, lens, per_doc, vocabulary)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(make, schema)
    rows.write.parquet(folder)
    return Index(docs.sparkSession, folder)


def _vocabulary() -> defaultdict:
    """Terms to numbers in the order of their first use."""
    v = defaultdict()
    v.default_factory = v.__len__
    return v


class _Scores:
    """The score of a term in a document, for the statistics of an index: whole numbers, division rounds down."""

    def __init__(self, n_docs: int, n_terms: int, df: dict[str, int]):
        self.n_docs, self.n_terms = n_docs, max(n_terms, 1)
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}

    def m(self, lens: np.ndarray) -> np.ndarray:
        return 10 + (90 * lens.astype(np.int64) * self.n_docs) // self.n_terms

    @staticmethod
    def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1000000000 * tf) // (1000 * tf + 8 * m)

    def bounds(self, meta: np.ndarray) -> np.ndarray:
        """Per block, no document's part is above this: more occurrences or a shorter document only raise it."""
        most = meta["most"].astype(np.int64)
        out = np.zeros(len(meta), np.int64)
        for name, tf in (("n1", np.ones_like(most)), ("n2", np.minimum(most, 3)), ("n4", most)):
            some = meta[name] != NONE
            out[some] = np.maximum(out[some], self.part(tf[some], self.m(meta[name][some])))
        return out


class _List:
    """A term's list in a shard; blocks are decompressed when first asked for."""

    def __init__(self, meta: bytes, data: bytes, weight: int, scores: _Scores, m: np.ndarray):
        self.meta, self.data, self.weight, self.m = np.frombuffer(meta, META), np.frombuffer(data, np.uint8), weight, m
        self.last = self.meta["last"]
        self.most = weight * scores.bounds(self.meta)
        self.bound = int(self.most.max())
        self.blocks, self.whole = {}, None

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.blocks:
            x = self.meta[b]
            n, at, wide, tf_wide = int(x["rows"]), int(x["at"]), int(x["wide_doc"]), int(x["wide_tf"])
            docs = np.cumsum(self.data[at:at + n * wide].view(f"<u{wide}").astype(np.int64))
            if b:  # the first gap counts from the block before
                docs += int(self.last[b - 1])
            tf = self.data[at + n * wide:at + n * (wide + tf_wide)].view(f"<u{tf_wide}").astype(np.int64)
            self.blocks[b] = docs, self.weight * _Scores.part(tf, self.m[docs])
        return self.blocks[b]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            parts = [self.block(b) for b in range(len(self.meta))]
            self.whole = parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))
        return self.whole

    def add(self, docs: np.ndarray, score: np.ndarray, rest: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidates (ascending) and scores with this list's part, without those that cannot reach ``least``."""
        b = np.searchsorted(self.last, docs)
        inside = b < len(self.last)
        top = np.where(inside, self.most[np.minimum(b, len(self.last) - 1)], 0)
        able = score + top + rest >= least
        docs, score, b, inside = docs[able], score[able], b[able], inside[able]
        if self.whole is None and len(docs):
            used = np.unique(b[inside])
            if not len(used):
                return docs, score
            if len(used) < len(self.meta):
                parts = [self.block(int(i)) for i in used]
                at, parts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            else:
                at, parts = self.all()
        elif len(docs):
            at, parts = self.whole
        else:
            return docs, score
        i = np.minimum(np.searchsorted(at, docs), len(at) - 1)
        return docs, score + np.where(at[i] == docs, parts[i], 0)


def _order(entry: tuple) -> tuple:
    """Highest score first, then ascending key, null before others."""
    score, key = entry
    return -score, key is not None, key if key is not None else 0


def search_shard(lists: list[_List], n: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that can be among the best ``k`` given that ``least`` is the heap's least score, and their exact scores."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = max(least, 1)
    lists = sorted(lists, key=lambda x: -x.bound)
    rest = np.append(np.cumsum([x.bound for x in lists][::-1], dtype=np.int64)[::-1], 0)
    if rest[0] < least:
        return nothing
    essential = int(np.count_nonzero(rest >= least))  # what follows cannot reach it alone
    total = np.zeros(n, np.int64)
    for x in lists[:essential]:
        docs, parts = x.all()
        total[docs] += parts
    docs = np.flatnonzero(total + rest[essential] >= least)
    score = total[docs]
    if essential < len(lists) and len(docs) > k:  # the k-th of what is known so far is a bound too
        least = max(least, int(np.partition(score, len(score) - k)[len(score) - k]))
    for i in range(essential, len(lists)):
        if not len(docs):
            return nothing
        docs, score = lists[i].add(docs, score, int(rest[i + 1]), least)
    kept = score >= least
    docs, score = docs[kept], score[kept]
    if len(docs) > k:
        kept = score >= np.partition(score, len(score) - k)[len(score) - k]
        docs, score = docs[kept], score[kept]
    return docs, score


def _blocks(items: DataFrame, key: Column, text: Column) -> Iterator[dict[int, tuple[object, list[str]]]]:
    """The items and their terms (row tag -> key, distinct terms), at most ``ITEM_CHARS`` of text or one item at a time."""
    rows = tagged(items.select(key.alias("key"), text.cast("string").alias("text")))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // ITEM_CHARS)
    for i in range(n):
        some = rows if n == 1 else rows.where(F.pmod(F.xxhash64("__row"), F.lit(n)) == i)
        yield {r["__row"]: (r["key"], sorted(term_counts(r["text"]))) for r in some.toLocalIterator()}


def search(index: Index, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 10, out: str = "doc_id") -> DataFrame:
    """The ``k`` best documents of every item: ``key``, ``rank`` (from 1), ``out`` (the document's key), ``score``.

    Equal scores rank by ascending document key (null first; repeated keys in any order). Items without a term, or with no
    document above 0, have no row; repeated items each have their rows. Other columns of ``items`` are not read. Items are
    answered in blocks of a bounded size, each in one pass over the lists of its terms.
    """
    spark, kind = index.spark, index.key
    item_kind = items.select(key).schema[0].dataType
    found = None
    schema = T.StructType([T.StructField("tag", T.LongType()), T.StructField("score", T.LongType()), T.StructField("doc", kind)])
    for block in _blocks(items, F.col(key), F.col(text)):
        best = _search_block(index, {tag: terms for tag, (_, terms) in block.items()}, k, schema)
        names = spark.createDataFrame([(tag, item) for tag, (item, _) in block.items()],
                                      T.StructType([schema[0], T.StructField("item", item_kind)]))
        ranked = F.row_number().over(Window.partitionBy("tag").orderBy(F.desc("score"), F.asc("doc")))
        best = best.withColumn("rank", ranked).where(F.col("rank") <= k)
        best = best.join(small_side(names, 64), "tag").select(F.col("item").alias(key), "rank", F.col("doc").alias(out), "score")
        found = best if found is None else found.union(best)
    if found is None:
        return spark.createDataFrame([], T.StructType([
            T.StructField(key, item_kind), T.StructField("rank", T.IntegerType()), T.StructField(out, kind), T.StructField("score", T.LongType())]))
    return found


def _search_block(index: Index, items: dict[int, list[str]], k: int, schema: T.StructType) -> DataFrame:
    """The best ``k`` of each item in every task (written out)."""
    spark = index.spark
    terms = sorted({t for ts in items.values() for t in ts})
    asked = spark.createDataFrame([(t,) for t in terms], "term string")
    lists = index.rows.join(F.broadcast(asked), "term", "left_semi")  # at most ITEM_CHARS of text, or one item
    df = {t: n for t, n in lists.groupBy("term").agg(F.sum("df")).toLocalIterator()}
    scores = _Scores(index.n_docs, index.n_terms, df)
    # rarest terms first, which lets heavy lists come first in a shard
    items = {tag: [t for t in ts if scores.weight.get(t, 0) > 0] for tag, ts in items.items()}

    doc_kind = to_arrow_type(index.key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {tag: [] for tag in items}
        shard, lists, waiting, keys, m = None, {}, {}, [], None

        def finish():
            rank = sorted(range(len(keys)), key=lambda i: _order((0, keys[i])))
            place = np.empty(len(keys), np.int64)
            place[rank] = np.arange(len(keys))
            for t, (meta, data) in waiting.items():
                lists[t] = _List(meta, data, scores.weight[t], scores, m)
            for tag, ts in items.items():
                here = [lists[t] for t in ts if t in lists]
                if not here:
                    continue
                heap = heaps[tag]
                docs, score = search_shard(here, len(keys), k, heap[-1][0] if len(heap) == k else 0)
                if len(docs):
                    top = np.lexsort((place[docs], -score))[:k]
                    heap += [(int(score[i]), keys[docs[i]]) for i in top]
                    heap.sort(key=_order)
                    del heap[k:]

        for b in batches:
            for s, term, meta, data, names, lens in zip(*(b.column(i) for i in range(6))):
                s = s.as_py()
                if s != shard:
                    if shard is not None:
                        finish()
                    shard, lists, waiting, keys, m = s, {}, {}, [], None
                if term.is_valid:
                    if scores.weight[term.as_py()] > 0:
                        waiting[term.as_py()] = meta.as_py(), data.as_py()
                else:
                    keys, m = names.as_py(), scores.m(np.frombuffer(lens.as_py(), "<u4"))
        if shard is not None:
            finish()
        rows = [(tag, score, key) for tag, heap in heaps.items() for score, key in heap]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                          pa.array(columns[2], doc_kind)], names=schema.names)

    columns = ["shard", "term", "blocks", "postings", "keys", "lens"]
    shards = lists.select(*columns).union(index.rows.where("term is null").select(*columns))
    shards = shards.repartition("shard").sortWithinPartitions("shard", F.col("term").isNotNull())
    return written(shards.mapInArrow(run, schema), "best")
