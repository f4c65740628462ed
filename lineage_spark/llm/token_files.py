"""Token-ID output: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

A text is encoded once; the ids then get ranks by their count over all documents (ties by id), so frequent ids
have small ranks. A rank takes one to four bytes. Its length is not in the data but in a control byte, which
holds the lengths of four ranks (two bits each), so a reader takes all lengths of a block from a table
of 256 rows and gathers the bytes at once, without a loop over ids.

A data set is a folder of token files in ascending order of (key, content), a file with the ids by rank and a table
of the files. A token file has, little-endian, one after another:

====================  ==========================================================================
``TOKRANK1``          8 bytes
counts                int64 x 5: documents, ids, blocks, bytes of keys, bytes of data
key ends              int64 per document: where its key ends; the complement of that for a null key
keys                  the keys as UTF-8 text
id ends               int64 per document: ids of the file up to and with it
block starts          int64 per block of ``BLOCK`` ids: where its data begin
control bytes         one per four ids (a block's last one is filled up with zeros)
data bytes            the ranks, low bytes first
====================  ==========================================================================

Blocks are independent, so ids ``a..b`` of a file are read without decoding what is before them.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineage_spark.llm.common import small_side, written
from lineage_spark.session import scratch_path

MAGIC = b"TOKRANK1"
BLOCK = 1 << 16
# ids of a file, unless its last document is longer
IDS_PER_FILE = 1 << 23
# pieces of text, and words of them, that a worker remembers (twice so many of each at most), and the longest it remembers
CACHED_PIECES, CACHED_CHARS = 1 << 18, 48
# characters of a text that are cut into pieces at a time
RUN_CHARS = 1 << 22

LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.int64)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ranks (uint32)."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF) + (ranks > 0xFFFF).astype(np.int64) + (ranks > 0xFFFFFF)
    fours = np.zeros((-len(ranks) % 4) + len(ranks), np.uint8)
    fours[:len(ranks)] = size - 1
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    taken = np.arange(4) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[taken].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of control and data bytes (uint8 arrays)."""
    size = LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(size) - size
    data = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    return (data[at] | data[at + 1] << 8 | data[at + 2] << 16 | data[at + 3] << 24) & MASKS[size]


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# a word of letters that normalisation keeps as one letter each, with ASCII punctuation before and after it
_PLAIN = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")


class _Memory:
    """A dict of bounded size: when its newer half is full the older one goes, but for what was asked for since."""

    def __init__(self, bound: int):
        self.bound, self.newer, self.older = bound, {"": b""}, {}

    def unknown(self, keys: Iterable[str]) -> list[str]:
        """The distinct keys that are not held; all others are in ``newer`` afterwards."""
        if len(self.newer) >= self.bound:
            self.newer, self.older = {"": b""}, self.newer
        newer, older, out = self.newer, self.older, []
        for k in {k for k in keys if k not in newer}:
            if k in older:
                newer[k] = older[k]
            else:
                out.append(k)
        return out


class Encoder:
    """Texts to ids by a tokenizer of the ``tokenizers`` library that drops white space and case and ends each of its words with ``</w>``.

    Nothing such a tokenizer does reaches across a blank, tab or line end, so a text's ids are those of its pieces
    between them; each distinct piece is encoded once, and remembered up to a bound. A piece that is a plain word, maybe between punctuation,
    is as many of the tokenizer's words, which are remembered too and go to the library many at a time, to be parted at the word ends; any other piece
    goes alone. ``test_pieces_encode_as_the_whole_text`` holds this against whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks of an executor are its threads
        self.tokenizer = _tokenizer(path)
        self.pieces, self.words = _Memory(CACHED_PIECES), _Memory(CACHED_PIECES)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts, one after another, and the number of ids of each text; long texts go in runs of pieces."""
        runs, of = [], []
        for i, t in enumerate(texts):
            at = 0
            while True:
                end = t.find(" ", at + RUN_CHARS) if len(t) - at > RUN_CHARS else -1
                runs.append(t[at:end] if end >= 0 else t[at:])
                of.append(i)
                if end < 0:
                    break
                at = end
        ids, sizes, first = [], [], 0
        while first < len(runs):
            last, chars = first, 0
            while last < len(runs) and chars < RUN_CHARS:
                chars += len(runs[last])
                last += 1
            some = self._run(runs[first:last])
            ids.append(some[0])
            sizes.append(some[1])
            first = last
        if not runs:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        return np.concatenate(ids), np.bincount(of, np.concatenate(sizes), len(texts)).astype(np.int64)

    def _run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        column = pa.array(texts, pa.large_string())
        for blank in "\n\t\r":
            column = pc.replace_substring(column, blank, " ")
        cut = pc.split_pattern(column, " ")
        pieces = cut.flatten().dictionary_encode()
        distinct, codes = pieces.dictionary.to_pylist(), pieces.indices.to_numpy()
        self._learn(self.pieces.unknown(distinct))
        known = self.pieces.newer
        raw = [known[p] for p in distinct]
        for p in self.passing:
            del known[p]
        size = np.fromiter(map(len, raw), np.int64, len(raw)) >> 2
        flat, start = np.frombuffer(b"".join(raw), "<u4"), np.cumsum(size) - size
        each = size[codes]
        ends = np.cumsum(each)
        ids = flat[np.repeat(start[codes] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
        last = np.cumsum(cut.value_lengths().to_numpy(zero_copy_only=False))
        return ids, np.diff(np.concatenate([[0], np.concatenate([[0], ends])[last]]))

    def _learn(self, pieces: list[str]) -> None:
        """Add the ids of new pieces; long ones stay only as long as they are ``passing``."""
        known = self.pieces.newer
        self.passing = [p for p in pieces if len(p) > CACHED_CHARS]
        bare, marked, rest = [], [], []
        for p in pieces:
            m = _PLAIN.fullmatch(p)
            if not m or "<|" in p:  # special tokens begin with these marks
                rest.append(p)
            elif m[1] or m[3]:
                marked.append((p, m[1], m[2].lower(), m[3]))
            else:
                bare.append(p)
        lowered = [p.lower() for p in bare]
        wrong = self._learn_words(self.words.unknown(chain(lowered, (u for x in marked for u in x[1:]))))
        words = self.words.newer
        if wrong:
            rest += [p for p, w in zip(bare, lowered) if w in wrong] + [x[0] for x in marked if wrong.intersection(x[1:])]
            words.update(dict.fromkeys(wrong, b""))  # for the moment: such pieces are encoded whole below
        known.update(zip(bare, map(words.__getitem__, lowered)))
        for p, before, word, after in marked:
            known[p] = words[before] + words[word] + words[after]
        for w in wrong:
            del words[w]
        for p in [w for w in words if len(w) > CACHED_CHARS] if self.passing else ():
            del words[p]
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(some, encoded))

    def _learn_words(self, units: list[str]) -> set[str]:
        """Add the ids of letter or punctuation runs, each one of the tokenizer's words; returns those that turn out not to be."""
        wrong = set()
        for at in range(0, len(units), 1000):
            some = units[at:at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(some):
                wrong.update(some)
                continue
            raw = ids.tobytes()
            self.words.newer.update(zip(some, [raw[i:j] for i, j in zip([0, *ends], ends)]))
        return wrong


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    """One for each worker process, whose tasks follow one another."""
    return Encoder(path)


def tokenized(docs: DataFrame, tokenizer: str, key: str, text: str, end_id: int, width: int) -> DataFrame:
    """``key``, ``__row`` (the same when a task runs again), ``__crc`` (as uint32) and ``__n`` of the ids, and the ids in ``width`` bytes each, written out."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = _encoder(tokenizer), TaskContext.get().partitionId() << 33
        for b in batches:
            at = 0
            while at < len(b):
                texts, held = [], 0
                while at + len(texts) < len(b) and held < 4 * RUN_CHARS:  # bounded, whatever the texts
                    texts.append(b.column(1)[at + len(texts)].as_py() or "")
                    held += len(texts[-1]) + 64
                n, (ids, size) = len(texts), encoder(texts)
                ends = np.cumsum(size + 1)
                coded = np.full(len(ids) + n, end_id, "<u4")
                own = np.ones(len(coded), bool)
                own[ends - 1] = False
                coded[own] = ids
                raw, cuts = memoryview(coded.tobytes()), [0, *(4 * ends).tolist()]
                crc = pa.array([zlib.crc32(raw[i:j]) for i, j in zip(cuts, cuts[1:])], pa.int64())
                kept = coded.astype(f"<u{width}")
                binary = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.array(cuts, np.int64) // 4 * width), pa.py_buffer(kept)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, n), pa.array(np.arange(row, row + n)), crc, pa.array(size + 1, pa.int64()),
                                                  binary.cast(pa.binary())], names=names)
                row, at = row + n, at + n

    names = [key, "__row", "__crc", "__n", "__ids"]
    kind = docs.select(key).schema[0].dataType
    schema = T.StructType([T.StructField(key, kind), *[T.StructField(n, T.LongType()) for n in names[1:4]],
                           T.StructField("__ids", T.BinaryType())])
    return written(docs.select(key, F.col(text).cast("string").alias(text)).mapInArrow(encode, schema), "token-ids")


def ranked_ids(rows: DataFrame, width: int) -> np.ndarray:
    """The ids by falling count over all rows (ties by id). Its size is that of the vocabulary in use."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            part = np.bincount(np.concatenate([np.frombuffer(x.as_buffer(), f"<u{width}") for x in b.column(0)]))
            if len(part) > len(total):
                total = np.concatenate([total, np.zeros(len(part) - len(total), np.int64)])
            total[:len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    per_task = rows.select("__ids").mapInArrow(counts, "id long, n long")
    found = per_task.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    ids, n = found["id"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    return ids[np.lexsort((ids, -n))].astype("<u4")


def _put(uri: str, parts: list[bytes]) -> None:
    """A file, whole or not at all; a task that runs again replaces it with the same bytes."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(temp) as out:
        for p in parts:
            out.write(p)
    store.move(temp, path)


class _FileWriter:
    """Gathers documents of one token file; ids are coded block by block, so few lie in memory uncoded."""

    def __init__(self):
        self.keys, self.key_ends, self.id_ends, self.n = [], [], [], 0
        self.waiting, self.n_waiting, self.starts, self.control, self.data, self.n_data = [], 0, [], [], [], 0
        self.key_bytes = 0

    def add(self, key: str | None, ranks: np.ndarray) -> None:
        text = (key or "").encode("utf-8", "surrogatepass")
        self.key_bytes += len(text)
        self.keys.append(text)
        self.key_ends.append(~self.key_bytes if key is None else self.key_bytes)
        self.n += len(ranks)
        self.id_ends.append(self.n)
        self.waiting.append(ranks)
        self.n_waiting += len(ranks)
        if self.n_waiting >= 16 * BLOCK:
            self._code(BLOCK)

    def _code(self, least: int) -> None:
        ranks = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        at = 0
        while len(ranks) - at >= least and at < len(ranks):
            control, data = pack(ranks[at:at + BLOCK])
            self.starts.append(self.n_data)
            self.control.append(control)
            self.data.append(data)
            self.n_data += len(data)
            at += BLOCK
        self.waiting = [ranks[at:]]
        self.n_waiting = len(self.waiting[0])

    def parts(self) -> list[bytes]:
        self._code(1)
        counts = [len(self.keys), self.n, len(self.starts), self.key_bytes, self.n_data]
        return [MAGIC, np.array(counts, "<i8").tobytes(), np.array(self.key_ends, "<i8").tobytes(), *self.keys,
                np.array(self.id_ends, "<i8").tobytes(), np.array(self.starts, "<i8").tobytes(), *self.control, *self.data]


class TokenFile:
    """One open token file."""

    def __init__(self, uri: str, ids_by_rank: np.ndarray):
        store, path = fs.FileSystem.from_uri(uri)
        self.src, self.ids_by_rank = store.open_input_file(path), ids_by_rank
        head = self.src.read_at(48, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        docs, self.n, blocks, key_bytes, self.n_data = np.frombuffer(head, "<i8", 5, 8).tolist()
        at = 48
        ends = self._ints(at, docs)
        raw = self.src.read_at(key_bytes, at + 8 * docs)
        at += 8 * docs + key_bytes
        last = np.where(ends < 0, ~ends, ends)
        first = np.concatenate([[0], last[:-1]])
        self.keys = [None if e < 0 else raw[a:b].decode("utf-8", "surrogatepass") for e, a, b in zip(ends, first, last)]
        self.id_ends = self._ints(at, docs)
        self.starts = np.append(self._ints(at + 8 * docs, blocks), self.n_data)
        self.control = at + 8 * docs + 8 * blocks
        self.data = self.control + (self.n // BLOCK) * (BLOCK // 4) + (self.n % BLOCK + 3) // 4

    def _ints(self, at: int, n: int) -> np.ndarray:
        return np.frombuffer(self.src.read_at(8 * n, at), "<i8")

    def ids(self, first: int, last: int) -> Iterator[np.ndarray]:
        """The ids at positions ``first`` to ``last`` (exclusive) of the file, block by block."""
        for b in range(first // BLOCK, -(-last // BLOCK)):
            n = min(BLOCK, self.n - b * BLOCK)
            control = np.frombuffer(self.src.read_at((n + 3) // 4, self.control + b * (BLOCK // 4)), np.uint8)
            a, z = int(self.starts[b]), int(self.starts[b + 1])
            ranks = unpack(control, np.frombuffer(self.src.read_at(z - a, self.data + a), np.uint8), n)
            yield self.ids_by_rank[ranks[max(first - b * BLOCK, 0):last - b * BLOCK]]

    def documents(self) -> Iterator[tuple[str | None, int, list[np.ndarray]]]:
        """Key, position in the file and pieces of the ids of each document; a block is decoded once."""
        blocks = self.ids(0, self.n)
        block, used, at = np.zeros(0, "<u4"), 0, 0
        for key, end in zip(self.keys, self.id_ends.tolist()):
            pieces, need = [], end - at
            while need:
                if used == len(block):
                    block, used = next(blocks), 0
                piece = block[used:used + need]
                pieces.append(piece)
                used, need = used + len(piece), need - len(piece)
            yield key, at, pieces
            at = end

    def close(self) -> None:
        self.src.close()


_FILES = "part long, seq long, name string, n_docs long, n_ids long"


class TokenFiles:
    """A written data set: ``folder`` and its table of files."""

    def __init__(self, spark: SparkSession, folder: str, key: T.StructField):
        self.spark, self.folder, self.key = spark, folder, key
        self.files = spark.read.schema(_FILES).parquet(f"{folder}/files")

    def ids_by_rank(self) -> np.ndarray:
        store, path = fs.FileSystem.from_uri(_uri(f"{self.folder}/ids_by_rank.bin"))
        with store.open_input_stream(path) as src:
            return np.frombuffer(src.read(), "<u4")

    def _placed(self) -> DataFrame:
        """The files and the number of ids before each; one row per file, added up per part first."""
        parts = self.files.groupBy("part").agg(F.sum("n_ids").alias("__ids"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select("part", F.coalesce(F.sum("__ids").over(before), F.lit(0)).alias("__before"))
        inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        return self.files.join(small_side(parts, 32), "part").select(
            "name", (F.col("__before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base"))

    def documents(self, with_ids: bool = False) -> DataFrame:
        """What the files hold: key, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of the
        ids as little-endian uint32) and, on demand, ``ids``."""
        ranked, folder = self.ids_by_rank(), _uri(self.folder)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    source, rows, held = TokenFile(f"{folder}/{name}", ranked), [], 0
                    for key, at, pieces in source.documents():
                        crc = 0
                        for p in pieces:
                            crc = zlib.crc32(np.ascontiguousarray(p, "<u4"), crc)
                        n = sum(map(len, pieces))
                        rows.append((key, base + at, n, crc, np.concatenate(pieces).astype(np.int64) if with_ids else None))
                        held += n if with_ids else 4
                        if held > 1 << 20:
                            yield _batch(rows, with_ids)
                            rows, held = [], 0
                    source.close()
                    if rows:
                        yield _batch(rows, with_ids)

        placed = self._placed().repartition("name")
        out = placed.mapInArrow(read, "key string, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
        return out.select(F.col("key").cast(self.key.dataType).alias(self.key.name), *out.columns[1:])


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int64())] if with_ids else [])]
    columns = list(zip(*rows))
    names = ["key", "start", "n_tokens", "ids_crc32", "ids"][:len(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(columns[i], k) for i, k in enumerate(kinds)], names=names)


def _uri(path: str) -> str:
    """A path as pyarrow reads it."""
    if "://" in path:
        return path
    return "file://" + path.removeprefix("file:")


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, key: str = "doc_id", text: str = "text",
          end_id: int = 1, ids_per_file: int = IDS_PER_FILE) -> TokenFiles:
    """Encode every whole text, append ``end_id`` and write the token files.

    Null and empty texts have the end id alone. Documents are in ascending order of the key (nulls first); rows that repeat
    a key follow by the crc32 of their ids, their number of ids and their place in the input, so equal rows are any
    order of the same bytes, and one key that holds a third of all rows is cut into many range partitions. Other columns of ``docs``
    are not read and may have any name. An empty table gives a data set without files. Special tokens that a text spells out
    become their ids, as the library does by default. The key is kept as text and cast back, so its type must survive that.
    ``tokenizer`` names a file that every worker has. Nothing but the table of counts of the vocabulary passes through the driver.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    field = docs.select(key).schema[0]
    width = 2 if max(*_tokenizer(tokenizer).get_vocab().values(), end_id) < 1 << 16 else 4  # bytes of ids on their way to the files
    rows = tokenized(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), tokenizer, "__key", "__text", end_id, width)
    ranked = ranked_ids(rows, width)
    target = _uri(folder)
    _put(f"{target}/ids_by_rank.bin", [ranked.tobytes()])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
        rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
        part, made, out = TaskContext.get().partitionId(), [], _FileWriter()

        def done():
            name = f"tokens-{part:06d}-{len(made):06d}.tok"
            _put(f"{target}/{name}", out.parts())
            made.append((part, len(made), name, len(out.keys), out.n))

        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), b.column(1)):
                out.add(k, rank[np.frombuffer(ids.as_buffer(), f"<u{width}")])
                if out.n >= ids_per_file:
                    done()
                    out = _FileWriter()
        if out.keys:
            done()
        columns = list(zip(*made)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["part", "seq", "name", "n_docs", "n_ids"])

    order = ["__key", "__crc", "__n", "__row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = placed.select(F.col("__key").cast("string").alias("__key"), "__ids").mapInArrow(save, _FILES)
    files.write.parquet(f"{folder}/files")
    return TokenFiles(spark, folder, field)
