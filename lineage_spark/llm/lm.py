"""N-gram language model in an Elias-Fano trie, built and queried on the executors.

Level 1 holds the training words (64-bit hashes in order; the rank is the word's number). An entry of level ``k`` is
``parent * words + word``, ``parent`` being the entry of its context in level ``k - 1``: one increasing sequence in which the
successors of a context lie together, so the context's place and a search among its successors find it. Counts are kept as
their running sums, also Elias-Fano coded, and smoothed probabilities as 16-bit codes of log10.

A level is cut into parts of about ``PART_TOKENS`` training tokens. Tasks send each part their sorted keys and counts as packed bytes
and one task per part merges them and writes the part as one file in the shared folder. Parts follow the running sum of the
parent level's counts and, inside a context, the word number: a frequent context is spread over several parts without a sample.
Workers map the files into memory, so nothing of the size of the model passes the driver or is copied per worker.

Probability of a word after a context, from the shortest context up (Dirichlet smoothing):
``p_k = (c(context word) + mu * p_(k-1)) / (c(context) + mu)``; the lowest level adds one to every count.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.llm.common import word_hashes
from lineage_spark.llm.elias_fano import U64, EliasFano
from lineage_spark.session import scratch_path

ORDER = 2
MU = 5.0
PART_TOKENS = 1 << 21
CHUNK_TOKENS = 1 << 19
MERGE_ENTRIES = 1 << 22
END = 0x0A0A0A0A0A0A0A0A  # the end token's number among the 64-bit word hashes
CODE_STEP = 2.5e-4  # of log10; codes reach 16


def _chunks(texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, token hashes, tokens per row): every text is its words and one end."""
    held, sizes, total, first = [], [], 0, 0
    end = np.array([END], U64)
    for i, t in enumerate(texts):
        words = word_hashes(t)
        held += [words, end]
        sizes.append(len(words) + 1)
        total += len(words) + 1
        if total >= CHUNK_TOKENS:
            yield first, np.concatenate(held), np.array(sizes)
            held, sizes, total, first = [], [], 0, i + 1
    if sizes:
        yield first, np.concatenate(held), np.array(sizes)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[start], np.add.reduceat(counts, start) if len(start) else counts


def _packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Keys less the first one, in as few bytes each as the last needs; counts in 1 or 8 bytes each."""
    rel = keys - keys[0]
    width = max(1, (int(rel[-1]).bit_length() + 7) // 8)
    k = int(keys[0]).to_bytes(8, "little") + rel.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    small = counts.max() < 256
    return bytes([width]) + k, (b"\1" + counts.astype(np.uint8).tobytes()) if small else (b"\0" + counts.astype("<i8").tobytes())


def _unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    width, base = keys[0], int.from_bytes(keys[1:9], "little")
    raw = np.frombuffer(keys, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    c = np.frombuffer(counts, np.uint8 if counts[0] else "<i8", offset=1).astype(np.int64)
    return wide.view("<u8").ravel() + U64(base), c


def _write_file(uri: str, header: dict, arrays: dict[str, np.ndarray]) -> None:
    """One file: header length, JSON header, arrays at multiples of 8 bytes. A rerun task replaces it with the same bytes."""
    at, where = 0, {}
    for name, a in arrays.items():
        where[name] = [at, len(a), a.dtype.str]
        at += (a.nbytes + 7) // 8 * 8
    head = json.dumps({**header, "arrays": where}).encode()
    head += b" " * (-(len(head) + 8) % 8)
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(temp) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    store.move(temp, path)


@lru_cache(maxsize=4096)
def _mapped(uri: str) -> tuple[dict, dict[str, np.ndarray]]:
    """The header and memory-mapped arrays of a file; from a remote store it is first copied to a worker's temporary file."""
    store, path = fs.FileSystem.from_uri(uri)
    if store.type_name != "local":
        handle, local = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as out, store.open_input_stream(path) as src:
            while block := src.read(1 << 22):
                out.write(block)
        path = local
    raw = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8:8 + size].tobytes())
    start = 8 + size
    return head, {n: raw[start + at:start + at + count * np.dtype(kind).itemsize].view(kind)
                  for n, (at, count, kind) in head["arrays"].items()}


class _Part:
    """One mapped part of a level."""

    def __init__(self, uri: str):
        head, a = _mapped(uri)
        self.base, self.codes = U64(head["base"]), a.get("codes")
        self.keys = EliasFano(a["k_low"], a["k_upper"], a["k_ones"], head["n"], head["k_bits"])
        self.sums = EliasFano(a["s_low"], a["s_upper"], a["s_ones"], head["n"] + 1, head["s_bits"])

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        ok = np.flatnonzero(keys >= self.base)
        out[ok] = self.keys.find(keys[ok] - self.base)
        return out


class Level:
    """A level: where its parts are, and the number of entries and tokens before each."""

    def __init__(self, folder: str, k: int, parts: int, entries: dict[int, int], tokens: dict[int, int]):
        self.folder, self.k, self.parts = folder, k, parts
        n, t = np.zeros(parts, np.int64), np.zeros(parts, np.int64)
        for p, v in entries.items():
            n[p], t[p] = v, tokens[p]
        self.size = n
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.mass = np.concatenate([[0], np.cumsum(t)])

    @property
    def entries(self) -> int:
        return int(self.first[-1])

    @property
    def tokens(self) -> int:
        return int(self.mass[-1])

    def _each_part(self, part: np.ndarray) -> Iterator[tuple[_Part, int, np.ndarray]]:
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.diff(part[order])) + 1
        for at in np.split(order, cut) if len(order) else []:
            p = int(part[at[0]])
            if self.size[p]:
                yield _Part(part_uri(self.folder, self.k, p)), p, at

    def find(self, keys: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Entry numbers of the keys, or -1."""
        out = np.full(len(keys), -1, np.int64)
        for p, number, at in self._each_part(part):
            i = p.find(keys[at])
            out[at] = np.where(i >= 0, i + self.first[number], -1)
        return out

    def before_and_count(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens before each entry, and its count."""
        before, count = np.zeros(len(entry), np.int64), np.zeros(len(entry), np.int64)
        for p, number, at in self._each_part(np.searchsorted(self.first, entry, side="right") - 1):
            i = entry[at] - self.first[number]
            lo = p.sums.get(i).astype(np.int64)
            before[at], count[at] = lo + self.mass[number], p.sums.get(i + 1).astype(np.int64) - lo
        return before, count

    def log10_p(self, entry: np.ndarray) -> np.ndarray:
        """Stored smoothed log10 probabilities."""
        out = np.zeros(len(entry))
        for p, number, at in self._each_part(np.searchsorted(self.first, entry, side="right") - 1):
            out[at] = p.codes[entry[at] - self.first[number]] * -CODE_STEP
        return out


def part_uri(folder: str, k: int, part: int) -> str:
    return f"{folder}/level-{k}/part-{part:06d}.ef"


def _hash_part(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)


class Trie:
    """The levels built so far."""

    def __init__(self, levels: list[Level], mu: float):
        self.levels, self.mu = levels, mu

    @property
    def words(self) -> int:
        return self.levels[0].entries

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        return self.levels[0].find(hashes, _hash_part(hashes, self.levels[0].parts))

    def child_part(self, k: int, parent: np.ndarray, word: np.ndarray, parts: int) -> np.ndarray:
        """Part of level ``k + 1`` that holds the successor ``word`` of entries of level ``k``: monotone in both."""
        before, count = self.levels[k - 1].before_and_count(parent)
        share = (before + count * (word / max(self.words, 1))) / max(self.levels[0].tokens, 1)
        return np.minimum((share * parts).astype(np.int64), parts - 1)

    def key(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        return parent.astype(U64) * U64(self.words) + word.astype(U64)

    def walk(self, ids: np.ndarray, first: np.ndarray, upto: int) -> list[np.ndarray]:
        """For each token, the entries of the n-grams ending there, by length from 1 to ``upto`` (-1: not in the trie).

        ``first`` marks the first token of a text; the end of a text is the context of the next one's start.
        """
        out = [ids]
        end = self.word_ids(np.array([END], U64))[0]
        place = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
        for k in range(2, upto + 1):
            # the context: the (k-1)-gram that ends one token before
            parent = np.concatenate([[-1], out[k - 2][:-1]])
            parent[place < k - 1] = -1
            if k == 2:
                parent[first] = end
            entry = np.full(len(ids), -1, np.int64)
            ok = np.flatnonzero((parent >= 0) & (ids >= 0))
            if len(ok):
                key, inverse = np.unique(self.key(parent[ok], ids[ok]), return_inverse=True)
                p, w = (key // U64(self.words)).astype(np.int64), (key % U64(self.words)).astype(np.int64)
                level = self.levels[k - 1]
                entry[ok] = level.find(key, self.child_part(k - 1, p, w, level.parts))[inverse]
            out.append(entry)
        return out

    def parents(self, grams: list[np.ndarray], first: np.ndarray, k: int) -> np.ndarray:
        """Context entry of level ``k`` of every token (-1: none)."""
        place = np.arange(len(first)) - np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        parent = np.concatenate([[-1], grams[k - 1][:-1]])
        parent[place < k] = -1
        if k == 1:
            parent[first] = self.word_ids(np.array([END], U64))[0]
        return parent

    def unigram(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (0: unknown) and add-one log10 probabilities."""
        count = np.zeros(len(ids), np.int64)
        known = ids >= 0
        u, inverse = np.unique(ids[known], return_inverse=True)
        count[known] = self.levels[0].before_and_count(u)[1][inverse]
        return count, np.log10((count + 1.0) / (self.levels[0].tokens + self.words + 1.0))

    def log10_p(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts, add-one and smoothed log10 probabilities of every token."""
        count, base = self.unigram(ids)
        grams = self.walk(ids, first, len(self.levels))
        p = base.copy()
        for k in range(1, len(self.levels)):
            parent = self.parents(grams, first, k)
            has = np.flatnonzero(parent >= 0)
            u, inverse = np.unique(parent[has], return_inverse=True)
            context = self.levels[k - 1].before_and_count(u)[1][inverse]
            backed = p.copy()
            backed[has] += np.log10(self.mu / (context + self.mu))
            seen = grams[k] >= 0
            backed[seen] = self.levels[k].log10_p(grams[k][seen])
            p = backed
        return count, base, p

    def lower_log10(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 p of ``word`` after the context one word shorter than the entry ``parent`` of the top level."""
        if len(self.levels) == 1:
            return self.unigram(word)[1]
        # the words of the parent, read back from its keys
        words, entry = [], parent
        for k in range(len(self.levels), 1, -1):
            key = self.key_of(k, entry)
            words.append((key % U64(self.words)).astype(np.int64))
            entry = (key // U64(self.words)).astype(np.int64)
        shorter = words[::-1] + [word]  # the n-gram without its first word
        return self.log10_chain(np.stack(shorter, axis=1))

    def key_of(self, k: int, entry: np.ndarray) -> np.ndarray:
        level, out = self.levels[k - 1], np.zeros(len(entry), U64)
        for p, number, at in level._each_part(np.searchsorted(level.first, entry, side="right") - 1):
            out[at] = p.keys.get(entry[at] - level.first[number]) + p.base
        return out

    def log10_chain(self, rows: np.ndarray) -> np.ndarray:
        """log10 p of the last word of each row of word numbers, given the words before it in the row."""
        length, last = rows.shape[1], rows[:, -1]
        p = self.unigram(last)[1]
        for k in range(1, length):
            entry = rows[:, length - 1 - k]  # context of k words, ending before the last
            ok = entry >= 0
            for depth in range(2, k + 1):
                word = rows[:, length - 1 - k + depth - 1]
                entry = np.where(ok, self.child(depth, np.maximum(entry, 0), word), -1)
                ok = entry >= 0
            e = np.maximum(entry, 0)
            context = np.where(ok, self.levels[k - 1].before_and_count(e)[1], 0)
            child = np.where(ok, self.child(k + 1, e, last), -1)
            backed = p + np.where(ok, np.log10(self.mu / (context + self.mu)), 0.0)
            seen = child >= 0
            backed[seen] = self.levels[k].log10_p(child[seen])
            p = backed
        return p

    def child(self, k: int, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        level = self.levels[k - 1]
        return level.find(self.key(parent, word), self.child_part(k - 1, parent, word, level.parts))


def _partials(trie: Trie | None, parts: int):
    """Per task: keys of the next level with their counts, packed by part."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, held = [], [], 0
        for batch in batches:
            for _, h, sizes in _chunks(batch["__text"]):
                if trie is None:
                    k, c = np.unique(h, return_counts=True)
                else:
                    level = len(trie.levels)
                    u, inverse = np.unique(h, return_inverse=True)
                    ids = trie.word_ids(u)[inverse]
                    first = np.zeros(len(h), bool)
                    first[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = True
                    parent = trie.parents(trie.walk(ids, first, level), first, level)
                    ok = parent >= 0
                    k, c = np.unique(trie.key(parent[ok], ids[ok]), return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held > MERGE_ENTRIES and len(keys) > 1:
                    k, c = _summed(np.concatenate(keys), np.concatenate(counts))
                    keys, counts = [k], [c]
                    if len(k) > MERGE_ENTRIES // 2:
                        yield packed_rows(k, c)
                        keys, counts = [], []
                    held = len(k) if keys else 0
        if keys:
            yield packed_rows(*_summed(np.concatenate(keys), np.concatenate(counts)))

    def packed_rows(k: np.ndarray, c: np.ndarray) -> pd.DataFrame:
        if trie is None:
            part = _hash_part(k, parts)
        else:
            n = U64(trie.words)
            part = trie.child_part(len(trie.levels), (k // n).astype(np.int64), (k % n).astype(np.int64), parts) if len(k) \
                else np.empty(0, np.int64)
        cut = np.flatnonzero(np.diff(part)) + 1
        rows = [(int(part[at[0]]), *_packed(k[at], c[at])) for at in np.split(np.arange(len(k)), cut) if len(at)]
        return pd.DataFrame(rows, columns=["part", "keys", "counts"])

    return count


def _build_part(folder: str, k: int, trie: Trie | None):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        both = [_unpacked(a, b) for a, b in zip(rows["keys"], rows["counts"])]
        keys, counts = _summed(np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both]))
        coded, sums = EliasFano.build(keys - keys[0]), EliasFano.build(np.concatenate([[0], np.cumsum(counts)]).astype(U64))
        arrays = {f"k_{n}": a for n, a in coded.arrays().items()} | {f"s_{n}": a for n, a in sums.arrays().items()}
        if trie is not None:
            n = U64(trie.words)
            parent, word = (keys // n).astype(np.int64), (keys % n).astype(np.int64)
            context = trie.levels[-1].before_and_count(parent)[1]
            lower = 10.0 ** trie.lower_log10(parent, word)
            p = np.log10((counts + trie.mu * lower) / (context + trie.mu))
            arrays["codes"] = np.minimum(np.rint(p / -CODE_STEP), 65535).astype(np.uint16)
        _write_file(part_uri(folder, k, part), {"base": int(keys[0]), "n": len(keys), "k_bits": coded.bits, "s_bits": sums.bits}, arrays)
        return pd.DataFrame({"part": [part], "entries": [len(keys)], "tokens": [int(counts.sum())]})

    return build


def train(texts: DataFrame, text: str = "text", order: int = ORDER, mu: float = MU, part_tokens: int = PART_TOKENS) -> Trie:
    """Count all n-grams up to ``order`` of the column ``text`` and build the trie in the shared folder.

    Null and empty texts are one end token. Without rows the trie is empty.
    """
    spark: SparkSession = texts.sparkSession
    folder = scratch_path(spark, "ngram-trie")
    folder = folder if "://" in folder else f"file://{folder}" if folder.startswith("/") else folder.replace("file:/", "file:///", 1)
    rows = texts.select(F.coalesce(texts[text], F.lit("")).alias("__text"))
    # about six bytes a token; only sets how many parts there are
    size = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    parts = max(8, -(-size // (6 * part_tokens)))
    levels: list[Level] = []
    for k in range(1, order + 1):
        trie = Trie(levels, mu) if levels else None
        made = rows.mapInPandas(_partials(trie, parts), "part int, keys binary, counts binary") \
            .groupBy("part").applyInPandas(_build_part(folder, k, trie), "part int, entries long, tokens long").collect()
        levels = levels + [Level(folder, k, parts, {r["part"]: r["entries"] for r in made}, {r["part"]: r["tokens"] for r in made})]
    return Trie(levels, mu)


def scored(df: DataFrame, trie: Trie, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``df``.

    Every text, null and empty ones too, has one end token. ``base_score`` is the add-one unigram log10 probability from exact counts.
    """
    model = df.sparkSession.sparkContext.broadcast(trie)  # part tables only: a few numbers per part
    kind = df.schema[key].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = model.value
        for batch in batches:
            out = []
            for _, h, sizes in _chunks(batch["__text"]):
                u, inverse = np.unique(h, return_inverse=True)
                ids = t.word_ids(u)[inverse]
                start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                first = np.zeros(len(h), bool)
                first[start] = True
                count, base, p = t.log10_p(ids, first)
                out.append((sizes, np.add.reduceat((count > 0).astype(np.int64), start),
                            np.add.reduceat(base, start), np.add.reduceat(p, start)))
            cols = [np.concatenate([o[i] for o in out]) if out else [] for i in range(4)]
            yield pd.DataFrame({"key": batch["key"], "n_tokens": cols[0], "n_known": cols[1],
                                "train_tokens": t.levels[0].tokens, "base_score": cols[2], "score": cols[3]})

    rows = df.select(df[key].alias("key"), F.coalesce(df[text], F.lit("")).alias("__text"))
    return rows.mapInPandas(
        score, f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    ).withColumnRenamed("key", key)
