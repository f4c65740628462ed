"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks.

1. Every document becomes numbers over the items' vocabulary (0: any other word). Passages of ``WINDOW`` words give the
   document frequencies, counted over all documents.
2. A randomised SVD of the TF-IDF passages finds the latent basis: a random range finder, one power step and a
   small eigenproblem; products with the passage matrix are summed by feature on the executors, over all passages of all
   documents and of the block of items, ``SVD_PASSAGES`` at a time.
3. In a document in which ``min_lcs`` of an item's words occur (repeated words as often), regions that hold so many of them are looked at.
   Dense ones (as long as the item divided by ``min_lcs``) are candidates as they are, so that no replaced word, offset or block of items
   loses a copy of an item of ``DENSE_WORDS`` words or more; of longer ones (words put in) the overlapping passages, of a length that fits the item, are projected and compared with
   the item's passages (items come in blocks of bounded size): a cosine of ``min_cosine`` makes a candidate, in which ``min_answer``
   of the item's rarest words must occur too (a few common words in order are no copy).
4. In a candidate region the longest common subsequence with the item must cover ``min_lcs`` of the item's words. Where an answer is given,
   ``min_answer`` of its words must occur there too; without one the item's ``ANSWER_TERMS`` rarest words stand for it, in long regions only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import BROADCAST_BYTES, packed, same_identity, written
from lineage_spark.session import cut_lineage

WINDOW, LEAST_WORDS = 16, 4
MIN_KNOWN = 0.6
DENSE_WORDS = 10  # of shorter items a few common words in order are no copy: they need the cosine and the rarest words too
DIMENSIONS, OVERSAMPLING = 48, 16
SVD_PASSAGES = 4096  # passages that a task multiplies at a time
CHUNKS_HELD = 4  # times that many are held, to be multiplied with others of as many known words
MIN_COSINE, MIN_LCS, MIN_ANSWER = 0.7, 0.7, 0.5
ANSWER_TERMS = 5
BLOCK_BYTES = 4 << 20
CHUNK = 2048
_FEATURES_PER_GROUP = 512


_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    """Lower-cased letter and digit runs: case and punctuation do not hide a passage."""
    return _TOKEN.findall(text.lower()) if text else []


_STRANGE = re.compile(r"\W")
_ASCII = bytes(range(128))
_WORD_BYTES = bytes(i if i > 127 or _TOKEN.match(chr(i)) else 32 for i in range(256))


def word_bytes(text: str | None) -> list[bytes]:
    """The :func:`tokens` in UTF-8, cut on the bytes of the whole text at once."""
    low = text.lower() if text else ""
    raw = low.encode("utf-8", "surrogatepass")
    if not low.isascii():
        for c in set(_STRANGE.findall(raw.translate(None, _ASCII).decode("utf-8", "surrogatepass"))):
            low = low.replace(c, " ")
        raw = low.encode("utf-8", "surrogatepass")
    return raw.translate(_WORD_BYTES).split()


@dataclass
class _Item:
    item: object
    ids: np.ndarray
    answer: set[int] = field(default_factory=set)
    masks: dict[int, int] = field(default_factory=dict)
    given: bool = False  # the answer comes from an answer column


def lcs_length(masks: dict[int, int], length: int, region: list[int]) -> int:
    """Longest common subsequence of an item (``masks``: id -> its positions as bits) and a region, bit-parallel."""
    full = (1 << length) - 1
    state = full
    for t in region:
        m = masks.get(t)
        if m:
            u = state & m
            state = ((state + u) | (state - u)) & full
    return length - state.bit_count()


def _starts(n: int, window: int, step: int) -> np.ndarray:
    """Passage starts that cover ``n`` words: every ``step``, and the last full passage; one for a shorter text."""
    if n <= window:
        return np.zeros(1 if n else 0, np.int64)
    s = np.arange(0, n - window + 1, step)
    return s if s[-1] == n - window else np.append(s, n - window)


def _passages(ids: np.ndarray, window: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and the words of each passage (short texts padded with 0)."""
    s = _starts(len(ids), window, step)
    if len(ids) < window:
        ids = np.pad(ids, (0, window - len(ids)))
    return s, ids[s[:, None] + np.arange(window)[None, :]]


def _encoded(vocabulary: dict[bytes, int]):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = vocabulary.get
        for batch in batches:
            out = [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)).tobytes() for words in map(word_bytes, batch["__text"])]
            yield pd.DataFrame({"key": batch["key"], "__a": batch["__a"], "__b": batch["__b"], "ids": out})

    return encode


def _counts(features: int):
    """Per task: passages per feature (feature 0 counts all passages)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(features, np.int64)
        for batch in batches:
            for raw in batch["ids"]:
                _, p = _passages(np.frombuffer(raw, np.int32), WINDOW, WINDOW)
                if len(p):
                    q = np.sort(p, axis=1)
                    first = np.concatenate([np.ones((len(q), 1), bool), q[:, 1:] != q[:, :-1]], axis=1)
                    c = np.bincount(q[first], minlength=features)
                    c[0] = len(p)
                    total += c
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": at, "n": total[at]})

    return count


def _projected(p: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """TF-IDF passages times ``basis`` (features x dims); the passage vectors have unit length."""
    w = idf[p]
    # sum over repeated words inside a passage of (tf * idf)^2, from pairs of equal words
    norm = np.sqrt(((p[:, :, None] == p[:, None, :]) * (w[:, :, None] * w[:, None, :])).sum(axis=(1, 2)))
    y = np.einsum("pw,pwd->pd", w, basis[p], optimize=False)
    return y / np.maximum(norm, 1e-9)[:, None]


def _add_product(total: np.ndarray, p: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> None:
    """Adds A^T (A basis) to ``total`` for the TF-IDF matrix A of the passages ``p`` (rows of words), whose rows have unit length."""
    q = np.sort(p[p.any(axis=1)], axis=1)
    q = q[:, int((q == 0).sum(axis=1).min(initial=q.shape[1])):]  # other words come first and carry no weight
    weight = idf[q]
    # sum of (tf * idf)^2 over a passage's words: repeats are neighbours, and every place counts its word's places
    first = np.ones(q.shape, bool)
    first[:, 1:] = q[:, 1:] != q[:, :-1]
    run = np.cumsum(first) - 1
    same = np.bincount(run)[run].reshape(q.shape) if len(run) else run.reshape(q.shape)
    weight = (weight / np.maximum(np.sqrt((weight * weight * same).sum(axis=1)), 1e-9)[:, None]).astype(np.float32)
    y = np.matmul(weight[:, None, :], basis.take(q, axis=0))[:, 0]
    at = np.flatnonzero(q)
    at = at[np.argsort(q.ravel()[at], kind="stable")]
    if len(at):
        word, row, weight = q.ravel()[at], at // q.shape[1], weight.ravel()[at]
        begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        # words with as many places are summed together, as products of equal shape
        size = np.diff(np.append(begin, len(word)))
        begin = begin[np.argsort(size, kind="stable")]
        size, words = np.unique(size, return_counts=True)
        for places, some in zip(size, np.split(begin, np.cumsum(words)[:-1])):
            of = some[:, None] + np.arange(places)
            total[word[some]] += np.matmul(weight[of][:, None, :], y.take(row[of], axis=0))[:, 0]


def _gram_product(idf: np.ndarray, basis: np.ndarray, window: int, chunk: int):
    """Per task: A^T (A basis) over all passages of its texts, in rows of ``_FEATURES_PER_GROUP`` features."""
    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(basis.shape, np.float64)
        held: list[np.ndarray] = []
        n = 0

        def add() -> None:
            # passages with as many known words go together, so that the places of other words are left out
            many = np.concatenate(held)
            many = many[np.argsort((many > 0).sum(axis=1), kind="stable")]
            for lo in range(0, len(many), chunk):
                _add_product(total, many[lo:lo + chunk], idf, basis)

        for batch in batches:
            for raw in batch["ids"]:
                p = _passages(np.frombuffer(raw, np.int32), window, window)[1]
                held.append(p)
                n += len(p)
                if n >= CHUNKS_HELD * chunk:
                    add()
                    held, n = [], 0
        if n:
            add()
        for g in range(0, len(total), _FEATURES_PER_GROUP):
            part = total[g:g + _FEATURES_PER_GROUP]
            if part.any():
                yield pd.DataFrame({"group": [g], "sums": [part.tobytes()]})

    return product


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(s, np.float64) for s in rows["sums"])
    return pd.DataFrame({"group": [int(rows["group"].iloc[0])], "sums": [np.asarray(total).tobytes()]})


def randomised_basis(encoded: DataFrame, idf: np.ndarray, dims: int, seed: int = 10) -> np.ndarray:
    """Right singular vectors (features x dims) of the TF-IDF passages of all texts (``ids``: their words' numbers)."""
    width = min(dims + OVERSAMPLING, len(idf))

    def times(basis: np.ndarray) -> np.ndarray:
        parts = encoded.mapInPandas(_gram_product(idf, basis.astype(np.float32), WINDOW, SVD_PASSAGES), "group int, sums binary") \
            .groupBy("group").applyInPandas(_summed, "group int, sums binary").collect()  # features x width numbers
        out = np.zeros(basis.shape)
        for r in parts:
            block = np.frombuffer(bytes(r["sums"]), np.float64).reshape(-1, basis.shape[1])
            out[r["group"]:r["group"] + len(block)] = block
        return out

    start = np.random.default_rng(seed).standard_normal((len(idf), width))
    q, _ = np.linalg.qr(times(start))
    z = times(q)
    small = q.T @ z
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return (q @ vectors[:, np.argsort(-values)[:dims]]).astype(np.float32)


def passage_words(length: int) -> int:
    """Words of the passages that an item of ``length`` words is compared by: two thirds of it, at most ``WINDOW``; 8 or 4
    for an item of fewer than ``DENSE_WORDS``; 0 if it is not searched."""
    if length < DENSE_WORDS:
        return next((w for w in (8, LEAST_WORDS) if w <= length), 0)
    return min(WINDOW, 2 * length // 3)


def least_common(min_lcs: float, length: int) -> int:
    """The least subsequence that covers ``min_lcs`` of ``length`` words."""
    return max(1, int(np.ceil(min_lcs * length - 1e-9)))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class _Index:
    """Latent passages of one block of items, and the checks of a candidate."""

    def __init__(self, items: list[_Item], idf: np.ndarray, basis: np.ndarray, min_cosine: float, min_lcs: float, min_answer: float):
        self.items, self.idf, self.basis = items, idf.astype(np.float32), basis
        self.min_cosine, self.min_lcs, self.min_answer = min_cosine, min_lcs, min_answer
        self.window = [passage_words(len(x.ids)) for x in items]
        self.latent = [_unit(_projected(_passages(x.ids, w, 2)[1], self.idf, basis)).astype(np.float32).T if w else None
                       for x, w in zip(items, self.window)]
        # word -> the items it belongs to and how often, as arrays cut by ``cuts``
        counts = [(t, i, m.bit_count()) for i, x in enumerate(items) if self.window[i] for t, m in x.masks.items()]
        words, owners, often = np.array(sorted(counts), np.int64).reshape(-1, 3).T
        self.owners, self.often, self.cuts = owners, often, np.searchsorted(words, np.arange(len(idf) + 1))
        self.needed = np.array([least_common(min_lcs, len(x.ids)) if self.window[i] else 1 << 30 for i, x in enumerate(items)], np.int64)

    def shared(self, ids: np.ndarray) -> np.ndarray:
        """Items enough of whose words (and given answer's words) occur in the text: necessary, and checked first as it is the cheapest."""
        known = ids[self.cuts[ids + 1] > self.cuts[ids]]
        if len(known) < self.needed.min(initial=1 << 30):
            return np.empty(0, np.int64)
        words, count = np.unique(known, return_counts=True)
        size = self.cuts[words + 1] - self.cuts[words]
        at = np.repeat(self.cuts[words] - np.cumsum(size) + size, size) + np.arange(size.sum())
        found = np.bincount(self.owners[at], weights=np.minimum(self.often[at], np.repeat(count, size)), minlength=len(self.items))
        enough = np.flatnonzero(found >= self.needed)
        said = set(ids.tolist()) if any(self.items[i].given for i in enough) else set()
        return np.array([i for i in enough if not self.items[i].given or self._answered(i, said) >= self.min_answer], np.int64)

    def _answered(self, index: int, said) -> float:
        answer = self.items[index].answer
        return len(answer.intersection(said)) / len(answer) if answer else 1.0

    def regions(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
        """(item index, start, end, dense) of the regions that hold enough of the item's words; every span that starts at a word of the
        item lies in a region."""
        order = np.argsort(ids, kind="stable")
        in_order = ids[order]
        for i in self.shared(ids).tolist():
            item, window, least = self.items[i], self.window[i], int(self.needed[i])
            if len(item.ids) < DENSE_WORDS:
                starts, p = _passages(ids, window, window // 2)
                starts, p = (x[(p > 0).sum(axis=1) >= MIN_KNOWN * window] for x in (starts, p))
                for lo in range(0, len(p), CHUNK):
                    mine = _unit(_projected(p[lo:lo + CHUNK], self.idf, self.basis)).astype(np.float32)
                    for r in np.flatnonzero((mine @ self.latent[i]).max(axis=1) >= self.min_cosine):
                        start = int(starts[lo + r])
                        yield i, max(0, start - len(item.ids)), start + window + len(item.ids), False
                continue
            words = np.fromiter(item.masks, np.int32)
            lo, hi = np.searchsorted(in_order, words), np.searchsorted(in_order, words, "right")
            at = np.sort(np.concatenate([order[a:b] for a, b in zip(lo, hi)]))
            long = 2 * len(item.ids) + window
            dense = min(long, int(np.ceil(len(item.ids) / max(self.min_lcs, 0.5))))
            for span, step in ((dense, max(1, window // 4)), (long, window)):
                starts = at[:len(at) - least + 1]
                starts = starts[at[least - 1:] - starts < span]
                end = -1
                for s in starts.tolist():
                    if s >= end:
                        end = s + step
                        yield i, s, min(len(ids), s + span + step), span == dense

    def cosine(self, region: np.ndarray, index: int, known: float) -> float:
        """Best cosine of the region's passages of which a share of ``known`` are words of items."""
        window = self.window[index]
        p = _passages(region, window, window // 4 if len(self.items[index].ids) >= DENSE_WORDS else 1)[1]
        p = p[(p > 0).sum(axis=1) >= known * window]
        if not len(p):
            return 0.0
        return float((_unit(_projected(p, self.idf, self.basis)).astype(np.float32) @ self.latent[index]).max())

    def confirm(self, ids: np.ndarray, index: int, start: int, end: int, dense: bool) -> tuple[float, float, float] | None:
        """(cosine, LCS share, answer share) of a region, if it passes the checks (the cheaper ones first)."""
        item, region = self.items[index], ids[start:end]
        words = region.tolist()
        answer = self._answered(index, words)
        if (item.given or not dense) and answer < self.min_answer:
            return None
        common = lcs_length(item.masks, len(item.ids), words)
        if common < self.needed[index]:
            return None
        cosine = self.cosine(region, index, 0.0 if dense else MIN_KNOWN)
        return (cosine, common / len(item.ids), answer) if dense or cosine >= self.min_cosine else None

    def search(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, a, b, raw in zip(batch["key"], batch["__a"], batch["__b"], batch["ids"]):
                ids = np.frombuffer(raw, np.int32)
                best: dict[int, tuple[float, float, float]] = {}
                for index, *region in self.regions(ids):
                    hit = self.confirm(ids, index, *region)
                    if hit and (index not in best or (hit[1], hit[0]) > (best[index][1], best[index][0])):
                        best[index] = hit
                rows += [(key, a, b, self.items[index].item, *hit) for index, hit in best.items()]
            yield pd.DataFrame(rows, columns=["key", "__a", "__b", "item", "cosine", "lcs_share", "answer_share"])


def _block_leaks(docs: DataFrame, rows: list, kinds: tuple[str, str], dims: int, checks: tuple[float, float, float]) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    items, answers = [], []
    for r in rows:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in word_bytes(r["__text"])], np.int32)
        items.append(_Item(r["item"], ids))
        answers.append({vocabulary.setdefault(w, len(vocabulary) + 1) for w in word_bytes(r["answer"])})
    encoded = written(docs.mapInPandas(_encoded(vocabulary), f"key {kinds[0]}, __a long, __b long, ids binary"), "passages")
    features = len(vocabulary) + 1
    counted = encoded.select("ids").mapInPandas(_counts(features), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = np.zeros(features)
    for r in counted.collect():  # one row per word of the items
        df[r["feature"]] = r["n"]
    total = df[0]
    idf = np.log((total + 1.0) / (df + 1.0)) + 1.0
    idf[0] = 0.0  # words of no item carry no weight
    own = docs.sparkSession.createDataFrame([(x.ids.tobytes(),) for x in items], "ids binary")
    basis = randomised_basis(encoded.select("ids").union(own), idf, dims)
    for x, answer in zip(items, answers):
        for at, t in enumerate(x.ids.tolist()):
            x.masks[t] = x.masks.get(t, 0) | (1 << at)
        rare = sorted(set(x.ids.tolist()), key=lambda t: (-idf[t], t))[:ANSWER_TERMS]
        x.answer, x.given = answer or set(rare), bool(answer)
    index = docs.sparkSession.sparkContext.broadcast(_Index(items, idf, basis, *checks))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return index.value.search(batches)

    return encoded.mapInPandas(
        search, f"key {kinds[0]}, __a long, __b long, item {kinds[1]}, cosine double, lcs_share double, answer_share double")


def leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id",
          item_text: str = "text", answer: str | None = None, dims: int = DIMENSIONS, min_cosine: float = MIN_COSINE,
          min_lcs: float = MIN_LCS, min_answer: float = MIN_ANSWER) -> DataFrame:
    """``key, __a, __b, item, cosine, lcs_share, answer_share``: one row per row of ``df`` and item found in it.

    ``__a, __b`` are hashes of the text. Whole texts are searched. Null, empty and blank texts and items match nothing; items
    of fewer than 4 words are too short to be evidence and are not searched. Repeated rows and repeated items give rows each.
    Only the named columns are read. Either table may be empty.
    """
    norm = F.coalesce(df[text], F.lit(""))
    docs = df.select(df[key].alias("key"), F.xxhash64(norm).alias("__a"), F.xxhash64(F.lit("second"), norm).alias("__b"),
                     norm.alias("__text"))
    said = benchmark[answer] if answer else F.lit(None).cast("string")
    queries = benchmark.select(benchmark[item].alias("item"), benchmark[item_text].alias("__text"), said.alias("answer"))
    queries = cut_lineage(queries.where(F.octet_length("__text") > 0))
    kinds = (df.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString())
    size = queries.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("item", "__text"), F.lit(blocks)) == b).orderBy("item", "__text").collect()
        found = _block_leaks(docs, part, kinds, dims, (min_cosine, min_lcs, min_answer))
        out = found if out is None else out.union(found)
    return out


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df``, unchanged, in whose text no item was found (see :func:`leaks`)."""
    identity = ["__a", "__b"]
    gone = cut_lineage(leaks(df, benchmark, text, key, **options).select(*identity).distinct())
    norm = F.coalesce(df[text], F.lit(""))
    rows = packed(df, F.xxhash64(norm).alias("__a"), F.xxhash64(F.lit("second"), norm).alias("__b"))
    small = gone.count() * 32 <= BROADCAST_BYTES
    return rows.join(F.broadcast(gone) if small else gone, same_identity(rows, gone, identity), "left_anti").select("__doc.*")
