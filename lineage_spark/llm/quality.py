"""Quality classifier: hashed word n-gram logistic regression, learned with follow-the-regularised-leader.

Features of a text are its word 1- and 2-grams and the 1- and 2-grams of its words' shapes (letters to ``a``/``A``,
digits to ``0``, other characters kept, repeats collapsed; a pair's shape says if its words are equal), hashed into ``2**bits`` weights and
counted relative to the text's number of n-grams. A score is a sparse dot product through the logistic function.

Training is sequential by nature, so it runs as one task over a bounded sample: the ``max_labelled`` labelled
rows of smallest id hash. Scoring covers every row, in parallel, with the weights shipped once (``4 * 2**bits`` bytes).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import WORD_RE

BITS = 18
MAX_LABELLED = 4000
EPOCHS = 4
SCALE = 16.0  # relative counts of the n-grams of one kind sum to this
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
CACHED_WORDS = 200_000
_KINDS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = [np.uint64(s) for s in (0x1, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_REPEATED = np.uint64(0x85EBCA77C2B2AE63)
_SHAPES = [(re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0"), (re.compile(r"(\W)\1+"), r"\1")]


def shape_of(word: str) -> str:
    """``THE!!`` -> ``A!``, ``Then,`` -> ``Aa,``, ``x86`` -> ``a0``."""
    s = _SHAPES[0][0].sub(lambda m: "A" if m[0].isupper() else ("Aa" if m[0][0].isupper() else "a"), word)
    s = _SHAPES[1][0].sub("0", s)
    return _SHAPES[2][0].sub(r"\1", s)


class _Words(dict):
    """word -> (word hash, shape hash); emptied when it holds ``CACHED_WORDS`` words."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        v = (xxhash.xxh3_64_intdigest(word.lower()), xxhash.xxh3_64_intdigest(shape_of(word), seed=7))
        self[word] = v
        return v


def features(text: str | None, bits: int, cache: _Words) -> list[np.ndarray]:
    """Weight indexes of the n-grams of each kind; every kind is empty for a text without words."""
    words = WORD_RE.findall(text) if text else []
    if not words:
        return [np.empty(0, np.int64)] * _KINDS
    both = np.array([cache[w] for w in words], dtype=np.uint64)
    out = []
    shift = np.uint64(64 - bits)
    for col, (one, two) in enumerate(((0, 1), (2, 3))):
        h = both[:, col]
        out.append((((h ^ _SEEDS[one]) * _MIX) >> shift).astype(np.int64))
        pair = (h[:-1] * _SEEDS[two]) ^ h[1:]
        if col:  # a repeated word is part of the shape of a pair
            pair ^= (both[:-1, 0] == both[1:, 0]) * _REPEATED
        out.append(((pair * _MIX) >> shift).astype(np.int64))
    return out


@dataclass
class QualityModel:
    """Weights and bias of the fitted classifier."""

    weights: np.ndarray
    bias: float
    bits: int

    def score(self, text: str | None, cache: _Words) -> float:
        z = self.bias
        for idx in features(text, self.bits, cache):
            if len(idx):
                z += SCALE * float(self.weights[idx].mean())
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, z))))

    def column(self, text: Column) -> Column:
        """Score of a text column, as an Arrow-batched UDF over whole texts."""
        model = self

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            cache = _Words()
            for texts in batches:
                yield pd.Series([model.score(t, cache) for t in texts], dtype="float64")

        return scored(text)


def fit_ftrl(texts: list[str | None], labels: list[int], bits: int = BITS, epochs: int = EPOCHS) -> QualityModel:
    """FTRL-proximal logistic regression over the given rows, in their order."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    cache, rows = _Words(), []
    for t in texts:
        parts = []
        for idx in features(t, bits, cache):
            if len(idx):
                u, c = np.unique(idx, return_counts=True)
                parts.append((u, c * (SCALE / len(idx))))
        idx = np.concatenate([p[0] for p in parts] + [np.array([size])])
        val = np.concatenate([p[1] for p in parts] + [np.array([1.0])])
        idx, at = np.unique(idx, return_inverse=True)
        rows.append((idx, np.bincount(at, weights=val)))

    def weights_at(zi, ni):
        w = (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for (idx, val), y in zip(rows, labels):
            w = weights_at(z[idx], n[idx])
            p = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w @ val)))))
            g = (p - y) * val
            sigma = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA
            z[idx] += g - sigma * w
            n[idx] += g * g
    w = weights_at(z, n)
    return QualityModel(w[:size].astype(np.float32), float(w[size]), bits)


def sample_of(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, max_labelled: int) -> DataFrame:
    """``__key, __label, __order, __text`` of the training rows (see :func:`train`)."""
    ids = (
        labels.select(labels[key].alias("__key"), labels[label].alias("__label")).dropna()
        .groupBy("__key").agg((F.avg("__label") >= 0.5).cast("int").alias("__label"))
        .withColumn("__order", F.xxhash64("__key")).orderBy("__order", "__key").limit(max_labelled)
    )
    sample = docs.select(docs[key].alias("__key"), docs[text].alias("__text")).join(F.broadcast(ids), "__key")
    one = F.min(F.struct(F.xxhash64("__text").alias("hash"), F.col("__text").alias("text")))
    return sample.groupBy("__key", "__label", "__order").agg(one.alias("__one_text")).select("__key", "__label", "__order", F.col("__one_text.text").alias("__text"))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          max_labelled: int = MAX_LABELLED, bits: int = BITS, epochs: int = EPOCHS) -> QualityModel:
    """Fit on the labelled rows of ``docs``; at most ``max_labelled`` of them, one for each of the ids of smallest hash.

    Null labels and ids are left out; an id labelled more than once counts as 1 if most of its labels are 1. Of rows that repeat an id
    the one with the text of least hash counts, so the bound holds on rows.
    Without any labelled row the model scores 0.5 everywhere.
    """
    sample = sample_of(docs, labels, text, key, label, max_labelled)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["__order", "__key", "__text"], na_position="first")
        m = fit_ftrl(rows["__text"].tolist(), rows["__label"].tolist(), bits, epochs)
        return pd.DataFrame({"weights": [m.weights.tobytes()], "bias": [m.bias]})

    # one bounded group, so one task; its result is one row of 4 * 2**bits bytes
    fitted = sample.groupBy(F.lit(1).alias("__one")).applyInPandas(fit, "weights binary, bias double").collect()
    if not fitted:
        return QualityModel(np.zeros(1 << bits, np.float32), 0.0, bits)
    return QualityModel(np.frombuffer(bytes(fitted[0]["weights"]), np.float32), fitted[0]["bias"], bits)


def scored(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with column ``out``: the probability of label 1, for null, empty and very long texts too."""
    return docs.withColumn(out, model.column(docs[text]))
