"""The Elias-Fano trie language model against plain counting."""

import collections
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lineage_spark.llm import lm
from lineage_spark.llm.common import words_of
from lineage_spark.llm.elias_fano import EliasFano


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200, unique=True), st.integers(0, 60))
def test_round_trip_and_search(values, shift):
    v = np.unique(np.array(values, np.uint64) >> np.uint64(shift))
    coded = EliasFano.build(v)
    assert (coded.get(np.arange(len(v))) == v).all()
    assert (coded.find(v) == np.arange(len(v))).all()
    others = np.setdiff1d(np.concatenate([v + np.uint64(1), v[v > 0] - np.uint64(1)]), v)
    assert (coded.find(others) == -1).all()


def test_equal_neighbours():
    v = np.array([0, 0, 3, 3, 3, 900, 900], np.uint64)
    assert (EliasFano.build(v).get(np.arange(len(v))) == v).all()


def brute(train, texts, order, mu):
    tok = [words_of(t) + ["\n"] for t in train]
    counts = [collections.Counter() for _ in range(order + 1)]
    for t in tok:
        for i, w in enumerate(t):
            for k in range(1, order + 1):
                context = t[max(0, i - k + 1):i]
                if k == 2 and i == 0:
                    context = ["\n"]
                if len(context) == k - 1:
                    counts[k][tuple(context) + (w,)] += 1
    n, v = sum(counts[1].values()), len(counts[1])
    out = []
    for text in texts:
        t = words_of(text) + ["\n"]
        base = total = known = 0
        for i, w in enumerate(t):
            p = (counts[1][(w,)] + 1) / (n + v + 1)
            known += counts[1][(w,)] > 0
            base += math.log10(p)
            for k in range(1, order):
                context = tuple(t[max(0, i - k):i]) if i else (("\n",) if k == 1 else ())
                if len(context) == k and counts[k][context]:
                    p = (counts[k + 1][context + (w,)] + mu * p) / (counts[k][context] + mu)
            total += math.log10(p)
        out.append((len(t), known, n, base, total))
    return out


@pytest.mark.parametrize("order,part_tokens", [(1, 1 << 20), (2, 1 << 20), (2, 40), (3, 200), (4, 100)])
def test_scores_match_counting(spark, monkeypatch, order, part_tokens):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 500)
    r = random.Random(order)
    word = lambda: f"W{int(r.paretovariate(0.7)) % 90}é"
    texts = [None, "", " ", "the"] + [" ".join(word() for _ in range(r.randint(1, 60))) for _ in range(80)]
    train = texts[:60] + texts[:10]
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in enumerate(texts)], "doc_id long, text string, part int, key string")
    trie = lm.train(spark.createDataFrame([(t,) for t in train], "text string").repartition(3), order=order, part_tokens=part_tokens)
    got = {x["doc_id"]: tuple(x)[1:] for x in lm.scored(df, trie).collect()}
    for i, want in enumerate(brute(train, texts, order, lm.MU)):
        assert got[i][:3] == want[:3]
        assert got[i][3] == pytest.approx(want[3], rel=1e-9)
        assert got[i][4] == pytest.approx(want[4], abs=lm.CODE_STEP * want[0] * order)


def test_without_training_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    trie = lm.train(df.where("false"))
    got = {x["doc_id"]: tuple(x)[1:] for x in lm.scored(df, trie).collect()}
    assert got == {1: (3, 0, 0, 0.0, 0.0), 2: (1, 0, 0, 0.0, 0.0)}
    assert lm.scored(df.where("false"), trie).count() == 0


def test_packed_keys_round_trip():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 500, dtype=np.uint64))
    for counts in (np.ones(len(keys), np.int64), np.arange(len(keys)) * 7 + 1):
        k, c = lm._unpacked(*lm._packed(keys, counts))
        assert (k == keys).all() and (c == counts).all()


def test_held_out_text_is_better_predicted_than_by_single_words(spark):
    import __spark_entry__ as entry
    out = entry.queries()["op5_lm_score"](spark, "/root/testdata/sf0.01").toPandas()
    held = out[out.held_out]
    assert (held.score.sum() / held.n_tokens.sum()) > (held.base_score.sum() / held.n_tokens.sum())
