"""Ranked lexical search against a plain scoring of every document."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineage_spark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(d, collections.Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, total = len(counted), sum(x[2] for x in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in counted:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "naïve", "漢字", "x1", "The", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(r.choices(words, weights, k=r.choice([1, 5, 20, 60, 400])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " \n-- ;"), (n + 3, "the-THE_the\x7fthe"), (n + 4, "lonely"), (None, "w0 w1 w200")]
    docs += [(n + 10 + i, "w3 w50 shared passage") for i in range(700)]  # ties far beyond k
    docs += docs[:20]  # repeated rows
    items = [(1, "the w1 w2 w40 w299"), (2, None), (3, ""), (4, "lonely"), (5, "absent words"), (6, "shared PASSAGE w3"), (7, "w0"),
             (8, " ".join(words)), (None, "naïve É 漢字"), (6, "shared PASSAGE w3")]
    return docs, items


@pytest.mark.parametrize("shard_docs,k", [(1 << 16, 10), (40, 10), (333, 3), (1, 10)])
def test_search_matches_brute_force(spark, shard_docs, k):
    docs, items = corpus(shard_docs, 500)
    if shard_docs == 1:
        docs = docs[:60] + docs[500:506]
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in docs], "doc_id long, text string, term string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    index = lexical.build(df, shard_docs=shard_docs)
    got = lexical.search(index, asked, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == brute(docs, items, k)


def test_items_in_blocks_and_text_keys(spark, monkeypatch):
    docs, items = corpus(5, 120)
    monkeypatch.setattr(lexical, "ITEM_CHARS", 300)
    df = spark.createDataFrame([(None if d is None else f"{d:06d}", t) for d, t in docs], "name string, body string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(lexical.build(df, key="name", text="body", shard_docs=50), asked, out="name")
    assert rows(got) == brute([(None if d is None else f"{d:06d}", t) for d, t in docs], items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    index = lexical.build(none)
    assert lexical.search(index, some).collect() == []
    assert (index.n_docs, index.n_terms) == (0, 0)
    full = lexical.build(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    for items in (some.where("false"), some.select("item_id", F.lit(None).cast("string").alias("text"))):
        out = lexical.search(full, items)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def coded_lists(r, n_docs, n_lists):
    lens = r.integers(1, 100000, n_docs).astype(np.uint32)
    parts = [np.sort(r.choice(n_docs, r.integers(1, n_docs), replace=False)) for _ in range(n_lists)]
    docs, of = np.concatenate(parts), np.repeat(np.arange(n_lists), [len(p) for p in parts])
    tfs = np.minimum(r.geometric(0.4, len(docs)) ** r.integers(1, 9, len(docs)), 1 << 22).astype(np.int64)
    return lens, parts, docs, of, tfs


def test_blocks_round_trip_and_bounds_hold():
    r = np.random.default_rng(1)
    lens, parts, docs, of, tfs = coded_lists(r, 3000, 20)
    meta, data, first = lexical.coded(docs, tfs, of, lens[docs])
    scores = lexical._Scores(3000, int(lens.sum()), {"t": 10})
    m = scores.m(lens)
    for i, part in enumerate(parts):
        own = meta[first[0, i]:first[0, i + 1]]
        x = lexical._List(own.tobytes(), data[first[1, i]:first[1, i + 1]].tobytes(), 7, scores, m)
        exact = 7 * scores.part(tfs[of == i], m[part])
        got_docs, got = x.all()
        assert got_docs.tolist() == part.tolist() and got.tolist() == exact.tolist()
        assert all(x.most[b] >= x.blocks[b][1].max() for b in range(len(own)))


def test_search_skips_blocks():
    """A short rare list leads; of the long list, only blocks that hold its documents are decompressed."""
    n = 60000
    lens = np.full(n, 50, np.uint32)
    rare, common = np.array([3, 30000, 59999]), np.arange(n)
    docs, of = np.concatenate([rare, common]), np.repeat([0, 1], [3, n])
    meta, data, first = lexical.coded(docs, np.ones(len(docs), np.int64), of, lens[docs])
    scores = lexical._Scores(n, int(lens.sum()), {"rare": 3, "common": n // 2})
    m = scores.m(lens)
    lists = [lexical._List(meta[first[0, i]:first[0, i + 1]].tobytes(), data[first[1, i]:first[1, i + 1]].tobytes(), w, scores, m)
             for i, w in enumerate((scores.weight["rare"], scores.weight["common"]))]
    least = int(lists[1].bound) + 1
    found, score = lexical.search_shard(lists, n, 2, least)
    assert found.tolist() == rare.tolist() and len(set(score.tolist())) == 1
    assert lists[1].whole is None and len(lists[1].blocks) == 3
    # a heap that is out of reach: nothing is decompressed
    fresh = [lexical._List(x.meta.tobytes(), x.data.tobytes(), x.weight, scores, m) for x in lists]
    assert not len(lexical.search_shard(fresh, n, 2, lists[0].bound + lists[1].bound + 1)[0])
    assert not fresh[0].blocks and not fresh[1].blocks
