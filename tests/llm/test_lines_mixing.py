"""Line dedup and source mixing against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from lineage_spark.llm import line_dedup, mixing

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(texts, min_docs, min_chars):
    def key(line):
        return line.strip(STRIP).translate(LOWER)

    seen = collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and seen[key(x)] >= min_docs)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs,min_chars,max_bits", [(1, 1, 1 << 20), (2, 3, 1 << 20), (5, 1, 1 << 20), (5, 0, 1 << 20)])
def test_lines_match_brute_force(spark, min_docs, min_chars, max_bits):
    r = random.Random(min_docs)
    pool = ["", " ", "a", "Shared line", " shared LINE\t", "É x", "é x", "footer", "z" * 5000] + [f"own {i}" for i in range(80)]
    texts = [None, "", "\n", "\n\n a \n"] + ["\n".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(60)]
    texts += texts[:20]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kept_text string, drops int")
    out = line_dedup.without_repeated_lines(df, min_docs=min_docs, min_chars=min_chars, max_bits=max_bits)
    assert out.columns == ["doc_id", "text", "drops", "n_lines", "n_dropped", "kept_text"]
    got = {x["doc_id"]: (x["n_lines"], x["n_dropped"], x["kept_text"]) for x in out.collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts, min_docs, min_chars)


def test_lines_with_a_full_filter(spark, monkeypatch):
    """A filter far too small makes every line a suspect; the result is the same."""
    monkeypatch.setattr(line_dedup, "MIN_BITS", 1 << 16)
    texts = [f"line {i}\nshared {i % 7}" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    out = line_dedup.without_repeated_lines(df, min_docs=429, max_bits=1 << 16)
    assert {x["n_dropped"] for x in out.where("doc_id % 7 < 4").collect()} == {1}
    assert {x["n_dropped"] for x in out.where("doc_id % 7 >= 4").collect()} == {0}


def test_no_lines(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.without_repeated_lines(df).count() == 0


def filled(sizes, total, cap, weights):
    """The rule as stated: share by weight, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, excess = dict.fromkeys(names, 0.0), set(names), total * sum(sizes.values())
    while excess > 1e-9 and open_:
        whole = sum(w[s] for s in open_)
        for s in open_:
            target[s] += excess * w[s] / whole
        excess = 0.0
        for s in list(open_):
            if target[s] >= cap * sizes[s]:
                excess += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def mixed(spark, data, **options):
    df = spark.createDataFrame(data, "doc_id long, text string, source string, row int, size string")
    return mixing.Mix(df, **options)


def random_docs(seed, n):
    r = random.Random(seed)
    sources = ["b", "a", None, "é", "Z", "empty"]
    return [(i if r.random() > 0.05 else None, None if s == "empty" else " ".join("w" for _ in range(int(r.paretovariate(0.8)))),
             s, 0, "x") for i in range(n) for s in [r.choice(sources)]]


@pytest.mark.parametrize("seed,total,cap", [(1, 1.5, 2.0), (2, 0.4, 2.0), (3, 2.0, 2.0), (4, 1.0, 1.0)])
def test_mix_meets_targets(spark, seed, total, cap):
    data = random_docs(seed, 300)
    mix = mixed(spark, data, total=total, cap=cap, block_words=16, shards=8)
    out = mix.per_document().toPandas()
    assert len(out) == len(data)
    sizes = collections.Counter()
    for _, t, s, *_ in data:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    expect = filled(sizes, total, cap, (3.0, 1.0, 2.0))
    assert (out.taken <= cap * out["size"]).all()
    for s, t in expect.items():
        own = out[out.source.isna() if s is None else out.source == s]
        assert own.target.to_numpy() == pytest.approx(t, abs=1e-6)
        assert (own.source_size == sizes[s]).all()
        assert abs(own.taken.sum() - t) <= 1


def test_mix_shards_are_exact_disjoint_and_repeat(spark):
    data = random_docs(5, 400)
    runs = [mixed(spark, data, block_words=8, shards=13) for _ in range(2)]
    draws = [m.draws.select("row", "block", "pass", "shard", "start", "taken", "order").toPandas() for m in runs]
    a, b = (d.sort_values(["row", "block", "pass"]).reset_index(drop=True) for d in draws)
    assert a.equals(b)
    assert not a.duplicated(["row", "block", "pass"]).any()
    per = a.groupby("shard").size().reindex(range(13), fill_value=0)
    assert [int(x) for x in per] == [len(a) * (i + 1) // 13 - len(a) * i // 13 for i in range(13)]
    shares = np.array([r["quotas"] for r in runs[0].shares.orderBy("shard").collect()])
    assert [int(x) for x in shares.sum(axis=1)] == [int(x) for x in per]
    shuffled = runs[0].shuffled()
    assert shuffled.count() == len(a)


def test_hypergeometric_split_follows_its_distribution(spark):
    """Left counts over many nodes: mean and variance of the hypergeometric distribution."""
    F = mixing.F
    df = spark.range(4000).select(mixing._hypergeometric(
        F.lit(60).cast("long"), F.lit(20).cast("long"), F.lit(30).cast("long"), F.lit(1), F.col("id")).alias("k"))
    k = df.toPandas().k
    assert k.between(0, 20).all()
    assert abs(k.mean() - 10) < 0.15
    assert abs(k.var() - 30 * (1 / 3) * (2 / 3) * 30 / 59) < 0.4


def test_mix_of_nothing(spark):
    assert mixed(spark, []).per_document().count() == 0
    out = mixed(spark, [(1, None, "a", 0, ""), (2, "", None, 0, "")]).per_document().collect()
    assert [(r["taken"], r["target"]) for r in out] == [(0, 0.0), (0, 0.0)]


def test_word_count(spark):
    df = spark.createDataFrame([("a  b\tc\x0bd",), ("  é",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(mixing.word_count(df["t"])).collect()] == [4, 2, 0, 0]
    assert hashlib.sha256(b"").hexdigest()
