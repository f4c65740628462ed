"""The Jaccard join against brute force over all pairs."""

import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from lineage_spark.llm import common, jaccard
from lineage_spark.llm.common import words_of
from lineage_spark.llm.components import components


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = words_of(t)
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if sets[i] and key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(sets[i]), least.get(find(i), key) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def near_copies(r, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, most)):
            at = r.randrange(len(w))
            if r.random() < 0.5:
                w[at] = f"new{r.randrange(10**6)}"
            elif r.random() < 0.5:
                del w[at]
            else:
                w.insert(at, f"in{r.randrange(10**6)}")
        out.append(" ".join(w))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: f"w{int(r.paretovariate(0.6)) % 400}"
    passage = [f"p{i}" for i in range(40)]
    texts = [None, "", " \t", "one", "ONE", "two words", "a b c", "A b c d", "a b c d e"]
    for size in (6, 7, 13, 30, 60, 150, 400):
        base = [word() for _ in range(size)]
        texts += near_copies(r, base, 12, max(1, size // 40))
    hot = [word() for _ in range(90)]
    texts += near_copies(r, hot, 120, 6)
    texts += [" ".join([word() for _ in range(r.randint(5, 60))] + passage + [word() for _ in range(5)]) for _ in range(40)]
    texts += [" ".join(word() for _ in range(r.randint(1, 12))) for _ in range(60)]
    texts += texts[:30]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    return [(k if k != 20 else None, t) for k, t in rows]


def joined(spark, rows, n, percent):
    df = spark.createDataFrame([(k, t, 1, "x", "y") for k, t in rows], "doc_id long, text string, n int, key string, sid string")
    return jaccard.JaccardJoin(df.repartition(5), n=n, percent=percent), df


@pytest.mark.parametrize("seed,n,percent,block", [(1, 4, 85, 2048), (2, 5, 80, 2048), (3, 4, 85, 16), (4, 2, 60, 8)])
def test_components_match_brute_force(spark, monkeypatch, seed, n, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", block)
    rows = corpus(seed)
    join, _ = joined(spark, rows, n, percent)
    got = sorted(map(tuple, join.per_document().collect()), key=repr)
    assert got == sorted(brute(rows, n, percent), key=repr)


def test_one_of_each(spark):
    rows = corpus(7)
    join, df = joined(spark, rows, 5, 80)
    out = join.one_of_each()
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    classes = brute(rows, 5, 80)
    with_words = [c for c in classes if c[1]]
    blank = [t for t in rows if not words_of(t[1])]
    assert sum(not words_of(t) for _, t in kept) == len(blank)
    # the row without an id is the first of its component, so that component keeps it
    ids = {c[2] for c in with_words}
    assert len([1 for _, t in kept if words_of(t)]) == len(ids)


def test_no_rows(spark):
    join, _ = joined(spark, [], 4, 85)
    assert join.per_document().count() == 0
    assert join.one_of_each().count() == 0


def test_linked_sets_share_a_key():
    """The tiles lose no link: sets at the threshold, whatever their sizes, have a common key."""
    r = np.random.default_rng(1)
    for percent in (85, 80, 60):
        for size in list(range(1, 40)) + [97, 250, 1000, 5000]:
            for _ in range(6):
                a = np.unique(r.integers(0, 2**64, size, dtype=np.uint64))
                most = size - -(-percent * size // 100)
                keep = r.choice(len(a), len(a) - int(r.integers(0, most + 1)), replace=False)
                b = np.unique(a[keep])
                more = r.integers(0, 2**64, 1 + size // 2, dtype=np.uint64)
                while not jaccard.links_exactly(a, np.union1d(b, more), percent) and len(more):
                    more = more[:-1]
                b = np.union1d(b, more)
                if jaccard.links_exactly(a, b, percent) and not np.array_equal(a, b):
                    assert set(jaccard.segment_keys(a, percent)) & set(jaccard.segment_keys(b, percent))


def test_bitmap_bound_is_never_below_the_overlap():
    r = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(r.integers(0, 2**64, int(r.integers(1, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate([r.choice(a, int(r.integers(0, len(a) + 1))), r.integers(0, 2**64, 50, dtype=np.uint64)]))
        ba, bb = jaccard._folded([jaccard._bitmap(x, jaccard._bits_for(len(x))).tobytes() for x in (a, b)])
        only_a, only_b = np.bitwise_count(ba & ~bb).sum(), np.bitwise_count(bb & ~ba).sum()
        assert min(len(a) - only_a, len(b) - only_b) >= len(np.intersect1d(a, b))


def test_components_of_long_paths(spark):
    edges = [(i + 1, i) for i in range(300)] + [(1000, 1001), (2000, 2000)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def test_few_pairs_below_the_threshold_are_proposed():
    """A group of near copies around the threshold: bitmaps part nearly all pairs that do not link, so tests do not grow with its square."""
    r = np.random.default_rng(3)
    base = r.integers(0, 2**64, 150, dtype=np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, 150 - d, replace=False), r.integers(0, 2**64, d, dtype=np.uint64)]))
            for d in r.integers(0, 22, 150)]
    n, sid = np.array([len(s) for s in sets]), np.arange(len(sets))
    bitmaps = [jaccard._bitmap(s, jaccard._bits_for(len(s))).tobytes() for s in sets]
    label = list(range(len(sets)))
    links = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard.links_exactly(sets[i], sets[j], 85)}
    for _ in sets:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    comp, yes = np.array(label), np.ones(len(sets), bool)
    out = jaccard._proposals(n, sid, comp, yes, yes, bitmaps, [None] * len(sets), 85, 1 << 20)
    apart = sum(1 for i in range(len(sets)) for j in range(i) if label[i] != label[j])
    assert apart > 1000 and len(out) < 0.05 * apart
    assert not any(p[4] for p in out)
    # all pairs that link are allowed, each once
    out = jaccard._proposals(n, sid, sid, yes, yes, bitmaps, [None] * len(sets), 85, 1 << 20)
    assert links <= {tuple(sorted(p[:2])) for p in out} and len(out) == len({tuple(sorted(p[:2])) for p in out})


def test_lists_of_partners_only_are_dropped():
    import pandas as pd

    rows = pd.DataFrame({"marked": [8, 8, 9, 13, 13, 21, 20 + 2], "sid": [1, 2, 3, 4, 5, 6, 7]}).sort_values(["marked", "sid"])
    for size in (1, 2, 10):
        out = pd.concat(jaccard._lists(rows.iloc[i:i + size] for i in range(0, len(rows), size)))
        assert sorted(out["sid"]) == [1, 2, 3]


def test_only_members_with_a_partner_take_their_wide_bitmap_along(spark, monkeypatch):
    """Texts that share a passage and little else meet in many lists; wide bitmaps in all of them filled the disk. The keys of the lists
    do not stay either once the lists are made."""
    r = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"w{r.randrange(10**6)}" for _ in range(80)]) for _ in range(40)]
    texts += near_copies(r, texts[0].split(), 5, 4)
    rows, moved = list(enumerate(texts)), []
    real = jaccard.JaccardJoin._proposed

    def spied(self, rest, tested, signatures, turn, tests):
        proposed, state = real(self, rest, tested, signatures, turn, tests)
        if tests:
            moved.append((state[1].count(), state[-1].count()))
        return proposed, state

    monkeypatch.setattr(jaccard.JaccardJoin, "_proposed", spied)
    join, _ = joined(spark, rows, 2, 60)
    assert sorted(map(tuple, join.per_document().collect())) == sorted(brute(rows, 2, 60))
    assert moved and moved[0][0] > 100 and moved[0][1] < 0.2 * moved[0][0]
    assert join.docs.columns == ["key", "tid", "n", "sid"]


def test_narrow_bitmaps_leave_out_no_pair():
    r = np.random.default_rng(6)
    base = r.integers(0, 2**64, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, 200 - d, replace=False), r.integers(0, 2**64, d, dtype=np.uint64)]))
            for d in r.integers(0, 120, 100)]
    n, sid = np.array([len(s) for s in sets]), r.permutation(len(sets))
    comp, outer, home = sid % 60, sid % 3 > 0, np.ones(len(sets), bool)
    tried = [None if i % 2 else sid[:5] for i in range(len(sets))]
    wide, narrow = ([jaccard._bitmap(s, jaccard._bits_for(len(s), f)).tobytes() for s in sets] for f in (jaccard.BITMAP_FACTOR, jaccard.NARROW_FACTOR))
    kept = jaccard._paired(n, sid, comp, outer, home, narrow, tried, 80, 4)
    assert kept == [k for k in zip(sid.tolist(), comp.tolist(), outer.tolist(), home.tolist()) if k[0] in {x[0] for x in kept}]
    at = np.flatnonzero(np.isin(sid, [k[0] for k in kept]))
    assert 0 < len(at) < len(sets)
    pick = lambda v: [v[i] for i in at]
    few = jaccard._proposals(n[at], sid[at], comp[at], outer[at], home[at], pick(wide), pick(tried), 80, 4)
    assert few and few == jaccard._proposals(n, sid, comp, outer, home, wide, tried, 80, 4)


def batch_bytes(df):
    """Bytes of text in each batch that a Python worker gets."""
    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"bytes": [int(b["text"].str.len().sum())]})

    return [r[0] for r in df.select("text").mapInPandas(sizes, "bytes long").collect()]


def test_workers_get_batches_of_bounded_bytes(spark, monkeypatch):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    row = 100_000
    big = spark.range(0, 150, 1, 1).selectExpr("id doc_id", f"repeat(concat('w', id, ' '), {row}) text").selectExpr("doc_id", f"left(text, {row}) text")
    before, inside = spark.conf.get(setting), []
    real = jaccard.written

    def spied(df, name):
        inside.append(max(batch_bytes(big)) if not inside else int(spark.conf.get(setting).rstrip("b")))
        return real(df, name)

    monkeypatch.setattr(jaccard, "written", spied)
    rows = [(i, f"a b c d e f {i // 4}") for i in range(40)]
    join, _ = joined(spark, rows, 4, 85)
    steps = list(inside)
    assert len(steps) > 5 and max(steps) <= common.BATCH_BYTES + row
    assert spark.conf.get(setting) == before
    assert sorted(map(tuple, join.per_document().collect())) == sorted(brute(rows, 4, 85))
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        1 / 0
    assert spark.conf.get(setting) == before


def test_pipeline_scores_batches_of_bounded_bytes(spark, monkeypatch):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    monkeypatch.setattr(corpus_pipeline, "load", lambda *_: labels)
    docs = spark.createDataFrame([(1, "good words here"), (2, "bad"), (3, None)], "doc_id long, text string")
    try:
        kept = corpus_pipeline.quality_stage(spark, docs, "")
        assert int(spark.conf.get(setting).rstrip("b")) == common.BATCH_BYTES
        assert {r["doc_id"] for r in kept.collect()} <= {1, 2, 3}
    finally:
        spark.conf.set(setting, before)
