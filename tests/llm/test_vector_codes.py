"""Vector codes against plain Lloyd rounds in Python's whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineage_spark.llm import vector_codes


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(k, lab, list(v)) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, _, v in kept), default=0)
    width += -width % parts
    d = width // parts
    ints = [[x[0] * 1024 // x[1] for x in (float(y).as_integer_ratio() for y in v + [0.0] * (width - len(v)))] for _, _, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:entries]
    books = [[ints[i][p * d:(p + 1) * d] for i in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for t in range(rounds + 1):
        at = [[nearest(x[p * d:(p + 1) * d], books[p]) for p in range(parts)] for x in ints]
        if t < rounds:
            for p in range(parts):
                for j in range(len(books[p])):
                    mine = [ints[i][p * d:(p + 1) * d] for i in range(len(ints)) if at[i][p][1] == j]
                    if mine:
                        books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    errors = [sum(a[0] for a in x) for x in at]
    by_label = {}
    for (_, lab, _), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    fits = lambda v: v if v < 1 << 63 else None
    return sorted([(kept[i][0], "".join(f"{a[1]:02x}" for a in at[i]), fits(errors[i]), fits(by_label[kept[i][1]])) for i in range(len(kept))], key=str), sha


def run(df, **options):
    codes = vector_codes.compress(df, **options)
    out = vector_codes.with_label_error(codes.rows)
    return sorted([tuple(r) for r in out.select("key", "code", "error", "label_error").collect()], key=str), codes.sha256(), codes


def vectors(seed, n, width, spread=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, width))
    return [(int(i), [float(np.float32(x)) for x in centres[i % 12] + spread * r.normal(size=width) * 0.3], int(i % 5) if i % 7 else None) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("n,width,entries,rounds", [(400, 16, 32, 4), (300, 8, 256, 4), (50, 4, 256, 2), (500, 12, 9, 6), (200, 8, 1, 3)])
def test_codes_match_brute_force(spark, n, width, entries, rounds):
    rows = vectors(n, n, width)
    rows += rows[:40] + [(None, rows[3][1], 2), (rows[5][0], rows[9][1], None)]  # repeated rows, null and repeated keys
    rows += [(900, None, 1), (901, [1.0, None] + [0.0] * (width - 2), 1), (902, [float("nan")] * width, 1), (903, [float("inf")] * width, 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("clash")).repartition(4)
    got, sha, codes = run(df, entries=entries, rounds=rounds)
    assert (got, sha) == brute(rows, entries=entries, rounds=rounds)


def test_bounds_save_distances(spark):
    rows = vectors(3, 3000, 16, spread=0.2)
    got, sha, codes = run(spark.createDataFrame(rows, SCHEMA), entries=24)
    done = codes.rows.agg(F.sum("n_distances")).first()[0]
    assert done < 0.6 * len(rows) * 4 * 24 * 5  # a full scan in each of five assignments


@pytest.mark.parametrize("scale", [1e3, 1e6, 1e15, 3e37, 1e200])
def test_large_numbers_are_exact(spark, scale):
    rows = [(k, [x * scale for x in v], lab) for k, v, lab in vectors(8, 60, 8)] + [(100, [0.3] * 8, 1)]
    kind = "float" if scale < 1e38 else "double"
    rows = [(k, [float(np.float32(x)) if kind == "float" else x for x in v], lab) for k, v, lab in rows]
    got, sha, _ = run(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int"), entries=10, rounds=3)
    expect, expect_sha = brute(rows, entries=10, rounds=3)
    if scale > 1e7:  # sums of errors that do not fit
        got, expect = [r[:3] for r in got], [r[:3] for r in expect]
    assert (got, sha) == (expect, expect_sha)


def test_uneven_lengths_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [0.5], 1), (3, [], 2), (4, [1.0] * 6, None)]
    got, sha, _ = run(spark.createDataFrame(rows, SCHEMA))
    assert (got, sha) == brute(rows)
    for only in ([], [(1, None, 1)]):
        got, sha, codes = run(spark.createDataFrame(only, SCHEMA))
        assert got == [] and codes.rows.columns == ["key", "label", "code", "error", "n_distances"]
    got, sha, _ = run(spark.createDataFrame([(3, [], 2), (4, [], 2)], SCHEMA))
    assert got == [(3, "00000000", 0, 0), (4, "00000000", 0, 0)]


def test_net_displacement_is_tighter_than_the_sum_of_moves():
    r = np.random.default_rng(4)
    book = vector_codes.Codebooks(np.floor(r.normal(size=(20, 6)) * 1000))
    moves = np.zeros(20)
    for _ in range(4):
        old = book.rounds[-1]
        book.rounds.append(np.floor(old + r.normal(size=(20, 6)) * 200))
        moves += np.sqrt(((book.rounds[-1] - old) ** 2).sum(1))
    net, group = book.displaced()
    assert (net[0] <= moves * (1 + 1e-5)).all() and (net[0] < 0.9 * moves).mean() > 0.5
    assert net.shape == (5, 20) and (net[4] < 1e-3).all()
    assert all((group[:, book.group[e]] >= net[:, e]).all() for e in range(20))


def test_bounds_hold_over_rounds():
    """Bounds carried by net displacement never contradict the exact distances."""
    r = np.random.default_rng(5)
    x = np.floor(r.normal(size=(500, 5)) * 1000)
    book = vector_codes.Codebooks(x[:30].copy())
    state, skipped = None, 0
    for t in range(6):
        state, computed = vector_codes.assign(x, book, state)
        d = vector_codes.distances(x, book.rounds[-1])
        assert (state["entry"] == d.argmin(1)).all()
        skipped += int((computed == 0).sum())
        book.rounds.append(np.floor(book.rounds[-1] + r.normal(size=(30, 5)) * (40 if t % 2 else 2)))
    assert skipped
