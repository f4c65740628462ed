"""Vector codes: product quantisation by exact Lloyd rounds that skip distances by norm-of-sum bounds.

A vector of whole numbers is cut into equal parts, and each part has a codebook. A round assigns every part to its nearest
entry and moves the entries to the mean of their parts. Most assignments do not change, and bounds tell so
without a distance: a row carries, per part, an upper bound of the distance to its entry and, per group of entries, a lower
bound of the distance to all others in it, each stamped with the round in which it was exact. The driver keeps the codebooks of all rounds
(a few thousand numbers each), so a bound of round ``s`` is carried to round ``t`` by the *net* displacement
``|c(t) - c(s)|`` of the entries, the norm of the sum of their moves. That is never more than the sum of the norms of the moves that
accumulated bounds subtract, and an entry that comes back costs nothing. Only where the carried bounds overlap are distances computed, first
to the own entry, then to the groups that are still open.

Bounds decide what is computed, never the result: distances are exact whole numbers, bounds are rounded outwards, and equal
distances go to the lower index.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineage_spark.llm.common import small_side, written

SCALE = 1024
# groups of entries with a lower bound of their own
GROUPS = 8
# whole numbers up to this size have exact squared distances in doubles (up to 4,096 numbers a part)
EXACT_ABS = 1 << 19
# bits of a sum's limb: a long holds the sum of 2 ** 31 tasks' limbs
LIMB = 32
UP, DOWN, MOST = 1 + 1e-6, 1 - 1e-6, np.float32(3e38)  # single-precision bounds are rounded outwards


def kept_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and holds no null, NaN or infinity."""
    x = F.col(f"`{vector}`")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return df.where(x.isNotNull() & ~F.coalesce(bad, F.lit(True)))


def whole_numbers(lists: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x), padded with zeros to ``width``; whole doubles, or Python's whole numbers where doubles are not exact."""
    lens = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width))
    out[np.arange(width) < lens[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    big = np.abs(out) > 2.0 ** 52 / SCALE  # these are whole, or half or quarter numbers: Python's numbers multiply them exactly
    values = np.floor(np.where(big, 0, out) * SCALE)
    if big.any():
        values = _python_ints(values)
        values[big] = [n * SCALE // q for n, q in map(float.as_integer_ratio, out[big].tolist())]
    return values


def _python_ints(x: np.ndarray) -> np.ndarray:
    if x.dtype == object:
        return x
    out = np.empty(x.shape, object)
    out.reshape(-1)[:] = [int(v) for v in x.reshape(-1).tolist()]
    return out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries: whole doubles where they fit, else Python's whole numbers."""
    if x.dtype != object and c.dtype != object and max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT_ABS:
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
    x, c = _python_ints(x), _python_ints(c)
    out = np.empty((len(x), len(c)), object)
    for j, entry in enumerate(c):
        out[:, j] = ((x - entry) ** 2).sum(1) if x.shape[1] else 0
    return out


def _root(d: np.ndarray) -> np.ndarray:
    if d.dtype != object:
        return np.sqrt(d)
    return np.array([float(min(math.isqrt(v), 10 ** 300)) for v in d.reshape(-1)]).reshape(d.shape)


def _upper(d: np.ndarray) -> np.ndarray:
    """A bound not below the root of ``d``, in single precision."""
    out = (_root(d) + (d.dtype == object)) * UP
    return np.where(out < MOST, out, np.inf).astype(np.float32)


def _lower(d: np.ndarray) -> np.ndarray:
    """A bound not above the root of ``d``, in single precision."""
    return np.minimum(_root(d) * DOWN, MOST).astype(np.float32)


class Codebooks:
    """The codebooks of one part over all rounds, and the groups of its entries."""

    def __init__(self, first: np.ndarray):
        self.rounds = [first]
        n = len(first)
        if n > GROUPS and first.shape[1] and first.dtype != object:  # neighbours along the main direction share a group: near ones are rescanned together
            spread = first - first.mean(0)
            order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable")
        else:
            order = np.arange(n)
        self.group = np.empty(n, np.int64)
        self.group[order] = np.arange(n) * min(GROUPS, n) // max(n, 1)
        self.members = [np.flatnonzero(self.group == g) for g in range(min(GROUPS, n))]

    def displaced(self) -> tuple[np.ndarray, np.ndarray]:
        """Net displacement of every entry from each earlier round to now (round x entry), and the most in a group (round x group)."""
        now = self.rounds[-1]
        net = np.stack([_upper(_own(old, now, np.arange(len(now)))).astype(np.float64) for old in self.rounds])
        return net, np.stack([net[:, m].max(1) for m in self.members], 1)


def state_type(groups: int) -> np.dtype:
    """What a row carries per part: entry, upper bound with its round, a lower bound per group with its round."""
    return np.dtype([("entry", "u1"), ("upper", "<f4"), ("upper_at", "u1"), ("lower", "<f4", (groups,)), ("lower_at", "u1", (groups,))])


def assign(x: np.ndarray, books: Codebooks, state: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The new state of the parts ``x`` for the newest codebook, and the number of distances computed for each."""
    t, c, n, g = len(books.rounds) - 1, books.rounds[-1], len(x), len(books.members)
    rows = np.arange(n)
    if state is None:
        d = distances(x, c)
        best = np.argmin(d, 1)
        out = np.zeros(n, state_type(g))
        out["entry"], out["upper_at"], out["lower_at"] = best, t, t
        out["upper"] = _upper(d[rows, best])
        others = _lower(d)
        others[rows, best] = MOST
        for k, m in enumerate(books.members):
            out["lower"][:, k] = others[:, m].min(1)
        return out, np.full(n, len(c), np.int64)

    out = state.copy()
    entry = state["entry"].astype(np.int64)
    net, net_group = books.displaced()
    upper = (state["upper"] + net[state["upper_at"], entry]) * UP
    lower = (state["lower"] - net_group[state["lower_at"], np.arange(g)]) * DOWN
    computed = np.zeros(n, np.int64)
    tight = np.flatnonzero(upper >= lower.min(1))
    if not len(tight):
        return out, computed
    # the distance to the own entry first
    own = _own(x[tight], c, entry[tight])
    computed[tight] += 1
    out["upper"][tight] = upper[tight] = _upper(own)
    out["upper_at"][tight] = t
    open_groups = upper[tight, None] >= lower[tight]
    some = np.flatnonzero(open_groups.any(1))
    if not len(some):
        return out, computed
    at, opened = tight[some], open_groups[some]
    best, best_d = entry[at].copy(), own[some].copy()
    scanned = {}
    for k, m in enumerate(books.members):
        r = np.flatnonzero(opened[:, k])
        if not len(r):
            continue
        d = distances(x[at[r]], c[m])
        computed[at[r]] += len(m)
        scanned[k] = r, d
        pick = np.argmin(d, 1)  # members ascend, so the first of equals has the lowest index
        near, which = d[np.arange(len(r)), pick], m[pick]
        better = (near < best_d[r]) | ((near == best_d[r]) & (which < best[r]))
        best[r[better]], best_d[r[better]] = which[better], near[better]
    left = best != entry[at]
    if left.any():  # the entry that was left joins the others of its group, at a known distance
        k = books.group[entry[at[left]]]
        out["lower"][at[left], k] = np.minimum(lower[at[left], k], _lower(own[some][left]))
        out["lower_at"][at[left], k] = t
    for k, (r, d) in scanned.items():
        others = _lower(d)
        others[books.members[k][None, :] == best[r][:, None]] = MOST
        out["lower"][at[r], k] = others.min(1)
        out["lower_at"][at[r], k] = t
    out["entry"][at], out["upper"][at] = best, _upper(best_d)
    return out, computed


def _own(x: np.ndarray, c: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its entry."""
    mine = c[entry]
    if x.dtype != object and mine.dtype != object and max(np.abs(x).max(initial=0), np.abs(mine).max(initial=0)) <= EXACT_ABS:
        return ((x - mine) ** 2).sum(1)
    out = np.zeros(len(x), object)
    if x.shape[1]:
        out[:] = ((_python_ints(x) - _python_ints(mine)) ** 2).sum(1)
    return out


def _limbs(v: int, n: int) -> list[int]:
    """A whole number in ``n`` limbs of LIMB bits, the last with the sign; limbs add up on their own in a long."""
    return [v >> LIMB * j & (1 << LIMB) - 1 for j in range(n - 1)] + [v >> LIMB * (n - 1)]


class Codes:
    """The final codebooks (``books``), rows (``rows``: key, label, ``code``, ``error``, ``n_distances``) and their digest."""

    def __init__(self, books: list[np.ndarray], rows: DataFrame):
        self.books, self.rows = books, rows

    def sha256(self) -> str:
        """Of all components by part, entry and position, in decimal, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for e in b for v in e).encode()).hexdigest()


def _stored(x: np.ndarray) -> list[bytes] | None:
    """Rows of whole doubles as int32 bytes; None if some do not fit."""
    if x.dtype == object or np.abs(x).max(initial=0) > EXACT_ABS:
        return None
    return [r.tobytes() for r in x.astype("<i4")]


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = 4, entries: int = 256, rounds: int = 4) -> Codes:
    """Codes of every kept vector after ``rounds`` rounds and a final assignment.

    Rows with a null vector, or a null or non-finite component, are left out. The first codebooks are the vectors of the ``entries``
    smallest keys (null last; equal keys by their components), fewer if there are fewer rows. Repeated rows count each; other
    columns are not read. Vectors shorter than the longest, and a length that ``parts`` does not divide, are filled up
    with zeros. An empty table gives no rows and empty codebooks. ``error`` is null in the case that it does not fit a long. Every
    round writes the rows with their bounds once and drops the round before; per task and entry one row of sums is shuffled, and
    the codebooks (``entries`` x length numbers) are all that reaches the driver.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has 1 to 256 entries")
    spark = df.sparkSession
    kept = kept_vectors(df, vector).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"),
                                           F.col(f"`{vector}`").cast("array<double>").alias("x"))
    n_rows, width, largest = kept.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    width = (width or 0) + -(width or 0) % parts
    d = width // parts
    # a sum has so many bits at most; beyond 62 it is added up in limbs
    bits = (int((largest or 0) * n_rows) * SCALE + 1).bit_length() + 1 if (largest or 0) < 1e280 else 2048
    limbs = 0 if bits <= 62 else -(-bits // LIMB) + 1
    heads = whole_numbers(pa.array([r["x"] for r in kept.orderBy(F.asc_nulls_last("key"), "x").limit(entries).collect()],
                                   pa.list_(pa.float64())), width)
    books = [Codebooks(heads[:, p * d:(p + 1) * d]) for p in range(parts)]

    def cut(x: np.ndarray) -> list[np.ndarray]:
        return [x[:, p * d:(p + 1) * d] for p in range(parts)]

    kinds = kept.schema
    schema = T.StructType([kinds["key"], kinds["label"], T.StructField("x", T.ArrayType(T.DoubleType())),
                           T.StructField("ints", T.BinaryType()), T.StructField("state", T.BinaryType()),
                           T.StructField("n_distances", T.LongType())])
    groups = len(books[0].members)

    def numbers(b: pa.RecordBatch, stored: bool) -> np.ndarray:
        if not stored:
            return whole_numbers(b.column(2), width)
        ints = b.column(3)
        whole = np.frombuffer(b"".join(i for i in ints.to_pylist() if i is not None), "<i4").reshape(len(b) - ints.null_count, width).astype(np.float64)
        if not ints.null_count:
            return whole
        out, at = np.empty((len(b), width), object), ints.is_valid().to_numpy(zero_copy_only=False)
        out[at], out[~at] = _python_ints(whole), _python_ints(whole_numbers(b.column(2).filter(ints.is_null()), width))
        return out

    def one_round(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = numbers(b, not first)
                held = None if first else np.frombuffer(b"".join(b.column(4).to_pylist()), state_type(groups)).reshape(len(b), parts)
                states, count = [], np.zeros(len(b), np.int64) if first else np.asarray(b.column(5).to_numpy(zero_copy_only=False))
                for p, part in enumerate(cut(x)):
                    s, n = assign(part, books[p], None if first else held[:, p])
                    states.append(s)
                    count = count + n
                ints = _stored(x)
                whole = b.column(2) if ints is None else pa.nulls(len(b), b.column(2).type)
                state = np.stack(states, 1) if len(b) else np.zeros((0, parts), state_type(groups))
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), whole, pa.array(ints, pa.binary()) if ints is not None else pa.nulls(len(b), pa.binary()),
                    pa.array([s.tobytes() for s in state], pa.binary()), pa.array(count, pa.int64())], names=schema.names)
        return run

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(books[0].rounds[0])
        total, count = np.zeros((parts, n, d), object if limbs else np.int64), np.zeros((parts, n), np.int64)
        for b in batches:
            if not len(b):
                continue
            x = numbers(b, True)
            entry = np.frombuffer(b"".join(b.column(4).to_pylist()), state_type(groups)).reshape(len(b), parts)["entry"].astype(np.int64)
            for p, part in enumerate(cut(x)):
                count[p] += np.bincount(entry[:, p], minlength=n)
                order = np.argsort(entry[:, p], kind="stable")
                used, start = np.unique(entry[order, p], return_index=True)
                if d:
                    values = _python_ints(part) if limbs else part.astype(np.int64)
                    total[p, used] += np.add.reduceat(values[order], start, axis=0)
        p, e = np.nonzero(count)
        rows = [[w for v in r for w in _limbs(v, limbs)] for r in total[p, e].tolist()] if limbs else total[p, e].tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(p, pa.int64()), pa.array(e, pa.int64()), pa.array(count[p, e], pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"])

    state = kept.select("*", F.lit(None).cast("binary").alias("ints"), F.lit(None).cast("binary").alias("state"), F.lit(0).cast("long").alias("n_distances"))
    for t in range(rounds + 1 if len(heads) else 0):
        state = written(state.mapInArrow(one_round(t == 0), schema), "vector-codes")
        if t == rounds:
            break
        added = state.mapInArrow(sums, "part long, entry long, n long, total array<long>")
        added = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
            F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(d * max(limbs, 1))]).collect()
        for p in range(parts):
            book = books[p].rounds[-1].copy()
            for r in added:
                if r["part"] == p:
                    total = [r[f"t{i}"] if not limbs else sum(r[f"t{i * limbs + j}"] << LIMB * j for j in range(limbs)) for i in range(d)]
                    mean = [v // r["n"] for v in total]
                    if any(abs(v) > EXACT_ABS for v in mean):
                        book = _python_ints(book)
                    book[r["entry"]] = mean
            books[p].rounds.append(book)
    final = [b.rounds[-1] for b in books]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = numbers(b, True)
            entry = np.frombuffer(b"".join(b.column(4).to_pylist()), state_type(groups)).reshape(len(b), parts)["entry"]
            error = sum(_own(part, final[p], entry[:, p].astype(np.int64)).astype(object) for p, part in enumerate(cut(x)))
            error = [int(v) if v < 1 << 63 else None for v in error]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([e.tobytes().hex() for e in entry], pa.string()),
                                              pa.array(error, pa.int64()), b.column(5)], names=["key", "label", "code", "error", "n_distances"])

    out = T.StructType([kinds["key"], kinds["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
                        T.StructField("n_distances", T.LongType())])
    if not len(heads):
        return Codes(final, spark.createDataFrame([], out))
    return Codes(final, state.mapInArrow(coded, out))


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` and ``label_error``: errors summed over equal labels, nulls together; null where a sum does not fit a long."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    sums = rows.groupBy("label").agg(F.when(F.count("error") == F.count(F.lit(1)), total).alias("label_error"))
    sums = written(sums.withColumnRenamed("label", "__label"), "label-errors")
    return rows.join(small_side(sums, 64), F.col("label").eqNullSafe(F.col("__label")), "left").drop("__label")
