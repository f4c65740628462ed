"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

A text's set is its distinct word n-grams (64-bit hashes, sorted); equal sets are one member from then on.

* **Tiles.** Sizes are cut into bands; tile ``k`` takes the members whose size lets them link with a member of
  band ``k`` (two tiles per member). Two sets that link differ in at most ``H`` grams, ``H`` following from the sizes of the
  tile, so when the hash space is cut into more than ``H`` segments they agree on whole segments. Members of a tile with an equal
  segment meet in a list; members with more than the tile's allowance of empty segments meet on those too, so no link is lost. A list
  without a member of its own tile's band repeats another tile's and is dropped; lists that share most members become one.
* **Bitmaps.** Lists of two give one pair. In longer lists members of different components are compared by hashed bitmaps whose
  bit counts bound the overlap from above, and each member proposes untried partners that the bound allows. Where a member goes to
  all its lists, narrow bitmaps go first: only members that those leave a partner take their wide one along.
* **Exact.** Proposed pairs are tested by intersecting the sorted arrays; links merge components, and lists that have become one
  component are done, as are those all of whose allowed pairs were tested. The others go on with more proposals a member.

Rows moved are linear in the text; no list is expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import math
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import (
    BROADCAST_BYTES, forget, one_row_each, packed, release_shuffles, same_identity, small_batches, small_side, union_of,
    word_hashes, written)
from lineage_spark.llm.components import components

CONTRACTING_ROUNDS = 2
# proposals of one member in a list in the first round after those, and their growth a round: where few pairs are tested in vain all go at once
FIRST_TESTS, TESTS_GROWTH = 4, 8
BLOCK_MEMBERS = 2048
# texts that a task turns into grams before it hands them on
PIECE_TEXTS = 1000
# bits of a bitmap for each gram (rounded up to a power of two): with so many hardly a pair below the threshold is tested in vain, and
# a test moves two arrays of 64 bits a gram
BITMAP_FACTOR, MAX_BITMAP_BITS = 8, 1 << 15
# the same of a narrow bitmap: enough to part sets that share little, which most members of a list do
NARROW_FACTOR = 2
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S32)) * _M1
    return (x ^ (x >> _S29)) * _M2


def grams(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word ``n``-grams; a shorter text is one gram, one without words none."""
    h = word_hashes(text)
    if not len(h):
        return np.empty(0, np.uint64)
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out ^ h[i:len(h) - k + 1 + i]) + np.uint64(i)
    return np.unique(out)


def set_id(g: np.ndarray) -> int:
    """The identity of a set, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(g.tobytes()) - (1 << 63)


def _most_differences(a: int, b: int, percent: int) -> int:
    """The most grams in which linked sets of ``a`` and ``b`` grams differ."""
    return (a + b) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def _tile(k: int, percent: int) -> tuple[int, int, int, int]:
    """First and last size, number of segments and allowance of empty segments of tile ``k``."""
    first = 1
    for _ in range(k):
        first = max(first + 1, -(-first * 100 // percent))
    top = max(first + 1, -(-first * 100 // percent)) - 1
    last = top * 100 // percent
    most = _most_differences(top, last, percent)
    if most == 0:
        return first, last, 0, 0  # only equal sets can link
    spare = 1
    while spare < 8:
        segments = most + 1 + spare
        if segments * math.exp(-first / segments) < 0.25 * spare:
            break
        spare += 1
    return first, last, most + 1 + spare, spare


def _tiles_of(size: int, percent: int) -> list[int]:
    k, out = 0, []
    while _tile(k, percent)[0] <= size:
        if size <= _tile(k, percent)[1]:
            out.append(k)
        k += 1
    return out


@lru_cache(maxsize=100_000)
def _tiles_cached(size: int, percent: int) -> tuple[int, ...]:
    return tuple(_tiles_of(size, percent))


def _marked_keys(g: np.ndarray, percent: int) -> np.ndarray:
    """The list keys of a set: one per segment that is not empty, in each of its tiles. Their lowest bit is 0 in the tile of the set's
    own band, 1 where it only is a partner for smaller sets."""
    out = []
    mixed = _mix(g)
    tiles = _tiles_cached(len(g), percent)
    for k in tiles:
        _, _, segments, spare = _tile(k, percent)
        if not segments:
            continue
        seg = ((g >> _S32) * np.uint64(segments)) >> _S32
        start = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        salt = np.uint64(k * 0x1000003 + 1)
        keys = [_mix(np.add.reduceat(mixed, start) ^ _mix(seg[start] + (salt << _S32)))]
        if segments - len(start) > spare:
            empty = np.setdiff1d(np.arange(segments, dtype=np.uint64), seg[start])
            keys.append(_mix(_M2 ^ _mix(empty + (salt << _S32))))
        out.append((np.concatenate(keys) & ~np.uint64(1)) | np.uint64(k != tiles[-1]))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def segment_keys(g: np.ndarray, percent: int) -> np.ndarray:
    """The list keys of a set without the mark of :func:`_marked_keys`."""
    return _marked_keys(g, percent) & -2


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), PIECE_TEXTS):
            yield batch.iloc[at:at + PIECE_TEXTS]


def _described(n: int, percent: int):
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in _pieces(batches):
            size, sid, keys = [], [], []
            for t in batch["__text"]:
                g = grams(t, n)
                s = set_id(g)
                size.append(len(g))
                sid.append(s)
                keys.append(_marked_keys(g, percent) if s not in seen else np.empty(0, np.int64))
                seen.add(s)
            yield pd.DataFrame({"key": batch["key"].array, "tid": batch["tid"].array, "n": size, "sid": sid, "keys": keys})

    return describe


def _lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lists with two members or more, one of them of the tile's own band, from ``(marked, sid)`` rows sorted by both; equal lists once
    per task."""
    seen: set[int] = set()

    def emit(marked: np.ndarray, sid: np.ndarray):
        new = np.concatenate([[True], (marked[1:] != marked[:-1]) | (sid[1:] != sid[:-1])])
        marked, sid = marked[new], sid[new]
        key = marked & -2
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        name = _mix(np.add.reduceat(_mix(sid.view(np.uint64)), start) + size.astype(np.uint64)).view(np.int64)
        keep = np.flatnonzero((size > 1) & (marked[start] & 1 == 0))  # those of the own band come first
        keep = keep[np.unique(name[keep], return_index=True)[1]]
        keep = keep[[name[i] not in seen for i in keep]] if len(keep) else keep
        seen.update(name[keep].tolist())
        at = np.concatenate([np.arange(start[i], start[i] + size[i]) for i in keep]) if len(keep) else np.empty(0, np.int64)
        return pd.DataFrame({"list": np.repeat(name[keep], size[keep]), "sid": sid[at], "members": np.repeat(size[keep], size[keep])})

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        key, sid = batch["marked"].to_numpy(np.int64), batch["sid"].to_numpy(np.int64)
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1] & -2))  # the last key may go on in the next batch
        if cut == 0 and held and held[0][0][0] & -2 == key[0] & -2:
            held.append((key, sid))
            continue
        done = held + [(key[:cut], sid[:cut])]
        held = [(key[cut:], sid[cut:])]
        yield emit(np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])) if sum(
            len(d[0]) for d in done) else pd.DataFrame({"list": [], "sid": [], "members": []}).astype("int64")
    if held:
        yield emit(np.concatenate([d[0] for d in held]), np.concatenate([d[1] for d in held]))


def links_exactly(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted arrays: 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum()) if len(b) else 0
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _bitmap(g: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, bool)
    out[(g & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little")


def _bits_for(size: int, factor: int = BITMAP_FACTOR) -> int:
    bits = 64
    while bits < min(size * factor, MAX_BITMAP_BITS):
        bits <<= 1
    return bits


def _folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of equal width: a wider one (a power of two more) is folded, which keeps the bound."""
    width = min(len(b) for b in bitmaps)
    return np.stack([np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 8), axis=0) for b in bitmaps])


def _bound(n_i, n_j, ones_i, ones_j, both) -> np.ndarray:
    """The most grams that two sets can share: a bit that only one bitmap has stands for a gram that only its set has."""
    return np.minimum(n_i - (ones_i - both), n_j - (ones_j - both))


def _allowed(n_i, n_j, most, percent: int):
    return 100 * most >= percent * (n_i + n_j - most)


def _partners(n, sid, comp, outer, home, bitmaps, tried, percent: int, tests: int) -> Iterator[tuple]:
    """For every outer member of a tile, partners of other components that bit counts do not exclude and that it has not tried: the
    member's row, the partners' rows, and of each pair the share of common grams that the bit counts make likely.

    With ``tests`` only partners at home in this tile, and a pair of outer members only once.
    """
    order = np.lexsort((sid, n))
    n, sid, comp, outer, home = n[order], sid[order], comp[order], outer[order], home[order]
    bits = _folded([bitmaps[i] for i in order])
    ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    free = 1 - np.minimum(ones / (64 * bits.shape[1]), 0.99)  # share of the bits that are not set
    for i in np.flatnonzero(outer):
        lo = int(np.searchsorted(n, -(-n[i] * percent // 100)))
        hi = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
        fit = comp[lo:hi] != comp[i]
        if tests:
            fit &= home[lo:hi] & (~outer[lo:hi] | (sid[lo:hi] > sid[i]))
        j = lo + np.flatnonzero(fit)
        if not len(j):
            continue
        both = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
        ok = _allowed(n[i], n[j], _bound(n[i], n[j], ones[i], ones[j], both), percent)
        if tried[order[i]] is not None and len(tried[order[i]]):
            ok &= ~np.isin(sid[j], tried[order[i]])
        if not ok.any():
            continue
        j, both = j[ok], both[ok]
        common = (n[i] + n[j] - (ones[i] - both) / free[j] - (ones[j] - both) / free[i]) / 2
        yield order[i], order[j], common / (n[i] + n[j] - common)


def _proposals(n, sid, comp, outer, home, bitmaps, tried, percent: int, tests: int) -> list[tuple[int, int, int, int, bool]]:
    """The pairs of :func:`_partners` that are to be tested.

    With ``tests`` 0, to gather: one a member, the least id of those that seem to link by the expected overlap, else the likeliest one.
    Otherwise up to ``tests`` of the likeliest. Rows are (member, partner, their components, whether the member has more than these).
    None left: no pair of the member here can link.
    """
    out = []
    for i, j, share in _partners(n, sid, comp, outer, home, bitmaps, tried, percent, tests):
        if not tests:
            likely = 100 * share >= percent
            best = [np.argmin(np.where(likely, sid[j], np.iinfo(np.int64).max)) if likely.any() else np.argmax(share)]
        else:
            best = np.lexsort((sid[j], -share))[:tests]
        out += [(int(sid[i]), int(sid[j[k]]), int(comp[i]), int(comp[j[k]]), len(best) < len(j)) for k in best]
    return out


def _paired(n, sid, comp, outer, home, bitmaps, tried, percent: int, tests: int) -> list[tuple[int, int, bool, bool]]:
    """The members ``sid, comp, outer, home`` in a pair of :func:`_partners`. A narrow bitmap allows every pair that a wide one allows, so
    those left out have no proposal to make or to get."""
    hit = np.zeros(len(n), bool)
    for i, j, _ in _partners(n, sid, comp, outer, home, bitmaps, tried, percent, tests):
        hit[i] = hit[j] = True
    return [(int(sid[i]), int(comp[i]), bool(outer[i]), bool(home[i])) for i in np.flatnonzero(hit)]


PROPOSED = {"list": "int64", "block": "int32", "a": "int64", "b": "int64", "ca": "int64", "cb": "int64", "more": "bool"}
PLACED = {"list": "int64", "block": "int32", "sid": "int64", "comp": "int64", "outer": "bool", "home": "bool"}


def _by_tile(found_in, kinds: dict[str, str], percent: int, tests: int):
    """Streams rows sorted by tile through ``found_in``; a tile that goes on in the next batch is held until it ends."""
    columns = ["n", "sid", "comp", "outer", "home", "bitmap", "tried"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def emit(rows: pd.DataFrame) -> pd.DataFrame:
            tile = rows["list"].to_numpy(np.int64), rows["block"].to_numpy(np.int64)
            new = np.flatnonzero((np.diff(tile[0]) != 0) | (np.diff(tile[1]) != 0)) + 1
            values = [rows[c].to_numpy() for c in columns]
            found = []
            for lo, hi in zip(np.concatenate([[0], new]), np.append(new, len(rows))):
                found += [(tile[0][lo], tile[1][lo], *p) for p in found_in(*(v[lo:hi] for v in values), percent, tests)]
            return pd.DataFrame(found, columns=list(kinds)).astype(kinds)

        for batch in batches:
            if not len(batch):
                continue
            last = (batch["list"] == batch["list"].iloc[-1]) & (batch["block"] == batch["block"].iloc[-1])
            cut = int(last.to_numpy().argmax())
            if cut == 0 and held and (held[0]["list"].iloc[0], held[0]["block"].iloc[0]) == (batch["list"].iloc[0], batch["block"].iloc[0]):
                held.append(batch)
                continue
            done = pd.concat([*held, batch.iloc[:cut]])
            held = [batch.iloc[cut:]]
            if len(done):
                yield emit(done)
        if held:
            yield emit(pd.concat(held))

    return compare


class JaccardJoin:
    """Sets whose Jaccard similarity is at least ``percent`` / 100, as components of all rows of ``df``.

    Words are lower-cased (A-Z). A text of fewer than ``n`` words is one gram; a null, empty or blank text has the empty set,
    which links with nothing. Equal sets always link. Rows with a null key have no component id of their own;
    other columns of ``df`` are ignored. Two sets are told apart by 64-bit hashes of their grams.
    """

    def __init__(self, df: DataFrame, text: str = "text", key: str = "doc_id", n: int = 4, percent: int = 85):
        self.percent, self.n = percent, n
        self._df, self._text, self._key = df, text, key
        norm = F.coalesce(df[text], F.lit(""))
        docs = df.select(df[key].alias("key"), F.xxhash64(norm).alias("tid"), norm.alias("__text"))
        kind = df.schema[key].dataType.simpleString()
        self._texts = docs
        with small_batches(df.sparkSession):
            described = written(
                docs.mapInPandas(_described(n, percent), f"key {kind}, tid long, n long, sid long, keys array<long>"), "jaccard-sets")
            members = self._members(described)
            # the keys, most of these rows, have gone into the lists, and so has the shuffle of them
            self.docs = written(described.drop("keys"), "jaccard-sets")
            forget(described)
            release_shuffles(df.sparkSession)
            self.links = self._links(members)

    @staticmethod
    def _members(described: DataFrame) -> DataFrame:
        postings = described.select(F.explode("keys").alias("marked"), "sid")
        lists = postings.repartition(F.col("marked").bitwiseAND(F.lit(-2))).sortWithinPartitions("marked", "sid") \
            .mapInPandas(_lists, "list long, sid long, members long")
        return written(lists.distinct(), "jaccard-lists")

    def _arrays(self, members: DataFrame) -> DataFrame:
        """``sid, n, grams`` of the sets that are in a list, from one text each."""
        n = self.n
        # one row of each set: its least (key, text); only ids are shuffled, not arrays
        wanted = self.docs.join(members.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("key", "tid")).alias("one"))
        wanted = written(wanted.select("one.*").distinct(), "jaccard-state")
        small = wanted.count() * 24 <= BROADCAST_BYTES
        match = [self._texts["key"].eqNullSafe(wanted["key"]), self._texts["tid"] == wanted["tid"]]
        texts = self._texts.join(F.broadcast(wanted) if small else wanted, match, "left_semi").select("tid", "__text")

        def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seen = set()
            for batch in _pieces(batches):
                sid, size, out = [], [], []
                for tid, t in zip(batch["tid"], batch["__text"]):
                    if tid in seen:
                        continue
                    seen.add(tid)
                    g = grams(t, n)
                    sid.append(set_id(g))
                    size.append(len(g))
                    out.append(g.tobytes())
                yield pd.DataFrame({"sid": sid, "n": size, "grams": out})

        found = written(texts.mapInPandas(arrays, "sid long, n long, grams binary"), "jaccard-arrays")
        # rows that repeat both key and text can bring a set twice: then, and only then, the arrays are shuffled
        if found.groupBy("sid").count().where("count > 1").isEmpty():
            return found
        once = written(found.groupBy("sid").agg(F.first("n").alias("n"), F.first("grams").alias("grams")), "jaccard-arrays")
        forget(found)
        return once

    @staticmethod
    def _both_ends(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
        """The ``pairs`` (``a, b, ca, cb``, written out) with the ``columns`` of the row of each end, as ``<column>_a`` and ``<column>_b``."""
        # a few pairs go to the rows, instead of all rows to the pairs
        few = pairs.count() * 32 <= BROADCAST_BYTES
        sides = []
        for end in "ab":
            own = pairs.select(F.col(end).alias("sid"), "b" if end == "a" else "a", *(["ca", "cb"] if end == "a" else []))
            found = rows.select("sid", *[F.col(c).alias(f"{c}_{end}") for c in columns]).join(F.broadcast(own) if few else own, "sid")
            sides.append(found.withColumnRenamed("sid", end))
        return sides[0].join(sides[1], ["a", "b"]).select("a", "b", "ca", "cb", *[f"{c}_{end}" for c in columns for end in "ab"])

    def _possible(self, pairs: DataFrame, signatures: DataFrame) -> DataFrame:
        """The ``pairs`` that sizes and bitmaps allow."""
        percent = self.percent
        pairs = written(pairs, "jaccard-pairs")

        def allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = []
                for n_a, n_b, x, y in zip(batch["n_a"], batch["n_b"], batch["bitmap_a"], batch["bitmap_b"]):
                    x, y = _folded([x, y])
                    one, two, both = (int(np.bitwise_count(v).sum(dtype=np.int64)) for v in (x, y, x & y))
                    keep.append(bool(_allowed(n_a, n_b, _bound(n_a, n_b, one, two, both), percent)))
                yield batch.loc[np.array(keep, bool), ["a", "b", "ca", "cb"]]

        out = written(self._both_ends(pairs, signatures, "n", "bitmap").mapInPandas(allowed, "a long, b long, ca long, cb long"), "jaccard-pairs")
        forget(pairs)
        return out

    def _confirmed(self, pairs: DataFrame, arrays: DataFrame) -> DataFrame:
        """``u, v, cu, cv, linked`` for the pairs ``a, b, ca, cb``, by exact intersection."""
        percent = self.percent
        pairs = written(pairs, "jaccard-pairs")

        def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yes = [links_exactly(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                       for x, y in zip(batch["grams_a"], batch["grams_b"])]
                yield pd.DataFrame({"u": batch["a"], "v": batch["b"], "cu": batch["ca"], "cv": batch["cb"], "linked": yes})

        tests = self._both_ends(pairs, arrays, "grams").mapInPandas(exact, "u long, v long, cu long, cv long, linked boolean")
        done = written(tests, "jaccard-tests")
        forget(pairs)
        return done

    @staticmethod
    def _merged(rest: DataFrame, salt: int) -> DataFrame:
        """``rest`` with lists that share most of their members made one list: those whose member of least hash is the same, where that
        at least halves the rows and does not make more than twice as many pairs. A pair that shares a list before shares one after."""
        pivots = written(rest.groupBy("list").agg(
            F.min(F.xxhash64("sid", F.lit(salt))).alias("pivot"), F.count(F.lit(1)).alias("size")), "jaccard-lists")
        whole = pivots.groupBy("pivot").agg(F.sum("size").alias("rows"), F.sum(F.col("size") * F.col("size")).alias("pairs"))
        united = rest.join(small_side(pivots.select("list", "pivot"), 32), "list")
        sizes = united.select("pivot", "sid").distinct().groupBy("pivot").agg(F.count(F.lit(1)).alias("n"))
        good = written(whole.join(sizes, "pivot").where("2 * n <= rows and n * n <= 2 * pairs").select("pivot", "n"), "jaccard-lists")
        out = written(united.join(small_side(good, 32), "pivot", "left").select(
            F.when(F.col("n").isNotNull(), F.col("pivot")).otherwise(F.col("list")).alias("list"), "sid", "comp",
            F.coalesce("n", "members").alias("members")).distinct(), "jaccard-state")
        forget(rest, pivots, good)
        return out

    @staticmethod
    def _open(rest: DataFrame) -> DataFrame:
        """Members of the lists that are not one component yet."""
        rest = written(rest, "jaccard-state")
        lists = written(rest.groupBy("list").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("list"), "jaccard-lists")
        left = written(rest.join(small_side(lists, 16), "list", "left_semi"), "jaccard-state")
        forget(rest, lists)
        return left

    def _links(self, members: DataFrame) -> DataFrame:
        arrays = self._arrays(members)
        signatures = self._signatures(arrays)
        twos = members.where("members = 2").groupBy("list").agg(F.min("sid").alias("a"), F.max("sid").alias("b"))
        twos = twos.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")).distinct()
        likely = self._possible(twos, signatures)
        tested = [self._confirmed(likely, arrays)]  # one written table a round
        rest = self._joined(written(members.where("members > 2").select("list", "sid", F.col("sid").alias("comp"), "members"), "jaccard-state"), tested[0])
        forget(members, likely)
        for salt in (1, 2):
            rest = self._merged(rest, salt)
        turn = 0
        while not rest.isEmpty():
            # first one test a round for each member, towards the least id: close copies gather in one step; then several
            tests = 0 if turn < CONTRACTING_ROUNDS else FIRST_TESTS * TESTS_GROWTH ** (turn - CONTRACTING_ROUNDS)
            proposed, state = self._proposed(rest, union_of(tested), signatures, turn, tests)
            up = F.col("a") < F.col("b")
            pairs = proposed.select(
                F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                F.when(up, F.col("ca")).otherwise(F.col("cb")).alias("ca"), F.when(up, F.col("cb")).otherwise(F.col("ca")).alias("cb")).distinct()
            new = self._confirmed(pairs, arrays)
            tested.append(new)
            kept = rest
            if tests:
                # every allowed pair of the other lists has been tested by now: they are done
                unsettled = written(proposed.where("more").select("list").distinct(), "jaccard-lists")
                state.append(unsettled)
                kept = rest.join(small_side(unsettled, 16), "list", "left_semi")
            before, rest = rest, self._joined(kept, new)
            forget(before, proposed, *state)
            release_shuffles(self._df.sparkSession)
            turn += 1
        links = written(union_of(tested).where("linked").select("u", "v"), "jaccard-links")
        forget(arrays, signatures, *tested)
        return links

    def _joined(self, rest: DataFrame, new: DataFrame) -> DataFrame:
        """``rest`` with the components that the ``new`` links join labelled anew; only the open lists."""
        moved = components(new.where("linked").select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        rest = rest.join(small_side(moved, 32), rest["comp"] == moved["node"], "left")
        return self._open(rest.select("list", "sid", F.coalesce("component", "comp").alias("comp"), "members"))

    @staticmethod
    def _signatures(arrays: DataFrame) -> DataFrame:
        @F.pandas_udf("binary")
        def bitmap(g: pd.Series) -> pd.Series:
            return pd.Series([_bitmap(a, _bits_for(len(a))).tobytes() for a in (np.frombuffer(x, np.uint64) for x in g)])

        @F.pandas_udf("binary")
        def narrow(g: pd.Series) -> pd.Series:
            return pd.Series([_bitmap(a, _bits_for(len(a), NARROW_FACTOR)).tobytes() for a in (np.frombuffer(x, np.uint64) for x in g)])

        return written(arrays.select("sid", "n", bitmap("grams").alias("bitmap"), narrow("grams").alias("narrow")), "jaccard-bitmaps")

    def _proposed(self, rest: DataFrame, tested: DataFrame, signatures: DataFrame, turn: int, tests: int) -> tuple[DataFrame, list[DataFrame]]:
        """Proposals ``list, a, b, ca, cb, more`` (see :func:`_proposals`) and the state written for them.

        A list of more than ``BLOCK_MEMBERS`` is cut into blocks. The first rounds (``tests`` 0) contract: a member goes to one list only, the
        longest it is in (copies share it), and there to one random block, so a bitmap moves once a round. After them, in the lists that
        are still several components, members outside the list's main component go to all its blocks and members inside to one, so that
        every pair of different components meets. As a member is in many lists then, it goes there with its narrow bitmap, and with the
        wide one only to those where a partner is left.
        """
        if not tests:
            longest = rest.groupBy("sid").agg(F.max(F.struct("members", "list")).alias("most"))
            rest = rest.join(longest, "sid").where(F.col("list") == F.col("most.list")).drop("most")
        main = rest.groupBy("list", "comp").count().groupBy("list").agg(
            F.max_by("comp", F.struct("count", "comp")).alias("main"), F.sum("count").alias("total"))
        blocks = F.ceil(F.col("total") / F.lit(BLOCK_MEMBERS)).cast("int")
        main = written(main.select("list", "main", blocks.alias("blocks")), "jaccard-state")
        outer = F.col("comp") != F.col("main")
        own = F.pmod(F.xxhash64("sid", F.lit(turn)), F.col("blocks")).cast("int")
        block = F.when(outer, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own)) if tests else F.array(own)
        placed = rest.join(small_side(main, 32), "list").select(
            "list", "sid", "comp", outer.alias("outer"), own.alias("own"), F.explode(block).alias("block"))
        placed = written(placed.select("list", "sid", "comp", "outer", (F.col("own") == F.col("block")).alias("home"), "block"), "jaccard-state")
        refused = tested.where("not linked")
        refused = refused.select("u", "v").union(refused.select("v", "u"))
        tried = refused.groupBy(F.col("u").alias("sid")).agg(F.collect_set("v").alias("tried"))
        tried = F.broadcast(tried) if refused.count() * 64 <= BROADCAST_BYTES else tried

        def tiles(places: DataFrame, width: str) -> DataFrame:
            # few places go to the bitmaps, instead of all bitmaps to the places
            bitmaps = signatures.select("sid", "n", F.col(width).alias("bitmap"))
            return bitmaps.join(tried, "sid", "left").join(small_side(places, 32), "sid").repartition("list", "block") \
                .sortWithinPartitions("list", "block")

        state = [main, placed]
        if tests:
            placed = written(tiles(placed, "narrow").mapInPandas(
                _by_tile(_paired, PLACED, self.percent, tests), "list long, block int, sid long, comp long, outer boolean, home boolean"), "jaccard-state")
            state.append(placed)
            release_shuffles(self._df.sparkSession)
        proposed = written(tiles(placed, "bitmap").mapInPandas(
            _by_tile(_proposals, PROPOSED, self.percent, tests), "list long, block int, a long, b long, ca long, cb long, more boolean"), "jaccard-proposals")
        return proposed, state

    def _classed(self) -> DataFrame:
        comp = components(self.links)
        sets = self.docs.select("key", "tid", "n", "sid")
        return written(sets.join(comp, sets["sid"] == comp["node"], "left").select(
            "key", "tid", "n", F.when(F.col("n") > 0, F.coalesce("component", "sid")).alias("class")), "jaccard-state")

    def one_of_each(self) -> DataFrame:
        """The rows of ``df``, unchanged, with one row of each component: that of the least key (null first), of equal keys
        the one with the least text hash. Rows without words link with nothing and all stay."""
        identity = ["__key", "__tid"]
        classed = self._classed().where("n > 0").select(F.col("key").alias("__key"), F.col("tid").alias("__tid"), "class")
        least = written(classed.groupBy("class").agg(F.min(F.struct(*identity)).alias("least")), "jaccard-state")
        stays = F.col("least.__key").eqNullSafe(F.col("__key")) & (F.col("least.__tid") == F.col("__tid"))
        marked = written(classed.join(least, "class").groupBy(*identity, stays.alias("stays")).agg(F.count(F.lit(1)).alias("n")), "jaccard-state")
        gone, repeated = marked.where("not stays").select(*identity), marked.where("stays and n > 1").select(*identity)
        small = gone.count() * 32 <= BROADCAST_BYTES
        rows = packed(self._df, self._df[self._key].alias("__key"), F.xxhash64(F.coalesce(self._df[self._text], F.lit(""))).alias("__tid"))
        left = rows.join(F.broadcast(gone) if small else gone, same_identity(rows, gone, identity), "left_anti")
        return one_row_each(left, repeated, identity).select("__doc.*")

    def per_document(self) -> DataFrame:
        """``key``, ``n_shingles`` and ``component_id``: the least key that links reach."""
        classed = self._classed()
        least = written(classed.where("n > 0").groupBy("class").agg(F.min("key").alias("least")), "jaccard-state")
        return classed.join(least, "class", "left").select(
            "key", F.col("n").alias("n_shingles"), F.coalesce("least", "key").alias("component_id"))
