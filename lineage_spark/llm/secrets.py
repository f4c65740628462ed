"""Secret scans: fixed patterns, and character Markov models that find further random strings. DataFrame operations only.

Two first-order character models are counted from labelled strings, one of random strings and one of ordinary
identifiers. A candidate (a long run of key characters with letters and digits) is reported when its log-likelihood ratio, random
against ordinary, is high enough in all and per character. The counts (two tables of ``len(ALPHABET) + 1`` squared) make one literal array.

Positions are code points. They come from the pieces between matches (``split``) and the matches themselves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.llm.common import hash_sample

# fixed values: the patterns of the base kinds, in order
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: runs are matched whole
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 characters or more
MIN_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
MIN_TOTAL, MIN_PER_CHARACTER = 12.0, 0.35
RANDOM_SAMPLES = 2000
ORDINARY_DOCS = 2000
_STATES = len(ALPHABET) + 1  # 0: any other character


def _spans(text: Column, pattern: str, value_group: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost non-overlapping matches."""
    lit = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    found = F.regexp_extract_all(text, lit, F.lit(0))
    value = F.regexp_extract_all(text, lit, F.lit(value_group)) if value_group else found
    pieces = F.arrays_zip(gaps.alias("gap"), F.transform(found, lambda m: F.length(m)).alias("len"), value.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        # the last piece is the text after the last match
        span = F.struct(begin.alias("start"), (begin + p["len"]).alias("end"), p["value"].alias("value"))
        return F.struct(
            (begin + F.coalesce(p["len"], F.lit(0))).alias("at"),
            F.when(p["len"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(pieces, start, step, lambda acc: acc["out"])).otherwise(empty)


def _states(token: Column) -> Column:
    """Character numbers: the place in ``ALPHABET``, 0 for any other character."""
    return F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))


def _pairs(token: Column) -> Column:
    """Numbers of the character pairs of a token."""
    s = _states(token)
    n = F.size(s)
    return F.zip_with(F.slice(s, F.lit(1), n - 1), F.slice(s, F.lit(2), n - 1), lambda a, b: a * F.lit(_STATES) + b)


@dataclass
class MarkovModel:
    """Log-likelihood ratio (random against ordinary) of each character pair."""

    ratios: list[float]

    def ratio(self, token: Column) -> Column:
        table = F.array(*[F.lit(r) for r in self.ratios])
        return F.aggregate(_pairs(token), F.lit(0.0), lambda a, p: a + F.get(table, p))


def train(samples: DataFrame) -> MarkovModel:
    """Fit on ``sample`` (string) and ``label`` (1: random string, 0: ordinary identifier).

    Null samples and labels and samples of fewer than two characters count for nothing; with an empty class every ratio is 0.
    """
    pairs = samples.where("label in (0, 1) and length(sample) > 1").select("label", F.explode(_pairs(F.col("sample"))).alias("pair"))
    counts = {0: [0] * (_STATES * _STATES), 1: [0] * (_STATES * _STATES)}
    for r in pairs.groupBy("label", "pair").count().collect():  # at most two rows per pair of characters
        counts[r["label"]][r["pair"]] = r["count"]
    if not any(counts[0]) or not any(counts[1]):
        return MarkovModel([0.0] * (_STATES * _STATES))
    out = []
    for a in range(_STATES):
        rows = [counts[k][a * _STATES:(a + 1) * _STATES] for k in (0, 1)]
        totals = [sum(r) for r in rows]
        # add-half smoothing, so an unseen pair is unlikely but not impossible
        out += [math.log((rows[1][b] + 0.5) / (totals[1] + 0.5 * _STATES)) - math.log((rows[0][b] + 0.5) / (totals[0] + 0.5 * _STATES))
                for b in range(_STATES)]
    return MarkovModel(out)


def random_strings(spark: SparkSession, n: int = RANDOM_SAMPLES) -> DataFrame:
    """Labelled random strings: digests of a counter in base 64, in hexadecimal and in upper-case base-36 letters."""
    digest = F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")).cast("binary"), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(digest)), "[=\\r\\n]", "")
    upper = F.upper(F.substring(F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", ""), 1, 24))
    kinds = F.array(base64, F.substring(digest, 1, 40), upper)
    return spark.range(n).select(F.explode(kinds).alias("sample"), F.lit(1).alias("label"))


def ordinary_identifiers(df: DataFrame, text: str = "text", key: str = "doc_id", max_docs: int = ORDINARY_DOCS) -> DataFrame:
    """Labelled ordinary words of at most ``max_docs`` texts (of smallest id hash; those in which a base pattern matches are
    left out), alone and joined by ``/``, ``-`` and ``_`` as in names and paths."""
    some = hash_sample(df.select(df[key].alias("k"), df[text].alias("t")), max_docs, F.col("k"))
    some = some.where(F.col("t").isNotNull() & ~F.col("t").rlike(ACCESS) & ~F.col("t").rlike(HEX) & ~F.col("t").rlike(ASSIGN))
    words = some.select(F.regexp_extract_all("t", F.lit(r"[A-Za-z0-9+/_-]{4,}"), F.lit(0)).alias("w"))
    # names and paths as programs write them: neighbouring words joined, some with a number
    fours = words.select(F.posexplode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - 3), F.lit(4)), lambda i: F.slice("w", i, 4))).alias("i", "four"))
    numbered = F.concat(F.array_join("four", "_"), F.lit("_"), F.pmod("i", F.lit(100)).cast("string"))
    joined = fours.select(F.explode(F.array(F.array_join("four", "/"), F.array_join("four", "-"), numbered)).alias("sample"))
    return words.select(F.explode("w").alias("sample")).union(joined).select("sample", F.lit(0).alias("label"))


def find_secrets(df: DataFrame, model: MarkovModel, text: str = "text") -> DataFrame:
    """``df`` with ``base_spans`` and ``all_spans``: arrays of ``start, rank, end`` (rank: place in ``KINDS``), by start.

    Null counts as an empty text, which has no spans. A random string that overlaps a base span is not reported again. Columns
    already so named are replaced.
    """
    t = F.coalesce(df[text], F.lit(""))

    def ranked(spans: Column, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    assigned = F.filter(_spans(t, ASSIGN, 2), lambda s: F.length(s["value"]) >= MIN_ASSIGNED)
    base = F.array_sort(F.concat(ranked(assigned, 0), ranked(_spans(t, ACCESS), 1), ranked(_spans(t, HEX), 2)))
    with_base = df.withColumn("base_spans", base)

    def secret(s: Column) -> Column:
        token = s["value"]
        mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
        ratio = model.ratio(token)
        apart = ~F.exists("base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return mixed & apart & (ratio >= F.greatest(F.lit(MIN_TOTAL), F.length(token) * F.lit(MIN_PER_CHARACTER)))

    found = ranked(F.filter(_spans(t, CANDIDATE), secret), 3)
    return with_base.withColumn("all_spans", F.array_sort(F.concat("base_spans", found)))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")
