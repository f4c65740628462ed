"""Scalar column helpers (all built-in Spark expressions, whole-stage codegen).

Patterns are Java regexes; keep shared patterns free of look-around and use ASCII
classes so the same pattern means the same thing in other engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_capture(col, pattern: str, group: int = 1) -> Column:
    """First match's ``group`` ('' when no match), the look-around-free form of
    a ``str_match`` with look-behind/ahead."""
    return F.regexp_extract(_c(col), pattern, group)


def first_match_or_null(col, pattern: str) -> Column:
    """Whole first match, null when there is none."""
    return F.nullif(F.regexp_extract(_c(col), pattern, 0), F.lit(""))


def replace_all(col, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(_c(col), pattern, replacement)


def replace_first(col, pattern: str, replacement: str) -> Column:
    """Replace only the first match (``sub``): everything before it is kept by a
    lazy prefix group. ``pattern`` must not contain capture groups."""
    return F.regexp_replace(_c(col), "(?s)^(.*?)" + pattern, "$1" + replacement)


def tokens(col, sep: str = " +") -> Column:
    """Trimmed text split on a separator regex."""
    return F.split(F.trim(_c(col)), sep)


def first_token(col, sep: str = " +") -> Column:
    return F.try_element_at(tokens(col, sep), F.lit(1))


def last_token(col, sep: str = " +") -> Column:
    return F.try_element_at(tokens(col, sep), F.lit(-1))


def nth_field(col, sep: str, n: int) -> Column:
    """The n-th (1-based) field between literal separators, '' when absent."""
    return F.split_part(_c(col), F.lit(sep), F.lit(n))


def quoted_token(col) -> Column:
    """First double-quoted substring."""
    return nth_field(col, '"', 2)


def strip_leading_slash(col) -> Column:
    return F.regexp_replace(_c(col), "^/", "")


def strip_url_tail(col) -> Column:
    """URL without its query string or fragment."""
    return F.regexp_replace(_c(col), "[?#].*$", "")


def basename(col) -> Column:
    """Last ``/``-separated token of a path ('' for a trailing slash)."""
    return F.element_at(F.split(_c(col), "/"), -1)


def clean_token_text(col) -> Column:
    """``=`` to space, ``"`` and ``,`` removed, runs of spaces collapsed, trimmed."""
    t = F.translate(_c(col), "=", " ")
    t = F.regexp_replace(t, '[",]', "")
    return F.trim(F.regexp_replace(t, " +", " "))


def first_containing(arr, needle: str) -> Column:
    """First array element containing ``needle`` (null when none)."""
    return F.try_element_at(F.filter(_c(arr), lambda x: x.contains(needle)), F.lit(1))


def prefix_paths(arr, base: str) -> Column:
    """Every element with ``base/`` in front."""
    return F.transform(_c(arr), lambda x: F.concat(F.lit(base + "/"), x))


def call_arguments(col, call: str) -> Column:
    """All ``call(...)`` argument texts of a string, quotes and spaces removed,
    cut at the first comma (``library("x", character.only=TRUE)`` gives ``x``)."""
    raw = F.regexp_extract_all(_c(col), F.lit(call + r"\(([^)]*)\)"), F.lit(1))
    return F.transform(raw, lambda x: F.substring_index(F.regexp_replace(x, "[\"' ]", ""), ",", 1))
