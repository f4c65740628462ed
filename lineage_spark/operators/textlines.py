"""Ordered line operators and the rule-driven line rewriter.

Line tables are ``(id, line_no, line)``. All lines of one id come from one source
row (see :mod:`lineage_spark.sources.lines`), so a window partitioned by the id is
bounded by the size of one input value (:func:`carry_forward`). Groups that may be huge (per user, per customer) and marker sections use the
distributed scans of :mod:`lineage_spark.operators.ordering` instead.

The rewriter applies an ordered rule list to each line: the first rule whose
pattern matches decides the action. Rules are plain data and are folded into one
``CASE WHEN`` projection at plan time, so a line table of any size is read once,
with no join and no UDF. A rule list is small by nature (tens of rules): it is what a
user writes, and it becomes part of the query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
COMMENT_PREFIX = "# auto removed: "
STATE_TOKEN = "{state}"
ACTIONS = ("substitute", "comment", "replace", "drop", "capture", "state")


@dataclass(frozen=True)
class Rule:
    """One rewrite rule.

    ``pattern`` is a Java regex tested with ``rlike``. Actions:

    * ``substitute`` – replace every match of ``target`` (default: ``pattern``)
      by ``replacement`` (``$1`` groups allowed);
    * ``comment`` – prefix the line with ``# auto removed: ``;
    * ``replace`` – the whole line becomes ``replacement``;
    * ``drop`` – the line is removed;
    * ``capture`` – the line becomes ``replacement`` filled from the groups of the
      first match (e.g. ``saveRDS\\((\\S+),`` with ``return($1)``);
    * ``state`` – like ``substitute``, with ``{state}`` in ``replacement`` taken
      from the carried state column (``state`` names it per rule; see
      :func:`carry_forward`).
    """

    pos: int
    pattern: str
    action: str
    replacement: str | None = None
    target: str | None = None
    state: str | None = None  # column carrying this rule's state (default: the rewrite's)

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}")


def rules_from_frame(df: DataFrame) -> list[Rule]:
    """Rules from a ``(pos, pattern, action, replacement[, target])`` table (small)."""
    has_target = "target" in df.columns
    return [
        Rule(r["pos"], r["pattern"], r["action"], r["replacement"], r["target"] if has_target else None)
        for r in df.collect()
    ]


def _escape_replacement(c: Column) -> Column:
    # a carried value inserted into a regex replacement must be literal
    return F.regexp_replace(c, r"([\\$])", r"\\$1")


def _action(rule: Rule, line: Column, state: Column | None) -> Column:
    if rule.action == "substitute":
        return F.regexp_replace(line, F.lit(rule.target or rule.pattern), F.lit(rule.replacement or ""))
    if rule.action == "comment":
        return F.concat(F.lit(COMMENT_PREFIX), line)
    if rule.action == "replace":
        return F.lit(rule.replacement or "")
    if rule.action == "drop":
        return F.lit(None).cast("string")
    if rule.action == "capture":
        pat = rule.target or rule.pattern
        return F.regexp_replace(F.regexp_extract(line, pat, 0), F.lit(pat), F.lit(rule.replacement or ""))
    # state
    if rule.state:
        state = F.col(rule.state)
    if state is None:
        raise ValueError("a state rule needs a state column")
    head, _, tail = (rule.replacement or "").partition(STATE_TOKEN)
    repl = F.concat(F.lit(head), _escape_replacement(F.coalesce(state, F.lit(""))), F.lit(tail))
    return F.regexp_replace(line, F.lit(rule.target or rule.pattern), repl)


def rewrite_expr(rules: list[Rule], line: Column, state: Column | None = None, default: Rule | None = None) -> Column:
    """The folded first-match-wins expression (null means: drop the line)."""
    ordered = sorted(rules, key=lambda r: r.pos)
    # nested CASE WHENs, last rule innermost: Catalyst reduces the pushed-down
    # "line is not null" filter of dropped lines to the drop rules' own tests
    # (measured faster than one flat CASE WHEN, which it evaluates twice)
    out = _action(default, line, state) if default else line
    for rule in reversed(ordered):
        out = F.when(line.rlike(rule.pattern), _action(rule, line, state)).otherwise(out)
    return out


def rewrite(lines: DataFrame, rules: list[Rule], line_col: str = "line", state_col: str | None = None,
            default: Rule | None = None) -> DataFrame:
    """Apply the rules to every line; dropped lines disappear, positions stay."""
    state = F.col(state_col) if state_col else None
    out = lines.withColumn(line_col, rewrite_expr(rules, F.col(line_col), state, default))
    return out.filter(F.col(line_col).isNotNull())


def carry_forward(lines: DataFrame, key: str, order: str, value: Column, out: str) -> DataFrame:
    """``out`` = the last non-null ``value`` at or before each line of the key."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(out, F.last(value, ignorenulls=True).over(w))


def first_match(df: DataFrame, group: list[str], order: str, cond: Column, value: str) -> DataFrame:
    """Per group, the first row (by ``order``) satisfying ``cond``: ``group + [order, value]``.

    An aggregate (``min_by``), so it is combined partially before the shuffle.
    """
    return (
        df.filter(cond)
        .groupBy(*group)
        .agg(F.min(order).alias(order), F.min_by(value, order).alias(value))
    )


def section_body(df: DataFrame, group: list[str], order: str, value: str, sep: str = "\n",
                 out: str = "body") -> DataFrame:
    """The section text: values joined in ``order``.

    The result holds the whole section as one value, so its size is the section's
    size; that is the output itself. A very large section is joined in chunks
    (see :func:`lineage_spark.operators.ordering.ordered_join`).
    """
    from lineage_spark.operators.ordering import ordered_join

    return ordered_join(df, group, order, value, sep, out)
