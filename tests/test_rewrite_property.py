"""Property: the folded rule expression equals a plain first-match-wins loop."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lineage_spark.operators import textlines
from lineage_spark.operators.textlines import COMMENT_PREFIX, Rule

WORDS = ["ab", "bc", "x", "yy", "z1"]

line_st = st.lists(st.sampled_from(WORDS + [" ", "-"]), min_size=0, max_size=8).map("".join)
rule_st = st.tuples(
    st.sampled_from(WORDS),
    st.sampled_from(["substitute", "comment", "replace", "drop"]),
    st.sampled_from(["Q", "", "R9"]),
)


def expected(line, rules):
    for pat, action, repl in rules:
        if re.search(pat, line):
            if action == "substitute":
                return re.sub(pat, repl, line)
            if action == "comment":
                return COMMENT_PREFIX + line
            if action == "replace":
                return repl
            return None
    return line


@settings(max_examples=12, deadline=None)
@given(lines=st.lists(line_st, min_size=1, max_size=12), rules=st.lists(rule_st, min_size=1, max_size=5))
def test_rewrite_matches_python_loop(spark, lines, rules):
    df = spark.createDataFrame([(1, i + 1, l) for i, l in enumerate(lines)], "doc long, line_no int, line string")
    rule_objs = [Rule(i + 1, p, a, r) for i, (p, a, r) in enumerate(rules)]
    got = {r["line_no"]: r["line"] for r in textlines.rewrite(df, rule_objs).collect()}
    want = {i + 1: expected(l, rules) for i, l in enumerate(lines)}
    assert got == {k: v for k, v in want.items() if v is not None}
