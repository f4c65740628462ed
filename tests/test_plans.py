"""Physical-plan properties behind the scale claims, read from ``explain()``."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from lineage_spark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_python(spark, name):
    plan = plan_text(entry.queries()[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in plan]


def test_rewrite_is_one_pass(spark):
    plan = plan_text(entry.queries()["rewrite_first_match"](spark, SF))
    assert "Exchange" not in plan


def test_row_diff_shuffles_once(spark):
    plan = plan_text(entry.queries()["row_diff"](spark, SF))
    exchanges = re.findall(r"^\(\d+\) Exchange$", plan, flags=re.M)
    assert len(exchanges) == 1 and "hashpartitioning" in plan


def test_workbook_filter_reaches_the_scan(spark):
    plan = plan_text(entry.queries()["run_workbook"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
