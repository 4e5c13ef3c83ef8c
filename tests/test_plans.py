"""Scale properties of every registered plan, read from ``explain("formatted")``.

These pin down what the design promises: no Python evaluation, no cartesian
products or nested-loop joins, every window
partitioned (except the per-partition offsets of ``assign_ids``), and the
calendar predicates pushed into the Parquet scan.
"""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from wardline.plans.analogues import QUERIES

SF = "/root/testdata/sf0.001"
ONE_ROW_NESTED_LOOP: set[str] = set()  # maxima and counts are scalar subqueries, not joins
UNPARTITIONED_WINDOW = {"assign_ids"}  # running sum over one row per partition
PUSHED_RANGE = {
    "roster_flag": "GreaterThanOrEqual(o_orderdate,",
    "not_assigned": "GreaterThanOrEqual(o_orderdate,",
    "gap_to_max": "GreaterThanOrEqual(o_orderdate,",
    "weekly_roster": "GreaterThanOrEqual(l_shipdate,",
}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(fn(spark, SF)) for name, fn in E.queries().items() if name in QUERIES}


def test_no_python_and_no_cartesian(plans):
    for name, text in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct"):
            assert node not in text, (name, node)


def test_nested_loop_joins_only_against_one_row(plans):
    users = {name for name, text in plans.items() if "BroadcastNestedLoopJoin" in text}
    assert users <= ONE_ROW_NESTED_LOOP


def test_windows_are_partitioned(plans):
    for name, text in plans.items():
        for first in re.findall(r"windowspecdefinition\(([^,]+),", text):
            unpartitioned = " ASC NULLS" in first or " DESC NULLS" in first or first.startswith("specifiedwindowframe")
            assert not unpartitioned or name in UNPARTITIONED_WINDOW, (name, first)


def test_calendar_ranges_reach_the_scan(plans):
    for name, needle in PUSHED_RANGE.items():
        pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\]", plans[name]))
        assert needle in pushed, (name, pushed)


def test_large_text_column_is_not_read(plans):
    # documents.text can hold 20,000 words per row; the timeline report never needs it
    schema = re.findall(r"ReadSchema: (struct<doc_id[^\n]*)", plans["entity_timeline"])
    assert schema and all("text:" not in s for s in schema)
