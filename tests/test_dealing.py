"""What a task sorts and groups doesn't grow with the table: rows are dealt over tasks by their number."""

import os

import pytest

from quorumdf import dealing, plans
from quorumdf.views import VIEWS, Civic

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", ["d07_tally_mismatch", "d11_official_as_petitioner", "d11_official_as_petitioner_whole", "e02_surname_as_of", "p07_wealth_by_year", "t05_segment_islands"])
def test_more_rows_go_to_more_tasks(spark, monkeypatch, name):
    monkeypatch.setattr(dealing, "ROWS", 150)
    plan = plans.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    rows = spark.read.parquet(f"{DATA}/{'orders' if name.startswith('d11') else 'lineitem'}.parquet").count()
    assert f", {-(-rows // 150)}), REPARTITION_BY_NUM" in plan


def test_motion_text_is_motion_without_tallies(spark):
    c = Civic(spark, DATA)
    text = c.motion_text
    assert set(c.motion.columns) - set(text.columns) == {"tally_yes", "tally_no", "tally_abstain"} and "tally" not in VIEWS["motion_text"]
    whole = c.motion.select(text.columns)
    assert text.exceptAll(whole).isEmpty() and whole.exceptAll(text).isEmpty()


def test_settled_views_are_read_by_those_that_build_on_them(spark):
    c = Civic(spark, DATA).settle("vote")
    plan = c.motion._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan
    plain = Civic(spark, DATA).motion
    assert c.motion.exceptAll(plain).isEmpty() and plain.exceptAll(c.motion).isEmpty()
