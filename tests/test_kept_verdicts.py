"""Assertions on a history are kept per run, and follow its content."""

import pytest
from test_history import rows
from test_run_tables import schema  # noqa: F401

from claimgauge.operators import assertions as A
from claimgauge.operators.history import FIELD_KEY
from claimgauge.operators.kept_verdicts import KeptVerdicts
from claimgauge.operators.run_tables import RunTable

EXPECTED = A.Expectation(FIELD_KEY, ("run_id", "payer", "field_name"), ("n",))


@pytest.fixture
def kept(spark, schema):  # noqa: F811
    history = RunTable(spark, f"{schema}.field_history", FIELD_KEY)
    return KeptVerdicts(spark, f"{schema}.field_verdicts", history, EXPECTED)


def listed(frame):
    return sorted((tuple(sorted(r.asDict().items(), key=str)) for r in frame.collect()), key=str)


def agrees_with_the_whole(kept):
    """What is kept adds up to a report on all rows."""
    tables = {"h": (kept.history.read(), EXPECTED)}
    assert listed(kept.unique("h")) == listed(A.unique_report(tables))
    assert listed(kept.missing("h")) == listed(A.missing_report(tables))
    whole = A.bounds_report(tables).selectExpr("* except (least, greatest)", "cast(least as double) as least", "cast(greatest as double) as greatest")
    assert listed(kept.bounds("h")) == listed(whole)


def test_a_second_report_reads_the_new_run_only(spark, kept):
    kept.history.upsert(rows(spark, "r1", 1, ("P", "f", 1), (None, "f", 200), ("P", "g", -1)))
    assert kept.refresh() == ["run-r1"]
    agrees_with_the_whole(kept)
    kept.history.upsert(rows(spark, "r2", 2, ("P", "f", 50)))
    stale = kept.stale()
    assert list(stale) == ["run-r2"]
    read = kept._checked(stale).inputFiles()
    assert read and all("run_label=run-r2" in f for f in read)
    agrees_with_the_whole(kept)
    assert kept.refresh() == []


def test_a_run_that_is_stored_again_is_checked_again(spark, kept):
    kept.history.upsert(rows(spark, "r1", 1, ("P", "f", 1)).unionByName(rows(spark, "r1", 1, ("P", "f", 2))))
    kept.history.upsert(rows(spark, "r'2", 2, (None, "f", 101)))
    agrees_with_the_whole(kept)
    assert [r.failing_keys for r in kept.unique("h").collect()] == [1]
    kept.history.upsert(rows(spark, "r1", 1, ("P", "f", 3)), replace_run=True)
    assert kept.refresh() == ["run-r1"]
    agrees_with_the_whole(kept)
    assert [r.failing_keys for r in kept.unique("h").collect()] == [0]


def test_keys_are_unique_over_all_timestamps_of_a_run(spark, kept):
    kept.history.upsert(rows(spark, "r1", 1, ("P", "f", 1), ("P", "g", 1)))
    kept.history.upsert(rows(spark, "r1", 2, ("P", "f", 1)))
    assert len(kept.history.runs()) == 2
    agrees_with_the_whole(kept)
