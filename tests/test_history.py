"""Keyed history of official runs."""

import pytest

from claimgauge.operators import history as H
from claimgauge.operators.history import FIELD_KEY, History
from claimgauge.sources.scratch import shared_folder, stage

def rows(spark, run_id, day, *values):
    """values: (payer, field, n)"""
    listed = [(run_id, "S", payer, None, "m", field, n) for payer, field, n in values]
    frame = spark.createDataFrame(
        listed, "run_id string, data_source string, payer string, plan string, model_name string, field_name string, n bigint"
    )
    return frame.selectExpr("run_id", f"timestamp '2025-01-{day:02d} 00:00:00' as run_ts", "* except (run_id)")


@pytest.fixture
def history(spark, tmp_path):
    return History(spark, str(tmp_path / "history"), FIELD_KEY)


def content(frame):
    return sorted(((r.run_id, r.payer, r.field_name, r.n) for r in frame.collect()), key=str)


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, history):
    history.upsert(rows(spark, "r1", 1, ("P", "f", 1), (None, "f", 2), ("P", "g", 3)))
    history.upsert(rows(spark, "r2", 2, ("P", "f", 10)))
    history.upsert(rows(spark, "r1", 1, ("P", "f", 4), (None, "f", 5), ("P", "h", 6)))
    assert content(history.read()) == content_of(
        ("r1", "P", "f", 4), ("r1", None, "f", 5), ("r1", "P", "g", 3), ("r1", "P", "h", 6), ("r2", "P", "f", 10)
    )


def content_of(*wanted):
    return sorted(wanted, key=str)


def test_storing_a_run_again_changes_nothing(spark, history):
    again = rows(spark, "r1", 1, ("P", "f", 1), (None, "f", 2))
    history.upsert(again)
    before = content(history.read())
    history.upsert(again)
    history.upsert(history.latest())
    assert content(history.read()) == before


def test_replace_run_drops_vanished_keys(spark, history):
    history.upsert(rows(spark, "r1", 1, ("P", "f", 1), ("P", "g", 2)))
    history.upsert(rows(spark, "r1", 1, ("P", "f", 3)), replace_run=True)
    assert content(history.read()) == [("r1", "P", "f", 3)]


def test_nothing_is_kept_unless_persisted(spark, history):
    new = rows(spark, "r1", 1, ("P", "f", 1))
    history.upsert(new, persist=False)
    with pytest.raises(FileNotFoundError):
        history.read()
    assert history.read(like=new).count() == 0
    assert history.latest(like=new).columns == new.columns
    assert history.latest(like=new).count() == 0


def test_latest_and_previous_ignore_older_runs(spark, history):
    history.upsert(rows(spark, "r0", 1, ("P", "f", 0)))
    history.upsert(rows(spark, "r2", 3, ("P", "f", 2)))
    history.upsert(rows(spark, "r1", 2, ("P", "f", 1), (None, "g", 1)))
    assert content(history.latest()) == [("r2", "P", "f", 2)]
    assert content(history.previous()) == content_of(("r1", "P", "f", 1), ("r1", None, "g", 1))
    ranks = {r.run_id: r.run_rank for r in H.ranked_runs(history.read()).collect()}
    assert ranks == {"r2": 1, "r1": 2, "r0": 3}


def test_run_id_breaks_ties_of_the_timestamp(spark, history):
    history.upsert(rows(spark, "a", 1, ("P", "f", 1)).unionByName(rows(spark, "b", 1, ("P", "f", 2))))
    assert content(history.latest()) == [("b", "P", "f", 2)]
    assert content(history.previous()) == [("a", "P", "f", 1)]


def test_previous_of_a_single_run_is_empty(spark, history):
    history.upsert(rows(spark, "r1", 1, ("P", "f", 1)))
    assert history.previous().count() == 0


def test_run_ids_stay_text(spark, history):
    for day, run_id in enumerate(("007", "7", "2025-01-01", "a/b c=%", "1e3"), start=1):
        history.upsert(rows(spark, run_id, day, ("P", "f", day)))
    assert {r.run_id for r in history.read().collect()} == {"007", "7", "2025-01-01", "a/b c=%", "1e3"}
    assert content(history.latest()) == [("1e3", "P", "f", 5)]
    history.upsert(rows(spark, "007", 1, ("P", "f", 9)))
    assert ("007", "P", "f", 9) in content(history.read())
    assert history.read().count() == 5


def test_new_columns_are_added_and_lost_ones_kept(spark, history):
    from pyspark.sql import functions as F

    history.upsert(rows(spark, "r1", 1, ("P", "f", 1), ("P", "g", 2)))
    history.upsert(rows(spark, "r2", 2, ("P", "f", 3)).withColumn("extra", F.lit(1.5)))
    history.upsert(rows(spark, "r1", 1, ("P", "f", 4)).drop("n").withColumn("extra", F.lit(2.5)))
    found = {(r.run_id, r.field_name): (r.n, r.extra) for r in history.read().collect()}
    assert found == {("r1", "f"): (None, 2.5), ("r1", "g"): (2, None), ("r2", "f"): (3, 1.5)}


def test_only_touched_runs_are_rewritten(spark, history, tmp_path):
    history.upsert(rows(spark, "r1", 1, ("P", "f", 1)))
    untouched = sorted(p.name for p in (tmp_path / "history" / "run_label=run-r1").glob("*.parquet"))
    history.upsert(rows(spark, "r2", 2, ("P", "f", 1)))
    assert untouched == sorted(p.name for p in (tmp_path / "history" / "run_label=run-r1").glob("*.parquet"))


def delta_rows(spark, run_id, *values):
    """values: (data_source, payer, plan, field, total, invalid)"""
    frame = spark.createDataFrame(
        [(run_id, *v) for v in values],
        "run_id string, data_source string, payer string, plan string, field_name string,"
        " total_rows bigint, invalid_rows bigint",
    )
    return frame.selectExpr(
        "run_id", "timestamp '2025-01-01 00:00:00' as run_ts", "data_source", "payer", "plan",
        "'m' as model_name", "field_name", "'t' as terminology_table", "'c' as terminology_field",
        "total_rows", "invalid_rows", "100D * invalid_rows / total_rows as invalid_rows_pct",
        "100D * (total_rows - invalid_rows) / total_rows as valid_rows_pct",
    )


def test_delta_counts_a_missing_side_as_zero(spark):
    latest = delta_rows(spark, "r2", ("S", None, "X", "f", 10, 2), ("S", "P", "X", "new", 4, 1))
    previous = delta_rows(spark, "r1", ("S", "", "X", "f", 8, 4), ("S", "P", "X", "old", 5, 5))
    found = {r.field_name: r for r in H.validity_run_delta(latest, previous).collect()}
    assert set(found) == {"f", "new", "old"}
    f = found["f"]  # unknown and empty payer are one key; the latest row names it
    assert (f.payer, f.latest_total_rows, f.previous_total_rows, f.delta_total_rows) == ("", 10, 8, 2)
    assert f.delta_invalid_rows_pct == pytest.approx(-30)
    assert (found["new"].previous_run_id, found["new"].delta_total_rows) == (None, 4)
    assert (found["old"].latest_run_id, found["old"].delta_invalid_rows) == (None, -5)


def test_scratch_tables_go_to_the_folder_the_session_names(spark, checkpoint_dir):
    assert shared_folder(spark).removeprefix("file:").startswith(checkpoint_dir)
    staged = stage(rows(spark, "r1", 1, ("P", "f", 1)), "probe")
    assert staged.count() == 1
    assert all(checkpoint_dir in name for name in staged.inputFiles())
