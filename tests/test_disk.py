"""Shuffle files go with the write that needed them, and values travel in passes of a bounded size."""

import time

import pytest

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import catalog as C
from claimgauge.operators import field_quality as Q
from claimgauge.operators.history import FIELD_KEY
from claimgauge.operators.run_tables import RunTable
from claimgauge.sources.sample_claims import sample_sources
from claimgauge.sources.scratch import _CLEAN_UP, discard, shuffles_removed, stage

RUN = RunMeta("r", "2025-01-02 00:00:00")
AS_OF = "2025-01-01"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_by(spark, write):
    """Shuffle files that are there after ``write`` and were not before; Spark may take a moment to remove them."""
    before = shuffle_files(spark)
    write()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def counted(spark):
    return spark.range(0, 1000, 1, 4).selectExpr("id % 7 as k").groupBy("k").count()


def test_a_staged_table_leaves_no_shuffle_files(spark):
    frame = counted(spark)
    assert left_by(spark, lambda: discard(stage(frame, "counted"))) == set()
    assert spark.conf.get(_CLEAN_UP) == "false"  # as it was
    assert sorted(r["count"] for r in frame.collect()) == [142] + [143] * 6


def test_the_setting_is_restored(spark):
    spark.conf.set(_CLEAN_UP, "true")
    try:
        with pytest.raises(RuntimeError), shuffles_removed(spark):
            raise RuntimeError
        assert spark.conf.get(_CLEAN_UP) == "true"
    finally:
        spark.conf.unset(_CLEAN_UP)


def test_a_kept_run_leaves_no_shuffle_files_of_its_summary(spark, tmp_path):
    schema = f"disk_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"create schema {schema} location '{tmp_path}/store'")
    try:
        table = RunTable(spark, f"{schema}.field_history", FIELD_KEY)
        rows = counted(spark).selectExpr(
            "'r1' as run_id", "timestamp'2025-01-02 00:00:00' as run_ts", "'S' as data_source", "'P' as payer",
            "'X' as plan", "'m' as model_name", "cast(k as string) as field_name", "count",
        )
        assert left_by(spark, lambda: table.table.write(rows.selectExpr("*", "'run-r1' as run_label", "'at1' as run_stamp"))) == set()
        table.upsert(rows)
        assert table.latest().count() == 7
    finally:
        spark.sql(f"drop schema {schema} cascade")


def listed(frame):
    return sorted((r.asDict() for r in frame.collect()), key=str)


@pytest.mark.parametrize(("most", "jobs"), [(10**9, 0), (1, 23)])
def test_values_are_counted_in_passes_with_the_same_result(spark, small_dir, monkeypatch, most, jobs):
    """With room for one field a pass, each of the 23 fields that are looked up is a job of its own."""
    staged = []
    monkeypatch.setattr(Q, "stage", lambda frame, name: staged.append(name) or stage(frame, name))
    sample = sample_sources(spark, small_dir)
    whole = listed(Q.validity_summary(sample, RUN, as_of=AS_OF))
    staged.clear()
    monkeypatch.setattr(Q, "MAX_VALUES", most)
    assert listed(Q.validity_summary(sample, RUN, as_of=AS_OF, broadcast_limit=0)) == whole
    assert staged.count("values") == jobs


def test_a_pass_has_no_more_values_than_allowed(spark, monkeypatch):
    counters = [(f, False, 10 * i, i, 2 * i) for i, f in enumerate(["drg_code", "hcpcs_code", "rendering_npi", "billing_npi"], 1)]
    beside = spark.createDataFrame(
        [*counters, ("drg_code", True, 99, 0, 0)],
        "field_name string, is_completeness boolean, total_rows long, not_applicable_rows long, null_rows long",
    )
    checks = [c for c in C.only(C.VALIDITY, model=C.MEDICAL) if c.field in {x[0] for x in counters}]
    repeated = {s for c in checks if c.field == "hcpcs_code" for s in c.code_sets}
    codes = Q.sets.PackedCodes(repeated=repeated)
    values = {"drg_code": 7, "hcpcs_code": 16, "rendering_npi": 21, "billing_npi": 28}  # repeated codes: gated values travel
    for most in (1, 25, 40, 72):
        monkeypatch.setattr(Q, "MAX_VALUES", most)
        passes = Q._passes(beside, checks, codes)
        assert sorted(c.field for some, _ in passes for c in some) == sorted(values)
        for some, size in passes:
            assert size == sum(values[c.field] for c in some)
            assert size <= most or len(some) == 1
    assert len(passes) == 1
