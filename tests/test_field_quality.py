"""Counting: gates, repeated reference codes, both lookup paths, plan shape."""

from collections import Counter

import pytest

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import catalog as C
from claimgauge.operators.code_sets import counted_keys, pack
from claimgauge.operators.field_quality import (
    GRAIN,
    _count_by_value,
    _counts,
    completeness_summary,
    field_summaries,
    validity_summary,
    verdict,
)
from claimgauge.sources.sample_claims import RELATIONS, sample_sources
from claimgauge.sources.tables import Sources

RUN = RunMeta("r", "2025-01-02 00:00:00")
AS_OF = "2025-01-01"


@pytest.fixture(scope="module")
def sample(spark, small_dir):
    return sample_sources(spark, small_dir)


def test_catalogue_is_complete():
    assert Counter(c.model for c in C.COMPLETENESS) == {C.ELIGIBILITY: 2, C.MEDICAL: 17, C.PHARMACY: 1}
    assert Counter(c.model for c in C.VALIDITY) == {C.ELIGIBILITY: 14, C.MEDICAL: 27, C.PHARMACY: 8}
    assert sum(len(c.code_sets) for c in C.VALIDITY) == 24
    for checks in (C.COMPLETENESS, C.VALIDITY):
        assert len({(c.model, c.field) for c in checks}) == len(checks)
    for check in C.VALIDITY:
        assert check.field in RELATIONS[check.model][1]
        assert check.terminology_table and check.terminology_field


def listed(frame):
    return sorted((r.asDict() for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def validity(sample):
    return listed(validity_summary(sample, RUN, as_of=AS_OF))


@pytest.mark.parametrize("limit", [0, 8_000])
def test_lookups_do_not_depend_on_the_broadcast_limit(sample, validity, limit):
    assert listed(validity_summary(sample, RUN, as_of=AS_OF, broadcast_limit=limit)) == validity


def test_counters_add_up(sample, validity):
    for row in validity:
        assert row["applicable_rows"] + row["not_applicable_rows"] == row["total_rows"]
        assert row["null_rows"] + row["valid_rows"] + row["invalid_rows"] == row["applicable_rows"]
        assert row["non_null_rows"] == row["valid_rows"] + row["invalid_rows"]
    for row in listed(completeness_summary(sample, RUN)):
        counted = row["null_rows"] + row["non_null_rows"] + row["not_applicable_rows"]
        assert counted == row["total_rows"]


def test_sets_beyond_the_limit_are_not_broadcast(sample):
    sets = sorted({s for c in C.VALIDITY for s in c.code_sets}, key=lambda s: s.name)
    packed = pack(sample, sets)
    assert packed.places.keys() == set(sets)
    # Only sets without a single code fit into nothing.
    full = {r.set_no for r in packed.counted.select("set_no").distinct().collect()}
    assert {packed.numbers[s] for s in pack(sample, sets, limit=0).places}.isdisjoint(full)
    some = pack(sample, sets, limit=8_000).places.keys()
    assert set() < some < set(sets)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]


def test_all_fields_probe_one_broadcast(spark, sample):
    plan = final_plan(validity_summary(sample, RUN, C.only(C.VALIDITY, model=C.MEDICAL), AS_OF))
    assert plan.count("BroadcastHashJoin") > 10
    built = [x for x in plan.splitlines() if "BroadcastExchange HashedRelationBroadcastMode(List(input[0, string" in x]
    assert len([x for x in built if "ReusedExchange" not in x]) == 1


def test_large_sets_take_one_shuffled_join(spark, sample):
    checks = C.only(C.VALIDITY, model=C.MEDICAL)
    plan = validity_summary(sample, RUN, checks, AS_OF, broadcast_limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter, ((set_no") == 1


def test_one_pass_gives_both_summaries(sample, validity):
    complete, valid = field_summaries(sample, RUN, AS_OF)
    assert listed(valid) == validity
    assert listed(complete) == listed(completeness_summary(sample, RUN))


def medical(spark, rows):
    """One row per (claim_type, drg_code_type, drg_code, hcpcs_code)."""
    frame = spark.createDataFrame(rows, "claim_type string, drg_code_type string, drg_code string, hcpcs_code string")
    return frame.selectExpr("'S' as data_source", "'P' as payer", "cast(null as string) as plan", "*")


def sets(spark, **codes):
    return {
        f"terminology__{name}": spark.createDataFrame([(v,) for v in values], f"{column} string")
        for name, (column, values) in codes.items()
    }


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_drg_uses_the_set_of_its_type(spark, limit):
    rows = [
        ("institutional", "ms-drg", "m", None),  # valid
        ("institutional", "apr-drg", "a", None),  # valid
        ("institutional", "ms-drg", "a", None),  # only in the other set
        ("institutional", "other", "both", None),
        ("institutional", None, "both", None),
        ("institutional", "ms-drg", "", None),  # null
        ("institutional", "apr-drg", None, None),  # null
        (None, "apr-drg", "both", None),  # unknown gate: checked, valid
        ("professional", "ms-drg", "both", None),  # not applicable
    ]
    sources = Sources.from_frames(
        {C.MEDICAL: medical(spark, rows)}
        | sets(spark, ms_drg=("ms_drg_code", ["m", "both"]), apr_drg=("apr_drg_code", ["a", "both"]))
    )
    checks = C.only(C.VALIDITY, kind="drg")
    (row,) = validity_summary(sources, RUN, checks, AS_OF, limit).collect()
    assert (row.total_rows, row.not_applicable_rows, row.null_rows, row.valid_rows, row.invalid_rows) == (
        9, 1, 2, 3, 3,
    )
    assert row.plan is None
    assert row.valid_rows_applicable_pct == pytest.approx(100 * 3 / 8)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_repeated_codes_inflate_every_class(spark, limit):
    rows = [(None, None, None, code) for code in ("A", "A", "B", "", "", None, "Z")]
    sources = Sources.from_frames(
        {C.MEDICAL: medical(spark, rows)}
        | sets(spark, hcpcs_level_2=("hcpcs", ["A", "A", "A", "B", "", "", None, None]))
    )
    checks = [c for c in C.VALIDITY if c.field == "hcpcs_code"]
    (row,) = validity_summary(sources, RUN, checks, AS_OF, limit).collect()
    # A twice, three copies; B once; '' twice, two copies; NULL once; Z once.
    assert (row.valid_rows, row.null_rows, row.invalid_rows, row.total_rows) == (7, 5, 1, 13)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_codes_of_other_types_are_compared_as_text(spark, limit):
    rows = spark.sql("select 'S' as data_source, 'P' as payer, 'X' as plan, 1 as claim_type, code as hcpcs_code from values (12), (13), (null) as t(code)")
    sources = Sources.from_frames({C.MEDICAL: rows} | sets(spark, hcpcs_level_2=("hcpcs", ["12"])))
    checks = [c for c in C.VALIDITY if c.field == "hcpcs_code"]
    (row,) = validity_summary(sources, RUN, checks, AS_OF, limit).collect()
    assert (row.valid_rows, row.invalid_rows, row.null_rows) == (1, 1, 1)
    (row,) = completeness_summary(sources, RUN, [c for c in C.COMPLETENESS if c.field == "hcpcs_code"]).collect()
    assert (row.non_null_rows, row.null_rows) == (2, 1)


def test_state_values_are_distinct_over_three_columns(spark):
    states = spark.createDataFrame(
        [("N1", "One", "01"), ("N1", "N1", "01"), ("N2", None, "02")],
        "ansi_fips_state_abbreviation string, ansi_fips_state_name string, ansi_fips_state_code string",
    )
    (check,) = C.only(C.VALIDITY, kind="in_any_column")
    keys = counted_keys(Sources.from_frames({check.code_sets[0].table: states}), check.code_sets[0])
    assert {(r.key, r.copies) for r in keys.collect()} == {(k, 1) for k in ("N1", "One", "01", "N2", "02")}


def test_empty_source_gives_no_rows(spark, sample):
    empty = sample.overlay({m: sample.table(m).limit(0) for m in C.MODELS})
    assert completeness_summary(empty, RUN).count() == 0
    assert validity_summary(empty, RUN, as_of=AS_OF).count() == 0


def test_default_as_of_is_today(spark):
    rows = spark.sql(
        "select 'S' as data_source, 'P' as payer, 'X' as plan, d as birth_date"
        " from values (current_date()), (date_sub(current_date(), 1)) as t(d)"
    )
    checks = [c for c in C.VALIDITY if c.field == "birth_date"]
    (row,) = validity_summary(Sources.from_frames({C.ELIGIBILITY: rows}), RUN, checks).collect()
    assert (row.valid_rows, row.invalid_rows) == (1, 1)


def test_each_source_is_scanned_once(spark, sample, tmp_path):
    """All 27 checks of a table share one scan, and only their columns are read."""
    path = str(tmp_path / "medical")
    sample.table(C.MEDICAL).write.parquet(path)
    sources = sample.overlay({C.MEDICAL: spark.read.parquet(path)})
    checks = C.only(C.VALIDITY, model=C.MEDICAL)
    plan = validity_summary(sources, RUN, checks, AS_OF)._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "claim_type" in line]
    assert len(scans) == 1
    assert plan.count("BroadcastHashJoin") == 18
    few = completeness_summary(sources, RUN, [c for c in C.COMPLETENESS if c.field == "hcpcs_code"])
    scan = [x for x in few._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in x]
    assert len(scan) == 1 and "diagnosis_code_1" not in scan[0]


def test_the_loop_over_rows_is_small_enough_to_be_compiled(spark, sample, tmp_path):
    """The JVM interprets generated methods of 8000 bytes and more."""
    path = str(tmp_path / "medical")
    sample.table(C.MEDICAL).write.parquet(path)
    sources = sample.overlay({C.MEDICAL: spark.read.parquet(path)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = validity_summary(sources, RUN, C.only(C.VALIDITY, model=C.MEDICAL), AS_OF)
        debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
        stages = getattr(debug, "MODULE$").codegenStringSeq(rows._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = [(stages.apply(i)._1(), stages.apply(i)._3()) for i in range(stages.size())]
    loops = [
        size.maxMethodCodeSize()
        for tree, size in found
        if "HashAggregate" in tree.splitlines()[0] and "FileScan parquet [data_source" in tree
    ]
    assert len(loops) == 1 and loops[0] < 8000


def test_a_check_with_one_set_beyond_the_limit_looks_up_both(spark):
    """Both sets of drg_code are found where only the smaller one may be broadcast."""
    rows = [("institutional", "ms-drg", "m", None), ("institutional", "apr-drg", "a7", None), ("institutional", "ms-drg", "a7", None)]
    sources = Sources.from_frames(
        {C.MEDICAL: medical(spark, rows)}
        | sets(spark, ms_drg=("ms_drg_code", ["m"]), apr_drg=("apr_drg_code", [f"a{i}" for i in range(50)]))
    )
    used = {s for c in C.only(C.VALIDITY, kind="drg") for s in c.code_sets}
    assert len(pack(sources, used, limit=1_000).places) == 1
    (row,) = validity_summary(sources, RUN, C.only(C.VALIDITY, kind="drg"), AS_OF, 1_000).collect()
    assert (row.valid_rows, row.invalid_rows) == (2, 1)


def test_values_of_large_sets_travel_as_narrow_rows(spark, sample):
    """A value is shuffled with a number of its group, not with source, payer and plan, and is not aggregated before."""
    checks = C.only(C.VALIDITY, model=C.MEDICAL)
    plan = validity_summary(sample, RUN, checks, AS_OF, broadcast_limit=0)._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "lambdafunction" not in plan
    grouped = [x for x in plan.splitlines() if "HashAggregate(keys=[" in x and "value#" in x.partition("functions=")[0]]
    assert grouped == []


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_a_failed_gate_counts_the_copies_of_a_code(spark, limit):
    rows = [("professional", "ms-drg", code, None) for code in ("m", "z", "", None)] + [("institutional", "ms-drg", "m", None)]
    sources = Sources.from_frames(
        {C.MEDICAL: medical(spark, rows)} | sets(spark, ms_drg=("ms_drg_code", ["m", "m", "m", "", ""]), apr_drg=("apr_drg_code", ["a"]))
    )
    (row,) = validity_summary(sources, RUN, C.only(C.VALIDITY, kind="drg"), AS_OF, limit).collect()
    # not applicable: m three times, z once, '' twice, NULL once
    assert (row.total_rows, row.not_applicable_rows, row.null_rows, row.valid_rows) == (10, 7, 0, 3)


@pytest.mark.parametrize(("codes", "found"), [(["m", "n"], 0), (["m", "m"], 1)])
def test_values_whose_gate_fails_travel_only_to_repeated_codes(spark, codes, found):
    """A set that lists every code once adds nothing to a row that has counted already."""
    sources = Sources.from_frames(
        {C.MEDICAL: medical(spark, [("professional", "ms-drg", "m", None), ("professional", "ms-drg", "z", None)])}
        | sets(spark, ms_drg=("ms_drg_code", codes), apr_drg=("apr_drg_code", ["a"]))
    )
    checks = C.only(C.VALIDITY, kind="drg")
    table = sources.table(C.MEDICAL)
    grains = table.select(*GRAIN).distinct().selectExpr("*", "0L as grain")
    packed = pack(sources, {s for c in checks for s in c.code_sets}, limit=0)
    assert len(_count_by_value(table, checks, packed, grains).collect()) == found


def test_what_is_filled_is_counted_with_what_is_looked_up():
    """Both summaries of a code too large to broadcast take the same aggregates, so that a row has fewer than 100."""
    known = {c.field: c for c in C.only(C.VALIDITY, kind="in_reference", model=C.MEDICAL)}
    for check in C.only(C.COMPLETENESS, model=C.MEDICAL):
        if check.field in known:
            beside = _counts(verdict(known[check.field], AS_OF, "false"), None)
            assert _counts(verdict(check, AS_OF), None) == beside
