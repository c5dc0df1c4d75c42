"""A member-month that holds most claim lines must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from claimgauge.operators import reconciliation as R
from claimgauge.operators.diagnostics import mismatch_reason
from claimgauge.sources.tables import Sources

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def hot(small_partitions):
    """40,000 lines, half of them of one member in one month."""
    spark = small_partitions
    claims = spark.range(0, 40_000, 1, 8).selectExpr(
        "'S' as data_source",
        "'P' as payer",
        "'HMO' as plan",
        "case when id % 2 = 0 then 'hot' else concat('m', id % 500) end as person_id",
        "concat('claim', id) as claim_id",
        "cast(1.25 as decimal(18,2)) as paid_amount",
        "date '2020-03-05' as claim_line_start_date",
        "date '2020-03-05' as claim_start_date",
    )
    # The hot member is listed many times as well.
    months = spark.range(0, 5_000, 1, 8).selectExpr(
        "'S' as data_source",
        "'P' as payer",
        "'HMO' as plan",
        "case when id % 2 = 0 then 'hot' else concat('m', id % 250) end as person_id",
        "'202003' as year_month",
    )
    calendar = spark.sql(
        "select date '2020-03-05' as full_date, 5 as day, 202003 as year_month_int, '2020-03' as year_month"
    )
    return Sources.from_frames(
        {
            "core__medical_claim": claims,
            "core__member_months": months,
            "reference_data__calendar": calendar,
        }
    )


def final_plan(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join", [R.with_enrollment, R.without_enrollment])
def test_hot_member_month_is_split(hot, join):
    lines = R.dated_claims(hot)
    rows, plan = final_plan(join(lines, R.enrolled_member_months(hot)).select("claim_id", "person_id"))
    assert "skew=true" in plan
    # m1, m3 ... m249 are enrolled, m251 ... m499 are not.
    enrolled = 20_000 + 10_000
    assert len(rows) == (enrolled if join is R.with_enrollment else 40_000 - enrolled)


def test_monthly_metrics_split_the_hot_member_and_count_exactly(hot):
    rows, plan = final_plan(R.claim_metrics(hot))
    assert "skew=true" in plan
    (row,) = rows
    assert (row.claims, row.claim_lines, row.members_with_claims) == (30_000, 30_000, 126)
    assert float(row.paid_amount) == 30_000 * 1.25
    assert float(row.paid_amount_without_enrollment) == 40_000 * 1.25


def test_reasons_of_a_hot_unmatched_member_are_split(hot):
    others = hot.table("core__member_months").where("person_id <> 'hot'")
    rows, plan = final_plan(mismatch_reason(hot.overlay({"core__member_months": others})))
    assert "skew=true" in plan
    (row,) = rows
    assert (row.mismatch_reason, row.dropped_rows, row.dropped_claims) == (
        "No enrollment for person/month", 30_000, 30_000,
    )


def test_member_months_are_counted_with_repeats(hot):
    (row,) = R.member_month_metrics(hot).collect()
    assert (row.member_months, row.members) == (5_000, 126)


def test_combined_metrics_equal_the_separate_ones(hot):
    combined = R.claim_metrics(hot)
    separate = R.enrolled_claim_metrics(hot).join(R.paid_without_enrollment(hot), list(R.MONTH_GRAIN))
    assert combined.select(sorted(combined.columns)).exceptAll(
        separate.select(sorted(separate.columns))
    ).count() == 0
    assert combined.agg(F.count("*")).first()[0] == 1


def test_no_claim_line_is_multiplied_to_count_distinct_values(hot):
    """Spark's way to count several distinct columns is an Expand; it may only see claims that are added up."""
    for frame in (R.enrolled_claim_metrics(hot), R.claim_metrics(hot)):
        lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        (at,) = [i for i, line in enumerate(lines) if "Expand [" in line]
        assert any("Aggregate [" in line and "claim_id" in line for line in lines[at + 1 : at + 3])


def test_flags_take_two_sorts(hot):
    frame = mismatch_reason(hot)
    plan = final_plan(frame)[1].partition("== Initial Plan ==")[0]
    windows = [line for line in plan.splitlines() if "Window [" in line]
    sorts = [line for line in plan.splitlines() if "Sort [person_id" in line and "is_claim" not in line]
    assert len(windows) == 4
    assert len([line for line in sorts if "month_index" in line or "year_month_int" in line and "coalesce" not in line]) == 2


def test_enrollment_is_shuffled_once_for_all_that_share_it(hot):
    R.enrolled_claim_metrics(hot).collect()
    rows, plan = final_plan(R.member_month_metrics(hot))
    assert "id % 250" not in plan and "Scan parquet" in plan
    assert len(rows) == 1


def test_sums_of_sums_keep_the_type_of_a_sum(hot):
    paid = R.paid_without_enrollment(hot).schema["paid_amount_without_enrollment"].dataType.simpleString()
    assert paid == "decimal(28,2)"
    assert R.enrolled_claim_metrics(hot).schema["paid_amount"].dataType.simpleString() == paid
    both = R.claim_metrics(hot).schema
    assert {both[c].dataType.simpleString() for c in ("paid_amount", "paid_amount_without_enrollment")} == {paid}
