"""Monthly reconciliation on small tables worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import reconciliation as R
from claimgauge.sources.tables import Sources

RUN = RunMeta("r", "2025-01-02 00:00:00")
D = dt.date


def sources(spark, claims, months, first="2019-11-01", last="2020-06-30"):
    return Sources.from_frames(
        {
            "core__medical_claim": spark.createDataFrame(
                claims,
                "data_source string, payer string, plan string, person_id string, claim_id string,"
                " claim_line_start_date date, claim_start_date date, paid_amount decimal(18,2)",
            ),
            "core__member_months": spark.createDataFrame(
                months, "data_source string, payer string, plan string, person_id string, year_month string"
            ),
            "reference_data__calendar": spark.sql(
                f"select d as full_date, day(d) as day, year(d) * 100 + month(d) as year_month_int,"
                f" date_format(d, 'yyyy-MM') as year_month"
                f" from (select explode(sequence(date '{first}', date '{last}')) as d)"
            ),
        }
    )


def line(person, claim, day, paid, payer="P", plan="X", other_day=None):
    return ("S", payer, plan, person, claim, day, other_day, None if paid is None else Decimal(paid))


@pytest.fixture(scope="module")
def simple(spark):
    claims = [
        line("a", "c1", D(2020, 1, 5), "10.00"),
        line("a", "c1", D(2020, 1, 9), "5.00"),
        line("a", "c2", None, "2.50", other_day=D(2020, 1, 7)),
        line("b", "c3", D(2020, 1, 7), "100.00"),  # b is not enrolled in January
        line("a", "c4", D(2020, 4, 1), None),  # enrolled, amount unknown
        line("b", "c5", D(2030, 1, 1), "7.00"),  # beyond the calendar
        line("b", "c6", None, "9.00"),  # no date
        line(None, "c7", D(2020, 1, 5), "3.00"),
        line("a", "c8", D(2020, 2, 2), "4.00", payer=None),
    ]
    months = [
        ("S", "P", "X", "a", "202001"),
        ("S", "P", "X", "a", "202001"),
        ("S", "P", "X", "b", "202004"),
        ("S", "P", "X", "a", "202004"),
        ("S", "P", "X", None, "202001"),
        ("S", None, "X", "a", "202002"),
        ("S", None, "X", "a", "202003"),
    ]
    return sources(spark, claims, months)


def by_month(frame, payer):
    return {r.year_month_int: r for r in frame.collect() if r.payer == payer}


def test_measures_and_ratios(simple):
    rows = by_month(R.monthly_summary(simple, RUN), "P")
    assert sorted(rows) == [202001, 202002, 202003, 202004]
    january = rows[202001]
    assert (january.member_months, january.members) == (3, 1)
    assert (january.claims, january.claim_lines, january.members_with_claims) == (2, 3, 1)
    assert january.paid_amount == Decimal("17.50")
    assert january.paid_amount_without_enrollment == Decimal("120.50")
    assert january.pct_members_with_claims == pytest.approx(1 / 3)
    assert january.claims_per_1000 == pytest.approx(2000 / 3)
    assert january.pmpm_paid == pytest.approx(17.5 / 3)
    assert january.pmpm_paid_without_enrollment == pytest.approx(120.5 / 3)
    assert january.avg_paid_per_claim == pytest.approx(17.5 / 2)
    assert january.year_month == "2020-01" and january.run_id == "r"
    assert january.tuva_last_run == january.run_ts


def test_idle_months_are_zero_and_their_ratios_unknown(simple):
    idle = by_month(R.monthly_summary(simple, RUN), "P")[202002]
    assert (idle.member_months, idle.claims, idle.paid_amount) == (0, 0, 0)
    assert idle.claims_per_1000 is None and idle.avg_paid_per_claim is None


def test_unknown_amount_counts_as_a_line(simple):
    april = by_month(R.monthly_summary(simple, RUN), "P")[202004]
    assert (april.claims, april.claim_lines, april.paid_amount) == (1, 1, 0)


def test_unknown_payer_has_months_but_no_measures(simple):
    rows = by_month(R.monthly_summary(simple, RUN), None)
    assert sorted(rows) == [202002, 202003]
    for row in rows.values():
        assert (row.member_months, row.members, row.claims, row.paid_amount_without_enrollment) == (0,) * 4
        assert row.pmpm_paid is None


def test_rows_are_those_of_the_spine(simple):
    summary = R.monthly_summary(simple, RUN).select(*R.MONTH_GRAIN, "year_month")
    spine = R.month_spine(simple)
    assert summary.exceptAll(spine).count() == 0
    assert spine.exceptAll(summary).count() == 0


@pytest.mark.parametrize(
    "months",
    [
        ["201911", "202002"],  # across a year
        ["201913", "202002"],  # 13 is no month: the range starts with January 2020
        ["202000", "202003"],
        ["202002", "202015"],
        ["202001", "202013", "202015"],
        ["199999", "202003", "999999"],
        ["-5", "202003", "2147483647"],
        ["202003"],
        ["202099"],
        ["201001", "209912"],  # wider than the calendar
    ],
)
def test_spine_and_summary_agree_with_the_plain_range(spark, months):
    found = sources(spark, [], [("S", "P", "X", "a", m) for m in months])
    low, high = min(map(int, months)), max(map(int, months))
    calendar = [201911, 201912, *range(202001, 202007)]
    expected = [m for m in calendar if low <= m <= high]
    assert sorted(r.year_month_int for r in R.month_spine(found).collect()) == expected
    rows = {r.year_month_int: r.member_months for r in R.monthly_summary(found, RUN).collect()}
    assert sorted(rows) == expected
    assert rows == {m: months.count(str(m)) for m in expected}


def test_month_must_be_readable(spark):
    found = sources(spark, [], [("S", "P", "X", "a", "2020-01")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        R.member_months(found).collect()
