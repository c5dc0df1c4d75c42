"""Diagnostics against plain Python over every pair, on small random tables."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from claimgauge.operators import diagnostics as G
from claimgauge.operators import enrollment_match as E
from claimgauge.operators import member_diagnostics as P
from claimgauge.sources.tables import Sources

CUTOFF = 202003
SOURCE = "S1"
CLAIM = (
    "data_source string, payer string, plan string, person_id string, claim_id string,"
    " claim_line_start_date date, claim_start_date date, paid_amount decimal(18,2)"
)
MONTH = "data_source string, payer string, plan string, person_id string, year_month string"


def random_tables(seed):
    pick = random.Random(seed)
    sources, payers, plans = ["S1", "S2", None], ["P", " p ", "Q", None], ["X", "x", "Y", ""]
    people = ["a", "b", "c", None]
    days = [dt.date(2019, 11, 30), dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 2, 29), dt.date(2020, 3, 1), None]
    claims = [
        (
            pick.choice(sources), pick.choice(payers), pick.choice(plans), pick.choice(people),
            f"c{pick.randrange(25)}", pick.choice(days), pick.choice(days),
            pick.choice([Decimal("10.00"), Decimal("-4.50"), Decimal("7.25"), None]),
        )
        for _ in range(250)
    ]
    texts = ["201910", "201911", "201912", "202001", "202002", "202003", "202000", "201913", "2020-01", "", None]
    months = [
        (pick.choice(sources), pick.choice(payers), pick.choice(plans), pick.choice(people), pick.choice(texts))
        for _ in range(60)
    ]
    return claims, months


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    claims, months = random_tables(request.param)
    frames = Sources.from_frames(
        {
            "core__medical_claim": spark.createDataFrame(claims, CLAIM),
            "core__member_months": spark.createDataFrame(months, MONTH),
        }
    )
    lines = []
    for source, payer, plan, person, claim, first, second, paid in claims:
        day = first or second
        if day and paid is not None:
            lines.append((source, payer, plan, person, claim, day, paid, day.year * 100 + day.month))
    enrolled = {
        (source, payer, plan, person, int(text))
        for source, payer, plan, person, text in months
        if text and text.isdigit()
    }
    return frames, lines, enrolled


def same(*pairs):
    return all(a is not None and a == b for a, b in pairs)


def number(month):
    return month // 100 * 12 + month % 100


def exact(line, enrolled):
    source, payer, plan, person, _, _, _, month = line
    return any(
        same((e[0], source), (e[1], payer), (e[2], plan), (e[3], person), (e[4], month)) for e in enrolled
    )


def near(e, month):
    return 1 <= e[4] % 100 <= 12 and abs(number(e[4]) - number(month)) <= 1


def reason(line, enrolled):
    source, payer, plan, person, _, _, _, month = line
    mine = [e for e in enrolled if same((e[3], person))]
    now = [e for e in mine if e[4] == month]
    if person is None:
        return "NULL person_id"
    if any(same((e[0], source), (e[1], payer)) for e in now):
        return "Plan mismatch"
    if any(same((e[0], source)) for e in now):
        return "Payer mismatch"
    if now:
        return "Data source mismatch"
    if any(same((e[0], source), (e[1], payer), (e[2], plan)) and near(e, month) for e in mine):
        return "Enrollment month off by +/-1"
    return "No enrollment for person/month"


def test_mismatch_reason(case):
    frames, lines, enrolled = case
    expected = defaultdict(lambda: [Decimal(0), 0, set()])
    for x in lines:
        if x[7] < CUTOFF and not exact(x, enrolled):
            group = expected[x[7], reason(x, enrolled)]
            group[0] += x[6]
            group[1] += 1
            group[2].add(x[4])
    found = {
        (r.claim_year_month_int, r.mismatch_reason): (r.dropped_paid, r.dropped_rows, r.dropped_claims)
        for r in G.mismatch_reason(frames, CUTOFF).collect()
    }
    assert found == {k: (paid, n, len(ids)) for k, (paid, n, ids) in expected.items()}
    assert len({k[1] for k in found}) >= 5


def test_normalization_recovery(case):
    frames, lines, enrolled = case

    def norm(values):
        return tuple((v or "").strip(" ").upper() for v in values)

    expected = defaultdict(lambda: [Decimal(0), set()])
    for x in lines:
        found = any(
            same((e[3], x[3]), (e[4], x[7])) and norm(e[:3]) == norm(x[:3]) for e in enrolled
        )
        if x[7] < CUTOFF and found and not exact(x, enrolled):
            expected[x[7]][0] += x[6]
            expected[x[7]][1].add(x[4])
    found = {
        r.claim_year_month_int: (r.recovered_paid, r.recovered_claims)
        for r in G.normalization_recovery(frames, CUTOFF).collect()
    }
    assert found == {k: (paid, len(ids)) for k, (paid, ids) in expected.items() if paid > 0}


def totals(lines, enrolled, key):
    groups = defaultdict(lambda: [Decimal(0), Decimal(0)])
    for x in lines:
        groups[key(x)][0 if exact(x, enrolled) else 1] += x[6]
    return groups


def test_dropoff(case):
    frames, lines, enrolled = case
    early = [x for x in lines if x[7] < CUTOFF]
    groups = totals(early, enrolled, lambda x: (x[7], *x[:3]))
    found = {
        (r.claim_year_month_int, r.data_source, r.payer, r.plan_name): (r.paid_with_join, r.dropped_paid)
        for r in G.dropoff_by_month(frames, CUTOFF).collect()
    }
    assert found == {k: tuple(v) for k, v in groups.items() if v[1] > 0}

    groups = totals(lines, enrolled, lambda x: (*x[:3], "pre_2020" if x[7] < CUTOFF else "2020_plus"))
    for r in G.dropoff_by_period(frames, CUTOFF).collect():
        matched, dropped = groups.pop((r.data_source, r.payer, r.plan_name, r.period_bucket))
        assert (r.paid_with_join, r.dropped_paid, r.paid_without_join) == (matched, dropped, matched + dropped)
        if matched + dropped:
            assert r.dropped_pct == pytest.approx(float(100 * dropped / (matched + dropped)))
        else:
            assert r.dropped_pct is None
    assert not groups


@pytest.mark.parametrize("top", [5, 10_000])
def test_top_dropped_claims(case, top):
    frames, lines, enrolled = case

    def likely(x):
        mine = [e for e in enrolled if same((e[3], x[3]))]
        if x[3] is None:
            return "NULL person_id"
        if any(same((e[0], x[0]), (e[1], x[1])) and e[4] == x[7] for e in mine):
            return "Likely plan mismatch"
        if any(near(e, x[7]) for e in mine):
            return "Likely month shift"
        return "No obvious enrollment match"

    expected = [
        (x[7], x[0], x[1], x[2], x[3], x[4], x[6], likely(x))
        for x in lines
        if x[7] < CUTOFF and not exact(x, enrolled)
    ]
    nulls_first = [(-r[6], r[0], *[(v is not None, v or "") for v in r[1:6]], r) for r in expected]
    expected = [r[-1] for r in sorted(nulls_first, key=lambda r: r[:-1])][:top]
    assert [tuple(r) for r in P.top_dropped_claims(frames, CUTOFF, top).collect()] == expected


def lost(lines, enrolled):
    return [x for x in lines if x[0] == SOURCE and x[7] < CUTOFF and not exact(x, enrolled)]


def grouped(rows, key):
    groups = defaultdict(list)
    for x in rows:
        groups[key(x)].append(x)
    return groups


def test_unmatched_members(case):
    frames, lines, enrolled = case
    groups = grouped(lost(lines, enrolled), lambda x: x[3])
    found = {r.person_id: tuple(r)[1:] for r in P.unmatched_members(frames, SOURCE, CUTOFF).collect()}
    assert found == {
        person: (
            sum(x[6] for x in xs), len(xs), len({x[4] for x in xs}),
            min(x[7] for x in xs), max(x[7] for x in xs), min(x[5] for x in xs), max(x[5] for x in xs),
            len({x[1] for x in xs} - {None}), len({x[2] for x in xs} - {None}),
        )
        for person, xs in groups.items()
    }
    assert None in found


def test_unmatched_member_months(case):
    frames, lines, enrolled = case
    groups = grouped(lost(lines, enrolled), lambda x: (x[7], x[1], x[2], x[3]))
    found = {tuple(r)[:4]: tuple(r)[4:] for r in P.unmatched_member_months(frames, SOURCE, CUTOFF).collect()}
    assert found == {
        k: (sum(x[6] for x in xs), len(xs), len({x[4] for x in xs}), min(x[5] for x in xs), max(x[5] for x in xs))
        for k, xs in groups.items()
    }


def test_enrollment_footprint(case):
    frames, lines, enrolled = case
    groups = grouped(lost(lines, enrolled), lambda x: x[3])
    found = {r.person_id: tuple(r)[1:] for r in P.enrollment_footprint(frames, SOURCE, CUTOFF).collect()}
    expected = {}
    for person, xs in groups.items():
        mine = [e for e in enrolled if same((e[3], person))]
        expected[person] = (
            sum(x[6] for x in xs), len({x[4] for x in xs}), min(x[7] for x in xs), max(x[7] for x in xs),
            int(bool(mine)), int(any(e[0] == SOURCE for e in mine)),
            min((e[4] for e in mine), default=None), max((e[4] for e in mine), default=None),
            *[len({e[i] for e in mine} - {None}) for i in range(3)],
        )
    assert found == expected


def test_nearby_enrollment(case):
    frames, lines, enrolled = case
    expected = []
    for (person, payer, plan, month), xs in grouped(lost(lines, enrolled), lambda x: (x[3], x[1], x[2], x[7])).items():
        for e in enrolled:
            if not same((e[3], person)) or abs(e[4] - month) > 1:
                continue
            kind = "Adjacent month"
            if e[4] == month and e[0] is not None:
                known = None not in (e[1], payer, e[2], plan)
                if e[0] != SOURCE:
                    kind = "Same month, different data source"
                elif known and e[1] != payer and e[2] == plan:
                    kind = "Same month, payer mismatch"
                elif known and e[1] == payer and e[2] != plan:
                    kind = "Same month, plan mismatch"
            expected.append(
                (person, month, payer, plan, sum(x[6] for x in xs), len({x[4] for x in xs}), e[0], e[1], e[2], e[4], kind)
            )
    found = [tuple(r) for r in P.nearby_enrollment(frames, SOURCE, CUTOFF).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert len({r[-1] for r in found}) >= 2


def test_default_bucket_names(case):
    frames, _, _ = case
    names = {r.period_bucket for r in G.dropoff_by_period(frames).collect()}
    assert names == {"pre_2024"}


def test_filters_reach_the_file_scan(spark, case, tmp_path):
    frames, _, _ = case
    path = str(tmp_path / "claims")
    frames.table("core__medical_claim").write.parquet(path)
    stored = frames.overlay({"core__medical_claim": spark.read.parquet(path)})
    plan = E.claim_lines(stored, CUTOFF, SOURCE)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for wanted in ("IsNotNull(paid_amount)", "EqualTo(data_source,S1)", "Or(LessThan(claim_line_"):
        assert wanted in pushed
