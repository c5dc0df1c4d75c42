"""Monthly reconciliation of enrolled member months, claims and paid amounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.functions import months as M
from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators.bounded import broadcast_if_within
from claimgauge.sources.scratch import stage
from claimgauge.sources.tables import Sources

GROUP = ("data_source", "payer", "plan")
MONTH_GRAIN = (*GROUP, "year_month_int")
ENROLLMENT_KEY = (*GROUP, "person_id", "year_month_int")

# A calendar has one row per day: three thousand years fit.
MAX_CALENDAR_ROWS = 1_100_000

_COUNTS = ("member_months", "members", "claims", "claim_lines")
_AMOUNTS = ("paid_amount", "paid_amount_without_enrollment")


def member_months(sources: Sources) -> DataFrame:
    """Member months with the month as an integer; malformed text is an error."""
    return sources.table("core__member_months").selectExpr(
        *GROUP, "person_id", "cast(year_month as int) as year_month_int"
    )


def dated_claims(sources: Sources) -> DataFrame:
    """Claim lines with the calendar month of their date.

    Lines without a date, or on a day that the calendar does not cover, are
    left out. Lines without a paid amount stay.
    """
    days = sources.derived("calendar days", lambda: _days(sources))
    claims = sources.table("core__medical_claim").selectExpr(
        *GROUP,
        "person_id",
        "claim_id",
        "paid_amount",
        "coalesce(claim_line_start_date, claim_start_date) as claim_date",
    )
    return claims.join(days, F.expr("claim_date = full_date")).drop("claim_date", "full_date")


def _days(sources: Sources) -> DataFrame:
    """Days of the calendar; measured once for all that read these tables."""
    days = sources.table("reference_data__calendar").selectExpr("full_date", "year_month_int")
    return broadcast_if_within(days, MAX_CALENDAR_ROWS)


def _counted_keys(sources: Sources) -> DataFrame:
    """Enrollment laid out once for all that read these tables: its distinct keys, with their rows counted."""
    keys = member_months(sources).groupBy(*ENROLLMENT_KEY).agg(F.expr("count(1) as months"))
    return sources.derived("enrollment by key", lambda: stage(keys, "enrollment-keys"))


def enrolled_member_months(sources: Sources) -> DataFrame:
    """Distinct (source, payer, plan, person, month)."""
    return _counted_keys(sources).select(*ENROLLMENT_KEY)


def matchable(frame: DataFrame) -> DataFrame:
    """Rows whose five key parts are all known; others match nothing."""
    return frame.where(" and ".join(f"{k} is not null" for k in ENROLLMENT_KEY))


def _clustered(enrollment: DataFrame, *flags: str) -> DataFrame:
    """Enrollment keys, shuffled right below the join.

    Only a join whose two inputs both come straight from a shuffle can have its
    oversized partitions split at run time; a member-month that holds a third
    of all claim lines is then read by many tasks.
    """
    return matchable(enrollment).selectExpr(*ENROLLMENT_KEY, *flags).repartition(*ENROLLMENT_KEY)


def with_enrollment(claims: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Claim lines that have an enrollment row under all five keys."""
    return matchable(claims).join(_clustered(enrollment), list(ENROLLMENT_KEY), "left_semi")


def without_enrollment(claims: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Claim lines that have none; a NULL key part counts as none."""
    return claims.join(_clustered(enrollment), list(ENROLLMENT_KEY), "left_anti")


def member_month_metrics(sources: Sources) -> DataFrame:
    """Member-month rows (not distinct) and distinct members per month."""
    return _counted_keys(sources).groupBy(*MONTH_GRAIN).agg(
        F.expr("sum(months) as member_months"), F.expr("count(person_id) as members")
    )


def paid_without_enrollment(sources: Sources) -> DataFrame:
    """Paid amount per month of all dated claim lines, enrolled or not."""
    return dated_claims(sources).groupBy(*MONTH_GRAIN).agg(
        F.expr("sum(paid_amount) as paid_amount_without_enrollment")
    )


def _sum_type(lines: DataFrame) -> str:
    """Type that Spark gives the sum of paid amounts; a sum of sums would be wider."""
    return lines.agg(F.sum("paid_amount").alias("paid")).schema["paid"].dataType.simpleString()


def _by_claim(lines: DataFrame, *flags: str) -> DataFrame:
    """Lines and paid amount per month, claim and member.

    The member is wrapped, so that the partitioning of the join does not pass for one of this
    grouping: with both in one stage, Spark could split no oversized partition of the join.
    """
    wrapped = lines.withColumn("member", F.struct("person_id"))
    claims = wrapped.groupBy(*MONTH_GRAIN, "member", "claim_id", *flags).agg(
        F.expr("count(1) as lines"), F.expr("sum(paid_amount) as paid")
    )
    return claims.selectExpr(*MONTH_GRAIN, "member.person_id", "claim_id", *flags, "lines", "paid")


def enrolled_claim_metrics(sources: Sources) -> DataFrame:
    """Claims, lines, paid amount and members per month of enrolled claim lines.

    Lines are added up per claim and member first, so that claims and members
    are told apart among claims, and no line is multiplied for it.
    """
    lines = with_enrollment(dated_claims(sources), enrolled_member_months(sources))
    claims = _by_claim(lines)
    return claims.groupBy(*MONTH_GRAIN).agg(
        F.expr("count(distinct claim_id) as claims"),
        F.expr("sum(lines) as claim_lines"),
        F.expr(f"cast(sum(paid) as {_sum_type(lines)}) as paid_amount"),
        F.expr("count(distinct person_id) as members_with_claims"),
    )


def claim_metrics(sources: Sources) -> DataFrame:
    """The above and the paid amount of all lines, in one pass over the claims: lines carry a match flag."""
    enrolled = _clustered(enrolled_member_months(sources), "true as enrolled")
    lines = dated_claims(sources).join(enrolled, list(ENROLLMENT_KEY), "left")
    claims, paid = _by_claim(lines, "enrolled"), _sum_type(lines)
    return claims.groupBy(*MONTH_GRAIN).agg(
        F.expr("count(distinct case when enrolled then claim_id end) as claims"),
        F.expr("coalesce(sum(case when enrolled then lines end), 0L) as claim_lines"),
        F.expr(f"cast(sum(case when enrolled then paid end) as {paid}) as paid_amount"),
        F.expr("count(distinct case when enrolled then person_id end) as members_with_claims"),
        F.expr(f"cast(sum(paid) as {paid}) as paid_amount_without_enrollment"),
    )


def month_bounds(sources: Sources) -> DataFrame:
    """First and last month with member months or claims, per source, payer and plan.

    Enrolled claims are a subset of the dated claims and cannot widen the range.
    """
    seen = reduce(
        DataFrame.unionByName,
        [
            frame.groupBy(*GROUP).agg(
                F.expr("min(year_month_int) as first"), F.expr("max(year_month_int) as last")
            )
            for frame in (_counted_keys(sources), dated_claims(sources))
        ],
    )
    return seen.groupBy(*GROUP).agg(
        F.expr("min(first) as min_year_month_int"), F.expr("max(last) as max_year_month_int")
    )


def calendar_months(sources: Sources) -> DataFrame:
    return (
        sources.table("reference_data__calendar")
        .where("day = 1")
        .select("year_month_int", "year_month")
        .distinct()
    )


def _spelled_out(frame: DataFrame, sources: Sources) -> DataFrame:
    """Keep months that the calendar has, and add their text form."""
    months = sources.derived("calendar months", lambda: broadcast_if_within(calendar_months(sources), MAX_CALENDAR_ROWS))
    return frame.join(months, "year_month_int")


def month_spine(sources: Sources) -> DataFrame:
    """Every calendar month between the bounds of each source, payer and plan."""
    low, high = "min_year_month_int", "max_year_month_int"
    listed = (
        month_bounds(sources)
        .where(f"{low} is not null")
        .withColumns(
            {
                "start": M.first_index_from(F.col(low)),
                "stop": M.first_index_from(F.col(high)),
            }
        )
        .selectExpr(*GROUP, low, high, "explode(sequence(start, stop)) as month_index")
        .withColumn("year_month_int", M.from_index(F.col("month_index")))
        .where(f"year_month_int between {low} and {high}")
    )
    return _spelled_out(listed.select(*MONTH_GRAIN), sources).select(*MONTH_GRAIN, "year_month")


def _monthly_activity(sources: Sources) -> DataFrame:
    """Member-month and claim aggregates stacked and merged, one row per active month."""
    stacked = member_month_metrics(sources).unionByName(
        claim_metrics(sources), allowMissingColumns=True
    )
    measures = [*_COUNTS, *_AMOUNTS, "members_with_claims"]
    return stacked.groupBy(*MONTH_GRAIN).agg(*[F.expr(f"max({m}) as {m}") for m in measures])


def _fill_gaps(activity: DataFrame) -> DataFrame:
    """Add the idle months between two active ones; each active month covers its gap.

    ``is_active`` marks rows that carry their own measures. Working forward from
    each active month avoids a second pass over the claims for the bounds.
    """
    following = f"lead(year_month_int) over (partition by {', '.join(GROUP)} order by year_month_int)"
    this, after = F.col("active_month"), F.col("next_month")
    covered = (
        activity.where("year_month_int is not null")
        .withColumn("next_month", F.expr(following))
        .withColumnRenamed("year_month_int", "active_month")
        .withColumns({"start": M.first_index_from(this), "stop": M.first_index_from(after)})
        .withColumn(
            "month_index",
            F.explode(
                F.when(after.isNull(), F.array("start"))
                .when(F.col("start") < F.col("stop"), F.sequence("start", F.col("stop") - 1))
                .otherwise(F.array().cast("array<int>"))
            ),
        )
        .withColumn("year_month_int", M.from_index(F.col("month_index")))
    )
    return covered.where("next_month is not null or year_month_int = active_month").withColumn(
        "is_active", F.expr("year_month_int = active_month")
    )


def monthly_summary(sources: Sources, run: RunMeta) -> DataFrame:
    """One row per source, payer, plan and month between first and last activity.

    Rows with an unknown payer or plan are listed with measures of zero: the
    measures are attached by equality, and an unknown value equals nothing.
    """
    known = "(is_active and " + " and ".join(f"{g} is not null" for g in GROUP) + ")"

    filled = _fill_gaps(_monthly_activity(sources)).selectExpr(
        *MONTH_GRAIN,
        *[
            f"case when {known} then coalesce({name}, 0) else 0 end as {name}"
            for name in (*_COUNTS, *_AMOUNTS, "members_with_claims")
        ],
    )

    def ratio(top: str, bottom: str, name: str) -> str:
        return f"cast({top} as double) / nullif(cast({bottom} as double), 0D) as {name}"

    return (
        _spelled_out(filled, sources)
        .withColumns({"run_id": run.id_column(), "run_ts": run.ts_column()})
        .selectExpr(
            "run_id",
            "run_ts",
            *MONTH_GRAIN,
            "year_month",
            *_COUNTS,
            *_AMOUNTS,
            "members_with_claims",
            ratio("members_with_claims", "member_months", "pct_members_with_claims"),
            ratio("claims * 1000", "member_months", "claims_per_1000"),
            ratio("paid_amount", "member_months", "pmpm_paid"),
            ratio("paid_amount_without_enrollment", "member_months", "pmpm_paid_without_enrollment"),
            ratio("paid_amount", "claims", "avg_paid_per_claim"),
            "run_ts as tuva_last_run",
        )
    )
