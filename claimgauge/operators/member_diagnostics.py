"""RESTRICTED: diagnostics that list persons or claims.

Unlike the summaries and the aggregate diagnostics, results of this module name
individuals (person_id, claim_id). Keep them out of shared outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.functions import months as M
from claimgauge.operators import enrollment_match as E
from claimgauge.operators.reconciliation import without_enrollment
from claimgauge.sources.scratch import stage
from claimgauge.sources.tables import Sources

_RENAMED = {"year_month_int": "claim_year_month_int", "plan": "plan_name"}


def top_dropped_claims(
    sources: Sources, cutoff: int = E.DEFAULT_CUTOFF, top: int = 200
) -> DataFrame:
    """The ``top`` largest claim lines without enrollment, with a likely reason.

    The reported lines are written first: the search for them runs once, and
    Spark knows how few they are when it looks up their members' enrollment.
    """
    enrolled = E.enrollment(sources)
    order = [F.desc("paid_amount"), "year_month_int", *E.DIAGNOSTIC_GROUP, "person_id", "claim_id"]
    lines = without_enrollment(E.claim_lines(sources, cutoff), enrolled)
    reported = stage(lines.drop("claim_date").orderBy(*order).limit(top), "top-dropped-claims")

    index = M.month_index(F.col("year_month_int"))
    asked_key = ("data_source", "payer", "person_id", "year_month_int")
    asked = (
        reported.where("person_id is not null")
        .select(*asked_key)
        .distinct()
        .withColumn("month_index", index)
        .selectExpr(
            *[f"{k} as asked_{k}" for k in asked_key],
            "explode(array(month_index - 1, month_index, month_index + 1)) as near_index",
        )
    )
    near = enrolled.withColumn("month_index", index).join(
        asked, F.expr("person_id = asked_person_id and month_index = near_index")
    )
    same_payer = (
        "data_source = asked_data_source and payer = asked_payer"
        " and year_month_int = asked_year_month_int"
    )
    hints = near.groupBy(*[f"asked_{k}" for k in asked_key]).agg(
        F.expr(f"max(coalesce({same_payer}, false)) as same_payer")
    )
    found = " and ".join(f"{k} <=> asked_{k}" for k in asked_key)
    return (
        reported.join(hints, F.expr(found), "left")
        .orderBy(*order)
        .withColumnsRenamed(_RENAMED)
        .selectExpr(
            "claim_year_month_int",
            "data_source",
            "payer",
            "plan_name",
            "person_id",
            "claim_id",
            "paid_amount",
            # The labels.
            """case
                when person_id is null then 'NULL person_id'
                when same_payer then 'Likely plan mismatch'
                when same_payer is not null then 'Likely month shift'
                else 'No obvious enrollment match'
            end as likely_reason""",
        )
    )


def _unmatched(sources: Sources, data_source: str, cutoff: int) -> DataFrame:
    lines = E.claim_lines(sources, cutoff, data_source)
    return without_enrollment(lines, E.enrollment(sources, data_source))


def unmatched_members(
    sources: Sources, data_source: str, cutoff: int = E.DEFAULT_CUTOFF
) -> DataFrame:
    """Members of one source behind the unmatched paid amount; unknown members are one row."""
    return (
        _unmatched(sources, data_source, cutoff)
        .groupBy("person_id")
        .agg(
            F.expr("sum(paid_amount) as unmatched_paid_amount"),
            F.expr("count(1) as unmatched_claim_lines"),
            F.expr("count(distinct claim_id) as unmatched_claims"),
            F.expr("min(year_month_int) as first_unmatched_month"),
            F.expr("max(year_month_int) as last_unmatched_month"),
            F.expr("min(claim_date) as first_unmatched_date"),
            F.expr("max(claim_date) as last_unmatched_date"),
            F.expr("count(distinct payer) as payer_count"),
            F.expr("count(distinct plan) as plan_count"),
        )
        .orderBy(F.desc("unmatched_paid_amount"), F.desc("unmatched_claims"))
    )


def unmatched_member_months(
    sources: Sources, data_source: str, cutoff: int = E.DEFAULT_CUTOFF
) -> DataFrame:
    """Unmatched paid amount of one source per month, payer, plan and member."""
    return (
        _unmatched(sources, data_source, cutoff)
        .withColumnsRenamed(_RENAMED)
        .groupBy("claim_year_month_int", "payer", "plan_name", "person_id")
        .agg(
            F.expr("sum(paid_amount) as unmatched_paid_amount"),
            F.expr("count(1) as unmatched_claim_lines"),
            F.expr("count(distinct claim_id) as unmatched_claims"),
            F.expr("min(claim_date) as first_claim_date"),
            F.expr("max(claim_date) as last_claim_date"),
        )
        .orderBy(F.desc("unmatched_paid_amount"), "claim_year_month_int", "person_id")
    )


def enrollment_footprint(
    sources: Sources, data_source: str, cutoff: int = E.DEFAULT_CUTOFF
) -> DataFrame:
    """Where else, if anywhere, the unmatched members of one source are enrolled."""
    members = (
        _unmatched(sources, data_source, cutoff)
        .groupBy("person_id")
        .agg(
            F.expr("sum(paid_amount) as unmatched_paid_amount"),
            F.expr("count(distinct claim_id) as unmatched_claims"),
            F.expr("min(year_month_int) as first_unmatched_month"),
            F.expr("max(year_month_int) as last_unmatched_month"),
        )
    )
    # written, because both joins below read it, and Spark then knows how many members there are
    members = stage(members, "unmatched-members")
    in_source = (F.col("data_source") == data_source).cast("int")
    footprint = (
        E.enrollment(sources)
        .join(members.select("person_id"), "person_id", "left_semi")
        .groupBy("person_id", *E.DIAGNOSTIC_GROUP)
        .agg(F.expr("min(year_month_int) as first"), F.expr("max(year_month_int) as last"))
        .withColumn("in_source", in_source)
        .groupBy("person_id")
        .agg(
            F.expr("max(coalesce(in_source, 0)) as in_source"),
            F.expr("min(first) as first_enrollment_month_anywhere"),
            F.expr("max(last) as last_enrollment_month_anywhere"),
            # sets of one member's sources, payers and plans
            F.expr("cast(size(collect_set(data_source)) as bigint) as sources"),
            F.expr("cast(size(collect_set(payer)) as bigint) as payers"),
            F.expr("cast(size(collect_set(plan)) as bigint) as plans"),
        )
    )
    return (
        members.join(footprint, "person_id", "left")
        .selectExpr(
            "person_id",
            "unmatched_paid_amount",
            "unmatched_claims",
            "first_unmatched_month",
            "last_unmatched_month",
            "case when in_source is not null then 1 else 0 end as has_any_enrollment_anywhere",
            "coalesce(in_source, 0) as has_any_enrollment_in_source",
            "first_enrollment_month_anywhere",
            "last_enrollment_month_anywhere",
            "coalesce(sources, 0L) as enrollment_data_source_count",
            "coalesce(payers, 0L) as enrollment_payer_count",
            "coalesce(plans, 0L) as enrollment_plan_count",
        )
        .orderBy(F.desc("unmatched_paid_amount"), "person_id")
    )


def nearby_enrollment(
    sources: Sources, data_source: str, cutoff: int = E.DEFAULT_CUTOFF
) -> DataFrame:
    """Enrollment rows of unmatched member-months within one YYYYMM step.

    The step is plain integer arithmetic: December and January are not
    neighbours. Claim months are spread over the three candidates, which turns
    the range into an equality; enrollment is not multiplied.
    """
    months = (
        _unmatched(sources, data_source, cutoff)
        .withColumnsRenamed({"payer": "claim_payer", "plan": "claim_plan_name"})
        .groupBy(
            "person_id",
            F.col("year_month_int").alias("claim_year_month_int"),
            "claim_payer",
            "claim_plan_name",
        )
        .agg(
            F.expr("sum(paid_amount) as unmatched_paid_amount"),
            F.expr("count(distinct claim_id) as unmatched_claims"),
        )
        .where("person_id is not null")
    )
    wanted = months.selectExpr(
        "*",
        "explode(array(claim_year_month_int - 1, claim_year_month_int, claim_year_month_int + 1))"
        " as enrollment_year_month_int",
    )
    enrolled = (
        E.enrollment(sources)
        .where("person_id is not null")
        .selectExpr(
            "person_id",
            "year_month_int as enrollment_year_month_int",
            "data_source as enrollment_data_source",
            "payer as enrollment_payer",
            "plan as enrollment_plan_name",
        )
    )
    same_month = F.col("enrollment_year_month_int") == F.col("claim_year_month_int")
    here = F.col("enrollment_data_source") == data_source
    payer, plan = F.col("enrollment_payer"), F.col("enrollment_plan_name")
    claim_payer, claim_plan = F.col("claim_payer"), F.col("claim_plan_name")
    # The labels.
    relationship = (
        F.when(
            same_month & here & (payer != claim_payer) & (plan == claim_plan),
            "Same month, payer mismatch",
        )
        .when(
            same_month & here & (payer == claim_payer) & (plan != claim_plan),
            "Same month, plan mismatch",
        )
        .when(same_month & ~here, "Same month, different data source")
        .otherwise("Adjacent month")
    )
    return (
        wanted.join(enrolled, ["person_id", "enrollment_year_month_int"])
        .withColumn("enrollment_relationship", relationship)
        .select(
            "person_id",
            "claim_year_month_int",
            "claim_payer",
            "claim_plan_name",
            "unmatched_paid_amount",
            "unmatched_claims",
            "enrollment_data_source",
            "enrollment_payer",
            "enrollment_plan_name",
            "enrollment_year_month_int",
            "enrollment_relationship",
        )
        .orderBy(
            F.desc("unmatched_paid_amount"),
            "person_id",
            "claim_year_month_int",
            "enrollment_year_month_int",
        )
    )
