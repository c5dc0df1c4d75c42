"""Why paid amounts are lost when claims are matched to enrollment (aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.functions import months as M
from claimgauge.operators import enrollment_match as E
from claimgauge.sources.tables import Sources

PERSON_MONTH = ("person_id", "year_month_int")


def dropoff_by_month(sources: Sources, cutoff: int = E.DEFAULT_CUTOFF) -> DataFrame:
    """Paid amount lost by the enrollment match, per month, source, payer and plan."""
    paid = E.paid_by_match(E.claim_lines(sources, cutoff), E.enrollment(sources))
    return (
        E.drop_off(paid, ("year_month_int", *E.DIAGNOSTIC_GROUP))
        .where("dropped_paid > 0")
        .withColumnsRenamed({"year_month_int": "claim_year_month_int", "plan": "plan_name"})
        .orderBy(F.desc("dropped_paid"))
    )


def dropoff_by_period(sources: Sources, cutoff: int = E.DEFAULT_CUTOFF) -> DataFrame:
    """Loss before the cut-off month against loss from it on."""
    year = cutoff // 100
    paid = E.paid_by_match(E.claim_lines(sources), E.enrollment(sources)).withColumn(
        "period_bucket",
        F.when(F.col("year_month_int") < cutoff, f"pre_{year}").otherwise(f"{year}_plus"),
    )
    return (
        E.drop_off(paid, (*E.DIAGNOSTIC_GROUP, "period_bucket"))
        .withColumnRenamed("plan", "plan_name")
        .orderBy(F.desc("dropped_pct"), F.desc("dropped_paid"))
    )


# First match wins, from the narrowest agreement to none (fixed values).
_REASONS = """case
    when person_id is null then 'NULL person_id'
    when same_source_payer then 'Plan mismatch'
    when same_source then 'Payer mismatch'
    when same_month then 'Data source mismatch'
    when near_month then 'Enrollment month off by +/-1'
    else 'No enrollment for person/month'
end"""


def mismatch_reason(sources: Sources, cutoff: int = E.DEFAULT_CUTOFF) -> DataFrame:
    """Dropped paid amount, lines and claims per month and likely reason."""
    lines = E.claim_lines(sources, cutoff)
    order = (*PERSON_MONTH, "data_source", "payer")
    flagged = (
        E.stacked_keys(lines, E.enrollment(sources))
        .withColumn("month_index", M.month_index(F.col("year_month_int")))
        # one sort for all prefixes of its order, and one more for the neighbouring months
        .sortWithinPartitions(*order)
        .selectExpr(
            *E.KEY,
            "is_claim",
            "is_enrolled",
            "exact",
            "month_index",
            f"{E.seen_in_enrollment(order)} as same_source_payer",
            f"{E.seen_in_enrollment(order[:3])} as same_source",
            f"{E.seen_in_enrollment(order[:2])} as same_month",
        )
        .withColumn("near_month", F.expr(E.seen_within_a_month(("person_id", *E.DIAGNOSTIC_GROUP))))
        .where("is_claim = 1 and not exact")
        .selectExpr(*E.KEY, f"{_REASONS} as mismatch_reason")
    )
    return (
        E.lines_of_keys(lines, flagged, "mismatch_reason")
        .groupBy(F.col("year_month_int").alias("claim_year_month_int"), "mismatch_reason")
        .agg(
            F.expr("sum(paid_amount) as dropped_paid"),
            F.expr("count(1) as dropped_rows"),
            F.expr("count(distinct claim_id) as dropped_claims"),
        )
        .orderBy("claim_year_month_int", F.desc("dropped_paid"))
    )


def normalization_recovery(sources: Sources, cutoff: int = E.DEFAULT_CUTOFF) -> DataFrame:
    """Paid amount that trimming and upper-casing source, payer and plan would recover."""
    lines = E.claim_lines(sources, cutoff)
    normal = tuple(f"normal_{c}" for c in E.DIAGNOSTIC_GROUP)
    recovered = (
        E.stacked_keys(lines, E.enrollment(sources))
        .withColumns(
            {n: F.expr(f"upper(trim(coalesce({c}, '')))") for n, c in zip(normal, E.DIAGNOSTIC_GROUP)}
        )
        .selectExpr(
            *E.KEY,
            "is_claim",
            "exact",
            f"{E.seen_in_enrollment((*PERSON_MONTH, *normal))} as normalized",
        )
        .where("is_claim = 1 and normalized and not exact")
    )
    return (
        E.lines_of_keys(lines, recovered, "normalized")
        .groupBy(F.col("year_month_int").alias("claim_year_month_int"))
        .agg(
            F.expr("sum(paid_amount) as recovered_paid"),
            F.expr("count(distinct claim_id) as recovered_claims"),
        )
        .where("recovered_paid > 0")
        .orderBy("claim_year_month_int")
    )
