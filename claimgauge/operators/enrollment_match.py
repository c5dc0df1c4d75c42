"""Claims against enrollment, the common ground of the diagnostics.

Whether and how a claim line matches enrollment depends only on its key
(source, payer, plan, person, month). So keys of claims and of enrollment are
stacked and grouped once: the grouping de-duplicates both sides before the
shuffle, and a row that saw both sides is an exact match. Looser matches are
window maxima over prefixes of one order of the key, for which it is sorted
once. No join pairs up rows of one person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.functions import months as M
from claimgauge.operators.reconciliation import matchable
from claimgauge.sources.scratch import stage
from claimgauge.sources.tables import Sources

DIAGNOSTIC_GROUP = ("data_source", "payer", "plan")
KEY = (*DIAGNOSTIC_GROUP, "person_id", "year_month_int")
DEFAULT_CUTOFF = 202401


def claim_lines(
    sources: Sources, cutoff: int | None = None, data_source: str | None = None
) -> DataFrame:
    """Claim lines with a date and a paid amount, before ``cutoff`` (YYYYMM) if given."""
    lines = sources.table("core__medical_claim").where("paid_amount is not null")
    first, second = F.col("claim_line_start_date"), F.col("claim_start_date")
    if data_source is not None:
        lines = lines.where(F.col("data_source") == data_source)
    if cutoff is None:
        lines = lines.where(first.isNotNull() | second.isNotNull())
    else:
        lines = lines.where(M.month_starts_before(cutoff, first, second))
    return (
        lines.withColumn("claim_date", F.coalesce(first, second))
        .withColumn("year_month_int", M.year_month(F.col("claim_date")))
        .select(*KEY, "claim_id", "paid_amount", "claim_date")
    )


def enrollment(sources: Sources, data_source: str | None = None) -> DataFrame:
    """Distinct enrollment keys with a readable month; unreadable months are skipped.

    They are laid out once for all diagnostics of these tables.
    """

    def keys() -> DataFrame:
        rows = sources.table("core__member_months").withColumn("year_month_int", M.tolerant_year_month(F.col("year_month")))
        return stage(rows.where("year_month_int is not null").select(*KEY).distinct(), "enrollment-keys")

    rows = sources.derived("readable enrollment by key", keys)
    return rows if data_source is None else rows.where(F.col("data_source") == data_source)


def paid_by_match(lines: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Per claim key: paid amount, and whether enrollment has exactly this key."""
    stacked = lines.selectExpr(*KEY, "paid_amount", "1 as is_claim", "0 as is_enrolled").unionByName(
        matchable(enrolled).selectExpr(*KEY, "0 as is_claim", "1 as is_enrolled"),
        allowMissingColumns=True,
    )
    return (
        stacked.groupBy(*KEY)
        .agg(
            F.expr("sum(paid_amount) as paid"),
            F.expr("max(is_claim) as is_claim"),
            F.expr("max(is_enrolled) as is_enrolled"),
        )
        .where("is_claim = 1")
        .selectExpr(*KEY, "paid", "is_enrolled = 1 as matched")
    )


def drop_off(paid: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Total, matched and dropped paid amount, and the share dropped in percent."""
    return (
        paid.groupBy(*by)
        .agg(
            F.expr("sum(paid) as paid_without_join"),
            F.expr("sum(case when matched then paid else 0 end) as paid_with_join"),
            F.expr("sum(case when matched then 0 else paid end) as dropped_paid"),
        )
        .withColumn(
            "dropped_pct",
            F.expr(
                "100D * cast(dropped_paid as double) / nullif(cast(paid_without_join as double), 0D)"
            ),
        )
    )


def stacked_keys(lines: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Distinct keys of both sides, laid out by person for the windows to come.

    After de-duplication a person has at most one row per source, payer, plan
    and month, however many claim lines stand behind it. ``exact`` needs no
    window: it says that both sides have the key, and know all of it.
    """
    return (
        lines.selectExpr(*KEY, "1 as is_claim", "0 as is_enrolled")
        .unionByName(enrolled.selectExpr(*KEY, "0 as is_claim", "1 as is_enrolled"))
        .groupBy(*KEY)
        .agg(F.expr("max(is_claim) as is_claim"), F.expr("max(is_enrolled) as is_enrolled"))
        .withColumn("exact", F.expr(f"is_claim = 1 and is_enrolled = 1 and {_all_known(KEY)}"))
        .repartition("person_id")
    )


def _all_known(columns: tuple[str, ...]) -> str:
    return " and ".join(f"{c} is not null" for c in columns)


def seen_in_enrollment(within: tuple[str, ...]) -> str:
    """True if enrollment has a row that agrees on all of ``within`` (NULL agrees with nothing)."""
    return (
        f"({_all_known(within)}"
        f" and max(is_enrolled) over (partition by {', '.join(within)}) = 1)"
    )


def seen_within_a_month(same: tuple[str, ...]) -> str:
    """True if enrollment agrees on ``same`` in the month itself or a neighbouring one."""
    return (
        f"({_all_known(same)} and month_index is not null and"
        f" max(is_enrolled) over (partition by {', '.join(same)} order by month_index"
        " range between 1 preceding and 1 following) = 1)"
    )


def lines_of_keys(lines: DataFrame, keys: DataFrame, carried: str) -> DataFrame:
    """Claim lines of the given keys, with the column that the keys carry.

    Keys are compared null-safe, so that lines with unknown parts find theirs.
    """
    renamed = keys.selectExpr(*[f"{k} as key_{k}" for k in KEY], carried)
    same = " and ".join(f"{k} <=> key_{k}" for k in KEY)
    return lines.join(renamed, F.expr(same)).select(*lines.columns, carried)
