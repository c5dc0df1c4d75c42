"""Every query of the library over the sample claims, by name.

Parameters are fixed so that results can be compared with independent SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from claimgauge.functions.run_stamp import RunMeta, resolve_run_ts
from claimgauge.operators import assertions, diagnostics, member_diagnostics
from claimgauge.operators import reconciliation as R
from claimgauge.operators.catalog import COMPLETENESS, MODELS, VALIDITY, only
from claimgauge.operators.field_quality import completeness_summary, validity_summary
from claimgauge.operators.history import validity_run_delta
from claimgauge.operators.run_tables import RunTable
from claimgauge.plans.runs import KEYS, Runs
from claimgauge.sources.catalog_tables import ensure_schema
from claimgauge.sources.sample_claims import claim_lines, sample_sources
from claimgauge.sources.scratch import shared_folder
from claimgauge.sources.tables import Sources

AS_OF = "2025-01-01"
CUTOFF = 199801
ONE_SOURCE = "SRC_0"
EARLIER = RunMeta("r1", "2025-01-01 00:00:00")
LATER = RunMeta("r2", "2025-01-02 00:00:00")

Query = Callable[[SparkSession, str], DataFrame]


def comparable(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, and doubles to six places, as the SQL side has them."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (DecimalType, DoubleType)):
            column = F.round(column.cast("double"), 6).alias(field.name)
        columns.append(column)
    return frame.select(*columns)


_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], object]) -> object:
    """What ``build`` makes, once per application and folder of tables."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The mapped tables; queries share what is laid out of them."""
    return _once(spark, sf_dir, "sources", lambda: sample_sources(spark, sf_dir, lines=lambda: _claim_lines(spark, sf_dir)))


def _claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "claim lines", lambda: claim_lines(spark, sf_dir))


def _earlier_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The tables of the earlier run, over the same claim lines and code sets."""
    lines = lambda: _claim_lines(spark, sf_dir)
    return sample_sources(spark, sf_dir, earlier_run=True, lines=lines, references=_sources(spark, sf_dir))


def _on_sources(build: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(_sources(spark, sf_dir)))


SUMMARIES: dict[str, Callable[[Sources, RunMeta], DataFrame]] = {
    "completeness": completeness_summary,
    "validity": lambda sources, run: validity_summary(sources, run, as_of=AS_OF),
    "reconciliation": R.monthly_summary,
}

def _in_schema(spark: SparkSession, sf_dir: str, what: str, build: Callable[[str], object]) -> object:
    """What ``build`` makes in a schema of its own."""

    def in_new_schema() -> object:
        schema = f"claims_{what}_{uuid.uuid4().hex}"
        ensure_schema(spark, schema, f"{shared_folder(spark)}/{schema}")
        return build(schema)

    return _once(spark, sf_dir, what, in_new_schema)


def _kept_runs(spark: SparkSession, sf_dir: str, name: str) -> RunTable:
    """Two official runs of a summary: the earlier one, and the later one stored twice."""

    def build(schema: str) -> RunTable:
        kept = RunTable(spark, f"{schema}.{name}_history", KEYS[name])
        kept.upsert(SUMMARIES[name](_earlier_sources(spark, sf_dir), EARLIER))
        kept.upsert(SUMMARIES[name](_sources(spark, sf_dir), LATER))
        kept.upsert(kept.latest())
        return kept

    return _in_schema(spark, sf_dir, name, build)


def _history(name: str, pick: Callable[[RunTable], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(pick(_kept_runs(spark, sf_dir, name)))


def _schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run from before a column existed, then a run that brings it."""

    def build(schema: str) -> RunTable:
        kept = RunTable(spark, f"{schema}.completeness_history", KEYS["completeness"])
        earlier = completeness_summary(_earlier_sources(spark, sf_dir), EARLIER)
        kept.upsert(earlier.drop("non_null_rows_pct"))
        kept.upsert(completeness_summary(_sources(spark, sf_dir), LATER))
        return kept

    return comparable(_in_schema(spark, sf_dir, "evolving", build).read())


def _two_runs(spark: SparkSession, sf_dir: str) -> Runs:
    """A schema after two official runs."""

    def build(schema: str) -> Runs:
        runs = Runs(spark, schema=schema)
        runs.build(_earlier_sources(spark, sf_dir), EARLIER, persist=True, as_of=AS_OF)
        runs.build(_sources(spark, sf_dir), LATER, persist=True, as_of=AS_OF)
        return runs

    return _in_schema(spark, sf_dir, "two_runs", build)


def _by_name(name: str) -> Query:
    """A table or lasting view of the two runs, by its name and in a session of its own."""
    return lambda spark, sf_dir: comparable(spark.newSession().table(f"{_two_runs(spark, sf_dir).schema}.{name}"))


def _unofficial_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each run is after an official one and one that is not kept: only the current table has the latter."""

    def build(schema: str) -> Runs:
        runs = Runs(spark, schema=schema, keys={"completeness": KEYS["completeness"]})
        runs.build(_earlier_sources(spark, sf_dir), EARLIER, persist=True)
        runs.build(_sources(spark, sf_dir), LATER, persist=False)
        return runs

    runs = _in_schema(spark, sf_dir, "unofficial", build)
    places = {
        "current": runs.current("completeness"),
        "history": runs.history("completeness").read(),
        "latest": spark.table(f"{runs.schema}.completeness_latest_official_run"),
        "previous": spark.table(f"{runs.schema}.completeness_previous_official_run"),
    }
    return comparable(reduce(DataFrame.unionByName, [rows.withColumn("place", F.lit(p)) for p, rows in places.items()]))


# Shapes of a supplied run timestamp, over the dates of all orders.
RUN_TEXT = """case o_orderkey % 7
    when 0 then cast(cast(o_orderdate as date) as string) || ' 06:30:00'
    when 1 then cast(cast(o_orderdate as date) as string) || 'T23:59:59'
    when 2 then cast(cast(o_orderdate as date) as string)
    when 3 then '  ' || cast(cast(o_orderdate as date) as string) || ' 00:00:00 '
    when 4 then cast(year(o_orderdate) as string) || '-13-25 00:00:00'
    when 5 then ''
end"""
RUN_START = "2025-01-02 03:04:05"


def _run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    started_at = F.lit(RUN_START).cast("timestamp")
    return (
        orders.select(resolve_run_ts(F.expr(RUN_TEXT), started_at).alias("run_ts"))
        .groupBy("run_ts")
        .agg(F.expr("count(1) as runs"))
    )


def _repeated_codes(sources: Sources) -> DataFrame:
    sets = sorted({s for c in VALIDITY for s in c.code_sets if len(s.columns) == 1}, key=lambda s: s.name)
    return assertions.repeated_codes(sources, *sets)


def _validity_of_kind(kind: str) -> Query:
    checks = only(VALIDITY, kind=kind)
    return _on_sources(lambda s: validity_summary(s, LATER, checks, as_of=AS_OF))


VALIDITY_KINDS = {
    "valid_in_reference": "in_reference",
    "valid_drg": "drg",
    "valid_state": "in_any_column",
    "valid_allowed_values": "allowed_values",
    "valid_date_range": "date_range",
    "valid_positive_number": "positive_number",
    "valid_not_null": "not_null",
    "valid_text_present": "text_present",
    "valid_ssn": "ssn",
    "valid_zip": "zip",
    "valid_phone": "phone",
    "valid_email": "email",
}
COMPLETENESS_MODELS = dict(zip(("eligibility", "medical", "pharmacy"), MODELS))


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {
        "run_metadata": _run_metadata,
        "completeness_summary": _on_sources(lambda s: completeness_summary(s, LATER)),
    }
    for name, model in COMPLETENESS_MODELS.items():
        checks = only(COMPLETENESS, model=model)
        found[f"completeness_{name}"] = _on_sources(
            lambda s, checks=checks: completeness_summary(s, LATER, checks)
        )
    found["validity_summary"] = _on_sources(lambda s: validity_summary(s, LATER, as_of=AS_OF))
    # nothing fits into a broadcast: the way of a provider registry
    found["validity_large_sets"] = _on_sources(lambda s: validity_summary(s, LATER, as_of=AS_OF, broadcast_limit=0))
    found |= {name: _validity_of_kind(kind) for name, kind in VALIDITY_KINDS.items()}
    found |= {
        "enrolled_member_months": _on_sources(R.enrolled_member_months),
        "month_bounds": _on_sources(R.month_bounds),
        "month_spine": _on_sources(R.month_spine),
        "member_month_metrics": _on_sources(R.member_month_metrics),
        "paid_without_enrollment": _on_sources(R.paid_without_enrollment),
        "enrolled_claim_metrics": _on_sources(R.enrolled_claim_metrics),
        "monthly_reconciliation": _on_sources(lambda s: R.monthly_summary(s, LATER)),
    }
    for name in SUMMARIES:
        found[f"history_{name}"] = _history(name, RunTable.read)
        found[f"history_latest_{name}"] = _history(name, RunTable.latest)
        found[f"history_previous_{name}"] = _history(name, RunTable.previous)
        found[f"table_{name}"] = _by_name(name)
        found[f"view_latest_{name}"] = _by_name(f"{name}_latest_official_run")
        found[f"view_previous_{name}"] = _by_name(f"{name}_previous_official_run")
    found["history_schema_evolution"] = _schema_evolution
    found["unofficial_run"] = _unofficial_run
    found["run_ranking"] = _history("reconciliation", RunTable.ranked)
    found["validity_run_delta"] = _history(
        "validity", lambda h: validity_run_delta(h.latest(), h.previous())
    )
    found |= {
        "dropoff_by_month": _on_sources(lambda s: diagnostics.dropoff_by_month(s, CUTOFF)),
        "dropoff_by_period": _on_sources(lambda s: diagnostics.dropoff_by_period(s, CUTOFF)),
        "mismatch_reason": _on_sources(lambda s: diagnostics.mismatch_reason(s, CUTOFF)),
        "normalization_recovery": _on_sources(lambda s: diagnostics.normalization_recovery(s, CUTOFF)),
        "top_dropped_claims": _on_sources(lambda s: member_diagnostics.top_dropped_claims(s, CUTOFF)),
        "unmatched_members": _on_sources(
            lambda s: member_diagnostics.unmatched_members(s, ONE_SOURCE, CUTOFF)
        ),
        "unmatched_member_months": _on_sources(
            lambda s: member_diagnostics.unmatched_member_months(s, ONE_SOURCE, CUTOFF)
        ),
        "enrollment_footprint": _on_sources(
            lambda s: member_diagnostics.enrollment_footprint(s, ONE_SOURCE, CUTOFF)
        ),
        "nearby_enrollment": _on_sources(
            lambda s: member_diagnostics.nearby_enrollment(s, ONE_SOURCE, CUTOFF)
        ),
        "assert_unique_grain": lambda spark, d: _two_runs(spark, d).report("unique"),
        "assert_not_null": lambda spark, d: _two_runs(spark, d).report("missing"),
        "assert_pct_bounds": lambda spark, d: comparable(_two_runs(spark, d).report("bounds")),
        "assert_unique_reference": _on_sources(_repeated_codes),
    }
    return found
