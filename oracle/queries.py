"""One SQL text per registered query."""

from __future__ import annotations

from oracle import field_sql as F
from oracle import match_sql as M
from oracle.relations import with_relations

R1 = ("r1", "2025-01-01 00:00:00")
R2 = ("r2", "2025-01-02 00:00:00")

_RUN_METADATA = """
with t as (
    select case o_orderkey % 7
        when 0 then strftime(o_orderdate, '%Y-%m-%d') || ' 06:30:00'
        when 1 then strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59'
        when 2 then strftime(o_orderdate, '%Y-%m-%d')
        when 3 then '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00 '
        when 4 then strftime(o_orderdate, '%Y') || '-13-25 00:00:00'
        when 5 then '' end as x
    from orders
)
select coalesce(
        case when regexp_matches(trim(x), '^.{4}-.{2}-.{2}[ T].{2}:.{2}:.{2}') then try_cast(trim(x) as timestamp) end,
        timestamp '2025-01-02 03:04:05') as run_ts,
    count(*) as runs
from t group by 1"""


def _fields(fields, with_validity: bool) -> str:
    return with_relations(F.relations_of(fields), F.summary(fields, R2, with_validity))


def _kind(kind: str) -> str:
    return _fields([f for f in F.VALIDITY if f.kind == kind], True)


def _runs(name: str, body: str) -> str:
    """``body`` over r1 and r2, the two runs of one summary."""
    if name == "reconciliation":
        steps = M.reconciliation_steps("_r1") | M.reconciliation_steps()
        steps |= {"r1": M.monthly_summary(R1, "_r1"), "r2": M.monthly_summary(R2)}
        return with_relations(M.CORE, body, steps, earlier=True)
    fields, valid = (F.VALIDITY, True) if name == "validity" else (F.COMPLETENESS, False)
    steps = {"r1": F.summary(fields, R1, valid, "_r1"), "r2": F.summary(fields, R2, valid)}
    return with_relations(F.relations_of(fields), body, steps, earlier=True)


def _delta() -> str:
    """Both runs stacked under a tag, and one row per key by conditional aggregates."""

    def of(run: str, text: str) -> str:
        return f"max({text}) filter (tag = '{run}')"

    listed = [f"{of('now', c)} as latest_{c}, {of('then', c)} as previous_{c}" for c in ("run_id", "run_ts")]
    share = {f"{c}_pct": f"100.0::double * {c} / total_rows" for c in ("invalid_rows", "valid_rows")}
    for name, text in ({c: c for c in ("total_rows", "invalid_rows")} | share).items():
        now, then = (f"coalesce({of(run, text)}, 0)" for run in ("now", "then"))
        parts = {"latest": now, "previous": then, "delta": f"{now} - {then}"}
        listed += [f"{f'round({x}, 6)' if name in share else x} as {kind}_{name}" for kind, x in parts.items()]
    # a run's row without a payer or plan stands for the blank one, and shows as unknown where neither run has it
    key = "data_source, coalesce(payer, '') as payer_key, coalesce(plan, '') as plan_key, model_name, field_name"
    return _runs(
        "validity",
        f"select * exclude (payer_key, plan_key) from (select {key}, max(payer) as payer, max(plan) as plan,"
        " coalesce(max(terminology_table) filter (tag = 'now'), max(terminology_table)) as terminology_table,"
        " coalesce(max(terminology_field) filter (tag = 'now'), max(terminology_field)) as terminology_field, "
        + ", ".join(listed)
        + " from (select 'now' as tag, * from r2 union all select 'then' as tag, * from r1)"
        " group by data_source, payer_key, plan_key, model_name, field_name)",
    )


_RANKING = """
select run_id, run_ts, row_number() over (order by run_ts desc, run_id desc) as run_rank
from (select distinct run_id, run_ts from (from r1 union all from r2))"""

_EVOLVED = """
select * from r2 union all by name select * exclude (non_null_rows_pct) from r1"""

_GRAINS = {
    "completeness": "run_id, data_source, payer, plan, model_name, field_name",
    "validity": "run_id, data_source, payer, plan, model_name, field_name",
    "reconciliation": "run_id, data_source, payer, plan, year_month_int",
}
_REQUIRED = {
    "completeness": "run_id run_ts data_source model_name field_name",
    "validity": "run_id run_ts data_source model_name field_name",
    "reconciliation": "run_id run_ts data_source year_month_int year_month",
}
_PCT = "total_rows applicable_rows not_applicable_rows null_rows non_null_rows"
_PERCENTS = {"completeness": _PCT, "validity": f"{_PCT} valid_rows invalid_rows valid_rows_applicable"}


def _all_tables(body: str) -> str:
    """``body`` over the three summaries and their histories, each under its own name."""
    relations = sorted({*F.relations_of(F.VALIDITY), *F.relations_of(F.COMPLETENESS), *M.CORE})
    steps = M.reconciliation_steps("_r1") | M.reconciliation_steps()
    summaries = {
        "completeness": (F.summary(F.COMPLETENESS, R1, False, "_r1"), F.summary(F.COMPLETENESS, R2, False)),
        "validity": (F.summary(F.VALIDITY, R1, True, "_r1"), F.summary(F.VALIDITY, R2, True)),
        "reconciliation": (M.monthly_summary(R1, "_r1"), M.monthly_summary(R2)),
    }
    for name, (earlier, later) in summaries.items():
        steps[name] = later
        steps[f"{name}_earlier"] = earlier
        steps[f"{name}_history"] = f"from {name}_earlier union all from {name}"
    return with_relations(relations, body, steps, earlier=True)


def _reports() -> dict[str, str]:
    unique, required, bounds = [], [], []
    for name, grain in _GRAINS.items():
        for table in (name, f"{name}_history"):
            unique.append(
                f"select '{table}' as table_name, sum(n)::bigint as checked_rows, count(*) as distinct_keys,"
                f" count(*) filter (where n > 1) as failing_keys"
                f" from (select count(*) as n from {table} group by {grain})"
            )
            required += [
                f"select '{table}' as table_name, '{c}' as column_name, count(*) as checked_rows,"
                f" count(*) - count({c}) as failing_rows from {table}"
                for c in _REQUIRED[name].split()
            ]
            bounds += [
                f"select '{table}' as table_name, '{c}_pct' as column_name, count(*) as checked_rows,"
                f" count(*) filter (where {c}_pct not between 0 and 100) as failing_rows,"
                f" min({c}_pct) as least, max({c}_pct) as greatest from {table}"
                for c in _PERCENTS.get(name, "").split()
            ]
    return {
        "assert_unique_grain": _all_tables(" union all ".join(unique)),
        "assert_not_null": _all_tables(" union all ".join(required)),
        "assert_pct_bounds": _all_tables(" union all ".join(bounds)),
    }


def _repeated() -> str:
    sets = sorted({(f.table, f.column) for f in F.VALIDITY if f.kind == "in_reference"})
    sets += [("terminology__ms_drg", "ms_drg_code"), ("terminology__apr_drg", "apr_drg_code")]
    body = " union all ".join(
        f"select '{t}' as table_name, {c} as key, count(*) as copies from {t} group by {c} having count(*) > 1"
        for t, c in sets
    )
    return with_relations([t for t, _ in sets], body)


def oracle_queries() -> dict[str, str]:
    found = {
        "run_metadata": _RUN_METADATA,
        "completeness_summary": _fields(F.COMPLETENESS, False),
        "validity_summary": _fields(F.VALIDITY, True),
        "validity_large_sets": _fields(F.VALIDITY, True),
        "valid_in_reference": _kind("in_reference"),
        "valid_drg": _kind("drg"),
        "valid_state": _kind("in_any_column"),
        "valid_allowed_values": _kind("allowed_values"),
        "valid_date_range": _kind("date_range"),
        "valid_positive_number": _kind("positive_number"),
        "valid_not_null": _kind("not_null"),
        "valid_text_present": _kind("text_present"),
        "valid_ssn": _kind("ssn"),
        "valid_zip": _kind("zip"),
        "valid_phone": _kind("phone"),
        "valid_email": _kind("email"),
    }
    for name, model in (("eligibility", F.ELIG), ("medical", F.MED), ("pharmacy", F.RX)):
        found[f"completeness_{name}"] = _fields([f for f in F.COMPLETENESS if f.model == model], False)
    for name, body in M.STEP_QUERIES.items():
        found[name] = with_relations(M.CORE, body, M.reconciliation_steps())
    found["monthly_reconciliation"] = with_relations(M.CORE, M.monthly_summary(R2), M.reconciliation_steps())
    for name in _GRAINS:
        found[f"history_{name}"] = _runs(name, "from r1 union all from r2")
        found[f"history_latest_{name}"] = _runs(name, "from r2")
        found[f"history_previous_{name}"] = _runs(name, "from r1")
        found[f"table_{name}"] = found[f"view_latest_{name}"] = found[f"history_latest_{name}"]
        found[f"view_previous_{name}"] = found[f"history_previous_{name}"]
    found["unofficial_run"] = _runs(
        "completeness",
        " union all ".join(
            f"select *, '{place}' as place from {run}" + (" where false" if place == "previous" else "")
            for place, run in {"current": "r2", "history": "r1", "latest": "r1", "previous": "r1"}.items()
        ),
    )
    found["history_schema_evolution"] = _runs("completeness", _EVOLVED)
    found["run_ranking"] = _runs("reconciliation", _RANKING)
    found["validity_run_delta"] = _delta()
    for name, body in M.DIAGNOSTICS.items():
        found[name] = with_relations(M.CORE[:2], body, M.DIAGNOSTIC_STEPS)
    found |= _reports()
    found["assert_unique_reference"] = _repeated()
    return found
