"""WITH clauses that define the claims relations for DuckDB."""

from __future__ import annotations

from claimgauge.sources.sample_claims import CALENDAR, CALENDAR_COLUMNS, CALENDAR_DAYS, relation_sql


def _calendar() -> str:
    listed = ", ".join(f"{text} as {column}" for column, text in CALENDAR_COLUMNS.items())
    days = f"select cast(unnest(generate_series({CALENDAR_DAYS})) as date) as d"
    return f"select {listed} from ({days})"


def relation(name: str, earlier_run: bool = False) -> str:
    return _calendar() if name == CALENDAR else relation_sql(name, earlier_run)


def with_relations(names, body: str, steps: dict[str, str] | None = None, earlier: bool = False) -> str:
    """``body`` after the named relations and further steps.

    With ``earlier`` every relation is also defined as of the earlier run,
    under its name with ``_r1`` appended.
    """
    defined = [f"{n} as ({relation(n)})" for n in names]
    if earlier:
        defined += [f"{n}_r1 as ({relation(n, True)})" for n in names]
    defined += [f"{n} as ({text})" for n, text in (steps or {}).items()]
    return f"with {', '.join(defined)} {body}"
