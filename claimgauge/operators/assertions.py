"""Data assertions: each returns the failing rows, and none means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.functions.verdicts import quoted
from claimgauge.operators.catalog import CodeSet
from claimgauge.operators.code_sets import counted_by_set
from claimgauge.operators.history import FIELD_KEY, MONTH_KEY
from claimgauge.sources.tables import Sources


@dataclass(frozen=True)
class Expectation:
    """What must hold for one output table."""

    unique: tuple[str, ...]
    required: tuple[str, ...]
    percents: tuple[str, ...] = ()


_COMPLETENESS_PERCENTS = (
    "total_rows_pct", "applicable_rows_pct", "not_applicable_rows_pct", "null_rows_pct", "non_null_rows_pct",
)
_FIELD_REQUIRED = ("run_id", "run_ts", "data_source", "model_name", "field_name")

EXPECTED = {
    "completeness": Expectation(FIELD_KEY, _FIELD_REQUIRED, _COMPLETENESS_PERCENTS),
    "validity": Expectation(
        FIELD_KEY,
        _FIELD_REQUIRED,
        (*_COMPLETENESS_PERCENTS, "valid_rows_pct", "invalid_rows_pct", "valid_rows_applicable_pct"),
    ),
    "reconciliation": Expectation(
        MONTH_KEY, ("run_id", "run_ts", "data_source", "year_month_int", "year_month")
    ),
}


def not_unique(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that more than one row has."""
    return rows.groupBy(*key).agg(F.expr("count(1) as copies")).where("copies > 1")


def missing(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows without a value in a required column."""
    return rows.where(" or ".join(f"{c} is null" for c in required))


def out_of_bounds(rows: DataFrame, percents: Sequence[str]) -> DataFrame:
    """Rows with a percentage below 0 or above 100."""
    return rows.where(" or ".join(f"{c} < 0 or {c} > 100" for c in percents))


def repeated_codes(sources: Sources, *code_sets: CodeSet) -> DataFrame:
    """Codes listed more than once, with the table of their set; each copy inflates the rows it matches."""
    numbers = {s: i for i, s in enumerate(code_sets)}
    tables = ", ".join(quoted(s.table) for s in numbers)
    repeated = counted_by_set(sources, numbers).where("copies > 1")
    return repeated.selectExpr(f"array({tables})[set_no] as table_name", "key", "copies")


def unique_report(tables: Mapping[str, tuple[DataFrame, Expectation]]) -> DataFrame:
    """Per table: rows, distinct keys and keys held by several rows."""
    return _stacked(
        rows.groupBy(*expected.unique)
        .agg(F.expr("count(1) as copies"))
        .selectExpr(f"{quoted(name)} as table_name", "copies")
        .groupBy("table_name")
        .agg(
            F.expr("sum(copies) as checked_rows"),
            F.expr("count(1) as distinct_keys"),
            F.expr("count_if(copies > 1) as failing_keys"),
        )
        for name, (rows, expected) in tables.items()
    )


def missing_report(tables: Mapping[str, tuple[DataFrame, Expectation]]) -> DataFrame:
    """Per table and required column: rows without a value, all columns in one pass."""
    parts = []
    for name, (rows, expected) in tables.items():
        counts = [F.expr(f"count_if({c} is null) as missing_{c}") for c in expected.required]
        unfolded = ", ".join(
            f"struct({quoted(name)} as table_name, {quoted(c)} as column_name,"
            f" checked_rows, missing_{c} as failing_rows)"
            for c in expected.required
        )
        wide = rows.agg(F.expr("count(1) as checked_rows"), *counts)
        parts.append(wide.selectExpr(f"inline(array({unfolded}))"))
    return _stacked(parts)


def bounds_report(tables: Mapping[str, tuple[DataFrame, Expectation]]) -> DataFrame:
    """Per table and percentage: its range and the rows outside 0 to 100."""
    parts = []
    for name, (rows, expected) in tables.items():
        if not expected.percents:
            continue
        counts, unfolded = [], []
        for c in expected.percents:
            counts += [
                F.expr(f"count_if({c} < 0 or {c} > 100) as failing_{c}"),
                F.expr(f"min({c}) as least_{c}"),
                F.expr(f"max({c}) as greatest_{c}"),
            ]
            unfolded.append(
                f"struct({quoted(name)} as table_name, {quoted(c)} as column_name, checked_rows,"
                f" failing_{c} as failing_rows, least_{c} as least, greatest_{c} as greatest)"
            )
        wide = rows.agg(F.expr("count(1) as checked_rows"), *counts)
        parts.append(wide.selectExpr(f"inline(array({', '.join(unfolded)}))"))
    return _stacked(parts)


def failures(rows: DataFrame, expected: Expectation) -> dict[str, DataFrame]:
    """All assertions of one table by name, lazily."""
    checks = {
        "unique_grain": not_unique(rows, expected.unique),
        "not_null": missing(rows, expected.required),
    }
    if expected.percents:
        checks["pct_bounds"] = out_of_bounds(rows, expected.percents)
    return checks


def _stacked(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
