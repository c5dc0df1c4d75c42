"""Assertions on a history, checked run by run and kept.

A run that was checked is not read again until its content changes: every
verdict names the folders of the run that it was found on, and a run that is
stored again lies in another folder. Reports add up what is kept.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.functions.verdicts import quoted
from claimgauge.operators.assertions import Expectation
from claimgauge.operators.run_tables import RunTable
from claimgauge.sources.catalog_tables import PartitionedCatalogTable

_RUN = "run_label"
_MEASURES = ("checked_rows", "distinct_keys", "failing", "least", "greatest")


class KeptVerdicts:
    """What was found on the runs of one history, in a catalog table with a partition per run."""

    def __init__(self, spark: SparkSession, name: str, history: RunTable, expected: Expectation):
        self._spark = spark
        self.history = history
        self.expected = expected
        self.table = PartitionedCatalogTable(spark, name, (_RUN,))

    def _folders(self) -> dict[str, str]:
        """Folders of every run, from a listing of files; none is opened."""
        found: dict[str, set[str]] = {}
        for folder, values in self.history.table.folders():
            found.setdefault(values[_RUN], set()).add(folder)
        return {run: " ".join(sorted(folders)) for run, folders in found.items()}

    def stale(self) -> dict[str, str]:
        """Runs without a verdict on their present content, with its folders."""
        now = self._folders()
        kept = {}
        if self.table.exists():
            kept = {row[_RUN]: row["folders"] for row in self.table.read().select(_RUN, "folders").distinct().collect()}
        return {run: folders for run, folders in now.items() if kept.get(run) != folders}

    def refresh(self) -> list[str]:
        """Check the runs that need it, and only those; their names."""
        stale = self.stale()
        if stale:
            found = self._checked(stale)
            self.table.prepare(found)
            self.table.sweep()
            folder = self.table.write(found)
            self.table.publish(self.table.written_partitions(folder))
        gone = [run for run in self.table.partitions() if run[_RUN] not in self._folders()]
        self.table.withdraw(gone)
        if stale or gone:
            self.table.sweep()
        return sorted(stale)

    def _checked(self, stale: Mapping[str, str]) -> DataFrame:
        rows = self.history.table.read().where(F.col(_RUN).isin(*stale))
        keys = rows.groupBy(_RUN, *self.expected.unique).agg(F.expr("count(1) as copies"))
        unique = keys.groupBy(_RUN).agg(
            F.expr("sum(copies) as checked_rows"), F.expr("count(1) as distinct_keys"), F.expr("count_if(copies > 1) as failing")
        )
        parts = [unique.selectExpr(_RUN, "'unique' as kind", "cast(null as string) as column_name", *_MEASURES[:3], *_no_range())]
        counts = [f"count_if({c} is null) as missing_{c}" for c in self.expected.required]
        listed = [_struct("missing", c, f"missing_{c}") for c in self.expected.required]
        for c in self.expected.percents:
            counts += [f"count_if({c} < 0 or {c} > 100) as failing_{c}", f"min({c}) as least_{c}", f"max({c}) as greatest_{c}"]
            listed.append(_struct("bounds", c, f"failing_{c}", f"least_{c}", f"greatest_{c}"))
        wide = rows.groupBy(_RUN).agg(F.expr("count(1) as n"), *map(F.expr, counts))
        parts.append(wide.selectExpr(_RUN, f"inline(array({', '.join(listed)}))"))
        places = " ".join(f"when {quoted(run)} then {quoted(folders)}" for run, folders in stale.items())
        return reduce(DataFrame.unionByName, parts).withColumn("folders", F.expr(f"case {_RUN} {places} end"))

    def _of(self, kind: str) -> DataFrame:
        self.refresh()
        return self.table.read().where(F.col("kind") == kind)

    def unique(self, name: str) -> DataFrame:
        return self._of("unique").agg(
            F.lit(name).alias("table_name"), F.expr("sum(checked_rows) as checked_rows"),
            F.expr("sum(distinct_keys) as distinct_keys"), F.expr("sum(failing) as failing_keys"),
        )

    def missing(self, name: str) -> DataFrame:
        return self._of("missing").groupBy(F.lit(name).alias("table_name"), "column_name").agg(
            F.expr("sum(checked_rows) as checked_rows"), F.expr("sum(failing) as failing_rows")
        )

    def bounds(self, name: str) -> DataFrame:
        return self._of("bounds").groupBy(F.lit(name).alias("table_name"), "column_name").agg(
            F.expr("sum(checked_rows) as checked_rows"), F.expr("sum(failing) as failing_rows"),
            F.expr("min(least) as least"), F.expr("max(greatest) as greatest"),
        )


def _no_range() -> tuple[str, str]:
    return ("cast(null as double) as least", "cast(null as double) as greatest")


def _struct(kind: str, column: str, failing: str, least: str = "cast(null as double)", greatest: str = "cast(null as double)") -> str:
    return (
        f"struct({quoted(kind)} as kind, {quoted(column)} as column_name, n as checked_rows, cast(null as bigint) as distinct_keys,"
        f" {failing} as failing, cast({least} as double) as least, cast({greatest} as double) as greatest)"
    )
