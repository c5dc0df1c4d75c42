"""Whole runs: current summaries, official history, views."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import assertions
from claimgauge.operators.field_quality import completeness_summary, field_summaries, validity_summary
from claimgauge.operators.history import FIELD_KEY, LATEST, MONTH_KEY, PREVIOUS, History, validity_run_delta
from claimgauge.operators.kept_verdicts import KeptVerdicts
from claimgauge.operators.reconciliation import monthly_summary
from claimgauge.operators.run_tables import RunTable
from claimgauge.sources.catalog_tables import CatalogTable, ensure_schema
from claimgauge.sources.scratch import shuffles_removed
from claimgauge.sources.tables import Sources

KEYS = {"completeness": FIELD_KEY, "validity": FIELD_KEY, "reconciliation": MONTH_KEY}


@dataclass
class Runs:
    """Summaries and histories in one catalog schema, or below one output folder.

    In a schema, tables have names and statistics, runs are published whole, and
    the views of the latest and the previous run last. A folder needs no catalog.
    """

    spark: SparkSession
    root: str | None = None
    schema: str | None = None
    keys: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(KEYS))

    def __post_init__(self) -> None:
        if (self.root is None) == (self.schema is None):
            raise ValueError("name either a folder or a schema")
        if self.schema is not None:
            ensure_schema(self.spark, self.schema)

    def _current_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/current/{name}"

    def _current_table(self, name: str) -> CatalogTable:
        return CatalogTable(self.spark, f"{self.schema}.{name}")

    def history(self, name: str) -> History | RunTable:
        if self.schema is not None:
            return RunTable(self.spark, f"{self.schema}.{name}_history", self.keys[name])
        return History(self.spark, f"{self.root.rstrip('/')}/history/{name}", self.keys[name])

    def current(self, name: str) -> DataFrame:
        """A summary as last written."""
        if self.schema is not None:
            return self._current_table(name).read()
        return self.spark.read.parquet(self._current_path(name))

    def _replace_current(self, name: str, summary: DataFrame) -> None:
        if self.schema is not None:
            self._current_table(name).replace(summary)
        else:
            with shuffles_removed(self.spark):
                summary.write.mode("overwrite").parquet(self._current_path(name))

    def build(
        self,
        sources: Sources,
        run: RunMeta | None = None,
        persist: bool = False,
        as_of: dt.date | str | None = None,
        replace_run: bool = False,
    ) -> RunMeta:
        """Replace the current summaries; an official run also goes to the history.

        Each summary is computed once, written, and read back for its history.
        """
        run = run or RunMeta()
        summaries = self._summaries(sources, run, as_of)
        for name, summary in summaries.items():
            self._replace_current(name, summary)
        for name in summaries:
            self.history(name).upsert(self.current(name), persist, replace_run)
        if self.schema is not None and persist:
            self.register_views()
        return run

    def _summaries(self, sources: Sources, run: RunMeta, as_of: dt.date | str | None) -> dict[str, DataFrame]:
        if {"completeness", "validity"} <= self.keys.keys():  # from one pass over the checked tables
            found = dict(zip(("completeness", "validity"), field_summaries(sources, run, as_of)))
        elif "completeness" in self.keys:
            found = {"completeness": completeness_summary(sources, run)}
        else:
            found = {"validity": validity_summary(sources, run, as_of=as_of)} if "validity" in self.keys else {}
        if "reconciliation" in self.keys:
            found["reconciliation"] = monthly_summary(sources, run)
        return found

    def latest(self, name: str) -> DataFrame:
        return self.history(name).latest(self.current(name))

    def previous(self, name: str) -> DataFrame:
        return self.history(name).previous(self.current(name))

    def register_views(self, prefix: str = "") -> list[str]:
        """Views of the latest and previous official run of each summary.

        In a schema they last, lie in it, and follow every official run that is
        built; below a folder they are temporary.
        """
        names = []
        for name in self.keys:
            for which, rank in (("latest", LATEST), ("previous", PREVIOUS)):
                view = f"{prefix}{name}_{which}_official_run"
                if self.schema is None:
                    self.history(name).run(rank, self.current(name)).createOrReplaceTempView(view)
                else:
                    view = f"{self.schema}.{view}"
                    self._show_run(name, view, rank)
                names.append(view)
        return names

    def _show_run(self, name: str, view: str, rank: int) -> None:
        history = self.history(name)
        if history.table.exists():
            history.show_run(view, rank)
        else:
            current = self._current_table(name).name
            self.spark.sql(f"create or replace view {view} as select * from {current} where false")

    def validity_delta(self) -> DataFrame:
        return validity_run_delta(self.latest("validity"), self.previous("validity"))

    def tables(self) -> dict[str, tuple[DataFrame, assertions.Expectation]]:
        """Current and historical tables by name, with what must hold for them."""
        found = {}
        for name in self.keys:
            current, expected = self.current(name), assertions.EXPECTED[name]
            found[name] = (current, expected)
            found[f"{name}_history"] = (self.history(name).read(like=current), expected)
        return found

    def kept_verdicts(self, name: str) -> KeptVerdicts:
        """Assertions on the history of a summary; a run that was checked is not read again."""
        return KeptVerdicts(self.spark, f"{self.schema}.{name}_verdicts", self.history(name), assertions.EXPECTED[name])

    def report(self, kind: str) -> DataFrame:
        """The report ``unique``, ``missing`` or ``bounds`` of the tables of a schema, histories from what is kept."""
        whole = {"unique": assertions.unique_report, "missing": assertions.missing_report, "bounds": assertions.bounds_report}[kind]
        found = whole({name: (self.current(name), assertions.EXPECTED[name]) for name in self.keys})
        for name in self.keys:
            if kind != "bounds" or assertions.EXPECTED[name].percents:
                found = found.unionByName(getattr(self.kept_verdicts(name), kind)(f"{name}_history"))
        return found

    def failures(self) -> dict[str, DataFrame]:
        """Failing rows of every assertion on current and historical tables."""
        return {
            f"{table}.{check}": failing
            for table, (rows, expected) in self.tables().items()
            for check, failing in assertions.failures(rows, expected).items()
        }
