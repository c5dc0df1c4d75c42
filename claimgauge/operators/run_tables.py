"""Official runs of a summary in a catalog table, one partition and folder per run.

A run (id and timestamp) is written once into a folder of its own, and shown by
the location of its partition. Which runs there are is read from the names of
the partitions, so that a view of one run opens no file of any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.operators.history import LATEST, PREVIOUS, merge_rows
from claimgauge.sources.catalog_tables import PartitionedCatalogTable
from claimgauge.sources.scratch import remove

# The prefix keeps the partition value text, and apart from a missing one.
_LABEL, _STAMP = "run_label", "run_stamp"


def _labelled(rows: DataFrame) -> DataFrame:
    """Rows with the names of their partition: run id, and microseconds since 1970."""
    return rows.withColumns(
        {
            _LABEL: F.concat(F.lit("run-"), F.coalesce("run_id", F.lit(""))),
            _STAMP: F.concat(F.lit("at"), F.coalesce(F.unix_micros("run_ts").cast("string"), F.lit(""))),
        }
    )


class RunTable:
    """The kept runs of one summary, by the name of a catalog table."""

    def __init__(self, spark: SparkSession, name: str, key: Sequence[str]):
        self._spark = spark
        self.table = PartitionedCatalogTable(spark, name, (_LABEL, _STAMP))
        self.name = name
        self.key = tuple(key)

    def read(self, like: DataFrame | None = None) -> DataFrame:
        """All rows. Before the first official run: no rows, with the columns of ``like``."""
        if self.table.exists():
            return self.table.read().drop(_LABEL, _STAMP)
        if like is None:
            raise FileNotFoundError(f"no runs in {self.name}")
        return like.limit(0)

    def runs(self) -> list[dict[str, str]]:
        """Partitions of the runs, the latest first; run ids break ties of the timestamp."""

        def order(run: dict[str, str]) -> tuple:
            stamp = run[_STAMP][2:]
            return (bool(stamp), int(stamp or 0), run[_LABEL])

        return sorted(self.table.partitions(), key=order, reverse=True)

    def ranked(self) -> DataFrame:
        """run_id, run_ts and run_rank, from the catalog alone; no file is opened."""
        listed = [(r[_LABEL][4:], int(r[_STAMP][2:]) if r[_STAMP][2:] else None, i) for i, r in enumerate(self.runs(), 1)]
        frame = self._spark.createDataFrame(listed, "run_id string, micros long, run_rank int")
        return frame.select("run_id", F.timestamp_micros("micros").alias("run_ts"), "run_rank")

    def upsert(self, rows: DataFrame, persist: bool = True, replace_run: bool = False) -> None:
        """Add the rows of one or more runs; does nothing unless ``persist``.

        Rows of a run already kept are replaced by key and otherwise stay; with
        ``replace_run`` the kept run goes as a whole. Readers see each run (id and
        timestamp) as it was or as it is now, never in between: rows are complete
        in their folder before its one catalog command. Where a run comes again
        under another timestamp, that is shown first, and the rows that it replaces
        leave the old timestamp in a second command.
        """
        if not persist:
            return
        rows = _labelled(rows)
        self.table.prepare(rows)
        self.table.sweep()  # what a writer that died has left
        folder = self.table.write(rows)
        written = self.table.written_partitions(folder)
        labels = {values[_LABEL] for values, _ in written}
        kept = [run for run in self.table.partitions() if run[_LABEL] in labels]
        if kept and not replace_run:
            brought = folder
            try:
                folder = self.table.write(self._merged(brought, rows, sorted({run[_LABEL] for run in kept})))
            finally:
                remove(self._spark, brought)
            written = self.table.written_partitions(folder)
        self.table.publish(written)
        shown = [values for values, _ in written]
        self.table.withdraw([run for run in kept if run not in shown])
        for values in shown:
            self.table.analyze_partition(values)
        self.table.sweep()

    def _merged(self, folder: str, like: DataFrame, labels: Sequence[str]) -> DataFrame:
        brought = self._spark.read.schema(like.schema).parquet(folder)
        kept = self.table.read().where(F.col(_LABEL).isin(*labels))
        return merge_rows(kept, brought, self.key)

    def run(self, rank: int, like: DataFrame | None = None) -> DataFrame:
        """Rows of the run with this rank, 1 for the latest."""
        runs = self.runs()
        if rank > len(runs):
            return self.read(like).limit(0)
        return self.table.rows_of(runs[rank - 1]).drop(_LABEL, _STAMP)

    def latest(self, like: DataFrame | None = None) -> DataFrame:
        return self.run(LATEST, like)

    def previous(self, like: DataFrame | None = None) -> DataFrame:
        return self.run(PREVIOUS, like)

    def show_run(self, view: str, rank: int) -> None:
        """A lasting view of the run with this rank, for any session of the catalog.

        The view names its partition; it is made anew when a run is kept.
        """
        runs = self.runs()
        columns = ", ".join(f"`{c}`" for c in self.read().columns)
        which = self.table.condition(runs[rank - 1]) if rank <= len(runs) else "false"
        self._spark.sql(f"create or replace view {view} as select {columns} from {self.name} where {which}")
