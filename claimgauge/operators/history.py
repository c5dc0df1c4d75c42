"""Official-run history: keyed upsert per run, latest and previous run.

A history is a Parquet table partitioned by run. The run leads every key, so an
upsert touches only the partitions of the runs it brings, and a view of one run
reads only the partition of that run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.sources.scratch import stage

FIELD_KEY = ("run_id", "data_source", "payer", "plan", "model_name", "field_name")
MONTH_KEY = ("run_id", "data_source", "payer", "plan", "year_month_int")

LATEST, PREVIOUS = 1, 2

# The prefix keeps the partition value text: a run id like 007 must not become a number.
_PARTITION = "run_label"


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_PARTITION, F.concat(F.lit("run-"), "run_id"))


def merge_rows(existing: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of the same key replaced and new ones added.

    Keys compare null-safe, so a row with an unknown payer or plan is replaced
    too. Columns that only one side has are kept, NULL on the other.
    """
    incoming = rows.selectExpr(*[f"{k} as incoming_{k}" for k in key])
    same = " and ".join(f"{k} <=> incoming_{k}" for k in key)
    kept = existing.join(incoming, F.expr(same), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


class History:
    """The persisted runs of one summary."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str]):
        self._spark = spark
        self.path = path
        self.key = tuple(key)

    def _stored(self) -> DataFrame | None:
        try:
            return self._spark.read.option("mergeSchema", "true").parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _rows(self, like: DataFrame | None) -> DataFrame:
        stored = self._stored()
        if stored is not None:
            return stored
        if like is None:
            raise FileNotFoundError(f"no history at {self.path}")
        return like.limit(0)

    def read(self, like: DataFrame | None = None) -> DataFrame:
        """All rows. Before the first official run: no rows, with the columns of ``like``."""
        return self._rows(like).drop(_PARTITION)

    def upsert(self, rows: DataFrame, persist: bool = True, replace_run: bool = False) -> None:
        """Add the rows of one or more runs; does nothing unless ``persist``.

        Rows of a run already stored are replaced by key and otherwise kept;
        with ``replace_run`` the stored run is dropped as a whole.

        The new content of a partition is complete in a staged table before the
        stored one is replaced, so the replacing job reads no file that it
        removes and can be repeated from the staged table.
        """
        if not persist:
            return
        rows = _labelled(stage(rows, "history-rows"))
        stored = self._stored()
        if stored is not None and not replace_run:
            runs = rows.select(_PARTITION).distinct()
            touched = stored.join(runs, _PARTITION, "left_semi")
            rows = stage(merge_rows(touched, rows, self.key), "history-merge")
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_PARTITION)
            .parquet(self.path)
        )

    def run(self, rank: int, like: DataFrame | None = None) -> DataFrame:
        """Rows of the run with this rank, 1 for the latest."""
        return of_rank(self._rows(like), rank).drop(_PARTITION)

    def latest(self, like: DataFrame | None = None) -> DataFrame:
        return self.run(LATEST, like)

    def previous(self, like: DataFrame | None = None) -> DataFrame:
        return self.run(PREVIOUS, like)


def ranked_runs(history: DataFrame) -> DataFrame:
    """Distinct runs, the newest first; one row per run, so one sort is enough."""
    return history.select("run_id", "run_ts").distinct().selectExpr(
        "run_id",
        "run_ts",
        "dense_rank() over (order by run_ts desc, run_id desc) as run_rank",
    )


def of_rank(history: DataFrame, rank: int) -> DataFrame:
    """Rows of the run with this rank; exactly one run is broadcast."""
    run = ranked_runs(history).where(F.col("run_rank") == rank)
    wanted = run.selectExpr("run_id as wanted_id", "run_ts as wanted_ts")
    same = "run_id = wanted_id and run_ts = wanted_ts"
    if _PARTITION in history.columns:
        wanted = wanted.withColumn("wanted_label", F.concat(F.lit("run-"), "wanted_id"))
        same += f" and {_PARTITION} = wanted_label"
    return history.join(F.broadcast(wanted), F.expr(same)).select(*history.columns)


def validity_run_delta(latest: DataFrame, previous: DataFrame) -> DataFrame:
    """Change of row counts and percentages per field between two runs.

    A field that only one run has counts as 0 in the other. Unknown and empty
    payer or plan are the same key here.
    """
    identity = (
        "data_source", "payer", "plan",
        "model_name", "field_name", "terminology_table", "terminology_field",
    )
    measures = ("total_rows", "invalid_rows", "invalid_rows_pct", "valid_rows_pct")

    def side(rows: DataFrame, name: str) -> DataFrame:
        columns = ("run_id", "run_ts", *identity, *measures)
        return rows.selectExpr(*[f"{c} as {name}_{c}" for c in columns])

    same = " and ".join(
        [f"latest_{c} = previous_{c}" for c in ("data_source", "model_name", "field_name")]
        + [f"coalesce(latest_{c}, '') = coalesce(previous_{c}, '')" for c in ("payer", "plan")]
    )
    joined = side(latest, "latest").join(side(previous, "previous"), F.expr(same), "full")
    compared = []
    for m in measures:
        zero = "0D" if m.endswith("_pct") else "0L"
        now, before = f"coalesce(latest_{m}, {zero})", f"coalesce(previous_{m}, {zero})"
        compared += [
            f"{now} as latest_{m}",
            f"{before} as previous_{m}",
            f"{now} - {before} as delta_{m}",
        ]
    return joined.selectExpr(
        *[f"coalesce(latest_{c}, previous_{c}) as {c}" for c in identity],
        *[f"{name}_{c}" for name in ("latest", "previous") for c in ("run_id", "run_ts")],
        *compared,
    ).orderBy("data_source", "payer", "plan", "model_name", "field_name")
