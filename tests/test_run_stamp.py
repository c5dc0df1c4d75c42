import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimgauge.functions.run_stamp import RunMeta, resolve_run_ts

START = dt.datetime(2030, 1, 2, 3, 4, 5)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-02-25 00:00:00", dt.datetime(2026, 2, 25)),
        ("2026-02-25T00:00:00Z", dt.datetime(2026, 2, 25)),
        ("  2026-02-25 10:11:12 ", dt.datetime(2026, 2, 25, 10, 11, 12)),
        ("2026-02-25", START),
        ("None", START),
        ("", START),
        ("2026-13-25 00:00:00", START),
        ("2026/02/25 00:00:00", START),
        (None, START),
    ],
)
def test_usable_text_wins_and_the_rest_falls_back(spark, text, expected):
    run = RunMeta("r", text, "2030-01-02 03:04:05")
    assert spark.range(1).select(run.ts_column().alias("t")).first().t == expected


def test_rule_works_on_a_column(spark):
    rows = spark.createDataFrame([("2026-02-25 00:00:00",), ("x",)], "t string")
    found = rows.select(resolve_run_ts(F.col("t"), F.lit("2030-01-02 03:04:05").cast("timestamp")).alias("r"))
    assert {r.r for r in found.collect()} == {dt.datetime(2026, 2, 25), START}


def test_defaults_are_fixed_once_per_run(spark):
    run = RunMeta()
    first, second = (
        spark.range(1).select(run.id_column().alias("i"), run.ts_column().alias("t")).first() for _ in "ab"
    )
    assert first == second and first.i and first.t
    assert RunMeta().run_id != run.run_id
