"""The bitmap lets through all that is in it, and hardly anything else while it is empty enough."""

import numpy as np
from pyspark.sql import functions as F

from claimgauge.llm import hash_filter


def test_wanted_hashes_pass_and_others_seldom(spark):
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("h"))
    wanted = rows.where("id % 10 = 0")
    bits = hash_filter.bitmap(wanted, F.col("h"))
    assert bits.nbytes == 16 << 20
    hashes = np.array([r.h for r in rows.orderBy("id").collect()], dtype=np.int64)
    passed = hash_filter.holds(bits, hashes)
    assert passed[::10].all() and passed.sum() <= 4000 + 20
    kept = hash_filter.likely(rows, F.col("h"), hash_filter.bitmap_rows(wanted, F.col("h")))
    assert kept.columns == rows.columns
    assert sorted(r.id for r in kept.collect()) == np.flatnonzero(passed).tolist()


def test_the_highest_and_lowest_hashes(spark):
    values = [-(2**63), -1, 0, 1, 2**63 - 1, 1 << 37, (1 << 37) - 1]
    rows = spark.createDataFrame([(v,) for v in values], "h long")
    bits = hash_filter.bitmap(rows, F.col("h"))
    assert hash_filter.holds(bits, np.array(values, dtype=np.int64)).all()
    assert hash_filter.likely(rows, F.col("h"), hash_filter.bitmap_rows(rows, F.col("h"))).count() == len(values)


def test_nothing_wanted(spark):
    rows = spark.range(10).select(F.xxhash64("id").alias("h"))
    assert not hash_filter.bitmap(rows.limit(0), F.col("h")).any()
    assert hash_filter.likely(rows, F.col("h"), hash_filter.bitmap_rows(rows.limit(0), F.col("h"))).count() == 0
