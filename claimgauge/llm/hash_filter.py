"""A bitmap of hashes, of a fixed size, that tasks use to leave out rows early.

It lets through every row whose hash is in it, and some others; more of them as
the bitmap fills up. What must be exact is decided later.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a bit for each value of so many leading bits: 16 MB, whatever the number of rows
FILTER_BITS = 27


def _place(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - FILTER_BITS) + 1  # buckets count from 1


def bitmap_rows(rows: DataFrame, hashed: Column) -> DataFrame:
    """The bits of 64-bit hashes as rows (at, bits) of 4 KB each, 16 MB at most."""
    places = rows.select(_place(hashed).alias("place"))
    return places.groupBy(F.bitmap_bucket_number("place").alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )


def bitmap(rows: DataFrame, hashed: Column) -> np.ndarray:
    """The same as an array; the driver receives 16 MB at most."""
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for row in bitmap_rows(rows, hashed).collect():
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        out[(row["at"] - 1) * len(part) : row["at"] * len(part)] = part
    return out


def likely(rows: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """Those ``rows`` whose hash the bitmap rows let through, by a broadcast of 16 MB at most."""
    names = rows.columns
    marked = rows.select("*", _place(hashed).alias("filter_place"))
    marked = marked.select("*", F.bitmap_bucket_number("filter_place").alias("filter_at"), F.bitmap_bit_position("filter_place").alias("filter_bit"))
    byte = F.conv(F.hex(F.substring("bits", F.lit(1) + F.expr("cast(filter_bit div 8 as int)"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(filter_byte, cast(filter_bit % 8 as int)) & 1") == 1
    joined = marked.join(F.broadcast(bits), F.col("filter_at") == F.col("at")).withColumn("filter_byte", byte)
    return joined.where(is_set).select(*(F.col(f"`{n}`") for n in names))


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap lets through."""
    place = hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    return ((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
