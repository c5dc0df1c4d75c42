"""Broadcast only what was measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_within(frame: DataFrame, max_rows: int) -> DataFrame:
    """``frame`` marked for broadcast if it has at most ``max_rows`` rows.

    The check reads no more than one row past the bound. Beyond it the frame is
    returned unmarked, and the join shuffles both sides instead.
    """
    if frame.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(frame)
    return frame
