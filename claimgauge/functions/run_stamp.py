"""Run identity stamped on every output row."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position and characters that a usable timestamp text must have (fixed values).
_SHAPE = ((5, "-"), (8, "-"), (11, " T"), (14, ":"), (17, ":"))
_SHORTEST = 19


def resolve_run_ts(text: Column, started_at: Column) -> Column:
    """The supplied text as a timestamp, or the run start where it is unusable.

    Text is usable if, once trimmed, it looks like ``YYYY-MM-DD hh:mm:ss`` (or
    with a T) and really casts to a timestamp.
    """
    trimmed = F.trim(text)
    shaped = F.length(trimmed) >= _SHORTEST
    for position, characters in _SHAPE:
        shaped &= F.substring(trimmed, position, 1).isin(*characters)
    return F.coalesce(F.when(shaped, trimmed.try_cast("timestamp")), started_at)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass(frozen=True)
class RunMeta:
    """Run id and timestamp, fixed once on the driver for a whole run."""

    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_ts: str | None = None
    started_at: str = field(default_factory=_now)

    def id_column(self) -> Column:
        return F.lit(self.run_id)

    def ts_column(self) -> Column:
        started_at = F.lit(self.started_at).cast("timestamp")
        if self.run_ts is None:
            return started_at
        return resolve_run_ts(F.lit(str(self.run_ts)), started_at)
