"""Reference code sets: counted keys, packed into one relation.

A lookup must not depend on a code set being small. All sets that a run needs
are counted together, once. Those that fit become one relation (key, copies by
set), which is broadcast once and probed by every field; the others are joined
to counted values by one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.operators.catalog import CodeSet
from claimgauge.sources.scratch import stage
from claimgauge.sources.tables import Sources

BROADCAST_LIMIT = 128 * 1024 * 1024
# Bytes a broadcast hash table needs per entry besides the key itself.
_ENTRY_OVERHEAD = 80


def _keys(sources: Sources, code_set: CodeSet) -> DataFrame:
    columns = [f"cast({c} as string)" for c in code_set.columns]
    key = columns[0] if len(columns) == 1 else f"explode(array({', '.join(columns)}))"
    return sources.table(code_set.table).selectExpr(f"{key} as key").where("key is not null")


def counted_keys(sources: Sources, code_set: CodeSet) -> DataFrame:
    """One row per key, with how many copies of it a join would find.

    The key of a single-column set may be listed twice, and every copy counts.
    A set spread over several columns is a set of distinct values.
    """
    copies = "count(1)" if len(code_set.columns) == 1 else "1L"
    return _keys(sources, code_set).groupBy("key").agg(F.expr(f"{copies} as copies"))


def counted_by_set(sources: Sources, numbers: Mapping[CodeSet, int]) -> DataFrame:
    """The same for several sets, each by its number, in one aggregation.

    An aggregation per set would put the hash tables of all sets into each task behind their union.
    """
    listed = reduce(
        DataFrame.unionByName, [_keys(sources, s).selectExpr(f"{i} as set_no", "key") for s, i in numbers.items()]
    )
    distinct = ", ".join(str(i) for s, i in numbers.items() if len(s.columns) > 1)
    copies = f"case when set_no in ({distinct}) then 1L else count(1) end" if distinct else "count(1)"
    return listed.groupBy("set_no", "key").agg(F.expr(f"{copies} as copies"))


@dataclass
class PackedCodes:
    """Counted codes of several sets as written tables."""

    numbers: dict[CodeSet, int] = field(default_factory=dict)
    #: places of the sets that may be broadcast in the array of copies
    places: dict[CodeSet, int] = field(default_factory=dict)
    counted: DataFrame | None = None  # set_no, key, copies
    packed: DataFrame | None = None  # key, copies
    #: copies of the empty code, for sets that list it
    blanks: dict[CodeSet, int] = field(default_factory=dict)
    #: sets that list some code more than once; a value of the others counts once, found or not
    repeated: set[CodeSet] = field(default_factory=set)

    def broadcast_table(self) -> DataFrame:
        """Every use is the same plan without a condition of its own, so that it is broadcast once."""
        return F.broadcast(self.packed)

    def shuffled_table(self, used: Iterable[CodeSet]) -> DataFrame:
        """Codes of the given sets; a check that has one set beyond the limit looks up all of its sets here."""
        wanted = sorted({self.numbers[s] for s in used})
        return self.counted.where(F.col("set_no").isin(*wanted)).selectExpr("set_no as known_set", "key", "copies")


def pack(sources: Sources, code_sets: Iterable[CodeSet], limit: int = BROADCAST_LIMIT) -> PackedCodes:
    """Count all sets in one job, and admit the smaller ones to ``limit`` bytes of broadcast memory.

    The driver receives one row per set. A key of several sets is listed once.
    """
    numbers = {s: i for i, s in enumerate(sorted(set(code_sets), key=lambda s: s.name))}
    if not numbers:
        return PackedCodes()
    counted = stage(counted_by_set(sources, numbers), "code-sets")
    entry = _ENTRY_OVERHEAD + 8 * len(numbers)
    sizes = counted.groupBy("set_no").agg(
        F.expr(f"count(1) * {entry} + sum(octet_length(key)) as size"),
        F.expr("max(case when key = '' then copies end) as blank"),
        F.expr("max(copies) as most"),
    ).collect()
    measured = dict.fromkeys(numbers.values(), 0) | {row["set_no"]: row["size"] for row in sizes}
    small, used = [], 0
    for code_set, number in sorted(numbers.items(), key=lambda item: (measured[item[1]], item[1])):
        used += measured[number]
        if used > limit:
            break
        small.append(code_set)
    blanks = {row["set_no"]: row["blank"] for row in sizes if row["blank"] is not None}
    blanks = {s: blanks[i] for s, i in numbers.items() if i in blanks}
    most = {row["set_no"]: row["most"] for row in sizes}
    repeated = {s for s, i in numbers.items() if most.get(i, 1) > 1}
    found = PackedCodes(numbers, {s: i for i, s in enumerate(small)}, counted, blanks=blanks, repeated=repeated)
    if small:
        by_set = [F.expr(f"max(case when set_no = {numbers[s]} then copies end)") for s in small]
        wanted = counted.where(F.col("set_no").isin(*(numbers[s] for s in small)))
        found.packed = stage(wanted.groupBy("key").agg(F.array(*by_set).alias("copies")), "packed-codes")
    return found
