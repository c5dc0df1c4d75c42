"""Named input tables.

Operators ask for a relation by its logical name and get a lazy DataFrame, so
column pruning and filters reach whatever scan stands behind the name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


class Sources:
    def __init__(self, resolve: Callable[[str], DataFrame], references: Sources | None = None):
        """``references`` are other tables whose code sets are these tables' code sets too."""
        self._resolve = resolve
        self.references = references or self
        self._tables: dict[str, DataFrame] = {}
        self._derived: dict[str, object] = {}

    def table(self, name: str) -> DataFrame:
        # Opening a table may cost a job (file listing, footer schema): once per relation.
        if name not in self._tables:
            self._tables[name] = self._resolve(name)
        return self._tables[name]

    def derived(self, name: str, build: Callable[[], object]) -> object:
        """What ``build`` makes of these tables, once for all operators that share them."""
        if name not in self._derived:
            self._derived[name] = build()
        return self._derived[name]

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Sources:
        """One Parquet table per relation below ``root``."""
        return cls(lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"))

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, names: Mapping[str, str] | None = None, schema: str | None = None
    ) -> Sources:
        """Catalog tables; ``names`` maps a relation to another table name."""
        names = names or {}
        prefix = f"{schema}." if schema else ""
        return cls(lambda name: spark.table(names.get(name, prefix + name)))

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> Sources:
        def resolve(name: str) -> DataFrame:
            frame = frames[name]
            return frame() if callable(frame) else frame

        return cls(resolve)

    def overlay(self, frames: Mapping[str, DataFrame]) -> Sources:
        """These tables, with some of them replaced."""
        return Sources(lambda name: frames[name] if name in frames else self.table(name))
