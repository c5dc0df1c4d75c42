"""Result tables in the catalog, published by the location of a table or a partition.

New content is written into a folder of its own and becomes visible by one
catalog command. A job that dies before it leaves the table as it was; the
folder that it leaves behind goes with the next write. A table has one writer
at a time, and any number of readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from claimgauge.functions.verdicts import quoted
from claimgauge.sources.scratch import folders_in, remove, shuffles_removed


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" location {quoted(location)}" if location else ""
    spark.sql(f"create schema if not exists {schema}{place}")


def _ddl(frame: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name in names)


class CatalogTable:
    """An external Parquet table whose content is replaced as a whole, or appended to."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        self.name = name
        schema, _, short = name.rpartition(".")
        root = spark.catalog.getDatabase(schema).locationUri if schema else spark.conf.get("spark.sql.warehouse.dir")
        self.folder = f"{root.rstrip('/')}/{short}_content"

    def exists(self) -> bool:
        return self._spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self._spark.table(self.name)

    def fresh_folder(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    def sweep(self) -> None:
        """Remove folders that no published content lies in."""
        files = self.read().inputFiles() if self.exists() else []
        used = {self._first_below(f) for f in files}
        for folder in folders_in(self._spark, self.folder):
            if folder.rstrip("/").rpartition("/")[2] not in used:
                remove(self._spark, folder)

    def _first_below(self, file: str) -> str:
        """Name of the folder directly below the table's that a file lies in."""
        tail = file.partition(f"/{self.folder.rpartition('/')[2]}/")[2]
        return tail.partition("/")[0]

    def _written(self, frame: DataFrame, by: Sequence[str] = ()) -> str:
        folder = self.fresh_folder()
        try:
            with shuffles_removed(self._spark):
                frame.write.partitionBy(*by).parquet(folder) if by else frame.write.parquet(folder)
        except BaseException:
            remove(self._spark, folder)
            raise
        return folder

    def replace(self, frame: DataFrame) -> None:
        """The rows of ``frame`` instead of what the table has; statistics of all columns."""
        folder = self._written(frame)
        known = self.exists()
        if known and self.read().schema.simpleString() == frame.schema.simpleString():
            self._spark.sql(f"alter table {self.name} set location {quoted(folder)}")
        else:
            if known:  # the definition changes with the content
                self._spark.sql(f"drop table {self.name}")
            columns = _ddl(frame, frame.columns)
            self._spark.sql(f"create table {self.name} ({columns}) using parquet location {quoted(folder)}")
        self._spark.catalog.refreshTable(self.name)
        self.analyze()
        self.sweep()

    def append(self, frame: DataFrame) -> None:
        """Rows added to the table, by column name; the first rows create it."""
        if not self.exists():
            self.replace(frame)
            return
        frame.select(*self.read().columns).write.insertInto(self.name)
        self.analyze()

    def analyze(self) -> None:
        self._spark.sql(f"analyze table {self.name} compute statistics for all columns")


class PartitionedCatalogTable(CatalogTable):
    """An external Parquet table of text partitions, each published by its location."""

    def __init__(self, spark: SparkSession, name: str, by: Sequence[str]):
        super().__init__(spark, name)
        self.by = tuple(by)

    def partitions(self) -> list[dict[str, str]]:
        """Values of the partition columns, from the catalog alone."""
        if not self.exists():
            return []
        listed = self._spark.sql(f"show partitions {self.name}").collect()
        return [{c: unquote(part.partition("=")[2]) for c, part in zip(self.by, row[0].split("/"), strict=True)} for row in listed]

    def folders(self) -> list[tuple[str, dict[str, str]]]:
        """(folder of one write, values) of the published partitions, from a listing of their files."""
        if not self.exists():
            return []
        found = {}
        for file in self.read().inputFiles():
            values = {c: unquote(unquote(file.partition(f"/{c}=")[2].partition("/")[0])) for c in self.by}
            found[(self._first_below(file), *values.values())] = values
        return [(key[0], values) for key, values in sorted(found.items())]

    def prepare(self, frame: DataFrame) -> None:
        """Create the table, or add the columns that it does not have."""
        values = [c for c in frame.columns if c not in self.by]
        if not self.exists():
            columns = ", ".join([_ddl(frame, values), *(f"`{c}` string" for c in self.by)])
            listed = ", ".join(f"`{c}`" for c in self.by)
            place = quoted(f"{self.folder}/none")
            self._spark.sql(f"create table {self.name} ({columns}) using parquet partitioned by ({listed}) location {place}")
            return
        new = [c for c in values if c not in self.read().columns]
        if new:
            self._spark.sql(f"alter table {self.name} add columns ({_ddl(frame, new)})")

    def write(self, frame: DataFrame) -> str:
        """Folder of the written partitions; nobody sees them yet."""
        return self._written(frame, self.by)

    def written_partitions(self, folder: str) -> list[tuple[dict[str, str], str]]:
        """(values, path) of the partitions in a written folder."""
        found = [({}, folder)]
        for column in self.by:
            found = [
                (values | {column: unquote(path.rstrip("/").rpartition("/")[2].partition("=")[2])}, path)
                for values, parent in found
                for path in folders_in(self._spark, parent)
            ]
        return found

    def _spec(self, values: Mapping[str, str]) -> str:
        return ", ".join(f"`{c}` = {quoted(values[c])}" for c in self.by)

    def publish(self, partitions: Sequence[tuple[Mapping[str, str], str]]) -> None:
        """Show the given folders as the content of their partitions, new partitions first."""
        known = [tuple(p[c] for c in self.by) for p in self.partitions()]
        new = [(v, path) for v, path in partitions if tuple(v[c] for c in self.by) not in known]
        if new:
            added = " ".join(f"partition ({self._spec(v)}) location {quoted(path)}" for v, path in new)
            self._spark.sql(f"alter table {self.name} add {added}")
        for values, path in partitions:
            if (values, path) not in new:
                self._spark.sql(f"alter table {self.name} partition ({self._spec(values)}) set location {quoted(path)}")
        self._spark.catalog.refreshTable(self.name)

    def withdraw(self, partitions: Sequence[Mapping[str, str]]) -> None:
        for values in partitions:
            self._spark.sql(f"alter table {self.name} drop if exists partition ({self._spec(values)})")

    def condition(self, values: Mapping[str, str]) -> str:
        return " and ".join(f"`{c}` = {quoted(values[c])}" for c in self.by)

    def rows_of(self, values: Mapping[str, str]) -> DataFrame:
        """One partition; the plan lists no other."""
        return self.read().where(self.condition(values))

    def analyze_partition(self, values: Mapping[str, str]) -> None:
        self._spark.sql(f"analyze table {self.name} partition ({self._spec(values)}) compute statistics")
