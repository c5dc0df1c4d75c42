"""Runs in catalog tables: published whole, listed from the catalog, seen through lasting views."""

import os

import pytest
from pyspark.sql import functions as F
from test_history import content, content_of, rows

from claimgauge.operators.history import FIELD_KEY
from claimgauge.operators.run_tables import RunTable
from claimgauge.sources.catalog_tables import CatalogTable, PartitionedCatalogTable, ensure_schema


@pytest.fixture
def schema(spark, tmp_path):
    name = f"quality_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"create schema {name} location '{tmp_path}/store'")
    yield name
    spark.sql(f"drop schema {name} cascade")


@pytest.fixture
def table(spark, schema):
    return RunTable(spark, f"{schema}.field_history", FIELD_KEY)


def folders(table):
    return set(os.listdir(table.table.folder.removeprefix("file:"))) - {"none"}


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, table):
    table.upsert(rows(spark, "r1", 1, ("P", "f", 1), (None, "f", 2), ("P", "g", 3)))
    table.upsert(rows(spark, "r2", 2, ("P", "f", 10)))
    table.upsert(rows(spark, "r1", 1, ("P", "f", 4), (None, "f", 5), ("P", "h", 6)))
    assert content(table.read()) == content_of(
        ("r1", "P", "f", 4), ("r1", None, "f", 5), ("r1", "P", "g", 3), ("r1", "P", "h", 6), ("r2", "P", "f", 10)
    )
    table.upsert(rows(spark, "r1", 1, ("P", "f", 7)), replace_run=True)
    assert content(table.read()) == content_of(("r1", "P", "f", 7), ("r2", "P", "f", 10))
    assert len(folders(table)) == 2


def test_storing_a_run_again_changes_nothing(spark, table):
    again = rows(spark, "r1", 1, ("P", "f", 1), (None, "f", 2))
    table.upsert(again)
    before = content(table.read())
    table.upsert(again)
    table.upsert(table.latest())
    assert content(table.read()) == before and len(folders(table)) == 1


def test_latest_and_previous(spark, table):
    table.upsert(rows(spark, "r0", 1, ("P", "f", 0)))
    assert table.previous().collect() == []
    table.upsert(rows(spark, "r2", 3, ("P", "f", 2)))
    table.upsert(rows(spark, "r1", 2, ("P", "f", 1), (None, "g", 1)).unionByName(rows(spark, "r3", 2, ("P", "f", 3))))
    assert content(table.latest()) == [("r2", "P", "f", 2)]
    assert content(table.previous()) == [("r3", "P", "f", 3)]
    assert [(r.run_id, r.run_rank, r.run_ts.day) for r in table.ranked().collect()] == [
        ("r2", 1, 3), ("r3", 2, 2), ("r1", 3, 2), ("r0", 4, 1),
    ]


def test_a_view_of_a_run_reads_no_other(spark, table):
    for day in (1, 2, 3):
        table.upsert(rows(spark, f"r{day}", day, ("P", "f", day)))
    read = table.latest().inputFiles()
    assert read and all("run_label=run-r3" in f for f in read)
    plan = table.latest()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_label" in plan and "Exchange" not in plan
    assert "Scan parquet" not in table.ranked()._jdf.queryExecution().executedPlan().toString()


def test_a_run_under_another_timestamp(spark, table):
    table.upsert(rows(spark, "r1", 1, ("P", "f", 1), ("P", "g", 2)))
    table.upsert(rows(spark, "r1", 2, ("P", "f", 3)))
    assert content(table.latest()) == [("r1", "P", "f", 3)]
    assert content(table.previous()) == [("r1", "P", "g", 2)]
    table.upsert(rows(spark, "r1", 3, ("P", "f", 4), ("P", "g", 5)))
    assert content(table.read()) == content_of(("r1", "P", "f", 4), ("r1", "P", "g", 5))
    assert len(table.runs()) == 1


def test_run_ids_stay_text(spark, table):
    names = ("007", "7", "2025-01-01", "a/b c=%", "1e3", "it's", "é+x")
    for day, run_id in enumerate(names, start=1):
        table.upsert(rows(spark, run_id, day, ("P", "f", day)))
    assert {r.run_id for r in table.read().collect()} == set(names)
    assert [r.run_id for r in table.ranked().collect()] == list(reversed(names))
    table.upsert(rows(spark, "a/b c=%", 4, ("P", "f", 9)))
    assert ("a/b c=%", "P", "f", 9) in content(table.read()) and table.read().count() == len(names)


def test_new_columns_are_added_and_lost_ones_kept(spark, table):
    table.upsert(rows(spark, "r1", 1, ("P", "f", 1), ("P", "g", 2)))
    table.upsert(rows(spark, "r2", 2, ("P", "f", 3)).withColumn("extra", F.lit(1.5)))
    table.upsert(rows(spark, "r1", 1, ("P", "f", 4)).drop("n").withColumn("extra", F.lit(2.5)))
    found = {(r.run_id, r.field_name): (r.n, r.extra) for r in table.read().collect()}
    assert found == {("r1", "f"): (None, 2.5), ("r1", "g"): (2, None), ("r2", "f"): (3, 1.5)}


def test_nothing_is_kept_unless_persisted(spark, table):
    new = rows(spark, "r1", 1, ("P", "f", 1))
    table.upsert(new, persist=False)
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.latest(like=new).count() == 0
    table.upsert(new)
    before = (content(table.read()), folders(table), table.runs())
    table.upsert(rows(spark, "r1", 1, ("P", "f", 5)), persist=False)
    assert (content(table.read()), folders(table), table.runs()) == before


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("before", ["write", "publish", "withdraw", "sweep"])
def test_a_killed_write_shows_the_old_or_the_new_run_whole(spark, table, monkeypatch, before):
    table.upsert(rows(spark, "r1", 1, ("P", "f", 1), ("P", "g", 2)))
    table.upsert(rows(spark, "r2", 2, ("P", "f", 10)))
    old = content(table.latest())
    new = rows(spark, "r2", 2, ("P", "f", 11), ("P", "g", 12))

    def die(self, *args):
        if before != "sweep" or self.written:
            raise Killed
        self.written = True

    PartitionedCatalogTable.written = False
    with monkeypatch.context() as patch:
        patch.setattr(PartitionedCatalogTable, before, die)
        with pytest.raises(Killed):
            table.upsert(new, replace_run=True)
    seen = content(RunTable(spark.newSession(), table.name, FIELD_KEY).latest())
    assert seen == (old if before in ("write", "publish") else content(new))
    assert content(table.previous()) == content_of(("r1", "P", "f", 1), ("r1", "P", "g", 2))
    # the next writer removes what the dead one left
    table.upsert(new, replace_run=True)
    assert content(table.latest()) == content(new)
    assert len(folders(table)) == 2


def test_a_failing_job_leaves_no_folder(spark, table):
    table.upsert(rows(spark, "r1", 1, ("P", "f", 1)))
    broken = rows(spark, "r2", 2, ("P", "f", 1)).withColumn("n", F.expr("cast(raise_error('no') as bigint)"))
    with pytest.raises(Exception, match="no"):
        table.upsert(broken)
    assert len(folders(table)) == 1 and len(table.runs()) == 1


def test_lasting_views_are_seen_by_other_sessions(spark, schema, table):
    table.upsert(rows(spark, "r1", 1, ("P", "f", 1)))
    other = spark.newSession()
    for rank, name in ((1, "latest"), (2, "previous")):
        table.show_run(f"{schema}.{name}", rank)
    assert content(other.table(f"{schema}.latest")) == [("r1", "P", "f", 1)]
    assert other.table(f"{schema}.previous").collect() == []
    table.upsert(rows(spark, "r2", 2, ("P", "f", 2)))
    for rank, name in ((1, "latest"), (2, "previous")):
        table.show_run(f"{schema}.{name}", rank)
    assert content(other.table(f"{schema}.latest")) == [("r2", "P", "f", 2)]
    assert content(other.table(f"{schema}.previous")) == [("r1", "P", "f", 1)]
    assert [v.isTemporary for v in other.catalog.listTables(schema) if v.name == "latest"] == [False]


def test_current_tables_are_replaced_and_appended_to(spark, schema):
    current = CatalogTable(spark, f"{schema}.current")
    current.replace(spark.range(5).withColumn("x", F.lit("a")))
    current.append(spark.range(5, 7).select(F.lit("b").alias("x"), "id"))
    assert sorted(r.id for r in current.read().where("x = 'b'").collect()) == [5, 6]
    stats = {r.col_name: r.data_type for r in spark.sql(f"describe extended {current.name}").collect()}
    assert "7 rows" in stats["Statistics"]
    current.replace(current.read().where("id < 2"))  # from its own content
    assert [r.id for r in current.read().orderBy("id").collect()] == [0, 1]
    current.replace(spark.range(3).withColumn("y", F.lit(1.5)))  # other columns
    assert current.read().columns == ["id", "y"] and current.read().count() == 3
    assert len(os.listdir(current.folder.removeprefix("file:"))) == 1


def test_a_killed_replacement_leaves_the_table_as_it_was(spark, schema, monkeypatch):
    current = CatalogTable(spark, f"{schema}.current")
    current.replace(spark.range(5))
    with monkeypatch.context() as patch:
        patch.setattr(CatalogTable, "_written", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            current.replace(spark.range(9))
    assert spark.newSession().table(current.name).count() == 5


def test_a_schema_may_be_there_already(spark, schema):
    ensure_schema(spark, schema)
    assert schema in [d.name for d in spark.catalog.listDatabases()]
