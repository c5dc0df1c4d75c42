"""Assertions return failing rows, and none on good data."""

import pytest

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import assertions as A
from claimgauge.operators.assertions import repeated_codes
from claimgauge.operators.catalog import CodeSet
from claimgauge.plans.runs import Runs
from claimgauge.sources.sample_claims import sample_sources
from claimgauge.sources.tables import Sources


@pytest.fixture(scope="module")
def runs(spark, small_dir, tmp_path_factory):
    runs = Runs(spark, str(tmp_path_factory.mktemp("out") / "tables"))
    day = "2025-01-0{} 00:00:00"
    runs.build(sample_sources(spark, small_dir), RunMeta("r0", day.format(1)), as_of="2025-01-01")
    assert runs.latest("validity").count() == 0  # not official, so not kept
    earlier = sample_sources(spark, small_dir, earlier_run=True)
    runs.build(earlier, RunMeta("r1", day.format(1)), persist=True, as_of="2025-01-01")
    runs.build(sample_sources(spark, small_dir), RunMeta("r2", day.format(2)), persist=True, as_of="2025-01-01")
    return runs


def test_good_tables_pass(runs):
    failing = runs.failures()
    assert len(failing) == 16
    assert {name: rows.count() for name, rows in failing.items()} == dict.fromkeys(failing, 0)


def test_views_and_delta(spark, runs):
    names = runs.register_views("t_")
    assert len(names) == 6
    for name in names:
        ids = {r.run_id for r in spark.table(name).select("run_id").distinct().collect()}
        assert ids == {"r2" if "latest" in name else "r1"}
    delta = runs.validity_delta()
    assert delta.where("delta_total_rows <> latest_total_rows - previous_total_rows").count() == 0
    assert delta.where("delta_total_rows > 0").count() > 0


def test_current_tables_hold_the_last_run_only(runs):
    for name in runs.keys:
        assert [r.run_id for r in runs.current(name).select("run_id").distinct().collect()] == ["r2"]


def test_broken_rows_are_returned(spark, runs):
    expected = A.EXPECTED["validity"]
    good = runs.current("validity")
    twice = good.unionByName(good.limit(3))
    assert A.not_unique(twice, expected.unique).count() == 3
    nameless = good.selectExpr("* except (field_name)", "nullif(field_name, 'race') as field_name")
    assert A.missing(nameless, expected.required).count() == good.where("field_name = 'race'").count() > 0
    wild = good.selectExpr(
        "* except (valid_rows_pct)", "case when field_name = 'race' then 101D else valid_rows_pct end as valid_rows_pct"
    )
    assert A.out_of_bounds(wild, expected.percents).count() == good.where("field_name = 'race'").count()


def test_repeated_keys_with_unknown_payer_are_found(spark):
    rows = spark.sql("select * from values ('r', null, 1), ('r', null, 2), ('r', 'P', 3) as t(run_id, payer, n)")
    (row,) = A.not_unique(rows, ("run_id", "payer")).collect()
    assert (row.payer, row.copies) == (None, 2)


def test_codes_of_all_sets_are_counted_by_one_aggregation(spark):
    """One hash table in a task, not one of each set."""
    race = CodeSet("terminology__race", ("description",))
    ndc = CodeSet("terminology__ndc", ("ndc",))
    sources = Sources.from_frames(
        {
            race.table: spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "description string"),
            ndc.table: spark.createDataFrame([("a",), ("b",), ("b",), ("b",)], "ndc string"),
        }
    )
    rows = repeated_codes(sources, race, ndc)
    assert sorted(map(tuple, rows.collect())) == [("terminology__ndc", "b", 3), ("terminology__race", "a", 2)]
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.index("HashAggregate") < plan.index("Union")
