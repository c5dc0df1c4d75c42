"""The mapped claims are joined once for all relations and runs."""

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import code_sets
from claimgauge.operators.catalog import MODELS, VALIDITY, only
from claimgauge.operators.field_quality import validity_summary
from claimgauge.plans import registered as Q
from claimgauge.sources import sample_claims
from claimgauge.sources.sample_claims import CLAIM_LINES, RELATIONS, relation_sql, sample_sources


def test_lines_are_joined_once(spark, small_dir, monkeypatch):
    written = []
    stage = sample_claims.stage
    monkeypatch.setattr(sample_claims, "stage", lambda frame, name: (written.append(name), stage(frame, name))[1])
    monkeypatch.setattr(Q, "_built", {})
    for sources in (Q._sources(spark, small_dir), Q._earlier_sources(spark, small_dir)):
        for name, (source, _) in RELATIONS.items():
            if source == CLAIM_LINES:
                assert "Join" not in sources.table(name)._jdf.queryExecution().optimizedPlan().toString()
    assert written == ["claim-lines"]


def test_relations_are_those_of_the_sql(spark, small_dir):
    base = {t: spark.read.parquet(f"{small_dir}/{t}.parquet") for t in sample_claims.BASE_TABLES}
    for name, frame in base.items():
        frame.createOrReplaceTempView(name)
    for earlier in (False, True):
        sources = sample_sources(spark, small_dir, earlier_run=earlier)
        for name, (source, _) in RELATIONS.items():
            if source == CLAIM_LINES:
                wanted, found = spark.sql(relation_sql(name, earlier)), sources.table(name)
                assert found.schema.simpleString() == wanted.schema.simpleString()
                assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0
    for name in base:
        spark.catalog.dropTempView(name)


def test_counting_loops_of_the_mapped_tables_are_small_enough_to_be_compiled(spark, small_dir):
    """The JVM interprets generated methods of 8000 bytes and more, projections in them included."""
    sources = sample_sources(spark, small_dir)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for model in MODELS:
            rows = validity_summary(sources, RunMeta("r"), only(VALIDITY, model=model), "2025-01-01")
            stages = debug.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
            found = [(stages.apply(i)._1().splitlines()[0], stages.apply(i)._3()) for i in range(stages.size())]
            # what unfolds the few counted rows is no loop over rows of the table
            assert max(size.maxMethodCodeSize() for top, size in found if "AS run_id#" not in top) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_code_sets_are_counted_once_for_both_runs(spark, small_dir, monkeypatch):
    packed, pack = [], code_sets.pack
    monkeypatch.setattr(code_sets, "pack", lambda *given: packed.append(given) or pack(*given))
    monkeypatch.setattr(Q, "_built", {})
    checks = only(VALIDITY, kind="drg")
    earlier, later = (
        validity_summary(sources(spark, small_dir), RunMeta("r"), checks, Q.AS_OF) for sources in (Q._earlier_sources, Q._sources)
    )
    assert len(packed) == 1
    # another plan, the same lines and codes
    valid = [rows.agg({"total_rows": "sum", "valid_rows": "sum"}).first() for rows in (earlier, later)]
    assert valid[0] == valid[1] and valid[0]["sum(valid_rows)"] > 0
    own = validity_summary(sample_sources(spark, small_dir, earlier_run=True), RunMeta("r"), checks, Q.AS_OF)
    assert len(packed) == 2
    counted = ["data_source", "payer", "plan", "total_rows", "valid_rows", "invalid_rows"]
    assert earlier.select(counted).exceptAll(own.select(counted)).count() == own.select(counted).exceptAll(earlier.select(counted)).count() == 0
