"""Claims tables derived from the driver's TPC-H-like tables.

The driver's tables are not claims, so each claims relation is a projection of
them, written once as text that Spark and DuckDB both run. No relation has a
condition on source rows: claims, enrollment and code sets all grow with the
tables. Valid and invalid, matched and unmatched rows occur because some keys
are listed under other codes, and some members enrolled in other plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimgauge.sources.scratch import stage
from claimgauge.sources.tables import Sources

#: more partitions than any table has
MAX_PARTITIONS = 1 << 24
#: columns from which a projection is compiled apart from what reads it
WIDE = 16

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

CLAIM_LINES = (
    "lineitem l join orders o on l.l_orderkey = o.o_orderkey"
    " join customer c on o.o_custkey = c.c_custkey"
)

CLAIM_LINES_FLAT = CLAIM_LINES.replace("l.l_", "l_").replace("o.o_", "o_").replace("c.c_", "c_")
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
    "o_orderkey", "o_orderdate", "c_custkey", "c_nationkey", "c_mktsegment",
)

SOURCE = "'SRC_' || cast(c.c_nationkey % 3 as string)"
PAYER = "case when c.c_custkey % 37 = 0 then null else c.c_mktsegment end"
PLAN = "case when c.c_custkey % 41 = 0 then null else 'HMO' end"
CLAIM_PAYER = (
    "case when o.o_orderkey % 53 = 0 then lower(c.c_mktsegment) when l.l_linenumber = 7 then 'OTHER'"
    " when c.c_custkey % 37 = 0 then null else c.c_mktsegment end"
)
CLAIM_PLAN = (
    "case when l.l_linenumber = 6 then 'PPO' when c.c_custkey % 41 = 0 then null else 'HMO' end"
)
CLAIM_DATE = (
    "case when l.l_partkey % 13 = 0 then null when l.l_partkey % 17 = 0 then date '1970-01-01'"
    " when l.l_partkey % 19 = 0 then date '2999-01-01' else cast(l.l_shipdate as date) end"
)
QUANTITY = "case when l.l_partkey % 11 = 0 then null else l.l_quantity - 5 end"


def _code(value: str) -> str:
    return f"case when l.l_linenumber = 4 then '' when l.l_suppkey % 23 = 0 then null else {value} end"


def _padded(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(cast({number} as string), {width}, '0')"


def _npi(offset: str = "") -> str:
    return _code(f"cast(1000000000 + l.l_suppkey{offset} as string)")


def _listed(key: str, code: str, retired: int) -> str:
    """A code set's entry for a key: every ``retired``-th one is listed under another code."""
    return f"case when {key} % {retired} = 0 then 'X' || cast({key} as string) else {code} end"


# relation -> (FROM text, {column: (type, expression)})
RELATIONS: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "input_layer__eligibility": (
        "customer c",
        {
            "person_id": ("string", "'P' || cast(c.c_custkey as string)"),
            "data_source": ("string", SOURCE),
            "payer": ("string", PAYER),
            "plan": ("string", PLAN),
            "gender": ("string", "case c.c_custkey % 6 when 0 then 'male' when 1 then 'female' when 2 then 'unknown' when 3 then 'M' when 4 then '' end"),
            "race": ("string", "case c.c_custkey % 5 when 0 then 'white' when 1 then 'asian' when 2 then 'zzz' when 3 then '' end"),
            "dual_status_code": ("string", "case when c.c_custkey % 11 = 0 then null else lpad(cast(c.c_custkey % 14 as string), 2, '0') end"),
            "original_reason_entitlement_code": ("string", "case when c.c_custkey % 9 = 0 then '' else cast(c.c_custkey % 6 as string) end"),
            "medicare_status_code": ("string", "case c.c_custkey % 4 when 0 then '10' when 1 then '40' when 2 then '99' else '' end"),
            "birth_date": ("date", "case when c.c_custkey % 13 = 0 then null when c.c_custkey % 17 = 0 then date '1900-01-01' when c.c_custkey % 19 = 0 then date '2999-01-01' else make_date(cast(1930 + c.c_custkey % 80 as int), cast(1 + c.c_custkey % 12 as int), cast(1 + c.c_custkey % 28 as int)) end"),
            "death_date": ("date", "case when c.c_custkey % 10 = 0 then date '2015-06-01' when c.c_custkey % 10 = 1 then date '2999-01-01' end"),
            "social_security_number": ("string", "case c.c_custkey % 7 when 0 then lpad(cast(c.c_custkey as string), 9, '1') when 1 then '123-45-' || lpad(cast(c.c_custkey as string), 4, '0') when 2 then '12345678X' when 3 then '' when 4 then '1234-5-6789' when 5 then '123-45-67-9' end"),
            "address": ("string", "case c.c_custkey % 4 when 0 then 'NULL' when 1 then '' when 2 then '12 Main St' end"),
            "city": ("string", "case c.c_custkey % 5 when 0 then 'NULL' when 1 then '' when 2 then null else 'Springfield' end"),
            "state": ("string", "case c.c_custkey % 7 when 0 then 'NATION_' || cast(c.c_nationkey as string) when 1 then 'N' || cast(c.c_nationkey as string) when 2 then lpad(cast(c.c_nationkey as string), 2, '0') when 3 then 'ZZ' when 4 then 'NULL' when 5 then '' end"),
            "zip_code": ("string", "case c.c_custkey % 7 when 0 then '12345' when 1 then '123456789' when 2 then '12345-6789' when 3 then '1234' when 4 then '12345_6789' when 5 then '' end"),
            "phone": ("string", "case c.c_custkey % 8 when 0 then '(555) 123-4567' when 1 then '555.123.4567' when 2 then '15551234567' when 3 then '25551234567' when 4 then '555123456' when 5 then '+15551234567' when 6 then '' end"),
            "email": ("string", "case c.c_custkey % 4 when 0 then 'a@b.c' when 1 then 'nobody' when 2 then '' end"),
        },
    ),
    "input_layer__medical_claim": (
        CLAIM_LINES,
        {
            "data_source": ("string", SOURCE),
            "payer": ("string", CLAIM_PAYER),
            "plan": ("string", CLAIM_PLAN),
            "claim_type": ("string", "case l.l_partkey % 6 when 0 then 'professional' when 1 then 'institutional' when 2 then 'institutional' when 3 then 'dental' when 4 then '' end"),
            "drg_code_type": ("string", "case l.l_linenumber % 3 when 0 then 'ms-drg' when 1 then 'apr-drg' else 'other' end"),
            "drg_code": ("string", _code(_padded("", "l.l_suppkey", 8))),
            "claim_start_date": ("date", CLAIM_DATE),
            "claim_end_date": ("date", CLAIM_DATE),
            "claim_line_start_date": ("date", CLAIM_DATE),
            "claim_line_end_date": ("date", CLAIM_DATE),
            "admission_date": ("date", CLAIM_DATE),
            "discharge_date": ("date", CLAIM_DATE),
            "paid_date": ("date", CLAIM_DATE),
            "service_unit_quantity": ("double", QUANTITY),
            "revenue_center_code": ("string", _code(_padded("", "l.l_partkey", 8))),
            "hcpcs_code": ("string", _code(_padded("J", "l.l_partkey", 8))),
            "hcpcs_modifier_1": ("string", "case l.l_partkey % 4 when 0 then 'NULL' when 1 then '' when 2 then 'A1' end"),
            "diagnosis_code_1": ("string", _code(_padded("E", "l.l_partkey + 1", 8))),
            "diagnosis_code_2": ("string", _code(_padded("E", "l.l_partkey + 2", 8))),
            "diagnosis_code_3": ("string", _code(_padded("E", "l.l_partkey + 3", 8))),
            "procedure_code_1": ("string", _code(_padded("0", "l.l_suppkey + 1", 8))),
            "procedure_code_2": ("string", _code(_padded("0", "l.l_suppkey + 2", 8))),
            "procedure_code_3": ("string", _code(_padded("0", "l.l_suppkey + 3", 8))),
            "discharge_disposition_code": ("string", _code(_padded("", "l.l_partkey", 8))),
            "admit_source_code": ("string", _code("cast(l.l_partkey as string)")),
            "admit_type_code": ("string", _code("cast(l.l_partkey as string)")),
            "bill_type_code": ("string", _code(_padded("", "l.l_partkey", 8))),
            "place_of_service_code": ("string", _code(_padded("", "l.l_partkey", 8))),
            "rendering_npi": ("string", _npi()),
            "billing_npi": ("string", _npi(" + 1")),
            "facility_npi": ("string", _npi(" + 2")),
        },
    ),
    "input_layer__pharmacy_claim": (
        CLAIM_LINES,
        {
            "data_source": ("string", SOURCE),
            "payer": ("string", CLAIM_PAYER),
            "plan": ("string", CLAIM_PLAN),
            "prescribing_provider_npi": ("string", _npi()),
            "dispensing_provider_npi": ("string", _npi(" + 3")),
            "dispensing_date": ("date", CLAIM_DATE),
            "ndc_code": ("string", _code(_padded("", "l.l_partkey", 11))),
            "quantity": ("double", QUANTITY),
            "days_supply": ("int", "case when l.l_partkey % 7 = 0 then null else cast(l.l_partkey % 30 as int) end"),
            "refills": ("int", "case when l.l_partkey % 5 = 0 then null else cast(l.l_partkey % 4 as int) end"),
            "paid_date": ("date", CLAIM_DATE),
        },
    ),
    "core__medical_claim": (
        CLAIM_LINES,
        {
            "data_source": ("string", f"case when o.o_orderkey % 43 = 0 then 'SRC_9' else {SOURCE} end"),
            "payer": ("string", CLAIM_PAYER),
            "plan": ("string", CLAIM_PLAN),
            "person_id": ("string", "case when c.c_custkey % 97 = 0 then null else 'P' || cast(c.c_custkey as string) end"),
            "claim_id": ("string", "'C' || cast(l.l_orderkey as string)"),
            "claim_line_start_date": ("date", "case when l.l_suppkey % 29 = 0 then null when o.o_orderkey % 47 = 0 then cast(o.o_orderdate + interval '1' month as date) else cast(o.o_orderdate as date) end"),
            "claim_start_date": ("date", "cast(l.l_shipdate as date)"),
            "paid_amount": ("decimal(18,2)", "case when l.l_partkey % 31 = 0 then null else cast(l.l_extendedprice as decimal(18,2)) end"),
        },
    ),
    "core__member_months": (
        "orders o join customer c on o.o_custkey = c.c_custkey",
        {
            "data_source": ("string", SOURCE),
            "payer": ("string", PAYER),
            # every fifth order enrolls its customer in another plan, so that its claims find no exact match
            "plan": ("string", f"case when o.o_orderkey % 5 = 0 then 'EPO' else {PLAN} end"),
            "person_id": ("string", "'P' || cast(c.c_custkey as string)"),
            "year_month": ("string", "cast(year(o.o_orderdate) * 100 + month(o.o_orderdate) as string)"),
        },
    ),
    "terminology__race": ("region", {"description": ("string", "case r_regionkey when 0 then 'white' when 1 then 'asian' when 2 then 'black' else 'other' end")}),
    "terminology__medicare_dual_eligibility": ("nation", {"dual_status_code": ("string", _listed("n_nationkey", _padded("", "n_nationkey", 2), 4))}),
    "terminology__ms_drg": ("supplier", {"ms_drg_code": ("string", _listed("s_suppkey", _padded("", "s_suppkey", 8), 3))}),
    "terminology__apr_drg": ("supplier", {"apr_drg_code": ("string", _listed("s_suppkey", _padded("", "s_suppkey", 8), 4))}),
    "terminology__revenue_center": ("part", {"revenue_center_code": ("string", _listed("p_partkey", _padded("", "p_partkey", 8), 3))}),
    # neighbouring parts share a code: this set lists most of its codes twice
    "terminology__hcpcs_level_2": ("part", {"hcpcs": ("string", _listed("p_partkey", _padded("J", "p_partkey - p_partkey % 2", 8), 5))}),
    "terminology__icd_10_cm": ("part", {"icd_10_cm": ("string", _listed("p_partkey", _padded("E", "p_partkey", 8), 4))}),
    "terminology__icd_10_pcs": ("part", {"icd_10_pcs": ("string", _listed("p_partkey", _padded("0", "p_partkey", 8), 3))}),
    "terminology__discharge_disposition": ("part", {"discharge_disposition_code": ("string", _listed("p_partkey", _padded("", "p_partkey", 8), 5))}),
    "terminology__admit_source": ("part", {"admit_source_code": ("string", _listed("p_partkey", "cast(p_partkey as string)", 4))}),
    "terminology__admit_type": ("part", {"admit_type_code": ("string", _listed("p_partkey", "cast(p_partkey as string)", 3))}),
    "terminology__bill_type": ("part", {"bill_type_code": ("string", _listed("p_partkey", _padded("", "p_partkey", 8), 7))}),
    "terminology__place_of_service": ("part", {"place_of_service_code": ("string", _listed("p_partkey", _padded("", "p_partkey", 8), 6))}),
    "terminology__provider": ("supplier", {"npi": ("string", _listed("s_suppkey", "cast(1000000000 + s_suppkey as string)", 3))}),
    "terminology__ndc": ("part", {"ndc": ("string", _listed("p_partkey", _padded("", "p_partkey", 11), 4))}),
    "reference_data__ansi_fips_state": (
        "nation",
        {
            "ansi_fips_state_abbreviation": ("string", _listed("n_nationkey", "'N' || cast(n_nationkey as string)", 5)),
            "ansi_fips_state_name": ("string", "n_name"),
            "ansi_fips_state_code": ("string", _listed("n_nationkey", _padded("", "n_nationkey", 2), 4)),
        },
    ),
}

CALENDAR = "reference_data__calendar"
CALENDAR_COLUMNS = {
    "full_date": "d",
    "day": "day(d)",
    "year_month_int": "cast(year(d) * 100 + month(d) as int)",
    "year_month": "cast(year(d) as string) || '-' || lpad(cast(month(d) as string), 2, '0')",
}
# Ends before the last claim, so that later claims have no calendar day.
CALENDAR_DAYS = "date '1995-01-01', date '2001-06-30', interval 1 day"

# The plan that a third of the customers had at the earlier run.
EARLIER_PLAN = "case when c.c_custkey % 3 = 0 then 'OLD' else {} end"


def relation_sql(name: str, earlier_run: bool = False) -> str:
    """SELECT text of one relation, the same for Spark and DuckDB."""
    source, columns = RELATIONS[name]
    if earlier_run and "plan" in columns:
        kind, plan = columns["plan"]
        columns = columns | {"plan": (kind, EARLIER_PLAN.format(plan))}
    listed = ", ".join(
        f"cast({expression} as {kind}) as {column}" for column, (kind, expression) in columns.items()
    )
    # Lines and orders both grow with the data: join them by shuffling, never by broadcast.
    hint = "/*+ merge(l, o) */ " if "lineitem" in source else ""
    return f"select {hint}{listed} from {source}"


def _calendar(spark: SparkSession) -> DataFrame:
    listed = ", ".join(f"{text} as {column}" for column, text in CALENDAR_COLUMNS.items())
    return spark.sql(f"select {listed} from (select explode(sequence({CALENDAR_DAYS})) as d)")


def claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order and customer, written once: the claims relations are projections of them."""
    base = Sources(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    text = f"select /*+ merge(l, o) */ {', '.join(LINE_COLUMNS)} from {CLAIM_LINES}"
    return stage(_over(spark, text, CLAIM_LINES, base), "claim-lines")


def _over(spark: SparkSession, text: str, source: str, base: Sources) -> DataFrame:
    used = [table for table in BASE_TABLES if f"{table} " in f"{source} "]
    for table in used:
        for before in ("from ", "join "):
            text = text.replace(f"{before}{table}", f"{before}{{{table}}}")
    return spark.sql(text, **{t: base.table(t) for t in used})


def _compiled_apart(relation: DataFrame, apart: bool) -> DataFrame:
    """The relation behind a boundary that moves no row: partitions stay as they are.

    What is generated for a projection of many columns and for the loop that counts them does not fit into
    one method of less than 8000 bytes, and the JVM would only interpret it.
    """
    return relation.coalesce(MAX_PARTITIONS) if apart else relation


def sample_sources(
    spark: SparkSession,
    sf_dir: str,
    earlier_run: bool = False,
    lines: Callable[[], DataFrame] | None = None,
    references: Sources | None = None,
) -> Sources:
    """Claims relations over the driver's Parquet files in ``sf_dir``.

    ``lines`` gives the table of :func:`claim_lines`, if several runs share it. Code sets are the same for all
    runs over a folder; with ``references`` they are those of another run's tables, and are not counted again.
    """
    base = Sources(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    joined = Sources(lambda _: lines() if lines else claim_lines(spark, sf_dir))

    def resolve(name: str) -> DataFrame:
        if name == CALENDAR:
            return _calendar(spark)
        source, text = RELATIONS[name][0], relation_sql(name, earlier_run)
        apart = len(RELATIONS[name][1]) > WIDE
        if source != CLAIM_LINES:
            return _compiled_apart(_over(spark, text, source, base), apart)
        for alias in ("l", "o", "c"):  # the joined lines have the columns of all three tables
            text = text.replace(f"{alias}.{alias}_", f"{alias}_")
        text = text.replace("/*+ merge(l, o) */ ", "").replace(f" from {CLAIM_LINES_FLAT}", " from {lines}")
        return _compiled_apart(spark.sql(text, lines=joined.table("lines")), apart)

    return Sources(resolve, references)
