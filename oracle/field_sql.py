"""Field summaries written out: one SELECT per field, all stacked, then counted."""

from __future__ import annotations

ELIG, MED, RX = "input_layer__eligibility", "input_layer__medical_claim", "input_layer__pharmacy_claim"
INST, PROF = "institutional", "professional"
AS_OF = "date '2025-01-01'"


class Field:
    """model, field, output labels, status rules in order, joins."""

    def __init__(self, model, field, kind, table, column, rules, joins=(), gate=None):
        self.model, self.field, self.kind = model, field, kind
        self.table, self.column, self.rules, self.joins, self.gate = table, column, rules, joins, gate


def empty(f):
    return f"coalesce(t.{f}, '') = ''"


def filled(model, f, gate=None):
    return Field(model, f, "filled", None, None, [(empty(f), "null"), ("true", "non_null")], gate=gate)


def fixed(model, f, kind, text, null, valid):
    rules = [(null, "null")] + ([(valid, "valid"), ("true", "invalid")] if valid else [("true", "valid")])
    return Field(model, f, kind, "validation_rule", text, rules)


def code(model, f, table, column, gate=None):
    rules = [(empty(f), "null"), (f"x.{column} is not null", "valid"), ("true", "invalid")]
    return Field(model, f, "in_reference", table, column, rules, ((table, "x", f"x.{column} = t.{f}"),), gate)


def one_of(model, f, *values):
    listed = ", ".join(f"'{v}'" for v in values)
    return fixed(model, f, "allowed_values", "|".join(values), empty(f), f"t.{f} in ({listed})")


def dated(model, f, low="1970-01-01"):
    inside = f"t.{f} > date '{low}' and t.{f} < {AS_OF}"
    return fixed(model, f, "date_range", f">{low} and < current_date", f"t.{f} is null", inside)


def positive(model, f, text="> 0"):
    return fixed(model, f, "positive_number", text, f"t.{f} is null", f"t.{f} > 0")



COMPLETENESS = [
    filled(ELIG, "race"),
    filled(ELIG, "dual_status_code"),
    filled(RX, "ndc_code"),
    *[filled(MED, f) for f in (
        "hcpcs_code", "diagnosis_code_1", "diagnosis_code_2", "diagnosis_code_3",
        "rendering_npi", "billing_npi", "facility_npi")],
    *[filled(MED, f, INST) for f in (
        "drg_code", "revenue_center_code", "procedure_code_1", "procedure_code_2", "procedure_code_3",
        "discharge_disposition_code", "admit_source_code", "admit_type_code", "bill_type_code")],
    filled(MED, "place_of_service_code", PROF),
]

_PRESENT = "non_null and non_blank and != 'NULL'"


def _shape(value: str) -> str:
    """The value with every digit as 9."""
    return f"translate({value}, '012345678', '999999999')"


_SSN = f"{_shape('t.social_security_number')} in ('999999999', '999-99-9999')"
_ZIP = f"{_shape('t.zip_code')} in ('99999', '999999999', '99999-9999')"
_PHONE = (
    f"({_shape(digits := "translate(t.phone, '-() .', '')")} = '9999999999'"
    f" or ({_shape(digits)} = '99999999999' and {digits}[1] = '1'))"
)

VALIDITY = [
    Field(
        MED, "drg_code", "drg",
        "terminology__ms_drg|terminology__apr_drg", "ms_drg_code|apr_drg_code",
        [(empty("drg_code"), "null"), ("x.ms_drg_code is not null", "valid"),
         ("y.apr_drg_code is not null", "valid"), ("true", "invalid")],
        (("terminology__ms_drg", "x", "t.drg_code_type = 'ms-drg' and x.ms_drg_code = t.drg_code"),
         ("terminology__apr_drg", "y", "t.drg_code_type = 'apr-drg' and y.apr_drg_code = t.drg_code")),
        INST,
    ),
    Field(
        ELIG, "state", "in_any_column", "reference_data__ansi_fips_state",
        "ansi_fips_state_abbreviation|ansi_fips_state_name|ansi_fips_state_code",
        [("coalesce(t.state, '') in ('', 'NULL')", "null"), ("x.v is not null", "valid"), ("true", "invalid")],
        (("(select distinct unnest([ansi_fips_state_abbreviation, ansi_fips_state_name,"
          " ansi_fips_state_code]) as v from reference_data__ansi_fips_state)", "x", "x.v = t.state"),),
    ),
    one_of(MED, "claim_type", PROF, INST),
    one_of(ELIG, "gender", "male", "female", "unknown"),
    one_of(ELIG, "original_reason_entitlement_code", "0", "1", "2", "3"),
    one_of(ELIG, "medicare_status_code", "00", "10", "11", "20", "21", "31", "40"),
    *[dated(MED, f) for f in (
        "claim_start_date", "claim_end_date", "claim_line_start_date", "claim_line_end_date",
        "admission_date", "discharge_date", "paid_date")],
    dated(ELIG, "birth_date", "1900-01-01"),
    dated(ELIG, "death_date", "1900-01-01"),
    dated(RX, "dispensing_date"),
    dated(RX, "paid_date"),
    positive(MED, "service_unit_quantity", "> 0 and non_null"),
    positive(RX, "quantity"),
    positive(RX, "days_supply"),
    positive(RX, "refills"),
    fixed(MED, "hcpcs_modifier_1", "not_null", "non_null", "t.hcpcs_modifier_1 is null", None),
    fixed(ELIG, "address", "text_present", _PRESENT, "coalesce(t.address, '') in ('', 'NULL')", None),
    fixed(ELIG, "city", "text_present", _PRESENT, "coalesce(t.city, '') in ('', 'NULL')", None),
    fixed(ELIG, "social_security_number", "ssn", "9 digits or ###-##-####", empty("social_security_number"), _SSN),
    fixed(ELIG, "zip_code", "zip", "5 digits or 9-digit zip (with or without hyphen)", empty("zip_code"), _ZIP),
    fixed(ELIG, "phone", "phone", "10 digits (or formatted equivalent), or 11 digits starting with 1", empty("phone"), _PHONE),
    fixed(ELIG, "email", "email", "non_null and contains @", empty("email"), "position('@' in t.email) > 0"),
    code(ELIG, "race", "terminology__race", "description"),
    code(ELIG, "dual_status_code", "terminology__medicare_dual_eligibility", "dual_status_code"),
    code(MED, "hcpcs_code", "terminology__hcpcs_level_2", "hcpcs"),
    *[code(MED, f"diagnosis_code_{i}", "terminology__icd_10_cm", "icd_10_cm") for i in (1, 2, 3)],
    *[code(MED, f"procedure_code_{i}", "terminology__icd_10_pcs", "icd_10_pcs", INST) for i in (1, 2, 3)],
    *[code(MED, f"{f}_code", f"terminology__{f}", f"{f}_code", INST) for f in (
        "revenue_center", "discharge_disposition", "admit_source", "admit_type", "bill_type")],
    code(MED, "place_of_service_code", "terminology__place_of_service", "place_of_service_code", PROF),
    *[code(MED, f, "terminology__provider", "npi") for f in ("rendering_npi", "billing_npi", "facility_npi")],
    code(RX, "ndc_code", "terminology__ndc", "ndc"),
    code(RX, "prescribing_provider_npi", "terminology__provider", "npi"),
    code(RX, "dispensing_provider_npi", "terminology__provider", "npi"),
]


def relations_of(fields) -> list[str]:
    names = {f.model for f in fields}
    for f in fields:
        for table, _, _ in f.joins:
            names.add("reference_data__ansi_fips_state" if table.startswith("(") else table)
    return sorted(names)


def _text(value) -> str:
    return "null" if value is None else "'" + value.replace("'", "''") + "'"


def _statuses(f: Field, model_suffix: str) -> str:
    gate = [(f"t.claim_type <> '{f.gate}'", "not_applicable")] if f.gate else []
    whens = " ".join(f"when {condition} then '{status}'" for condition, status in gate + f.rules)
    joins = " ".join(f"left join {table} {alias} on {on}" for table, alias, on in f.joins)
    return (
        f"select t.data_source, t.payer, t.plan, '{f.model}' as model_name, '{f.field}' as field_name,"
        f" {_text(f.table)} as terminology_table, {_text(f.column)} as terminology_field,"
        f" case {whens} end as s from {f.model}{model_suffix} t {joins}"
    )


def _pct(part: str, whole: str = "total_rows") -> str:
    return f"round(case when {whole} = 0 then 0 else 100.0::double * {part} / {whole} end, 6)"


def summary(fields, run: tuple[str, str], with_validity: bool, model_suffix: str = "") -> str:
    """SELECT of a whole summary; the relations must be defined already."""
    run_id, run_ts = run
    stacked = " union all ".join(_statuses(f, model_suffix) for f in fields)
    labels = ["model_name", "field_name"] + (["terminology_table", "terminology_field"] if with_validity else [])
    counts = {
        "total_rows": "count(*)",
        "applicable_rows": "count(*) filter (where s <> 'not_applicable')",
        "not_applicable_rows": "count(*) filter (where s = 'not_applicable')",
        "null_rows": "count(*) filter (where s = 'null')",
        "non_null_rows": "count(*) filter (where s in ('non_null', 'valid', 'invalid'))",
    }
    if with_validity:
        counts["valid_rows"] = "count(*) filter (where s = 'valid')"
        counts["invalid_rows"] = "count(*) filter (where s = 'invalid')"
    grain = ", ".join(["data_source", "payer", "plan", *labels])
    counted = ", ".join(f"{text} as {name}" for name, text in counts.items())
    percents = ", ".join(f"{_pct(name)} as {name}_pct" for name in counts)
    if with_validity:
        percents += f", {_pct('valid_rows', 'applicable_rows')} as valid_rows_applicable_pct"
    return (
        f"select '{run_id}' as run_id, timestamp '{run_ts}' as run_ts, *, {percents} from"
        f" (select {grain}, {counted} from ({stacked}) group by {grain})"
    )
