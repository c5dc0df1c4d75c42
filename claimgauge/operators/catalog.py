"""Which fields are checked, and how: plain data.

The names, code sets, gates and rule texts are fixed values; they appear in the
output and have to stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

ELIGIBILITY = "input_layer__eligibility"
MEDICAL = "input_layer__medical_claim"
PHARMACY = "input_layer__pharmacy_claim"
MODELS = (ELIGIBILITY, MEDICAL, PHARMACY)

INSTITUTIONAL = "institutional"
PROFESSIONAL = "professional"


@dataclass(frozen=True)
class CodeSet:
    """A reference table and the column, or columns, that hold its codes."""

    table: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.table}.{'|'.join(self.columns)}"


@dataclass(frozen=True)
class FieldCheck:
    model: str
    field: str
    kind: str
    gate: str | None = None  # claim_type the field belongs to
    terminology_table: str | None = None
    terminology_field: str | None = None
    code_sets: tuple[CodeSet, ...] = ()
    allowed: tuple[str, ...] = ()
    after: str | None = None


# --- completeness -----------------------------------------------------------

_COMPLETE_FIELDS = (
    (ELIGIBILITY, "race", None),
    (ELIGIBILITY, "dual_status_code", None),
    (MEDICAL, "drg_code", INSTITUTIONAL),
    (MEDICAL, "revenue_center_code", INSTITUTIONAL),
    (MEDICAL, "hcpcs_code", None),
    (MEDICAL, "diagnosis_code_1", None),
    (MEDICAL, "diagnosis_code_2", None),
    (MEDICAL, "diagnosis_code_3", None),
    (MEDICAL, "procedure_code_1", INSTITUTIONAL),
    (MEDICAL, "procedure_code_2", INSTITUTIONAL),
    (MEDICAL, "procedure_code_3", INSTITUTIONAL),
    (MEDICAL, "discharge_disposition_code", INSTITUTIONAL),
    (MEDICAL, "admit_source_code", INSTITUTIONAL),
    (MEDICAL, "admit_type_code", INSTITUTIONAL),
    (MEDICAL, "bill_type_code", INSTITUTIONAL),
    (MEDICAL, "place_of_service_code", PROFESSIONAL),
    (MEDICAL, "rendering_npi", None),
    (MEDICAL, "billing_npi", None),
    (MEDICAL, "facility_npi", None),
    (PHARMACY, "ndc_code", None),
)
COMPLETENESS = tuple(
    FieldCheck(model, field, "filled", gate) for model, field, gate in _COMPLETE_FIELDS
)

# --- validity ---------------------------------------------------------------

RULE = "validation_rule"


def _rule(model, field, kind, text, **parameters) -> FieldCheck:
    return FieldCheck(model, field, kind, None, RULE, text, **parameters)


def _choice(model, field, *allowed) -> FieldCheck:
    return _rule(model, field, "allowed_values", "|".join(allowed), allowed=allowed)


def _dated(model, field, after) -> FieldCheck:
    return _rule(model, field, "date_range", f">{after} and < current_date", after=after)


def _coded(model, field, table, column, gate=None) -> FieldCheck:
    known = (CodeSet(table, (column,)),)
    return FieldCheck(model, field, "in_reference", gate, table, column, known)


_MS_DRG = CodeSet("terminology__ms_drg", ("ms_drg_code",))
_APR_DRG = CodeSet("terminology__apr_drg", ("apr_drg_code",))
# drg_code_type -> the code set it selects
DRG_SETS = {"ms-drg": _MS_DRG, "apr-drg": _APR_DRG}

_STATES = CodeSet(
    "reference_data__ansi_fips_state",
    ("ansi_fips_state_abbreviation", "ansi_fips_state_name", "ansi_fips_state_code"),
)

_PRESENT = "non_null and non_blank and != 'NULL'"
_ZIP = "5 digits or 9-digit zip (with or without hyphen)"
_PHONE = "10 digits (or formatted equivalent), or 11 digits starting with 1"

VALIDITY = (
    FieldCheck(
        MEDICAL,
        "drg_code",
        "drg",
        INSTITUTIONAL,
        f"{_MS_DRG.table}|{_APR_DRG.table}",
        "ms_drg_code|apr_drg_code",
        (_MS_DRG, _APR_DRG),
    ),
    _choice(MEDICAL, "claim_type", PROFESSIONAL, INSTITUTIONAL),
    _dated(MEDICAL, "claim_start_date", "1970-01-01"),
    _dated(MEDICAL, "claim_end_date", "1970-01-01"),
    _dated(MEDICAL, "claim_line_start_date", "1970-01-01"),
    _dated(MEDICAL, "claim_line_end_date", "1970-01-01"),
    _dated(MEDICAL, "admission_date", "1970-01-01"),
    _dated(MEDICAL, "discharge_date", "1970-01-01"),
    _rule(MEDICAL, "service_unit_quantity", "positive_number", "> 0 and non_null"),
    _rule(MEDICAL, "hcpcs_modifier_1", "not_null", "non_null"),
    _dated(MEDICAL, "paid_date", "1970-01-01"),
    _coded(ELIGIBILITY, "race", "terminology__race", "description"),
    _coded(ELIGIBILITY, "dual_status_code", "terminology__medicare_dual_eligibility", "dual_status_code"),
    _choice(ELIGIBILITY, "gender", "male", "female", "unknown"),
    _choice(ELIGIBILITY, "original_reason_entitlement_code", "0", "1", "2", "3"),
    _choice(ELIGIBILITY, "medicare_status_code", "00", "10", "11", "20", "21", "31", "40"),
    _dated(ELIGIBILITY, "birth_date", "1900-01-01"),
    _dated(ELIGIBILITY, "death_date", "1900-01-01"),
    _rule(ELIGIBILITY, "social_security_number", "ssn", "9 digits or ###-##-####"),
    _rule(ELIGIBILITY, "address", "text_present", _PRESENT),
    _rule(ELIGIBILITY, "city", "text_present", _PRESENT),
    FieldCheck(
        ELIGIBILITY, "state", "in_any_column", None, _STATES.table, "|".join(_STATES.columns), (_STATES,)
    ),
    _rule(ELIGIBILITY, "zip_code", "zip", _ZIP),
    _rule(ELIGIBILITY, "phone", "phone", _PHONE),
    _rule(ELIGIBILITY, "email", "email", "non_null and contains @"),
    _coded(MEDICAL, "revenue_center_code", "terminology__revenue_center", "revenue_center_code", INSTITUTIONAL),
    _coded(MEDICAL, "hcpcs_code", "terminology__hcpcs_level_2", "hcpcs"),
    _coded(MEDICAL, "diagnosis_code_1", "terminology__icd_10_cm", "icd_10_cm"),
    _coded(MEDICAL, "diagnosis_code_2", "terminology__icd_10_cm", "icd_10_cm"),
    _coded(MEDICAL, "diagnosis_code_3", "terminology__icd_10_cm", "icd_10_cm"),
    _coded(MEDICAL, "procedure_code_1", "terminology__icd_10_pcs", "icd_10_pcs", INSTITUTIONAL),
    _coded(MEDICAL, "procedure_code_2", "terminology__icd_10_pcs", "icd_10_pcs", INSTITUTIONAL),
    _coded(MEDICAL, "procedure_code_3", "terminology__icd_10_pcs", "icd_10_pcs", INSTITUTIONAL),
    _coded(MEDICAL, "discharge_disposition_code", "terminology__discharge_disposition", "discharge_disposition_code", INSTITUTIONAL),
    _coded(MEDICAL, "admit_source_code", "terminology__admit_source", "admit_source_code", INSTITUTIONAL),
    _coded(MEDICAL, "admit_type_code", "terminology__admit_type", "admit_type_code", INSTITUTIONAL),
    _coded(MEDICAL, "bill_type_code", "terminology__bill_type", "bill_type_code", INSTITUTIONAL),
    _coded(MEDICAL, "place_of_service_code", "terminology__place_of_service", "place_of_service_code", PROFESSIONAL),
    _coded(MEDICAL, "rendering_npi", "terminology__provider", "npi"),
    _coded(MEDICAL, "billing_npi", "terminology__provider", "npi"),
    _coded(MEDICAL, "facility_npi", "terminology__provider", "npi"),
    _coded(PHARMACY, "ndc_code", "terminology__ndc", "ndc"),
    _coded(PHARMACY, "prescribing_provider_npi", "terminology__provider", "npi"),
    _coded(PHARMACY, "dispensing_provider_npi", "terminology__provider", "npi"),
    _dated(PHARMACY, "dispensing_date", "1970-01-01"),
    _rule(PHARMACY, "quantity", "positive_number", "> 0"),
    _rule(PHARMACY, "days_supply", "positive_number", "> 0"),
    _rule(PHARMACY, "refills", "positive_number", "> 0"),
    _dated(PHARMACY, "paid_date", "1970-01-01"),
)


def only(checks: tuple[FieldCheck, ...], *, model: str | None = None, kind: str | None = None):
    """The checks of one input table or of one kind of rule."""
    return tuple(
        c for c in checks if (model is None or c.model == model) and (kind is None or c.kind == kind)
    )
