"""Completeness and validity summaries, one scan per checked table.

The counters of all fields of a table are aggregated side by side, in one row
per (data_source, payer, plan), and turned into one row per field only after
the aggregation. So a claim row is never multiplied by the number of fields,
partial aggregation reduces it before the only shuffle, and a source that
holds a third of all rows still reaches the shuffle as one row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from claimgauge.functions import verdicts as V
from claimgauge.functions.run_stamp import RunMeta
from claimgauge.operators import code_sets as sets
from claimgauge.operators.bounded import broadcast_if_within
from claimgauge.operators.catalog import (
    COMPLETENESS,
    DRG_SETS,
    MODELS,
    VALIDITY,
    CodeSet,
    FieldCheck,
)
from claimgauge.sources.scratch import stage
from claimgauge.sources.tables import Sources

GRAIN = ("data_source", "payer", "plan")
_LABELS = ("model_name", "field_name", "terminology_table", "terminology_field")
_FILLED = "is_completeness"
_COUNTERS = ("total_rows", "not_applicable_rows", "null_rows", "good_rows")


def _as_of(as_of: dt.date | str | None) -> str:
    if as_of is None:
        return "current_date()"
    return f"date {V.quoted(dt.date.fromisoformat(str(as_of)).isoformat())}"


def verdict(check: FieldCheck, as_of: str, hit: str | None = None) -> V.Verdict:
    """The rule of one catalogue entry, over the columns of its table."""
    value = check.field
    match check.kind:
        case "filled":
            rule = V.filled(value)
        case "in_reference" | "drg":
            rule = V.in_reference(value, hit)
        case "in_any_column":
            rule = V.in_any_column(value, hit)
        case "allowed_values":
            rule = V.allowed_values(value, check.allowed)
        case "date_range":
            rule = V.date_range(value, check.after, as_of)
        case "positive_number":
            rule = V.positive_number(value)
        case "not_null":
            rule = V.not_null(value)
        case "text_present":
            rule = V.text_present(value)
        case "ssn":
            rule = V.ssn(value)
        case "zip":
            rule = V.zip_code(value)
        case "phone":
            rule = V.phone(value)
        case "email":
            rule = V.email(value)
        case other:
            raise ValueError(f"unknown rule kind {other!r}")
    return rule.gated(check.gate and f"claim_type = {V.quoted(check.gate)}")


def _lookups(check: FieldCheck) -> list[tuple[CodeSet, str]]:
    """Code sets to probe and the value to probe them with; at most one can hit."""
    if check.kind == "drg":
        return [
            (code_set, f"case when drg_code_type = {V.quoted(kind)} then {check.field} end")
            for kind, code_set in DRG_SETS.items()
        ]
    return [(code_set, check.field) for code_set in check.code_sets]


def _labels(check: FieldCheck) -> str:
    texts = (check.model, check.field, check.terminology_table, check.terminology_field)
    named = [f"{'cast(null as string)' if text is None else V.quoted(text)} as {name}" for text, name in zip(texts, _LABELS)]
    return ", ".join([*named, f"{str(check.kind == 'filled').lower()} as {_FILLED}"])


@dataclass(frozen=True)
class _Counted:
    """A check ready for counting: its class per row, and how often the row counts."""

    check: FieldCheck
    rule: V.Verdict
    weight: str | None = None


# Good values of a check that are counted elsewhere.
_ELSEWHERE = "false"


def _counts(rule: V.Verdict, weight: str | None) -> dict[str, str]:
    """Aggregates of the classes that a rule can give.

    Of a check whose values are counted elsewhere, the rows that fail its gate are a count that others of that gate share.
    """
    if rule.good in (None, _ELSEWHERE) and weight is None:
        if rule.applies is None:
            return {"total_rows": "count(1)", "null_rows": f"count_if({rule.blank})"}
        return {
            "total_rows": "count(1)",
            "not_applicable_rows": f"count_if(not ({rule.applies}))",
            "null_rows": f"count_if(coalesce({rule.applies}, true) and {rule.blank})",
        }
    wanted = {"null_rows": V.NULL}
    if rule.applies is not None:
        wanted["not_applicable_rows"] = V.NOT_APPLICABLE
    if rule.good not in (None, _ELSEWHERE):
        wanted["good_rows"] = V.GOOD
    if weight is None:
        return {"total_rows": "count(1)"} | {name: f"count_if({rule.code()} = {v})" for name, v in wanted.items()}
    return {"total_rows": f"sum({weight})"} | {
        name: f"sum(case when {rule.code()} = {v} then {weight} else 0 end)" for name, v in wanted.items()
    }


def _count_side_by_side(frame: DataFrame, counted: Sequence[_Counted]) -> DataFrame:
    """All counters of a table in one aggregation, then one row per field.

    Rules stand inside the aggregates rather than in a projection below them:
    Spark generates a method per aggregate, and the loop over rows stays below
    the size (8000 bytes) from which the JVM would only interpret it. What several
    fields count alike, such as the rows that fail a gate, is counted once.
    """
    totals, unfolded = {"count(1)": "n"}, []
    for item in counted:
        counts = dict.fromkeys(_COUNTERS, "0")
        for name, count in _counts(item.rule, item.weight).items():
            counts[name] = totals.setdefault(count, f"count_{len(totals)}")
        if item.rule.good is None:
            counts["good_rows"] = "{total_rows} - {not_applicable_rows} - {null_rows}".format(**counts)
        numbers = ", ".join(f"cast({counts[name]} as bigint) as {name}" for name in _COUNTERS)
        unfolded.append(f"struct({_labels(item.check)}, {numbers})")
    wide = frame.groupBy(*GRAIN).agg(*[F.expr(f"{count} as {name}") for count, name in totals.items()])
    return wide.selectExpr(*GRAIN, f"inline(array({', '.join(unfolded)}))")


def _with_broadcast_lookups(
    frame: DataFrame, checks: Sequence[FieldCheck], codes: sets.PackedCodes
) -> tuple[DataFrame, dict[FieldCheck, str]]:
    """Probe the packed code sets next to each row; a repeated key is kept as a count.

    Returns the frame and, per check, the number of copies found (NULL if none).
    """
    copies: dict[FieldCheck, str] = {}
    for i, check in enumerate(checks):
        probes = _lookups(check)
        for j, (code_set, value) in enumerate(probes):
            found = codes.broadcast_table().withColumnsRenamed({"key": f"key_{i}_{j}", "copies": f"copies_{i}_{j}"})
            frame = frame.join(found, F.expr(f"{value} = key_{i}_{j}"), "left")
        if probes:
            found_copies = ", ".join(f"get(copies_{i}_{j}, {codes.places[s]})" for j, (s, _) in enumerate(probes))
            copies[check] = f"coalesce({found_copies})"
    return frame, copies


def _beside_weight(check: FieldCheck, codes: sets.PackedCodes) -> str | None:
    """How often a row counts before its value is looked up: NULL matches nothing, and the copies of the empty code are known."""
    blanks = [f"when {value} = '' then {codes.blanks[s]}L" for s, value in _lookups(check) if codes.blanks.get(s, 1) != 1]
    return f"case {' '.join(blanks)} else 1L end" if blanks else None


# Groups of a table that may be broadcast: source, payer, plan and a number.
MAX_BROADCAST_GRAINS = 1_000_000


def _numbered_grains(beside: DataFrame) -> DataFrame:
    """A number for each source, payer and plan, written so that it stays."""
    return stage(beside.select(*GRAIN).distinct().withColumn("grain", F.expr("monotonically_increasing_id()")), "grains")


def _count_by_value(
    frame: DataFrame, checks: Sequence[FieldCheck], codes: sets.PackedCodes, grains: DataFrame
) -> DataFrame:
    """For code sets too large to broadcast: what each value found in them adds to the counters beside the rows.

    A narrow row per value, joined to the codes by one shuffle, has the number of its group, the value and whether
    its gate fails, nothing else. Every row has counted once already, so that values that are not found add nothing,
    nor do values whose gate fails if their set lists every code once: the latter stay where they are. Codes are
    hashed, so that the values are not sorted. NULL and the empty text, often the commonest values, never travel;
    both inputs of the join come straight from a shuffle, so that any other hot value is split at run time.
    """
    grains = broadcast_if_within(grains, MAX_BROADCAST_GRAINS)
    probes = [(i, check, s, value) for i, check in enumerate(checks) for s, value in _lookups(check)]
    # gates of values that have to be looked up though they fail
    gates = sorted({c.gate for _, c, s, _ in probes if c.gate and s in codes.repeated})
    failed = " + ".join(f"case when not (claim_type = {V.quoted(g)}) then {1 << k} else 0 end" for k, g in enumerate(gates))
    same = " and ".join(f"{g} <=> grain_{g}" for g in GRAIN)
    known = grains.selectExpr("grain", *[f"{g} as grain_{g}" for g in GRAIN])

    def travelling(check: FieldCheck, code_set: CodeSet, value: str) -> str:
        if not check.gate or code_set in codes.repeated:
            return f"nullif({value}, '')"
        return f"case when not (claim_type = {V.quoted(check.gate)}) then null else nullif({value}, '') end"

    lines = frame.join(known, F.expr(same)).selectExpr(
        "grain",
        f"{failed or 0} as failed_gates",
        *[f"{travelling(c, s, value)} as `{k}`" for k, (_, c, s, value) in enumerate(probes)],
    )

    def by_probe(numbers: Iterable[int]) -> str:
        return f"array({', '.join(map(str, numbers))})[cast(probe as int)]"

    gated = by_probe(1 << gates.index(c.gate) if c.gate in gates else 0 for _, c, _, _ in probes)

    literal_null = [str(i) for i, c in enumerate(checks) if c.kind == "in_any_column"]
    blank = f"when entry in ({', '.join(literal_null)}) and value = 'NULL' then {V.NULL}" if literal_null else ""
    values = (
        lines.unpivot(["grain", "failed_gates"], [f"`{k}`" for k in range(len(probes))], "probe", "value")
        .where("value is not null")
        .selectExpr(
            # entry and failed gate in one number, so that a row stays narrow
            f"2 * {by_probe(i for i, *_ in probes)} + if((failed_gates & {gated}) > 0, 1, 0) as tag",
            "grain",
            f"{by_probe(codes.numbers[s] for _, _, s, _ in probes)} as set_no",
            "value",
        )
    )
    counted = (
        values.join(codes.shuffled_table(s for _, _, s, _ in probes).hint("shuffle_hash"), F.expr("set_no = known_set and value = key"), "left")
        .withColumn("entry", F.expr("tag div 2"))
        .selectExpr(
            "grain",
            "entry",
            "coalesce(copies, 1L) - 1L as more",
            f"case when tag % 2 = 1 then {V.NOT_APPLICABLE} {blank} when copies is null then {V.BAD} else {V.GOOD} end as verdict",
        )
        .groupBy("grain", "entry")
        .agg(
            F.expr("sum(more) as total_rows"),
            F.expr(f"sum(case when verdict = {V.NOT_APPLICABLE} then more else 0L end) as not_applicable_rows"),
            F.expr(f"sum(case when verdict = {V.NULL} then more else 0L end) as null_rows"),
            F.expr(f"sum(case when verdict = {V.GOOD} then more + 1L else 0L end) as good_rows"),
        )
    )
    labels = ", ".join(f"struct({_labels(check)})" for check in checks)
    return counted.join(grains, "grain").selectExpr(*GRAIN, f"array({labels})[cast(entry as int)] as label", *_COUNTERS).select(
        *GRAIN, "label.*", *_COUNTERS
    )


# Values that one job shuffles: five to seven gigabytes of shuffle files.
MAX_VALUES = 400_000_000


def _passes(beside: DataFrame, checks: Sequence[FieldCheck], codes: sets.PackedCodes) -> list[tuple[list[FieldCheck], int]]:
    """Checks in groups of at most ``MAX_VALUES`` values that travel, or of one check; fields of one code set lie together.

    The counters beside the rows know how many values each field has; the driver receives one row per field.
    """
    rows = beside.where(f"not {_FILLED}").groupBy("field_name").agg(
        F.expr("sum(total_rows - null_rows) as filled"), F.expr("sum(not_applicable_rows) as outside")
    )
    known = {row["field_name"]: row for row in rows.collect()}
    found: list[tuple[list[FieldCheck], int]] = []
    for check in sorted(checks, key=lambda c: [s.name for s in c.code_sets]):
        values = 0
        if check.field in known:
            row = known[check.field]
            stays = 0 if codes.repeated.intersection(check.code_sets) else row["outside"]
            values = row["filled"] - stays
        if found and found[-1][1] + values <= MAX_VALUES:
            found[-1] = ([*found[-1][0], check], found[-1][1] + values)
        else:
            found.append(([check], values))
    return found


def _counted_in_passes(
    waiting: Sequence[tuple[DataFrame, Sequence[FieldCheck], DataFrame]], codes: sets.PackedCodes
) -> list[DataFrame]:
    """What is found by value for (table, its checks, its counters beside the rows).

    If all values together are too many for one job, each pass is a job of its own that is written, and its shuffle
    files are gone before the next one starts. A pass reads only the columns of its checks.
    """
    passes = []
    for table, checks, beside in waiting:
        grains = _numbered_grains(beside)
        passes += [(table, grains, *one) for one in _passes(beside, checks, codes)]
    together = sum(values for *_, values in passes) <= MAX_VALUES
    counted = [_count_by_value(table, checks, codes, grains) for table, grains, checks, _ in passes]
    return counted if together else [stage(part, "values") for part in counted]


#: kinds whose rules look at a value as it is; all others compare it with text
_TYPED_KINDS = ("date_range", "positive_number", "not_null")


def _as_text(frame: DataFrame, checks: Sequence[FieldCheck]) -> DataFrame:
    """Codes as text, whatever type the table gives them: 0450 and 450 are told apart only by text columns."""
    wanted = {c.field for c in checks if c.kind not in _TYPED_KINDS}
    if any(c.gate for c in checks):
        wanted.add("claim_type")
    if any(c.kind == "drg" for c in checks):
        wanted.add("drg_code_type")
    typed = {f.name: f.dataType for f in frame.schema.fields if f.name in wanted}
    return frame.withColumns({n: F.col(n).cast("string") for n, kind in typed.items() if not isinstance(kind, StringType)})


def _tally(
    sources: Sources,
    checks: Iterable[FieldCheck],
    as_of: str,
    broadcast_limit: int = sets.BROADCAST_LIMIT,
) -> DataFrame:
    """Counters per (data_source, payer, plan, field) for all given checks."""
    checks = tuple(checks)
    used = {s for c in checks for s in c.code_sets}
    # counted once for all that share these code sets
    name = f"codes within {broadcast_limit}: {sorted(s.name for s in used)}"
    codes = sources.references.derived(name, lambda: sets.pack(sources.references, used, broadcast_limit))
    parts, waiting = [], []
    for model in MODELS:
        mine = [c for c in checks if c.model == model]
        if not mine:
            continue
        by_value = [c for c in mine if not set(c.code_sets) <= codes.places.keys()]
        beside = [c for c in mine if c not in by_value]
        table = _as_text(sources.table(model), mine)
        frame, copies = _with_broadcast_lookups(table, beside, codes)
        counted = [
            _Counted(c, verdict(c, as_of, f"{copies[c]} is not null"), f"coalesce({copies[c]}, 1L)")
            if c in copies
            else _Counted(c, verdict(c, as_of))
            for c in beside
        ]
        counted += [_Counted(c, verdict(c, as_of, _ELSEWHERE), _beside_weight(c, codes)) for c in by_value]
        parts.append(_count_side_by_side(frame, counted))
        if by_value:
            parts[-1] = stage(parts[-1], "beside-values")
            waiting.append((table, by_value, parts[-1]))
    if not parts:
        raise ValueError("no checks given")
    tally = reduce(DataFrame.unionByName, [*parts, *_counted_in_passes(waiting, codes)])
    if not waiting:
        return tally
    return tally.groupBy(*GRAIN, *_LABELS, _FILLED).agg(*[F.expr(f"sum({c}) as {c}") for c in _COUNTERS])


def _percent(part: str, whole: str) -> str:
    """Zero-safe share in percent, 0.0 where the whole is 0."""
    return f"coalesce(100D * cast({part} as double) / nullif(cast({whole} as double), 0D), 0D)"


def _finish(tally: DataFrame, run: RunMeta, labels: Sequence[str], shares: Sequence[str]) -> DataFrame:
    counts = ["total_rows", "applicable_rows", *shares]
    return (
        tally.withColumn("applicable_rows", F.expr("total_rows - not_applicable_rows"))
        .withColumns({"run_id": run.id_column(), "run_ts": run.ts_column()})
        .selectExpr(
            "run_id",
            "run_ts",
            *GRAIN,
            *labels,
            *counts,
            "case when total_rows > 0 then 100D else 0D end as total_rows_pct",
            *[f"{_percent(c, 'total_rows')} as {c}_pct" for c in counts[1:]],
        )
    )


def _completeness(tally: DataFrame, run: RunMeta) -> DataFrame:
    return _finish(
        tally.withColumnRenamed("good_rows", "non_null_rows"),
        run,
        ("model_name", "field_name"),
        ("not_applicable_rows", "null_rows", "non_null_rows"),
    )


def _validity(tally: DataFrame, run: RunMeta) -> DataFrame:
    counted = (
        tally.withColumnRenamed("good_rows", "valid_rows")
        .withColumn("non_null_rows", F.expr("total_rows - not_applicable_rows - null_rows"))
        .withColumn("invalid_rows", F.expr("non_null_rows - valid_rows"))
    )
    summary = _finish(
        counted,
        run,
        _LABELS,
        ("not_applicable_rows", "null_rows", "non_null_rows", "valid_rows", "invalid_rows"),
    )
    return summary.withColumn(
        "valid_rows_applicable_pct", F.expr(_percent("valid_rows", "applicable_rows"))
    )


def completeness_summary(
    sources: Sources, run: RunMeta, checks: Iterable[FieldCheck] = COMPLETENESS
) -> DataFrame:
    """Null, filled and not-applicable rows per source, payer, plan and field."""
    return _completeness(_tally(sources, checks, _as_of(None)), run)


def validity_summary(
    sources: Sources,
    run: RunMeta,
    checks: Iterable[FieldCheck] = VALIDITY,
    as_of: dt.date | str | None = None,
    broadcast_limit: int = sets.BROADCAST_LIMIT,
) -> DataFrame:
    """Valid, invalid, null and not-applicable rows per source, payer, plan and field."""
    return _validity(_tally(sources, checks, _as_of(as_of), broadcast_limit), run)


def field_summaries(
    sources: Sources,
    run: RunMeta,
    as_of: dt.date | str | None = None,
    broadcast_limit: int = sets.BROADCAST_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """Completeness and validity from one pass: each checked table is read once for both.

    The counters are written, and both summaries read them: a few rows per source, payer, plan and field.
    """
    tally = stage(_tally(sources, (*COMPLETENESS, *VALIDITY), _as_of(as_of), broadcast_limit), "field-counters")
    return _completeness(tally.where(_FILLED), run), _validity(tally.where(f"not {_FILLED}"), run)
