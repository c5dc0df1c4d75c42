"""Field rules as Spark SQL expressions.

A rule turns a field into a :class:`Verdict`: three conditions that place every
row in exactly one of four classes. Rules are expression text, so that dozens
of them cost a few calls into the JVM to build, and they stay inside generated
code when they run: there is no Python in the path of a row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_APPLICABLE, NULL, GOOD, BAD = range(4)


def quoted(text: str) -> str:
    """A string as a SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Verdict:
    """First match wins: gate fails, blank, good, otherwise bad.

    ``applies`` is the gate. It is negated under three-valued logic, so a row
    whose gate is NULL is still checked. ``good=None`` means that every value
    that is not blank is good.
    """

    blank: str
    good: str | None = None
    applies: str | None = None

    def gated(self, applies: str | None) -> Verdict:
        return self if applies is None else replace(self, applies=applies)

    def _case(self, not_applicable, null, good, bad) -> str:
        gate = "" if self.applies is None else f"when not ({self.applies}) then {not_applicable} "
        last = f"else {good}" if self.good is None else f"when {self.good} then {good} else {bad}"
        return f"case {gate}when {self.blank} then {null} {last} end"

    def status(self, good: str = "valid", bad: str = "invalid") -> Column:
        """The class as text, one of not_applicable / null / good / bad."""
        return F.expr(self._case(*map(quoted, ("not_applicable", "null", good, bad))))

    def code(self) -> str:
        """The class as a small integer, cheap to compare while counting."""
        return self._case(NOT_APPLICABLE, NULL, GOOD, BAD)


def _blank(value: str) -> str:
    return f"({value} is null or {value} = '')"


def filled(value: str) -> Verdict:
    """Completeness: anything but NULL and '' counts as present."""
    return Verdict(blank=_blank(value))


def in_reference(value: str, hit: str) -> Verdict:
    """``hit`` says whether the value was found in its code set."""
    return Verdict(blank=_blank(value), good=hit)


def in_any_column(value: str, hit: str) -> Verdict:
    """Like :func:`in_reference`, and the literal text NULL counts as missing."""
    return Verdict(blank=f"({value} is null or {value} in ('', 'NULL'))", good=hit)


def allowed_values(value: str, allowed: Iterable[str]) -> Verdict:
    return Verdict(blank=_blank(value), good=f"{value} in ({', '.join(map(quoted, allowed))})")


def date_range(value: str, after: str, as_of: str) -> Verdict:
    """Strictly between a fixed lower bound and the as-of date (an expression)."""
    return Verdict(
        blank=f"{value} is null", good=f"({value} > date {quoted(after)} and {value} < {as_of})"
    )


def positive_number(value: str) -> Verdict:
    return Verdict(blank=f"{value} is null", good=f"{value} > 0")


def not_null(value: str) -> Verdict:
    """Only NULL is missing; '' and the text NULL count as values."""
    return Verdict(blank=f"{value} is null")


def text_present(value: str) -> Verdict:
    return Verdict(blank=f"({value} is null or {value} in ('', 'NULL'))")


def _matches(value: str, pattern: str) -> str:
    # \A and \z, because '$' also matches before a final newline in Java
    return f"{value} rlike r'\\A(?:{pattern})\\z'"


def ssn(value: str) -> Verdict:
    """123456789 or 123-45-6789."""
    return Verdict(blank=_blank(value), good=_matches(value, "[0-9]{9}|[0-9]{3}-[0-9]{2}-[0-9]{4}"))


def zip_code(value: str) -> Verdict:
    """12345, 123456789 or 12345-6789."""
    return Verdict(blank=_blank(value), good=_matches(value, "[0-9]{5}(?:-?[0-9]{4})?"))


def phone(value: str) -> Verdict:
    """Ten digits, or eleven with a leading 1, with - ( ) blank and dot anywhere between them."""
    return Verdict(blank=_blank(value), good=_matches(value, "[-() .]*(?:1[-() .]*)?(?:[0-9][-() .]*){10}"))


def email(value: str) -> Verdict:
    return Verdict(blank=_blank(value), good=f"contains({value}, '@')")
