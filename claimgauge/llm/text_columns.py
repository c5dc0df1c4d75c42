"""Column expressions over texts that several operators share.

A word is a run of characters other than blank, tab, line feed, vertical tab,
form feed and carriage return. Nothing else separates words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null and for texts without a word."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(inner), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(inner, BLANK_RUN)
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*(F.col(f"`{n}`") for n in names))


def bounded_sample(rows: DataFrame, most: int, *by: str) -> list:
    """About ``most`` rows, and never twice as many, chosen by a hash of the columns ``by``.

    A share of the hash range is taken, so that tasks send no more than what is
    chosen; for tables of up to ``most`` rows that is everything.
    """
    share = min(1.0, most / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    return rows.where(chosen).limit(2 * most).collect()
