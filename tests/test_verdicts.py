"""Edge values of every rule kind."""

import datetime as dt

import pytest

from claimgauge.functions import verdicts as V

D = dt.date
AS_OF = "date '2025-01-01'"

CASES = {
    "ssn": (
        V.ssn("x"),
        ["123456789", "123-45-6789"],
        ["12345678X", "1234-5-6789", "123-45-67-9", "123456789\n", "12345678", "123-45-678\n"],
        [None, ""],
    ),
    "zip": (
        V.zip_code("x"),
        ["12345", "123456789", "12345-6789"],
        ["1234", "12345_6789", "1234-56789", "12345\n", "1234-6789"],
        [None, ""],
    ),
    "phone": (
        V.phone("x"),
        ["(555) 123-4567", "555.123.4567", "15551234567", "1 (555) 123-4567"],
        ["25551234567", "555123456", "+15551234567", "5551234567\n", "-", "155512345678"],
        [None, ""],
    ),
    "email": (V.email("x"), ["a@b.c", "@"], ["nobody", " "], [None, ""]),
    "text_present": (V.text_present("x"), ["12 Main St", " ", "null"], [], [None, "", "NULL"]),
    "not_null": (V.not_null("x"), ["A1", "", "NULL"], [], [None]),
    "allowed": (
        V.allowed_values("x", ("male", "female", "unknown")),
        ["male", "female", "unknown"],
        ["M", "Male", " "],
        [None, ""],
    ),
    "in_reference": (V.in_reference("x", "x like 'A%'"), ["A1"], ["B1", "NULL"], [None, ""]),
    "in_any_column": (V.in_any_column("x", "x like 'A%'"), ["A1"], ["B1"], [None, "", "NULL"]),
    "quote": (V.allowed_values("x", ("O'Hara", "a\\b")), ["O'Hara", "a\\b"], ["OHara"], [None]),
}


def statuses(spark, kind, rule, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.s for r in rows.select("i", rule.status().alias("s")).orderBy("i").collect()]


@pytest.mark.parametrize("name", CASES)
def test_text_rules(spark, name):
    rule, valid, invalid, null = CASES[name]
    expected = ["valid"] * len(valid) + ["invalid"] * len(invalid) + ["null"] * len(null)
    assert statuses(spark, "string", rule, valid + invalid + null) == expected


def test_date_range_is_strict_on_both_ends(spark):
    since_1970 = V.date_range("x", "1970-01-01", AS_OF)
    values = [D(1970, 1, 2), D(2024, 12, 31), D(1970, 1, 1), D(2025, 1, 1), D(2999, 1, 1), None]
    assert statuses(spark, "date", since_1970, values) == ["valid"] * 2 + ["invalid"] * 3 + ["null"]
    since_1900 = V.date_range("x", "1900-01-01", AS_OF)
    values = [D(1900, 1, 2), D(1900, 1, 1), D(2999, 1, 1), None]
    assert statuses(spark, "date", since_1900, values) == ["valid", "invalid", "invalid", "null"]


def test_positive_number(spark):
    values = [0.5, 1.0, 0.0, -1.0, None]
    assert statuses(spark, "double", V.positive_number("x"), values) == (
        ["valid"] * 2 + ["invalid"] * 2 + ["null"]
    )


def test_filled_status_labels(spark):
    rows = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, " ")], "i int, x string")
    found = rows.select("i", V.filled("x").status(good="non_null").alias("s")).orderBy("i").collect()
    assert [r.s for r in found] == ["non_null", "null", "null", "non_null"]


def test_unknown_gate_is_still_checked(spark):
    rows = spark.createDataFrame(
        [(1, "institutional"), (2, None), (3, "professional"), (4, "dental"), (5, "")], "i int, claim_type string"
    ).selectExpr("*", "'A1' as x")
    rule = V.filled("x").gated("claim_type = 'institutional'")
    found = rows.select("i", rule.status(good="non_null").alias("s")).orderBy("i").collect()
    assert [r.s for r in found] == ["non_null", "non_null"] + ["not_applicable"] * 3


def test_code_and_status_agree(spark):
    rule = V.ssn("x").gated("y > 0")
    rows = spark.createDataFrame(
        [(x, y) for x in ("123456789", "1", "", None) for y in (1, 0, None)], "x string, y int"
    )
    names = {V.NOT_APPLICABLE: "not_applicable", V.NULL: "null", V.GOOD: "valid", V.BAD: "invalid"}
    for r in rows.selectExpr("x", "y", f"{rule.code()} as c").withColumn("s", rule.status()).collect():
        assert names[r.c] == r.s
