"""Quality rules against a plain Python version, and the edge cases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimgauge.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(rules.SYMBOLS, text)), len(lines) - len(set(lines)), len(covered),
    )


def failed(m):
    return m[0] < 20 or 100 * m[4] > 30 * m[0]


def test_measures_match_plain_python(spark, documents):
    found = {r[0]: r for r in rules.verdicts(documents).collect()}
    assert len(found) == documents.count()
    for row in documents.collect():
        want = brute(row.text)
        assert tuple(found[row.doc_id][1:6]) == want
        assert found[row.doc_id].base_failed == failed(want)
        assert found[row.doc_id].kept in ({False} if failed(want) else {True, False})


EDGE = [
    (1, None, "en", "a", 0),
    (2, "", None, "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", None, 7),
    (4, "one " * 9, "en", None, None),
    (5, "a b c d e f g h " * 3 + "x", "en", "b", 1),
    (5, "a b c d e f g h " * 3 + "x", "en", "b", 1),
    (None, " ".join(f"w{i}" for i in range(30)), "en", "b", 1),
    (7, "same\nsame\n\n \nsame", "en", "b", 1),
    (8, " ".join(f"w{i}" for i in range(50_000)), "en", "a", 1),
    (9, "é ü # x | " * 40, "de", "c", 1),
]


def test_edge_rows(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumns({"kept": F.lit(1), "n_words": F.lit("x"), "row": F.lit(2)})
    got = sorted((tuple(r) for r in rules.verdicts(docs).collect()), key=str)
    assert len(got) == len(EDGE)
    for doc_id, text, *_ in EDGE:
        want = brute(text)
        assert any(r[0] == doc_id and tuple(r[1:6]) == want and r[6] == failed(want) for r in got)
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in got if r[7]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert rules.verdicts(docs).count() == 0
    assert rules.keep_good(docs).count() == 0


def test_a_host_that_mostly_fails_takes_its_passing_documents_with_it(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad", "en", "spam", 1) for i in range(50)] + [(100, good, "en", "spam", 1)]
    rows += [(200 + i, good, "en", f"h{i % 9}", 1) for i in range(90)]
    rows += [(300, "bad", "en", "one", 1), (301, good, "en", None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in rules.verdicts(docs).collect()}
    assert not out[100].kept and not out[100].base_failed
    assert all(out[200 + i].kept for i in range(90))
    assert out[301].kept and not out[300].kept


def test_one_failure_is_shrunk_towards_all_hosts(spark):
    rows = [("one", True)] + [(f"h{i}", k == 0 and i % 2 == 0) for i in range(40) for k in range(20)]
    checked = spark.createDataFrame(rows, "host string, failed boolean")
    one = rules.host_rates(checked).where("host = 'one'").first()
    assert one.shrunk_rate < 0.2 and not one.host_rejected


@pytest.mark.parametrize("failed_", [True, False])
def test_hosts_without_any_spread(spark, failed_):
    checked = spark.createDataFrame([("a", failed_), ("b", failed_)], "host string, failed boolean")
    assert {r.host_rejected for r in rules.host_rates(checked).collect()} == {failed_}
