"""Quality rules of documents, judged together with the record of their host.

Each document is measured and checked by base rules. Failures are counted by
host, and a host's failure rate is shrunk towards the rate of all hosts with a
beta prior that is fitted to the hosts themselves. A document is kept if it
passes the base rules and its host's shrunk rate stays at or below
``max_host_rate``; a host has to fail mostly to take passing documents with it.

All steps are column functions: one pass over the texts, counts per host that
are combined before their shuffle, and a join of the small measures with the
hosts, whose hot keys Spark can split.

Defined results: a null text has no words and fails. A document without a host
is judged by its own rules only and counts for no host. Repeated rows count as
often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.text_columns import BLANK_RUN, words
from claimgauge.sources.scratch import stage

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class RuleLimits:
    min_words: int = 20
    max_repeat_percent: int = 30
    #: a host above this shrunk failure rate loses all its documents
    max_host_rate: float = 0.5
    #: bounds of the prior's weight, in documents
    min_prior: float = 1.0
    max_prior: float = 1e6


def _sorted_windows(windows: Column) -> Column:
    """Windows by hash and place; null where no window occurs twice, which is true of most texts."""
    at = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), at)


def _covered(at: Column) -> Column:
    """Words covered by windows that occur twice or more; ``at`` has to be a computed column."""

    def twin(k: Column, step: int, own: Column) -> Column:
        return F.coalesce(F.get(at, k + step)["h"] == own["h"], F.lit(False))

    marked = F.transform(at, lambda x, k: F.when(twin(k, -1, x) | twin(k, 1, x), x["i"]))
    starts = F.sort_array(F.filter(marked, lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))

    def add(state: Column, i: Column) -> Column:
        more = F.least(F.lit(WINDOW), i - state["last"])
        return F.struct((state["n"] + more).alias("n"), i.alias("last"))

    return F.aggregate(starts, zero, add, lambda state: state["n"])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as the struct ``row`` with the measures beside it."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), body.alias("body"))
    lines = F.filter(F.split("body", "\n"), lambda line: F.regexp_replace(line, BLANK_RUN, "") != "")
    rows = rows.select("row", "body", words(F.col("body")).alias("words"), lines.alias("lines"))
    rows = rows.select(
        "row",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    starts = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    # get() takes constant time; slice() would copy the array for each window
    windows = F.transform(starts, lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW))))
    rows = rows.select("row", F.col("n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", windows.alias("w"))
    rows = rows.withColumn("w", _sorted_windows(F.col("w")))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_covered(F.col("w")), F.lit(0))).drop("w")
    # a generator, because a filter on a measure would otherwise be moved below the steps above and
    # carry a copy of all of them, computed again for each element
    measures = F.struct(*(F.col(m).cast("long").alias(m) for m in MEASURES))
    return rows.select("row", F.inline(F.array(measures)))


def base_failed(limits: RuleLimits) -> Column:
    repeats = 100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    return (F.col("n_words") < limits.min_words) | repeats


def host_rates(checked: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Per host: n_docs, n_failed, shrunk_rate and whether it is rejected.

    ``checked`` has the columns host and failed. The prior has the mean rate of
    all documents and the spread between hosts that sampling alone does not
    explain.
    """
    known = checked.where(F.col("host").isNotNull())
    counts = known.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    hosts = stage(counts, "host-failures")
    n, failed = F.col("n_docs"), F.col("n_failed")
    total = hosts.agg(
        F.sum(n).alias("n"), F.sum(failed).alias("failed"), F.count("*").alias("hosts"),
        F.sum(failed * failed / n).alias("squares"),
    ).first()
    mean = (total["failed"] or 0) / (total["n"] or 1)
    within = mean * (1 - mean)
    spread = 0.0
    if total["n"]:
        # sum of n (rate - mean)^2, less what binomial sampling gives
        spread = (total["squares"] - total["n"] * mean * mean - within * (total["hosts"] - 1)) / total["n"]
    weight = limits.max_prior if within / limits.max_prior >= spread else within / spread - 1
    weight = min(max(weight, limits.min_prior), limits.max_prior)
    rate = (failed + F.lit(mean * weight)) / (n + F.lit(weight))
    return hosts.withColumn("shrunk_rate", rate).withColumn(
        "host_rejected", F.col("shrunk_rate") > limits.max_host_rate
    )


def judge(measured: DataFrame, host: str, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Adds base_failed and kept to the output of :func:`measure`; ``host`` is a field of ``row``."""
    checked = measured.withColumn("base_failed", base_failed(limits)).withColumn("host", F.col("row").getField(host))
    rejected = host_rates(checked.select("host", F.col("base_failed").alias("failed")), limits)
    rejected = rejected.where("host_rejected").select("host", "host_rejected")
    judged = checked.join(rejected, "host", "left")
    return judged.select(
        "row", *MEASURES, "base_failed",
        (~F.col("base_failed") & F.col("host_rejected").isNull()).alias("kept"),
    )


def verdicts(docs: DataFrame, limits: RuleLimits = RuleLimits(), text: str = "text", host: str = "source", key: str = "doc_id") -> DataFrame:
    """One row per document: key, measures, base_failed and kept. The texts are read once."""
    slim = measure(docs.select(*{c: F.col(f"`{c}`") for c in (key, host, text)}.values()), text)
    slim = slim.select(F.struct(F.col("row").getField(key).alias(key), F.col("row").getField(host).alias("host")).alias("row"), *MEASURES)
    judged = judge(stage(slim, "rule-measures"), "host", limits)
    return judged.select(F.col("row").getField(key).alias(key), *MEASURES, "base_failed", "kept")


def keep_good(docs: DataFrame, limits: RuleLimits = RuleLimits(), text: str = "text", host: str = "source") -> DataFrame:
    """The kept rows of ``docs``, with the same columns. Texts are measured twice, and not shuffled."""
    return judge(measure(docs, text), host, limits).where("kept").select("row.*")
