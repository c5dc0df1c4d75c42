"""A training corpus from raw documents: judge, clean, dedup, mix, encode.

Each stage takes what the one before kept, as a written table, and all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.llm import fuzzy_lines, mixing, near_documents, quality_rules
from claimgauge.llm.registered import piece_model_path, sentence_piece_digests, table
from claimgauge.sources.scratch import stage

#: no SQL has the library's SentencePiece encoding; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def judge_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules or their host's record reject go."""
    return quality_rules.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that nearly agree the first one stays; documents left without a word go."""
    left = fuzzy_lines.dedup_lines(docs, length="n_chars")
    return left.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]")) > 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the first by id and text; repeated rows are one document."""
    found = stage(near_documents.members_of(docs).where("doc_id is not null").select("doc_id", "tie", "group"), "near-groups")
    first = found.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    kept = first.select("first.*").union(found.where("group is null").select("doc_id", "tie").distinct())
    kept = stage(kept, "kept-documents").withColumnsRenamed({"doc_id": "kept_id", "tie": "kept_tie"})
    # of equal ids and texts the first row in order stays
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), F.struct("text", *(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    )
    rows = rows.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("tie") == F.col("kept_tie")), "left_semi")
    single = rows.groupBy("id", "tie").agg(F.min("row").alias("row"))
    single = single.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
    return single.unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    return mixing.mixed(docs, length="n_chars")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the ids and of the text decoded from them, per row of the mix.

    Python workers keep their words for later tasks: fewer here, because they go on to other stages.
    """
    return sentence_piece_digests(docs, piece_model_path(), cache_words=30_000)


STAGES = [
    ("quality_rules", judge_by_rules),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentence_pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written, and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
