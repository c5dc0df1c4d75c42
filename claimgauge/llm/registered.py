"""Queries of the corpus operators over the driver's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.llm import collocations, fuzzy_lines, languages, license_scan, line_quality, mixing, near_documents, near_vectors, paragraph_sketches, quality_rules, sentence_pieces, token_alignment, web_archives
from claimgauge.llm import oracle_sql as oracle

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def sentence_piece_digests(docs: DataFrame, model_path: str, cache_words: int = 200_000) -> DataFrame:
    """doc_id, number of ids, SHA-256 of the ids and of the decoded text; null texts count as empty."""
    encoded = sentence_pieces.encode(docs.select("doc_id", "text"), model_path, cache_words=cache_words).select("doc_id", "ids")
    decoded = sentence_pieces.decode(encoded, model_path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def held_out() -> Column:
    """Documents that nothing is learned from; those without an id are not among them."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return F.coalesce(fold == 1, F.lit(False))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.train(docs))


def op2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = languages.train(docs.where(~held_out()))
    return languages.predict(docs, net, keep=("doc_id", held_out().alias("held_out")))


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = line_quality.train(docs, labels.where(~held_out()))
    return line_quality.score(docs, model, keep=("doc_id", held_out().alias("held_out")))


def op4_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = web_archives.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_piece_digests(table(spark, sf_dir, "documents"), piece_model_path())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op6_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents.near_duplicates(table(spark, sf_dir, "documents"))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.line_report(table(spark, sf_dir, "documents"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.taken_words(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


def op11_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_sketches.version_report(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, byte_model_path(), piece_model_path())


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_languages": op2_languages,
        "op3_line_quality": op3_line_quality,
        "op4_web_archives": op4_web_archives,
        "op5_sentence_pieces": op5_sentence_pieces,
        "op6_near_documents": op6_near_documents,
        "op7_fuzzy_lines": op7_fuzzy_lines,
        "op8_near_vectors": op8_near_vectors,
        "op9_mixing": op9_mixing,
        "op10_quality_rules": op10_quality_rules,
        "op11_paragraph_sketches": op11_paragraph_sketches,
        "op12_collocations": op12_collocations,
        "op13_token_alignment": op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_near_documents": oracle.NEAR_DOCUMENTS,
        "op8_near_vectors": oracle.NEAR_VECTORS,
        "op10_quality_rules": oracle.QUALITY_RULES,
        "op12_collocations": oracle.COLLOCATIONS,
    }
