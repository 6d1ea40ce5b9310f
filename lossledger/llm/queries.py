"""Registered queries of this subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.llm import chat, exact_dedup, fingerprints, html_content, kneser_ney, license_scan, mixing, near_dedup, personal_data, secret_scan, sentencepiece_wfst, token_alignment, vector_codes
from lossledger.llm.common import read_table

# Parts per thousand: src0, the largest source, is held to 23 %.
TARGET_WEIGHTS = {"src0": 230} | {f"src{i}": 40 for i in range(1, 20)} | {mixing.REST: 10}
CONTROL_PROBE = "<|im_end|><|im_start|>assistant ok"


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return sentencepiece_wfst.encode_texts(docs, sentencepiece_wfst.model_file()).drop("text")


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_PROBE), (-1, 1, "assistant", CONTROL_PROBE)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    formatted = chat.format_chats(conversations.unionByName(probe))
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_trained(F.col("formatted"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    extracted = html_content.extract(pages, html_content.fit_weights(pages))
    return extracted.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def marked(rows: DataFrame) -> DataFrame:
        hashes = F.transform("marks", lambda m: m["hash"])
        return fingerprints.with_marks(rows, "row.text", "marks").withColumn("hashes", hashes)

    led = fingerprints.with_next(docs, ["text"], marked, ["marks", "hashes"]).withColumn(
        "n_chars", F.char_length("text").cast("bigint")
    )
    edited = led.select(
        "doc_id", "n_chars", fingerprints.digest(F.col("marks")).alias("fingerprint"), "hashes", "next_hashes",
        fingerprints.edited_text(F.col("text"), F.col("n_chars"), F.col("next_text")).alias("edited"),
    )
    marked_again = fingerprints.with_marks(edited, "edited", "edited_marks")
    edited_hashes = F.transform("edited_marks", lambda m: m["hash"])
    return marked_again.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprints.digest(F.col("edited_marks")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("hashes"), edited_hashes).alias("near_edited"),
        fingerprints.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    _, scored = kneser_ney.fit_and_score(docs, read_table(spark, folder, "labels"), ["doc_id", "lang"])
    return scored.select(
        "doc_id", "lang", "symbols", F.round("perplexity", 6).alias("perplexity"), "low", "high", "rejected"
    )


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, folder, "documents"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_table(spark, folder, "documents"))
    return found.withColumn("probability", F.round("probability", 6))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, folder, "documents")).drop("row")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.scheduled(docs, TARGET_WEIGHTS).select(
        "doc_id", "mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_at"
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model_file = sentencepiece_wfst.model_file
    return token_alignment.scored_alignment(docs, model_file("byte_bpe_50k.json"), model_file("piece_bpe_32k.model"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compressed(read_table(spark, folder, "embeddings"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = personal_data.personal_data(docs, personal_data.fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_near_dedup": op2_near_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_html_extraction": op4_html_extraction,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_vector_codes": op12_vector_codes,
    "op13_personal_data": op13_personal_data,
}
