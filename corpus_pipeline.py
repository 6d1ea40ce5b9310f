"""The corpus pipeline: quality, exact copies, near copies, mixing order, tokens.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of `documents`; what a stage
decides holds for the stages after it. doc_id has to be a key of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lossledger.llm import exact_dedup, kneser_ney, mixing, near_dedup, sentencepiece_wfst
from lossledger.llm.common import read_table, stored
from lossledger.llm.queries import TARGET_WEIGHTS

#: The near-copy stage links texts by this rule; op2_near_dedup has its own, of 3 words and 85 %.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the language model of trusted text rejects."""
    return kneser_ney.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share 80 % of their 5-word shingles, or are linked by such, the smallest doc_id."""
    return near_dedup.keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order in which the sources take turns."""
    return mixing.mixed(docs, TARGET_WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of the text that they decode to, its slot, block and place in the
    block. Rows lie in the order of the slots. Readers of several files do not keep an order, so the schedule is made
    again from the rows (it depends on nothing else) and stands in columns."""
    laid = mixing.laid_out(docs.select("doc_id", "text", "lang", "source"), TARGET_WEIGHTS)
    encoded = sentencepiece_wfst.encode_texts(laid, sentencepiece_wfst.model_file())
    return encoded.select(
        "doc_id", "lang", "source", "mix_source", "mix_slot", "mix_block", "mix_at",
        "n_tokens", "token_ids", "decoded_sha256", "round_trip",
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

# The language model's sums, minhash links and merges by rank are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
