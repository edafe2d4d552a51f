"""The operators over the given tables, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import bitplanes, language, merkle, periods, pitmanyor, quality, warc
from ledgerspark.llm.common import crc_mod, load
from ledgerspark.llm.decontamination import contaminated
from ledgerspark.llm.extraction import extract
from ledgerspark.llm.neardup import near_duplicates
from ledgerspark.llm.oracle import ORACLE
from ledgerspark.llm.packing import pack_documents
from ledgerspark.llm.pii import personal_data
from ledgerspark.llm.syncmers import edited_fingerprints

CAPACITY = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few 2048-token sequences as best fit finds."""
    docs = load(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path(), CAPACITY, keep_ids=False).drop("ids")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-syncmer fingerprints of every text and its edited text."""
    return edited_fingerprints(load(spark, sf_dir, "documents"))


#: scores from here on count as label 1
QUALITY_FLOOR = 0.3


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression score of every text, learned off the held-out fifth."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = quality.train(docs, labels, crc_mod("doc_id", 5) != 0)
    return docs.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), quality.score(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= QUALITY_FLOOR).cast("int"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text, learned off the held-out seventh."""
    docs = load(spark, sf_dir, "documents")
    return pitmanyor.scores(docs, crc_mod("doc_id", 7) != 2).select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: 4-word shingles, 0.8."""
    return near_duplicates(load(spark, sf_dir, "documents"), ngram=4, threshold=0.8).drop("rid")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every text, and those found by their contexts."""
    return personal_data(load(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2(F.col("base_list").cast("binary"), 256).alias("base_sha256"),
        F.col("spans_list").alias("spans"),
    )


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (document, benchmark item) pairs that leak, with their best window."""
    docs, items = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    return contaminated(docs, items).drop("rid")


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response record."""
    records = warc.derivatives(warc.responses(load(spark, sf_dir, "pages")))
    return warc.described(records)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(load(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned off the held-out third."""
    docs = load(spark, sf_dir, "documents")
    model = language.train(docs, crc_mod("doc_id", 3) != 1)
    return docs.select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        language.language(model, F.col("text")).alias("p"),
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; some are tampered with."""
    return merkle.manifest(load(spark, sf_dir, "documents")).drop("proof")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word runs of three periods and more in every text, some of them planted."""
    docs = load(spark, sf_dir, "documents")
    return periods.periodic_runs(docs, plant=True, keep_text=False).drop("runs", "collapsed")


def op13_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as bit planes and read back."""
    return bitplanes.round_trip(load(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_personal_data": op9_personal_data,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_binary_output": op13_binary_output,
}

__all__ = ["CAPACITY", "ORACLE", "QUALITY_FLOOR", "QUERIES", "tokenizer_path"]
