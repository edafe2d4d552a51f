"""A training corpus from raw documents: the stages, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

1. quality: documents whose quality score is under the floor go;
2. near_dedup: one document of each near-duplicate group stays;
3. decontamination: documents that hold a benchmark passage go;
4. personal_data: personal data in the texts is replaced by its kind;
5. packing: the texts as pieces, with their token ids, placed in fixed-size
   token sequences.

Null and empty texts have a quality like any other; those that stay are linked
with nothing, hold no passage and no personal data, and pack as their closing
id.  Null ids are kept.  Of rows that are equal, or near-equal, one stays.
Extra columns may have any names and pass through to the last stage, which
reads doc_id and text only.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontamination, neardup, packing, pii, quality
from ledgerspark.llm.common import load, stored
from ledgerspark.llm.queries import CAPACITY, QUALITY_FLOOR, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, F.col("text")) >= QUALITY_FLOOR)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(), CAPACITY)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: no SQL: compression, MinHash and tokenisation have none
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
