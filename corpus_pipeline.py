"""The corpus pipeline: five operators of ``recoda.llm``, one after the other, over ``documents``.

Every stage works on all rows its predecessor kept; all but the last return the
columns of ``documents`` (``n_chars`` follows the text where a stage changes it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoda.llm import decontaminate, line_dedup, packing, quality, simhash
from recoda.llm.common import stored, table
from recoda.llm.jobs import END_ID, MAX_BITS, SEQUENCE, SHINGLE, WINDOW, tokenizer_file
from recoda.llm.oracle import PIPELINE_SQL


def _with_length(docs: DataFrame, like: DataFrame) -> DataFrame:
    length = F.char_length("text").cast(like.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", length).select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail are gone; boilerplate lines are cut from the others."""
    return _with_length(quality.filter_quality(docs), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks are cut; every document stays, with what is left of its text."""
    return _with_length(line_dedup.strip_repeated_lines(docs), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component stays."""
    return simhash.drop_near_copies(docs, SHINGLE, MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window are gone."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), WINDOW)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left and their places in the sequences."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), SEQUENCE, END_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", pack),
]

# SimHash's XXH64 and the tokenizer's ids have no SQL; tests compare with a brute-force version.
ORACLE_SQL = PIPELINE_SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
