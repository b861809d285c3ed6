"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.

1. quality classifier: documents that importance resampling rejects go;
2. line dedup: repeated line chunks go, and documents that consist of nothing
   else (an empty text that was empty before stays);
3. SimHash near-dedup: one document of each group stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. best-fit packing: the pieces of what is left and their places.

Nulls, empty and long texts, ties, repeated rows, empty tables and further
columns are treated as the operators' docstrings say; the stages keep and
return the columns that ``docs`` has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import decontaminate, line_dedup, packing, quality, simhash
from churnlens.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the new text."""
    new = line_dedup.line_dedup(docs)
    left = new.where((F.col("n_chunks_removed") == 0) | (F.trim("text") != ""))
    changed = F.when(F.col("n_chunks_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return left.select(*[changed.alias(c) if c == "n_chars" else c for c in docs.columns])


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the classifier, the content-defined chunks or the packing; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
