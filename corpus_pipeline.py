"""A training corpus from raw documents: five stages, each one an operator of ``chatprep.llm``.

Each stage takes the documents that its predecessor kept, written as Parquet and read again, and
returns documents with the same columns; the last returns the packed pieces.

1. quality_classifier: documents whose calibrated score is below 0.3 go.
2. line_dedup: lines that repeat an earlier line (word-set similarity of 0.75 or more) are cut out;
   a document that had words and keeps none goes. ``n_chars`` follows the text.
3. near_dedup: of each group of near-duplicates (5-word shingles, 0.75) the smallest id stays.
4. source_mixing: sources are read as often as their temperature weights say; none less than once.
5. best_fit_packing: token pieces placed in sequences of 1024.

Every stage defines its result for null ids and texts, empty and very long texts, repeated rows,
empty tables and further columns as its operator does (see there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm import chosen_path, line_dedup, mixing, packing, quality_rff
from chatprep.llm.shared import materialize
from chatprep.session import table

ORACLE_SQL = None  # fitted models and hash orders: tested against brute-force versions instead


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rff.keep_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicated(docs, min_words=1)
    if "n_chars" not in docs.columns:
        return out
    count = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(count))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, mixing.plan_mixture(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
