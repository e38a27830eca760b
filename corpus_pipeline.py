"""The corpus pipeline: documents are judged, cleaned of repeated lines and near-duplicates, decontaminated and packed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last return the
columns of documents. Between stages rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import decontam, lines, packing, quality, queries, simhash
from tracewell.llm.common import stored

#: No SQL: scores and packing depend on a fitted model and on tokenization. Tests compare with brute force instead.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    labels = queries.table(spark, sf_dir, "labels")
    model = quality.fit(quality.training_rows(docs, labels, "doc_id", "text", "quality"))
    out = "_".join(["score", *docs.columns])  # no column of this name can be there
    return quality.score(docs, model, out=out).where(F.col(f"`{out}`") >= quality.CUTOFF).select(docs.columns)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated lines; a document may lose all its lines."""
    kept = lines.dedupe_lines(docs).drop("lines_removed")
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id, one row of it if it repeats.

    Shingles of four words and four bits at most, as the operator has them by default.
    """
    return simhash.one_of_each(docs).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontam.clean(docs, queries.table(spark, sf_dir, "benchmark")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    packed = packing.pack_documents(docs, queries.tokenizer_path(), added_tokens=True)
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", lines_stage),
    ("simhash_near_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
