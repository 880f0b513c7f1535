"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet before the next one reads it.  All stages but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleprep.llm.line_dedup import LineDedup
from titleprep.llm.packing import BestFitPacking
from titleprep.llm.pii import PersonalData
from titleprep.llm.quality import CompressionBands
from titleprep.llm.queries import tokenizer_path
from titleprep.llm.simhash import SimHashDedup
from titleprep.scale import reread


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length that the changed text has."""
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", length)
    return changed.select(*[f"`{c}`" for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands keep."""
    return CompressionBands()(docs).where("kept").select(*[f"`{c}`" for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that other documents keep."""
    return _as_documents(LineDedup()(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are within 3 bits."""
    return SimHashDedup(shingle=3, radius=3).keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _as_documents(PersonalData().redact(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return BestFitPacking(tokenizer_path("word_bpe_49k.json"))(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", packing),
]

# compression, fingerprints and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = reread(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
