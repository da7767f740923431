"""The training-data pipeline: five stages from documents to packed token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes it as
Parquet in the shared checkpoint folder and reads it back as the next stage's documents.  All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fernwood.llm import byte_cnn, decontaminate, mixing, near_dup, packing
from fernwood.llm.common import written
from fernwood.llm.queries import TOKENIZERS
from fernwood.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.3)."""
    return byte_cnn.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a Jaccard similarity of 0.8 or more over 5-word shingles."""
    return near_dup.deduplicated(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the source mix takes them: left out, once or twice."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.packed_rows(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mixing", mixture),
    ("token ids", token_ids),
]

#: a trained network, sketches and a schedule have no SQL form; tests hold the stages against
#: brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
