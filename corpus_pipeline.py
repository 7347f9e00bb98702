"""From raw documents to packed training sequences, stage by stage.

Every stage takes all rows that the stage before it kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieweave.llm import decontaminate, packing, secrets, simhash_trie, toxicity
from tieweave.llm.tables import table
from tieweave.session import RoundTables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression does not reject."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates."""
    return simhash_trie.one_of_each(docs, width=3, distance=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), size=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` follows the text."""
    made = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return made
    kind = docs.schema["n_chars"].dataType
    size = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
    return made.withColumn("n_chars", size)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, capacity=2048, terminator=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack),
]

#: Fitted weights, XXH64 fingerprints and token ids are not for SQL to compute.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    written = RoundTables(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs, _ = written.write(stage(spark, docs, sf_dir))
    return docs
