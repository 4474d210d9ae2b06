"""From raw documents to packed training sequences, in five stages of the operators in minegrain.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the
columns of documents. `run` stores every stage as Parquet in the shared folder and starts the next one from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minegrain.llm.common import stored, table
from minegrain.llm.decontaminate import drop_contaminated
from minegrain.llm.language import keep_identified
from minegrain.llm.line_dedup import drop_repeated_lines
from minegrain.llm.packing import pack_documents
from minegrain.llm.queries import bpe_encoder
from minegrain.llm.simhash import keep_one_per_component

# Share of a text's trigrams that its language must hold; texts of the learned languages lie far above it.
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that are in none of the learned languages. Null and letterless texts go."""
    return keep_identified(docs, MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one, or itself, has already; n_chars follows the text."""
    out = drop_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that repeat benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return pack_documents(docs, bpe_encoder())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Signatures, fingerprints and tokens have no SQL; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
