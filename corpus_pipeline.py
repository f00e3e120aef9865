"""The corpus pipeline: five stages over documents, each calling one operator of ``plumbline.llm``.

Every stage but the last returns the columns of the documents; rows that a stage
rejects are gone for the ones after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, decontamination, resampling, simhash, surrogates
from plumbline.llm.common import read_table
from plumbline.llm.queries import SURROGATE_KEY, VOCABULARY, public_tokenizers
from plumbline.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling draws; the rejected ones go."""
    return resampling.keep_drawn(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or near texts: the one with the smallest id."""
    return simhash.keep_one_of_each(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any window of the benchmark."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; ``n_chars`` follows the new text."""
    changed = surrogates.replace_personal_data(docs, SURROGATE_KEY)
    if "n_chars" not in docs.columns:
        return changed
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, with digests of the ids and of the bytes they decode to."""
    return bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN, carry=["doc_id", "lang", "source"])


STAGES = [("quality_resampling", quality), ("simhash_near_duplicates", near_duplicates),
          ("benchmark_decontamination", decontaminate), ("pii_surrogates", private_data), ("byte_bpe", tokens)]

#: Trained models, seeded noise, covering codes, keyed permutations and BPE have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    folder = scratch_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
