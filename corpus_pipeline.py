"""From raw documents to token ids, stage by stage; each stage works on all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import bpe, decontaminate, pii, quality, simhash
from tierwise.llm.common import documents, written
from tierwise.llm.queries import VOCABULARY, good_and_bad


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the importance sample; the others go."""
    _, sample = quality.resample(docs, documents(spark, sf_dir, "labels"), **good_and_bad())
    return sample.keeps(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, words=3, seed=42, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.without_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and ``n_chars`` counted anew."""
    return pii.redact(docs, length_col="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and the digest of the text that they decode to."""
    return bpe.encode(docs, VOCABULARY, ("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: No SQL: fingerprints, the fitted models and the merges cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
