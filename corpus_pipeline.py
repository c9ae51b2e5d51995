"""From documents to packed sequences: the stages of the corpus, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.catalogue import PII_KEY, SEQUENCE
from tamiz.llm.common import table
from tamiz.llm.decontaminate import drop_contaminated
from tamiz.llm.pack import pack_documents
from tamiz.llm.pii import pseudonymise
from tamiz.llm.simhash import keep_one
from tamiz.llm.toxicity import toxicity
from tamiz.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below one half of toxicity, by a model fitted on the documents that come in."""
    scored, score = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits of SimHash: that of the smallest id."""
    return keep_one(docs, shingle=3, radius=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data become pseudonyms of the same length, so that n_chars stays right."""
    return pseudonymise(docs, PII_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", replace_personal_data),
    ("packing", pack),
]
# Learned scores, keyed permutations and packing have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
