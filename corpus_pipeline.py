"""A training corpus from raw documents: drop toxic texts, keep one of each group of
near-duplicates, mask personal data, and pack what is left into token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes a stage's
result to the shared checkpoint folder and reads it again as the next one's input, so a
lost executor costs at most a part of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import packing, pii, simhash, toxicity
from tablework.llm.common import free_name, staged
from tablework.llm.queries import training_labels, vocabulary
from tablework.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labels of the training part."""
    return toxicity.reject(docs, toxicity.fit(docs, training_labels(load(spark, sf_dir, "labels"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by three-word shingles at 3 bits or fewer."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by marks; ``n_chars`` follows the text."""
    spans = free_name(docs, "pii_")
    masked = pii.redact(pii.detect(docs, out=spans), spans=spans)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of up to 2048 ids."""
    return packing.pack(docs, vocabulary(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: A trained classifier, hashes and a tokenizer are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
