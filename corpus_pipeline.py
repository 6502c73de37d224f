"""A corpus from ``documents``: quality, near-duplicates, personal data, mixing, packing.

``STAGES`` are functions of (spark, docs, sf_dir); each returns the columns of
``documents`` but for the last, which returns packed pieces.  ``run`` writes
every stage to the shared folder and reads it back, so each works on a fixed
table and a lost executor costs at most a stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import minhash_dedup, mixing, packing, personal_data, quality
from shelfmark.llm.common import recorded, removed, stored, table

# Folders of scratch tables that stages have written and that may still be read.
_scratch: list[str] = []


def _stage(run):
    """Before a stage, delete the scratch tables of earlier ones that its documents do not read.

    A stage's documents are the stored result of the one before, so its scratch
    tables are done with; of documents that still read some, these stay.
    """

    @wraps(run)
    def cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = "\n".join(docs.inputFiles()) if _scratch else ""
        for folder in [f for f in _scratch if f.rsplit("/", 1)[-1] not in read]:
            removed(spark, folder)
            _scratch.remove(folder)
        with recorded(_scratch):
            return run(spark, docs, sf_dir)

    return cleaned


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return quality.good_documents(docs)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates."""
    return minhash_dedup.distinct_documents(docs)


@_stage
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of each span of personal data in its place."""
    return personal_data.redact(docs, personal_data.trained_detector(docs))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents so that each source comes near its target."""
    return mixing.mixed_documents(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Perplexity, trees and tokenizer ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        with recorded(_scratch):
            docs = stored(docs, name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
