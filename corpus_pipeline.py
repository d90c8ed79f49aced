"""A training corpus from raw documents, in five stages.

Toxic documents go, one document of each near-duplicate group stays, secrets are
masked, sources are mixed to their weights, and what is left is packed into
sequences. Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all
but the last return the columns of ``documents``. ``run`` writes each stage's result
as Parquet to the shared checkpoint folder and reads it back for the next.

Null and empty texts pass the first stage, count as one group of copies in the
second, and have no words to mix in the fourth. Extra columns are carried to the
last stage. An empty table stays empty throughout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import jaccard, mixing, packing, secrets, toxicity
from tidepool.llm.common import drop_staged, staged_paths, table
from tidepool.session import checkpoint_root, ship_package


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by the kind of secret."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                     "sequence_id", "offset")


_obsolete: list[str] = []


def _stage(function):
    """``function``, which first deletes what earlier stages staged: their results are written by then."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        drop_staged(spark, _obsolete)
        _obsolete.clear()
        before = set(staged_paths())
        out = function(spark, docs, sf_dir)
        _obsolete.extend(p for p in staged_paths() if p not in before)
        return out

    run_stage.__name__, run_stage.__doc__ = function.__name__, function.__doc__
    return run_stage


STAGES = [
    ("toxicity", _stage(reject_toxic)),
    ("ngram_jaccard", _stage(drop_near_duplicates)),
    ("secrets", _stage(mask_secrets)),
    ("mixing", _stage(mix_sources)),
    ("packing", _stage(pack_sequences)),
]

# Learnt scores, minimum hashes and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole corpus."""
    folder = f"{checkpoint_root(spark)}/tidepool-corpus/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
