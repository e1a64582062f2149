"""A corpus pipeline: documents pass five stages, each written as Parquet and read again.

Toxic documents go, one of each group of near-duplicates stays, documents that
contain benchmark items go, secrets are cut out of the texts, and what is left
is coded with SentencePiece. All stages but the last return the columns of
documents. Each stage's docstring in ``folioframe.llm`` states what it makes of
nulls, empty texts and repeated rows; an empty table passes through empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm import decontaminate, secrets, sentencepiece_codec, simhash, toxicity
from folioframe.llm.queries import table, vocabulary
from folioframe.session import delete, scratch, scratch_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among ``docs``, does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by fingerprints: that with the smallest id."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by the secrets' kinds."""
    return secrets.redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with the check that they decode to it."""
    return sentencepiece_codec.round_trip(docs, vocabulary("piece_bpe_32k.model"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("secret_scans", secret),
    ("sentencepiece", pieces),
]

#: The classifier, the fingerprints and the pieces are beyond SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another; what a stage wrote for itself goes when its output is whole, and that when the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = scratch_path(spark, name)
        with scratch(spark, name):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(out)
        docs = spark.read.schema(made.schema).parquet(out)
        if before is not None:
            delete(spark, before)
        before = out
    return docs
