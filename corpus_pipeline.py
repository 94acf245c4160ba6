"""A corpus from raw documents to token ids, stage by stage.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and read
again as the next one's documents.  All but the last return the columns of ``documents``, whatever
these are; rows with null texts count as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline import session
from assayline.llm import bpe, bytecnn, contamination, pii, simhash
from assayline.llm.frames import table
from assayline.llm.queries import QUALITY


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents of this stage's input, does not reject."""
    net = bytecnn.fit_on(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    return bytecnn.score(rows, net).where(F.col("score") >= QUALITY).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id; fingerprints or five-word shingles make a group."""
    return simhash.keep_one(docs, similar=True)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return bpe.round_trip(rows, ranks, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "token_ids", "decodes")


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", pii_redaction),
    ("byte-level BPE", byte_level_bpe),
]

#: No SQL: the classifier is fitted, and fingerprints and token ids are not SQL functions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages.  What a stage staged is removed when it is written, and its input when it has been read."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        path = session.scratch(spark, name.replace(" ", "-"))
        with session.scratch_run(spark):
            made = function(spark, docs, sf_dir)
            schema = made.schema
            made.write.parquet(path)
        if last:
            session.remove(spark, last)
        docs, last = spark.read.schema(schema).parquet(path), path
    return docs
