"""Documents made ready for training, in five stages; each works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequon.llm import bpe, decontaminate, quality, secret_scan, simhash
from sequon.llm.common import kept, read
from sequon.llm.vocabulary import byte_bpe


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the policy keeps."""
    return quality.keep(docs, "v1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets masked."""
    return secret_scan.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed, and their digests."""
    ids = bpe.encode(spark, F.coalesce("text", F.lit("")), byte_bpe())
    return docs.select("doc_id", "lang", "source", ids.alias("ids")).select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret scans", secret_scans),
    ("encoding", encoding),
]

#: Fingerprints, a forest and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir))
    return docs
