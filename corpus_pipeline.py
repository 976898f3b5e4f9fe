"""The corpus pipeline: five stages over documents, each one operator's decisions.

toxicity drops the documents whose score reaches their language's threshold; line dedup
removes lines that repeat or resemble an earlier line of the corpus; SimHash keeps the
first document of each group of near copies; decontamination drops documents that contain
a test item; mixing draws the target shares of the sources. All but the last return the
columns of documents. ``n_chars`` follows the text.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm import decontam, linededup, mixing, simhash, toxicity
from quotewright.llm.arrow import bucket_of
from quotewright.session import finished


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents outside the held-out fold."""
    found = toxicity.judged(docs, _table(spark, sf_dir, "labels"), bucket_of(F.col("doc_id"), 4) != 2)
    return found.where(~F.col("rejected")).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(docs)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return cleaned.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix_sources),
]

# classifiers, union-find, tiling and hashed permutations are beyond SQL: the stages are
# tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; each result is written as Parquet
    to the shared folder and read again as the documents of the next; what a stage kept
    for itself is deleted when it ends."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = finished(spark, partial(stage, spark, docs, sf_dir))
    return docs
