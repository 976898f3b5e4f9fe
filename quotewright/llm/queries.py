"""The operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_token_counts(spark, sf):
    from quotewright.llm.tokens import token_counts

    return token_counts(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op3_language_id(spark, sf):
    """Learns where crc32(doc_id) mod 3 is not 1."""
    from quotewright.llm import langid
    from quotewright.llm.arrow import bucket_of

    docs = table(spark, sf, "documents")
    model = langid.fit(docs, bucket_of(F.col("doc_id"), 3) != 1)
    found = langid.predict(docs, model)
    return found.select("doc_id", (bucket_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op8_toxicity(spark, sf):
    """Learns where crc32(doc_id) mod 4 is not 2."""
    from quotewright.llm import toxicity
    from quotewright.llm.arrow import bucket_of

    learn = bucket_of(F.col("doc_id"), 4) != 2
    found = toxicity.judged(table(spark, sf, "documents"), table(spark, sf, "labels"), learn, ["doc_id"])
    found = found.select("row.doc_id", "score", "rejected")
    held = bucket_of(F.col("doc_id"), 4) == 2
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "rejected")


@query
def op5_quality_rules(spark, sf):
    from quotewright.llm.quality import quality

    return quality(table(spark, sf, "documents"))


@query
def op4_url_filter(spark, sf):
    from quotewright.llm.urls import judge

    return judge(table(spark, sf, "pages"))


@query
def op2_mix_sources(spark, sf):
    from quotewright.llm.mixing import mix_counts

    return mix_counts(table(spark, sf, "documents"))


@query
def op1_simhash_dedup(spark, sf):
    from quotewright.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf, "documents"))


@query
def op6_decontaminate(spark, sf):
    """The pairs of a document and a test item that it contains."""
    from quotewright.llm.decontam import contaminated

    found = contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "item_tokens", "covered", "tiles", "coverage")


@query
def op7_line_dedup(spark, sf):
    from quotewright.llm.linededup import dedup_lines

    found = dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_removed", F.col("clean").alias("text"))


@query
def op9_personal_data(spark, sf):
    from quotewright.llm.pii import personal_data

    return personal_data(table(spark, sf, "documents"))[0]


@query
def op12_sentencepiece(spark, sf):
    from quotewright.llm.pieces import piece_digests

    return piece_digests(table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op13_whiten(spark, sf):
    from quotewright.llm.whitening import whiten

    return whiten(table(spark, sf, "embeddings"))


@query
def op11_prefix_trie(spark, sf):
    from quotewright.llm.trie import conversation_trie

    return conversation_trie(table(spark, sf, "conversations"))
