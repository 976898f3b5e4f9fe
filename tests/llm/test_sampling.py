"""Bounded samples of rows to learn from."""

from pyspark.sql import functions as F

from quotewright.llm import langid, toxicity
from quotewright.llm.sampling import per_class


def test_copies_are_one_row_of_the_sample(spark):
    copies = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copied text").alias("text"), F.lit("xx").alias("lang"))
    others = spark.range(3000).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("t "), F.col("id")).alias("text"), F.lit("yy").alias("lang"))
    for keys in (["doc_id", "text"], ["text"], ["text", "lang"]):
        drawn, counts = per_class(copies.unionAll(others), "lang", 400, *keys)
        got = {r.lang: r["count"] for r in drawn.groupBy("lang").count().collect()}
        assert counts == {"xx": 1, "yy": 3000} and got["xx"] == 1 and 300 < got["yy"] < 500


def test_a_language_of_copies_is_learned(frame):
    rows = [(7, "zzyzx qwrtp zzyzx", "xx", "s")] * 5000 + [(100 + i, f"the cat sat on mat {i}", "en", "s") for i in range(300)]
    docs = frame(rows, parts=8)
    sample = langid.sample_bags(docs, F.lit(True), 50, 1 << 10)
    langs = sample.column("lang").to_pylist()
    assert langs.count("xx") == 1 and 20 < langs.count("en") < 90


def test_one_id_many_times_is_one_row_of_words(frame, spark):
    rows = [(1, "bad text here", "en", "s")] * 5000 + [(i, f"fine text {i}", "en", "s") for i in range(2, 40)]
    labels = spark.createDataFrame([(i, 0, int(i == 1)) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    sample, counts = toxicity.sample_words(frame(rows, parts=8), labels, F.lit(True), 100, {"buckets": 1 << 10, "stem": 4})
    assert counts == {1: 1, 0: 38} and sample.column("label").to_pylist().count(1) == 1
