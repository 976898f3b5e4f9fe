"""Quality rules: cross-document line frequency on top of base counts.

Normalised lines are hashed; a line that more than ``most_documents`` documents of one
host hold is boilerplate and removed; a document that loses more than half of its words
is depleted and rejected. Documents name no host, so their source stands for it.

The texts are read once: counts and line hashes are kept in the shared folder, and all
that follows works on them. Copies of a text within a host are one row with a count
before any line is looked at, so neither a large group of copies nor a hot line meets in
one task: lines are counted by partial sums and joined to the few frequent ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.arrow import narrow
from quotewright.llm.words import BLANKS, char_count, lines_with_words, normal_line, word_array
from quotewright.session import keep

SYMBOLS = "#*$%&|<>"


def base_counts(docs: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of rows
    with a ``text``; other columns stay. Windows are compared by a 64-bit hash."""
    text = F.col("text")
    cut = docs.withColumns({"_words": word_array(text), "_lines": lines_with_words(text)})
    windows = F.transform(
        F.col("_words"),
        lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)),
    )
    none = F.array().cast("array<bigint>")
    counted = cut.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": char_count(text, BLANKS, keep=True),
            "n_symbols": char_count(text, SYMBOLS),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(F.size("_words") > 2, F.slice(windows, F.lit(1), F.size("_words") - 2)).otherwise(none),
        }
    )
    # windows in order of hash, where one has an equal neighbour; most texts have none
    pairs = F.array_sort(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    sorted_ = counted.withColumn("_sorted", F.when(some, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    repeated = F.filter(
        F.col("_sorted"),
        lambda x, k: F.coalesce(x["h"] == F.get(F.col("_sorted"), k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(F.col("_sorted"), k + 1)["h"], F.lit(False)),
    )
    placed = sorted_.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    # a window covers its words up to the next repeated window, three at most
    cover = F.transform(
        F.col("_at"), lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_at"), k + 1) - p, F.lit(3)))
    )
    out = placed.withColumn("n_repeat_words", F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_words", "_windows", "_sorted", "_at")


def measure(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """Counts and line hashes of every row, kept in the shared folder. ``h1``, ``h2`` and
    the length name a text."""
    counted = base_counts(narrow(docs, doc_id=id_col, text=text_col, host=host_col))
    lines = F.transform(F.col("_lines"), normal_line)
    words = lambda line: F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), words(x).cast("long").alias("words")))
    text = F.col("text")
    named = {"lines": hashed, "h1": F.xxhash64(text), "h2": F.hash(text), "chars": F.length(text)}
    return keep(counted.withColumns(named).drop("text", "_lines"))


def frequent_lines(texts: DataFrame, most_documents: int) -> DataFrame:
    """host, line of the lines that more documents of the host hold. A line counts once
    for each document (row) that has it."""
    own = texts.select("host", "copies", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    return own.groupBy("host", "line").agg(F.sum("copies").alias("docs")).where(F.col("docs") > most_documents)


def quality(docs: DataFrame, most_documents: int = 20, lost_percent: int = 50, **columns: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept and removed_words of every row.

    NULL texts are empty: no words, so base_failed. Rows with a NULL source share the
    host NULL. Repeated rows are documents each. Ties cannot occur: limits are on counts.
    """
    rows = measure(docs, **columns)
    name = ["host", "h1", "h2", "chars"]
    texts = rows.where("size(lines) > 0").groupBy(*name).agg(F.count("*").alias("copies"), F.any_value("lines").alias("lines"))
    frequent = frequent_lines(texts, most_documents)
    lines = texts.select(*name, F.explode("lines").alias("x")).select(*name, "x.line", "x.words")
    f = frequent.select(F.col("host").alias("f_host"), F.col("line").alias("f_line"))
    hit = lines.join(f, lines["host"].eqNullSafe(f["f_host"]) & (lines["line"] == f["f_line"]), "left_semi")
    lost = hit.groupBy(*name).agg(F.sum("words").alias("removed_words"))
    lost = lost.select(*(F.col(c).alias(f"l_{c}") for c in name), "removed_words")
    same = [rows[c].eqNullSafe(lost[f"l_{c}"]) for c in name]
    joined = rows.join(lost, same, "left")
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    kept = ~F.col("base_failed") & (100 * removed <= lost_percent * F.col("n_words"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), removed.alias("removed_words")
    )
