"""URL filter: rules first, and a character language-model ratio for the rest.

Two variable-order Markov models over characters, one of the URLs that the rules accept
and one of those they reject, back off from three characters of context to none. A URL
without a rule passes when its log-likelihood difference per character is at or above a
threshold calibrated on labelled URLs that the models have not seen.

All counts come from 4-grams of the distinct URLs, which hold the counts of every lower
order; every join is on a gram, and the tables of grams grow only with the different
grams. Log ratios are whole micro-units, so sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.arrow import narrow
from quotewright.session import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path prefix, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
ORDER = 4
MICRO = 1_000_000
BINS = 1_000
_START, _END = "\x02", "\x03"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for NULL and for URLs without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both NULL where none does."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in longest]
    found = list(zip(fits, longest))
    rule = F.coalesce(*(F.when(f, F.lit(h + p)) for f, (h, p, _) in found)) if found else F.lit(None).cast("string")
    verdict = F.coalesce(*(F.when(f, F.lit(v)) for f, (_, _, v) in found)) if found else F.lit(None).cast("string")
    return rule, verdict


def grams(urls: DataFrame) -> DataFrame:
    """url, label, fit and each of its 4-grams with its number in the URL."""
    signs = F.split(F.concat(F.lit(_START * (ORDER - 1)), F.translate("url", UPPER, LOWER), F.lit(_END)), "")
    cut = urls.withColumn("_signs", signs)
    each = F.transform(
        F.sequence(F.lit(1), F.size("_signs") - (ORDER - 1)),
        lambda i: F.array_join(F.slice(F.col("_signs"), i, ORDER), ""),
    )
    return cut.select("url", "label", "fit", F.explode(each).alias("gram"))


def log_ratios(counts: DataFrame, totals: tuple[int, int], strength: float, alphabet: int) -> DataFrame:
    """gram, ratio: ln P_allow - ln P_block in millionths, from the counts ``a`` and
    ``b`` of every 4-gram. Each order adds ``strength`` times the next lower one."""
    sums = ["a", "b"]

    def joined(df: DataFrame, name: str, start: int, size: int) -> DataFrame:
        key = F.substring("gram", start, size)
        part = counts.groupBy(key.alias(name)).agg(*(F.sum(s).alias(f"{s}_{name}") for s in sums))
        return df.withColumn(name, key).join(part, name).drop(name)

    out = counts
    for order in range(ORDER):  # characters of context
        first = ORDER - order
        out = joined(out, f"g{order}", first, order + 1)
        if order:
            out = joined(out, f"c{order}", first, order)

    def probability(s: str, total: int) -> Column:
        p = F.lit(1.0 / alphabet)
        for order in range(ORDER):
            context = F.col(f"{s}_c{order}") if order else F.lit(total)
            p = (F.col(f"{s}_g{order}") + F.lit(strength) * p) / (context + F.lit(strength))
        return p

    ratio = F.round((F.log(probability("a", totals[0])) - F.log(probability("b", totals[1]))) * MICRO)
    return out.select("gram", ratio.cast("long").alias("ratio"))


def url_scores(labelled: DataFrame, strength: float, alphabet: int, held: int) -> tuple[DataFrame, int]:
    """url, bin (floor of the score in hundredths) of the distinct URLs, and the lowest
    bin that passes. Without URLs of both kinds there is nothing to tell them by: no
    scores, and all pass."""
    fit = F.col("label").isNotNull() & (F.conv(F.substring(F.md5("url"), 1, 1), 16, 10).cast("int") >= held)
    pieces = grams(labelled.withColumn("fit", fit))
    one = lambda v: F.sum(F.when(F.col("fit") & (F.col("label") == v), 1).otherwise(0))
    counts = keep(pieces.groupBy("gram").agg(one("allow").alias("a"), one("block").alias("b")))
    totals = counts.agg(F.sum("a"), F.sum("b")).first()
    if not totals[0] or not totals[1]:
        return labelled.select("url", F.lit(0).cast("long").alias("bin")), 0
    ratios = log_ratios(counts, (totals[0], totals[1]), strength, alphabet)
    score = F.floor(F.sum("ratio") / (F.count("*") * (MICRO // 100)))
    scored = keep(pieces.join(ratios, "gram").groupBy("url", "label", "fit").agg(F.greatest(F.lit(-BINS), F.least(F.lit(BINS), score)).cast("long").alias("bin")))
    return scored.select("url", "bin"), threshold(scored.where("label is not null and not fit"))


def threshold(held: DataFrame) -> int:
    """The bin of the best balanced accuracy on held-out labelled URLs, the one nearest
    to 0 (then the lower) among equals; 0 where a label is missing. At most 2,001 bins
    reach the driver."""
    rows = held.groupBy("bin").agg(*(F.sum(F.when(F.col("label") == v, 1).otherwise(0)).alias(v) for v in ("allow", "block"))).collect()
    allow, block = sum(r.allow for r in rows), sum(r.block for r in rows)
    if not allow or not block:
        return 0
    cuts = sorted({0, *(r.bin for r in rows), *(r.bin + 1 for r in rows)})
    right = lambda c: sum(r.allow for r in rows if r.bin >= c) * block + sum(r.block for r in rows if r.bin < c) * allow
    return max(cuts, key=lambda c: (right(c), -abs(c), -c))


def judge(pages: DataFrame, rules=RULES, strength: float = 4.0, alphabet: int = 128, held: int = 4, id_col="page_id", url_col="url") -> DataFrame:
    """page_id, host, path, rule, verdict, score_bin of every row.

    ``held`` of sixteen labelled URLs (by the first digit of their md5) calibrate, the
    others train. A NULL URL has empty host
    and path, no rule, and is judged as the empty text. Repeated URLs are judged once and
    train once; repeated rows and NULL ids stay. Among rules the longest wins.
    """
    rows = narrow(pages, page_id=id_col, url=url_col)
    urls = rows.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
    host, path = split_url(F.col("url"))
    _, said = match_rule(host, path, rules)
    scores, least = url_scores(urls.withColumn("label", said), strength, alphabet, held)
    scores = scores.select(F.col("url").alias("s_url"), "bin")
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = rows.withColumns({"host": host, "path": path}).join(scores, F.coalesce(rows["url"], F.lit("")) == scores["s_url"], "left")
    own = F.when(F.coalesce("bin", F.lit(0)) >= least, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.col("bin").alias("score_bin"))
