"""Exact table fingerprints, their comparison, and the load log built from it.

Long form throughout: (table_name, metric, value decimal(38,6)).
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.columns import plain_number

VALUE = "decimal(38,6)"
# the metrics that hold a content digest begin so
CONTENT = "content_"


def metric_columns(metrics: dict[str, str]) -> list[Column]:
    return [F.expr(sql).cast(VALUE).alias(name) for name, sql in metrics.items()]


def fingerprint(df: DataFrame, table: str, metrics: dict[str, str]) -> DataFrame:
    """All metrics of a table in one aggregate over one scan, unpivoted."""
    return unpivot_metrics(df.agg(*metric_columns(metrics)), table, list(metrics))


def digest_parts(schema: T.StructType) -> list[Column]:
    """The aggregates that ``digest_hex`` makes a digest of: of two hashes of every row over
    the schema's columns in the order of their names."""
    columns = []
    for f in sorted(schema, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        c = F.array_sort(F.map_entries(c)) if isinstance(f.dataType, T.MapType) else c
        # the hash passes over NULL, so that it is said apart
        columns += [c.isNull(), c]
    one, two = F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *reversed(columns))
    parts = []
    for i, h in enumerate((one, two)):
        # halves are summed as decimals, which no number of rows overflows
        low, high = F.pmod(h, F.lit(1 << 32)), F.shiftright(h, 32)
        parts += [F.sum(low.cast("decimal(20,0)")).alias(f"_low{i}"), F.sum(high.cast("decimal(20,0)")).alias(f"_high{i}"), F.bit_xor(h).alias(f"_xor{i}")]
    return parts


def digest_hex() -> Column:
    """64 hex digits: of each hash the sum modulo 2^63 and the exclusive or."""
    hexed = []
    for i in range(2):
        total = F.coalesce(F.col(f"_high{i}"), F.lit(0)) * F.lit(1 << 32) + F.coalesce(F.col(f"_low{i}"), F.lit(0))
        total = F.pmod(total.cast("decimal(38,0)"), F.lit(Decimal(1 << 63))).cast("long")
        hexed += [F.lpad(F.hex(total), 16, "0")]
        hexed += [F.lpad(F.hex(F.coalesce(f"_xor{i}", F.lit(0).cast("long"))), 16, "0")]
    return F.lower(F.concat(*hexed))


def content_digest(df: DataFrame) -> DataFrame:
    """One row: rows, and 254 bits of their content, digest: the sums (modulo 2^63) and the
    exclusive ors of two hashes of every row over all columns in the order of their names.

    Rows in another order, other files or other partitions give the same digest; a value
    moved from one row to another, NULL against an empty text, or a row repeated gives
    another. Map types are hashed as sorted entries. One aggregate over one scan.
    """
    sums = df.agg(F.count(F.lit(1)).alias("rows"), *digest_parts(df.schema))
    return sums.select("rows", digest_hex().alias("digest"))


def content_metrics(digest: Column) -> dict[str, Column]:
    """A digest as four numbers, to be compared like other metrics."""
    quarters = (F.substring(digest, 1 + 16 * i, 16) for i in range(4))
    return {f"{CONTENT}{i}": F.conv(q, 16, 10).cast(VALUE) for i, q in enumerate(quarters, 1)}


def fingerprint_with_content(df: DataFrame, table: str, metrics: dict[str, str]) -> DataFrame:
    """``fingerprint`` with the content digest as further metrics, still one scan."""
    content = content_metrics(digest_hex())
    wide = df.agg(*metric_columns(metrics), *digest_parts(df.schema))
    wide = wide.select(*metrics, *(c.alias(name) for name, c in content.items()))
    return unpivot_metrics(wide, table, [*metrics, *content])


def unpivot_metrics(wide: DataFrame, table: str, metrics: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]
    return wide.select(F.lit(table).alias("table_name"), F.inline(F.array(*pairs)))


def compare_fingerprints(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Metrics that differ; one missing on either side counts as NULL."""
    e = expected.select("table_name", "metric", F.col("value").alias("expected"))
    o = observed.select("table_name", "metric", F.col("value").alias("observed"))
    return e.join(o, ["table_name", "metric"], "full").where(
        ~F.col("expected").eqNullSafe(F.col("observed"))
    )


def load_log(expected: DataFrame, observed: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """One row per table: rows expected and loaded, match flag, mismatch detail. The detail
    names a differing content digest only where no other metric differs."""
    both = (
        expected.select("table_name", "metric", F.col("value").alias("e"))
        .join(
            observed.select("table_name", "metric", F.col("value").alias("o")),
            ["table_name", "metric"],
            "full",
        )
        .withColumn("same", F.col("e").eqNullSafe(F.col("o")))
    )
    shown = [F.coalesce(plain_number(c), F.lit("NULL")) for c in ("e", "o")]
    # the row count sorts first, the other metrics by name, the content last
    rank = F.when(F.col("metric") == "row_count", 0).when(F.col("metric").startswith(CONTENT), 2).otherwise(1)
    message = F.struct(
        rank.alias("rank"),
        F.format_string("%s: expected %s, got %s", F.col("metric"), *shown).alias("text"),
    )
    rows = F.col("metric") == "row_count"
    return (
        both.groupBy("table_name")
        .agg(
            F.max(F.when(rows, F.col("e"))).cast("bigint").alias("rows_expected"),
            F.max(F.when(rows, F.col("o"))).cast("bigint").alias("rows_loaded"),
            F.bool_and("same").alias("fingerprint_match"),
            # at most one message per metric of the table
            F.sort_array(F.collect_list(F.when(~F.col("same"), message))).alias("messages"),
        )
        .withColumn("messages", F.filter("messages", lambda m: (m["rank"] < 2) | (F.get("messages", F.lit(0))["rank"] == 2)))
        .select(
            F.lit(run_id).alias("run_id"),
            "table_name",
            "rows_expected",
            "rows_loaded",
            "fingerprint_match",
            F.nullif(F.array_join("messages.text", "; "), F.lit("")).alias("mismatch_detail"),
            F.lit(at).cast("timestamp").alias("loaded_at_utc"),
        )
    )


def load_problems(log: DataFrame) -> DataFrame:
    return log.where(~F.col("fingerprint_match")).select("table_name", "mismatch_detail")
