"""Return series per entity, and the summaries read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.columns import simple_return
from quotewright.session import finished, keep


# rows of a range at most, about (ranges are cut by a sample), and of a written file: Spark
# counts a file as 4 MB at least when it packs files into tasks, so this bounds a task's rows
RANGE_ROWS = 500_000
FILE_ROWS = 125_000
_SLICE_BITS = 16


def _ranges(df: DataFrame, key: str, order: str, ties: Sequence[str], ranges: int | None) -> DataFrame:
    """The rows with ``_part``, their range in the order (key, order, ties), written once.

    There are at least ``ranges`` ranges (or as many as a shuffle has), and more where these
    would hold over ``RANGE_ROWS`` rows. A hot series, a hot day and many copies of one row
    all spread over ranges: copies are told apart by the task that read them and their block
    of rows in it, which are written before the ranges are cut.
    """
    by = [key, order, *ties, "_slice"]

    def make() -> DataFrame:
        sliced = df.withColumn("_slice", F.shiftright(F.monotonically_increasing_id(), _SLICE_BITS))
        sliced = keep(sliced, FILE_ROWS)
        needed = -(-sliced.count() // RANGE_ROWS)
        least = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n = max(least, needed) if ranges or needed > least else None
        placed = sliced.repartitionByRange(n, *by) if n else sliced.repartitionByRange(*by)
        return placed.withColumn("_part", F.spark_partition_id()).drop("_slice")

    return finished(df.sparkSession, make, FILE_ROWS)


def _before(placed: DataFrame, key: str, order: str, ties: Sequence[str], window: int) -> DataFrame:
    """For each range of a series that is not its first: the last ``window`` rows before it.

    Only series of several ranges matter, of which there are fewer than ranges, and only
    the last ``window`` rows of each range, which Spark limits before the shuffle.
    """
    dated = placed.where(F.col(order).isNotNull())
    along = W.partitionBy(key).orderBy("_part")
    parts = (
        dated.groupBy(key, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns(
            {
                "_nth": F.row_number().over(along),
                "_start": F.sum("_n").over(along) - F.col("_n"),
                "_parts": F.count(F.lit(1)).over(W.partitionBy(key)),
            }
        )
        .where("_parts > 1")
        .withColumnRenamed(key, "_key")
    )
    backwards = W.partitionBy(key, "_part").orderBy(F.desc(order), *map(F.desc, ties))
    tails = dated.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= window)
    own = parts.select("_key", F.col("_part").alias("_own_part"), "_nth", (F.col("_start") + F.col("_n")).alias("_end"))
    tails = tails.join(own, tails[key].eqNullSafe(own["_key"]) & (tails["_part"] == own["_own_part"])).drop("_key", "_part")
    # a later range takes the row while it is among the last ``window`` before it; every
    # range between holds a row, so it is at most ``window`` ranges away
    tails = tails.withColumn("_to", F.explode(F.sequence(F.col("_nth") + 1, F.col("_nth") + window)))
    later = parts.select("_key", "_part", F.col("_nth").alias("_at"), "_start")
    near = tails[key].eqNullSafe(later["_key"]) & (tails["_to"] == later["_at"])
    position = F.col("_end") - F.col("_back")
    taken = tails.join(later, near).where(F.col("_start") - position <= window)
    return taken.select(*placed.columns, F.lit(False).alias("_own"))


def returns(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    *,
    gap_days: int = 5,
    window: int = 21,
    annualise: int = 252,
    ranges: int | None = None,
) -> DataFrame:
    """Adds days_since_prev, daily_return, log_return, is_gap_return, vol_<window>d_ann.

    A return over more than ``gap_days`` days is a gap return: kept, but left out
    of the volatility, which needs ``window`` non-gap returns in a row. ``order`` is a
    date. Rows of one day follow each other by their other columns in turn (NULL first),
    so copies are contiguous and the result is the same on every run. A row without a date
    is kept; it has no previous row and is none.

    All rows take one path. They are cut into ranges of the whole order (``ranges`` at least,
    or as many as a shuffle has; more where they would be large), and every range of a series gets the ``window`` rows before
    it: a return looks back one row and a volatility ``window - 1`` returns, so each range
    is computed apart and exactly, however long the series, its days or its copies.
    """
    ties = sorted(f.name for f in df.schema if f.name not in (key, order) and not isinstance(f.dataType, T.MapType))
    placed = _ranges(df, key, order, ties, ranges)
    rows = placed.withColumn("_own", F.lit(True)).unionByName(_before(placed, key, order, ties, window))
    # a task computes one range; the series within it need no further shuffle
    last = placed.agg(F.max("_part")).first()[0]
    rows = rows.repartitionById((last or 0) + 1, "_part")
    dated = F.col(order).isNotNull()
    # the rows before a range come first among equals
    series = W.partitionBy(key, "_part", dated).orderBy(order, *ties, "_own")
    frame = series.rowsBetween(1 - window, 0)
    usable = F.when(F.col("days_since_prev") <= gap_days, F.col("daily_return"))
    return (
        rows.withColumns({"_prev": F.when(dated, F.lag(value).over(series)), "_prev_day": F.lag(order).over(series)})
        .withColumns(
            {
                "days_since_prev": F.datediff(order, "_prev_day"),
                "daily_return": simple_return(value, "_prev"),
            }
        )
        .withColumns(
            {
                "log_return": F.ln(1 + F.col("daily_return")),
                "is_gap_return": F.when(F.col("days_since_prev") > gap_days, 1).otherwise(0),
                "_usable": usable,
            }
        )
        .withColumns(
            {
                "_n": F.count("_usable").over(frame),
                "_sd": F.stddev_samp("_usable").over(frame),
            }
        )
        .withColumn(
            f"vol_{window}d_ann", F.when(F.col("_n") == window, F.col("_sd") * F.sqrt(F.lit(float(annualise))))
        )
        .where("_own")
        .drop("_prev", "_prev_day", "_usable", "_n", "_sd", "_own", "_part")
    )


def latest_per_key(df: DataFrame, key: str, order: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per key. Spark limits every group before the shuffle."""
    newest = W.partitionBy(key).orderBy(F.desc(order), *[F.desc(c) for c in tie])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def entity_summary(
    series: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    vol: str,
    flag: str = "reconciliation_flag",
    flagged: str = "disagreed",
) -> DataFrame:
    """Counts, first and last value and total return per entity, in one pass."""
    out = series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observations"),
        F.min(order).alias("first_date"),
        F.max(order).alias("last_date"),
        F.avg(vol).alias(f"avg_{vol}"),
        F.count_if(F.col(flag) == flagged).alias(f"{flagged}_observations"),
        F.min_by(value, order).alias(f"first_{value}"),
        F.max_by(value, order).alias(f"last_{value}"),
    )
    return out.withColumn(f"{value}_return", simple_return(f"last_{value}", f"first_{value}"))


def group_daily_return(series: DataFrame, group: str, order: str) -> DataFrame:
    """Equal-weighted mean of the non-gap returns per group and day."""
    return (
        series.where("daily_return is not null and is_gap_return = 0")
        .groupBy(group, order)
        .agg(F.count(F.lit(1)).alias("securities"), F.avg("daily_return").alias("ew_return"))
    )
