"""Rows that stand for several equal ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK = 10_000


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, which is dropped; not at all for
    NULL, 0 or less. A row's copies are written in blocks that are dealt to all tasks
    first, so neither a large array nor one task holds a large count."""
    blocks = df.where(F.col(times) > 0).withColumn(
        "_block", F.explode(F.expr(f"sequence(0, ({times} - 1) div {_BLOCK}, 1)"))
    )
    dealt = blocks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    size = F.least(F.lit(_BLOCK), F.col(times) - F.col("_block") * _BLOCK)
    return dealt.withColumn("_i", F.explode(F.sequence(F.lit(1), size))).drop("_block", "_i", times)
