"""A fixed number of bits that tell tasks which 64-bit hashes cannot be in a set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
_PAGE = 1 << 13


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bits of a column of longs, ``bits`` / 8 bytes however many there are: pages of
    the bitmap are made on the executors from the different set bits, and at most all
    pages are fetched. A fuller bitmap lets more through; it never stops a member."""
    place = F.pmod(column, F.lit(bits))
    pages = hashes.select(place.alias("p")).distinct().groupBy(F.floor(F.col("p") / _PAGE).alias("page"))
    out = np.zeros(bits, bool)
    for row in pages.agg(F.collect_list((F.col("p") % _PAGE).cast("short")).alias("at")).toLocalIterator():
        out[row.page * _PAGE + np.array(row.at, np.int64)] = True
    return np.packbits(out, bitorder="little")


def may_hold(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (signed or unsigned) the bitmap has."""
    p = (hashes.view(np.uint64) % np.uint64(len(held) * 8)).astype(np.int64)
    return (held[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
