"""Helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class WordCache(dict):
    """word -> value of ``compute(word)``. Emptied when full, and words of over ``longest``
    characters are not remembered, so that a worker's memory stays bounded however many
    different words it meets and however long they are."""

    def __init__(self, compute: Callable[[str], object], most: int = 400_000, longest: int = 128) -> None:
        super().__init__()
        self._compute, self._most, self._longest = compute, most, longest

    def __missing__(self, word: str):
        value = self._compute(word)
        if len(word) <= self._longest:
            if len(self) >= self._most:
                self.clear()
            self[word] = value
        return value


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver has it; a cluster
    without a common folder gets it by ``--py-files``."""
    root, env = str(Path(__file__).resolve().parents[2]), df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return df.mapInArrow(run, schema)


def parts(batches: Iterable[pa.RecordBatch], column: str, rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to ``rows`` rows and, where ``column`` is text, to ``size`` bytes of it
    (a longer text is a batch of its own): only so much is Python strings at once."""
    for batch in batches:
        values = batch.column(column)
        text = pa.types.is_string(values.type) or pa.types.is_binary(values.type)
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy()) if text else np.zeros(batch.num_rows)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(start, min(stop, batch.num_rows) - start)
            start = stop


def with_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    names = [*keep, *new]
    return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *new.values()], names=names)


def bucket_of(column, modulus: int):
    """crc32 of an id as text, modulo: the folds of the contracts. NULL ids are in fold 0."""
    return F.coalesce(F.crc32(column.cast("string")) % modulus, F.lit(0))


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that other columns of
    the input, whatever they are called, cannot clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))
