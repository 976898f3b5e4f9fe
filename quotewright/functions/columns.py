"""Null-aware scalar expressions. ANSI mode is on, so divisions use ``try_divide``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def array_to_text(c: str | Column, sep: str = "|") -> Column:
    return F.array_join(as_column(c), sep)


def has_token(c: str | Column, token: str, sep: str = "|") -> Column:
    """1 when the delimited text lists ``token``, else 0; NULL text counts as 0."""
    parts = F.split(as_column(c), f"[{sep}]")
    return F.coalesce(F.array_contains(parts, token), F.lit(False)).cast("int")


def sym_pct_diff(a: str | Column, b: str | Column) -> Column:
    """Absolute difference relative to the mean of both, as a double."""
    x, y = as_column(a).cast("double"), as_column(b).cast("double")
    return F.try_divide(F.abs(x - y), (x + y) / 2)


def beyond_tolerance(diff: str | Column, tolerance: float) -> Column:
    """1 when strictly beyond the tolerance, else 0 (a NULL difference gives 0)."""
    return F.when(as_column(diff) > F.lit(tolerance), 1).otherwise(0)


def simple_return(now: str | Column, before: str | Column) -> Column:
    """now / before - 1 on doubles; NULL when either is missing or before is zero."""
    return F.try_divide(as_column(now).cast("double"), as_column(before).cast("double")) - 1


def first_violated(rules: Sequence[tuple[str, str]]) -> Column:
    """Name of the first rule whose SQL predicate is true; NULL when none is."""
    name, predicate = rules[0]
    chain = F.when(F.expr(predicate), name)
    for name, predicate in rules[1:]:
        chain = chain.when(F.expr(predicate), name)
    return chain


def plain_number(c: str | Column) -> Column:
    """Decimal text without trailing zeros, exponent or negative zero."""
    text = as_column(c).cast("decimal(38,6)").cast("string")
    # the text always has six places, so only those lose zeros
    trimmed = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.when(trimmed == "-0", "0").otherwise(trimmed)


def date_key(c: str | Column) -> Column:
    """A date as the integer YYYYMMDD."""
    d = as_column(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
