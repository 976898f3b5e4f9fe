"""Cleaning projection and the census of what it changes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.columns import array_to_text, nan_to_null
from quotewright.schemas import decimal_columns

_FLOATING = (T.FloatType, T.DoubleType)


def resolve(df: DataFrame, schema: T.StructType) -> dict[str, str]:
    """Schema column to input column, matched by name without case; a missing
    column raises."""
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"input lacks columns: {', '.join(missing)}")
    return {f.name: have[f.name.lower()] for f in schema}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types."""
    names = resolve(df, schema)
    return df.select([F.col(f"`{names[f.name]}`").cast(f.dataType).alias(f.name) for f in schema])


def clean_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    names = resolve(df, schema)
    incoming = {f.name: f.dataType for f in df.schema}

    def column(field: T.StructField) -> Column:
        c, have = F.col(f"`{names[field.name]}`"), incoming[names[field.name]]
        if isinstance(field.dataType, T.DecimalType) and isinstance(have, _FLOATING):
            c = nan_to_null(c)
        elif isinstance(field.dataType, T.StringType) and isinstance(have, T.ArrayType):
            c = array_to_text(c)
        return c.cast(field.dataType).alias(field.name)

    return [column(f) for f in schema]


def clean_decimals(df: DataFrame, schema: T.StructType) -> DataFrame:
    """As ``conform``, with NaN in decimal columns turned into NULL (before the
    cast, which rejects NaN) and arrays landing in text columns joined by ``|``."""
    return df.select(clean_columns(df, schema))


def is_nan(df: DataFrame, column: str) -> Column:
    """Whether the column is NaN; only floating types can be."""
    if isinstance(df.schema[column].dataType, _FLOATING):
        return F.isnan(F.col(f"`{column}`"))
    return F.lit(False)


def nan_census(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per column holding NaN: (column_name, nan_count). One pass."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.count_if(is_nan(df, c)).alias("nan_count")) for c in columns]
    if not pairs:
        return df.sparkSession.sql("select '' column_name, 0L nan_count").limit(0)
    return df.agg(F.array(*pairs).alias("census")).select(F.inline("census")).where("nan_count > 0")


def schema_nan_census(df: DataFrame, schema: T.StructType) -> DataFrame:
    names = resolve(df, schema)
    return nan_census(df, [names[c] for c in decimal_columns(schema)])
