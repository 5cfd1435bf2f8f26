"""Whole-table cleaning; columns that are not text pass unchanged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from mapstrata.functions.text import blank_to_null, stripped, zero_padded
from mapstrata.session import column, exact_names


@exact_names
def _on_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        *[
            (change(column(f.name)) if isinstance(f.dataType, T.StringType) else column(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def blanks_to_null(df: DataFrame) -> DataFrame:
    return _on_text(df, blank_to_null)


def strip_text(df: DataFrame) -> DataFrame:
    return _on_text(df, stripped)


@exact_names
def pad_columns(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Zero-pad the named columns as text; missing values stay missing."""
    return df.select(
        *[
            (zero_padded(column(n).cast("string"), widths[n]) if n in widths else column(n)).alias(n)
            for n in df.columns
        ]
    )
