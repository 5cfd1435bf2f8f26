"""Choosing, renaming and dropping columns. Only column names reach the driver, never data rows."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.session import column, exact_names

# What an unnamed index column of a delimited file is called.
INDEX_COLUMNS = ("Unnamed: 0", "_c0")

# Order of the rows of a metadata table or a dictionary.
POSITION = "row_position"


def drop_index_column(df: DataFrame) -> DataFrame:
    present = [name for name in INDEX_COLUMNS if name in df.columns]
    return df.drop(*present) if present else df


@exact_names
def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Named columns in the given order, repeated names once."""
    return df.select(*[column(name) for name in dict.fromkeys(names)])


def compiled(pattern: str) -> re.Pattern[str]:
    if not isinstance(pattern, str):
        raise TypeError("a regular expression must be a str")
    try:
        return re.compile(pattern)
    except re.error as error:
        raise ValueError(f"{pattern!r} is not a valid regular expression: {error}") from None


def columns_by_regex(df: DataFrame, pattern: str) -> list[str]:
    """Columns in which the pattern is found anywhere, in table order."""
    matcher = compiled(pattern)
    return [name for name in df.columns if matcher.search(name)]


def with_row_position(table: DataFrame) -> DataFrame:
    """Rows of metadata with their order, which counts where a name occurs twice.

    Tables read with ``positions`` carry it, as does any table with a sortable column of that name. For others it is
    the order in which Spark holds the rows, which is the caller's own only without a shuffle and within one file.
    """
    return table if POSITION in table.columns else table.withColumn(POSITION, F.monotonically_increasing_id())


def columns_by_class(
    df: DataFrame, metadata: DataFrame, names_column: str, class_column: str, values: list, keep: bool = True
) -> list[str]:
    """Columns of ``df`` whose metadata class is (``keep``) or is not in ``values``, in metadata order.

    The filter runs in Spark; what comes back is at most one row per existing column.
    """
    classified = column(class_column).isin(values) if values else F.lit(False)
    wanted = F.coalesce(classified, F.lit(False))
    rows = (
        with_row_position(metadata)
        .filter((wanted if keep else ~wanted) & column(names_column).isin(df.columns))
        .groupBy(column(names_column).alias("name"))
        .agg(F.min("row_position").alias("row_position"))
        .collect()
    )
    return [row["name"] for row in sorted(rows, key=lambda row: row["row_position"])]


def select_variables(
    df: DataFrame,
    listed: list[str],
    patterns: list[str],
    metadata: DataFrame | None = None,
    names_column: str | None = None,
    class_column: str | None = None,
    values: list | None = None,
) -> list[str]:
    """Union of the listed columns, the pattern matches and the metadata class, sorted."""
    chosen = set(listed)
    for pattern in patterns:
        chosen.update(columns_by_regex(df, pattern))
    if class_column is not None:
        chosen.update(columns_by_class(df, metadata, names_column, class_column, values or []))
    return sorted(chosen)


@exact_names
def rename_to_alias(df: DataFrame, metadata: DataFrame, names_column: str, alias_column: str) -> DataFrame:
    """Columns renamed by metadata; names without a column are ignored, the last duplicate wins."""
    rows = (
        with_row_position(metadata)
        .filter(column(names_column).isin(df.columns) & column(alias_column).isNotNull())
        .groupBy(column(names_column).alias("name"))
        .agg(F.max_by(column(alias_column), "row_position").alias("alias"))
        .collect()
    )
    return df.withColumnsRenamed({row["name"]: row["alias"] for row in rows})


def exclude_by_class(
    df: DataFrame, metadata: DataFrame, names_column: str, class_column: str, values: list
) -> DataFrame:
    """Only columns described in the metadata and of none of the given classes, in metadata order."""
    return project(df, columns_by_class(df, metadata, names_column, class_column, values, keep=False))
