"""Delimited and Parquet output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.session import case_sensitive_names, column


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet for ``.parquet`` paths, else delimited text with header, null as empty field.

    Every task writes its own file and a task that is run again replaces its output, so a lost
    executor leaves no partial or doubled rows.
    """
    with case_sensitive_names(df.sparkSession):
        if path.rstrip("/").endswith(".parquet"):
            df.write.mode(mode).parquet(path)
        else:
            df.write.mode(mode).csv(
                path,
                header=True,
                quote='"',
                escape='"',
                ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False,
            )


def write_units(wide: DataFrame, ids: list[str], path: str) -> None:
    """Wide aggregates in unit order."""
    write_table(wide.orderBy(*[column(i) for i in ids]), path)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """Translation dictionary, parts in the order in which they were merged."""
    order = [F.col("part"), F.col("variable")] if "part" in dictionary.columns else [F.col("variable")]
    write_table(dictionary.orderBy(*order).select("variable", "traduccion"), path)
