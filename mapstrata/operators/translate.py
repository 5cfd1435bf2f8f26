"""Dictionaries from codes to readable texts: columns ``variable`` and ``traduccion``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.functions.literals import list_from_text
from mapstrata.operators.aggregate import TOTAL_CODE, numeric_code
from mapstrata.operators.columns import with_row_position
from mapstrata.operators.joins import joined_with_few
from mapstrata.session import column


def first_description(metadata: DataFrame, names_column: str, variables: list[str] | None = None) -> DataFrame:
    """First metadata row of each variable; variables without a row have none here either."""
    positioned = with_row_position(metadata).filter(column(names_column).isNotNull())
    if variables is not None:
        positioned = positioned.filter(column(names_column).isin(variables) if variables else F.lit(False))
    whole = F.struct(*[column(c) for c in metadata.columns])
    return (
        positioned.groupBy(column(names_column).alias("described"))
        .agg(F.min_by(whole, "row_position").alias("row"))
        .select("row.*")
    )


def categorical_dictionary(
    metadata: DataFrame,
    names_column: str,
    values_column: str,
    alias_column: str,
    value_alias_column: str,
    variables: list[str] | None = None,
) -> DataFrame:
    """``variable-value`` to ``alias-value alias``. Both value lists are texts, paired up to the
    shorter one; where a list names a value twice the last one counts."""
    rows = first_description(metadata, names_column, variables)
    values, labels = list_from_text(column(values_column)), list_from_text(column(value_alias_column))
    paired = F.least(F.size(values), F.size(labels))
    entries = rows.select(
        column(names_column).alias("name"),
        column(alias_column).alias("alias"),
        F.posexplode(F.slice(F.arrays_zip(values.alias("value"), labels.alias("label")), 1, paired)).alias("i", "pair"),
    ).select(
        F.concat_ws("-", "name", F.coalesce("pair.value", F.lit("None"))).alias("variable"),
        F.concat_ws("-", "alias", F.coalesce("pair.label", F.lit("None"))).alias("traduccion"),
        F.struct("name", "i").alias("position"),
    )
    return entries.groupBy("variable").agg(F.max_by("traduccion", "position").alias("traduccion"))


def numeric_dictionary(
    metadata: DataFrame, names_column: str, alias_column: str, operation: str, variables: list[str] | None = None
) -> DataFrame:
    """``operation::variable`` to ``operation::alias``."""
    rows = first_description(metadata, names_column, variables)
    return rows.select(
        F.concat(F.lit(numeric_code(operation, "")), column(names_column)).alias("variable"),
        F.concat(F.lit(numeric_code(operation, "")), column(alias_column)).alias("traduccion"),
    )


def total_dictionary(metadata: DataFrame) -> DataFrame:
    """The row count stands for itself."""
    spark = metadata.sparkSession
    return spark.range(1).select(F.lit(TOTAL_CODE).alias("variable"), F.lit(TOTAL_CODE).alias("traduccion"))


def merged_dictionaries(parts: list[DataFrame]) -> DataFrame:
    """All entries; where parts name the same code the last part counts."""
    ranked = [part.select("variable", "traduccion", F.lit(i).alias("part")) for i, part in enumerate(parts)]
    return (
        reduce(DataFrame.unionByName, ranked)
        .groupBy("variable")
        .agg(F.max_by("traduccion", "part").alias("traduccion"), F.min("part").alias("part"))
        .select("variable", "traduccion", "part")
    )


def last_names(dictionary: DataFrame, code_column: str, name_column: str) -> DataFrame:
    """code, name; the last row of a code counts."""
    return (
        with_row_position(dictionary)
        .groupBy(column(code_column).alias("code"))
        .agg(F.max_by(column(name_column), "row_position").alias("name"))
    )


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the readable name of their ``code``; codes without one are left out. A code has a row per unit, so
    names are broadcast after a count of their bytes, or the join is salted."""
    others = [column(c) for c in rows.columns if c != "code"]
    return joined_with_few(rows, names, ["code"], others or [column("code")])


def codes_without_name(codes: DataFrame, dictionary: DataFrame, code_column: str) -> DataFrame:
    """Distinct codes that the dictionary does not list."""
    listed = dictionary.select(column(code_column).alias("code")).distinct()
    return codes.select("code").distinct().join(listed, "code", "left_anti")
