"""Declared column types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.numbers import is_number_text
from mapstrata.functions.text import stripped
from mapstrata.operators.columns import with_row_position
from mapstrata.session import column, exact_names

# Declared type names and the column type each one stands for.
DECLARED_TYPES = {
    "int": "bigint",
    "int64": "bigint",
    "int32": "int",
    "int16": "smallint",
    "int8": "tinyint",
    "float": "double",
    "float64": "double",
    "float32": "float",
    "bool": "boolean",
    "boolean": "boolean",
    "str": "string",
    "string": "string",
    "object": "string",
    "category": "string",
    "datetime64[ns]": "timestamp",
    "datetime64": "timestamp",
}


INTEGERS = {"bigint", "int", "smallint", "tinyint"}


def _cast_or_fail(value: Column, current: T.DataType, spark_type: str, name: str) -> Column:
    """The value as ``spark_type``. A value that the type cannot hold as it is fails: a fraction as an integer, a text
    that is no number, a number other than 0 and 1 as a truth value."""
    converted = value.try_cast(spark_type)
    wrong = converted.isNull()
    if spark_type in INTEGERS and isinstance(current, T.FractionalType):
        wrong |= value != F.floor(value)
    elif spark_type in ("double", "float") and isinstance(current, T.StringType):
        text = stripped(value)
        wrong |= ~(is_number_text(text) | (F.lower(text) == "nan"))
    elif spark_type == "boolean" and isinstance(current, T.NumericType):
        wrong |= ~value.isin(0, 1)
    message = F.concat(F.lit(f"column {name}: not a {spark_type}: "), value.cast("string"))
    return F.when(value.isNotNull() & wrong, F.raise_error(message)).otherwise(converted)


@exact_names
def convert_types(df: DataFrame, metadata: DataFrame, names_column: str, types_column: str) -> DataFrame:
    """Cast the columns named in the metadata; a value that does not convert fails the job.

    Text is never accepted as a truth value.
    """
    rows = (
        with_row_position(metadata)
        .select(column(names_column).alias("name"), column(types_column).alias("type"), "row_position")
        .orderBy("row_position")
        .collect()
    )
    current = {field.name: field.dataType for field in df.schema}
    casts: dict[str, Column] = {}
    for row in rows:
        name, declared = row["name"], row["type"]
        if name not in current:
            raise KeyError(f"column {name} does not exist")
        spark_type = DECLARED_TYPES.get(declared.lower()) if isinstance(declared, str) else None
        if spark_type is None:
            raise TypeError(f"type {declared} is not valid for column {name}")
        if spark_type == "boolean" and isinstance(current[name], T.StringType):
            raise TypeError(f"type {declared} is not valid for text column {name}")
        casts[name] = _cast_or_fail(column(name), current[name], spark_type, name)
    return df.select(*[casts.get(name, column(name)).alias(name) for name in df.columns])
