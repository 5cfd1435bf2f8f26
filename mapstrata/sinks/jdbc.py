"""Bulk append to a database table.

Each task inserts its partition in one transaction. There is no transaction over all partitions, and a task that runs twice
inserts twice: where readers must never see half a load, use ``staged.staged_load`` and its statements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Database type per column type; anything else is text.
DATABASE_TYPES = {
    T.ByteType: "INTEGER",
    T.ShortType: "INTEGER",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DecimalType: "NUMERIC",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.BooleanType: "BOOLEAN",
}


def database_type(data_type: T.DataType) -> str:
    return DATABASE_TYPES.get(type(data_type), "TEXT")


def identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def create_table_statement(df: DataFrame, table: str, key: str = "SERIAL") -> str:
    """Statement for a target table with a surrogate key, to be run once before loading; ``table`` may name a schema. A key of
    the type ``SERIAL`` ends at 2**31 rows, ``BIGSERIAL`` does not."""
    table = ".".join(map(identifier, table.split(".")))
    columns = [f"id {key} PRIMARY KEY"]
    columns += [f"{identifier(f.name)} {database_type(f.dataType)}" for f in df.schema]
    return f"CREATE TABLE IF NOT EXISTS {table} (\n    " + ",\n    ".join(columns) + "\n)"


def column_types_option(df: DataFrame) -> str:
    """Column types for a table that Spark creates; text columns keep the driver's own default."""
    typed = [(f.name, database_type(f.dataType)) for f in df.schema]
    return ", ".join(f"`{name}` {kind}" for name, kind in typed if kind != "TEXT")


def jdbc_options(
    df: DataFrame, url: str, table: str, create_table: bool, batch_size: int, connections: int, options: dict[str, str]
) -> dict[str, str]:
    chosen = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **options,
    }
    types = column_types_option(df)
    if create_table and types:
        chosen["createTableColumnTypes"] = types
    return chosen


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    create_table: bool = False,
    batch_size: int = 10_000,
    connections: int = 16,
    **options: str,
) -> None:
    """Append all rows by column name. ``connections`` limits how many tasks write at a time."""
    chosen = jdbc_options(df, url, table, create_table, batch_size, connections, options)
    df.write.format("jdbc").options(**chosen).mode("append").save()
