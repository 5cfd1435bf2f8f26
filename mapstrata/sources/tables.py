"""Table readers. Delimited files are read as text; Parquet keeps its own types."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.numbers import as_double
from mapstrata.functions.text import missing_to_null
from mapstrata.operators.columns import POSITION, drop_index_column
from mapstrata.operators.gate import Gate, passed_gate, watched
from mapstrata.session import column, exact_names, written_once
from mapstrata.sinks.versions import resolved
from mapstrata.sources.records import READER, read_delimited

CATALOG_COLUMNS = ("catalog", "pos", "clave", "clasificacion", "descripcion")


def _positioned(table: DataFrame) -> DataFrame:
    """Rows with their place: file, split of the file, row within it. Files count in the order of their names, in which
    the writers number them; Spark itself takes large files first."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return table.select("*", place.alias(POSITION))


@exact_names
def _read(spark: SparkSession, path: str, splits: bool, positions: bool = False, multiline: bool = True) -> DataFrame:
    """With ``splits`` delimited files of any size, else small ones, of which each is read by one task in its own order.
    Without ``multiline`` the caller vouches that no cell has a line break, and quotes are not counted. ``folder#name`` is an
    output of the version of a folder that counts."""
    path = resolved(path)
    try:
        if path.rstrip("/").endswith(".parquet"):
            table = spark.read.parquet(path)
            return drop_index_column(_positioned(table) if positions else table)
        raw = read_delimited(spark, path, multiline) if splits else spark.read.csv(path, header=True, inferSchema=False, multiLine=True, **READER)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from None
        raise
    texts = drop_index_column(_positioned(raw) if positions else raw)
    place = [POSITION] if positions else []
    return texts.select(
        *[missing_to_null(column(name)).alias(name) for name in texts.columns if name not in place], *place
    )


def read_microdata(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Microdata in splits, every delimited column as text and missing-value texts as null. Cells may hold line breaks unless
    ``multiline`` is off, which saves counting the quotes."""
    return _read(spark, path, splits=True, multiline=multiline)


def read_metadata(spark: SparkSession, path: str, positions: bool = False) -> DataFrame:
    """One row per variable, all text; descriptions hold line breaks and doubled quotes. With ``positions`` a column
    ``row_position`` keeps the file order, by which the first or last of equal names counts."""
    return _read(spark, path, splits=False, positions=positions)


@exact_names
def read_scale(spark: SparkSession, path: str, ids: list[str], multiline: bool = True) -> DataFrame:
    """Wide aggregate table: ids stay text (leading zeros), number-like columns become double. ``multiline`` as for microdata."""
    table = _read(spark, path, splits=True, multiline=multiline)
    return _typed_scale(table, ids, passed_gate(table, _without(table, ids)))


@exact_names
def staged_scale(
    spark: SparkSession, path: str, ids: list[str], multiline: bool = True
) -> tuple[DataFrame, int | None, str | None]:
    """The same table, its number of units and the folder of its copy. A delimited file is parsed once: the write of the copy
    finds the number-like columns and counts the units. Parquet is read where it is, and its units are not counted."""
    if path.rstrip("/").endswith(".parquet"):
        return read_scale(spark, path, ids), None, None
    table = _read(spark, path, splits=True, multiline=multiline)
    observed, outcome = watched(table, _without(table, ids))
    copied, copy = written_once(observed, "scale")
    gate = outcome()
    return _typed_scale(copied, ids, gate), gate.rows, copy


def _without(table: DataFrame, ids: list[str]) -> list[str]:
    return [name for name in table.columns if name not in ids]


def _typed_scale(table: DataFrame, ids: list[str], gate: Gate) -> DataFrame:
    numeric = set(gate.passed)
    types = {field.name: field.dataType for field in table.schema}
    picked = []
    for name in table.columns:
        value = column(name)
        if name in ids:
            value = value.cast("string")
        elif name in numeric:
            value = as_double(value, types[name])
        picked.append(value.alias(name))
    return table.select(*picked)


def read_long_scale(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """ids, ``code`` and ``value`` as ``forma_larga`` writes them; ids stay text, a value that is no number fails the job."""
    table = _read(spark, path, splits=True)
    for required in (*ids, "code", "value"):
        if required not in table.columns:
            raise ValueError(f"the long scale at {path} has no column {required}")
    raw = F.col("value")
    number = as_double(raw, table.schema["value"].dataType)
    failure = F.raise_error(F.concat(F.lit("a value of a long scale is no number: "), raw.cast("string")))
    value = F.when(raw.isNotNull() & number.isNull() & ~F.lower(raw.cast("string")).eqNullSafe("nan"), failure).otherwise(number)
    return table.select(*[column(i).cast("string").alias(i) for i in ids], F.col("code").cast("string").alias("code"), value.alias("value"))


def read_translations(
    spark: SparkSession, path: str, names_column: str, alias_column: str, positions: bool = False
) -> DataFrame:
    """Translation dictionary; both named columns must exist. ``positions`` as for metadata."""
    table = _read(spark, path, splits=False, positions=positions)
    for required in (names_column, alias_column):
        if required not in table.columns:
            raise ValueError(f"the translation dictionary has no column {required}")
    return table


def read_catalogs(spark: SparkSession, path: str) -> DataFrame:
    """All catalogues in one long table, ``pos`` being the order within a catalogue."""
    table = _read(spark, path, splits=False)
    for required in CATALOG_COLUMNS:
        if required not in table.columns:
            raise ValueError(f"the catalogue table has no column {required}")
    return table.select(
        *[column(c).cast(T.LongType() if c == "pos" else T.StringType()).alias(c) for c in CATALOG_COLUMNS]
    )


def read_bin_table(spark: SparkSession, path: str) -> DataFrame:
    """Bin table as written by the stratification; ``bin`` and ``part`` are integers, the rest text."""
    table = _read(spark, path, splits=True)
    whole = {"bin": "int", "part": "bigint"}
    return table.select(*[(column(c).cast(whole[c]) if c in whole else column(c)).alias(c) for c in table.columns])
