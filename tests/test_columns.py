"""Selecting, renaming, casting and dropping columns; errors for wrong requests."""

import pytest

from mapstrata.operators import columns
from mapstrata.operators.casts import convert_types
from mapstrata.operators.cleaning import pad_columns
from mapstrata.plans.prepare import Preparation


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("0", "1", "2", "3")], "`Unnamed: 0` string, `x.y` string, edad string, sexo string")


@pytest.fixture
def metadata(spark):
    rows = [("edad", "Edad", "num"), ("sexo", "Sexo", "cat"), ("edad", "Años", "cat"), ("otra", "Otra", None)]
    return spark.createDataFrame(rows, "var string, alias string, clase string").coalesce(1)


@pytest.fixture
def preparation(df, metadata):
    return Preparation(df, metadata, "var", "alias")


def test_index_column_is_dropped(preparation):
    assert preparation.df.columns == ["x.y", "edad", "sexo"]


def test_rename_takes_the_last_alias(preparation):
    assert preparation.rename_to_alias("alias").df.columns == ["x.y", "Años", "Sexo"]


def test_exclusion_keeps_described_columns_in_metadata_order(preparation):
    assert preparation.exclude_variables("clase", ["num"]).df.columns == ["sexo", "edad"]
    assert preparation.exclude_variables("clase", []).df.columns == ["edad", "sexo"]


def test_selection(preparation):
    assert columns.columns_by_regex(preparation.df, "e") == ["edad", "sexo"]
    assert preparation.select_variables(["x.y"], ["^ed"], "clase", ["cat"]) == ["edad", "sexo", "x.y"]
    assert columns.project(preparation.df, ["x.y", "edad", "x.y"]).collect()[0] == ("1", "2")
    with pytest.raises(ValueError):
        columns.columns_by_regex(preparation.df, "(")
    with pytest.raises(TypeError):
        columns.columns_by_regex(preparation.df, 3)


def test_casts(spark, df):
    def declared(*rows):
        return spark.createDataFrame(list(rows), "var string, tipo string")

    converted = convert_types(df, declared(("edad", "Int64"), ("sexo", "FLOAT"), ("x.y", "category")), "var", "tipo")
    assert dict(converted.dtypes) == {"Unnamed: 0": "string", "x.y": "string", "edad": "bigint", "sexo": "double"}
    with pytest.raises(KeyError):
        convert_types(df, declared(("nada", "int")), "var", "tipo")
    with pytest.raises(TypeError):
        convert_types(df, declared(("edad", "entero")), "var", "tipo")
    with pytest.raises(TypeError):
        convert_types(df, declared(("edad", "boolean")), "var", "tipo")
    words = spark.createDataFrame([("1.5",), (None,)], "edad string")
    with pytest.raises(Exception, match="edad"):
        convert_types(words, declared(("edad", "int")), "var", "tipo").collect()


@pytest.mark.parametrize(
    ("value", "kind", "declared", "expected"),
    [
        (1.7, "double", "int64", None), (2.0, "double", "int64", 2), ("1d", "string", "float", None), (" 1.5 ", "string", "float", 1.5),
        (2, "int", "bool", None), (1, "int", "bool", True), (0.0, "double", "bool", False), (3, "int", "float", 3.0),
    ],
)
def test_casts_that_would_change_a_value_fail(spark, value, kind, declared, expected):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    metadata = spark.createDataFrame([("v", declared)], "var string, tipo string")
    if expected is None:
        with pytest.raises(Exception, match="column v"):
            convert_types(df, metadata, "var", "tipo").collect()
    else:
        assert convert_types(df, metadata, "var", "tipo").collect()[0]["v"] == expected


def test_padding_keeps_missing_values(spark):
    df = spark.createDataFrame([(1, "7"), (None, None)], "a int, b string")
    assert [tuple(r) for r in pad_columns(df, {"a": 2, "b": 3}).collect()] == [("01", "007"), (None, None)]


def test_argument_types(preparation, metadata):
    with pytest.raises(TypeError):
        Preparation("df", metadata, "var", "alias")
    with pytest.raises(TypeError):
        preparation.rename_to_alias(1)
    with pytest.raises(TypeError):
        preparation.exclude_variables("clase", "num")
    with pytest.raises(TypeError):
        preparation.group_totals("edad")
