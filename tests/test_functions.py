"""Column functions against the plain Python behaviour they stand for."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from mapstrata.functions.literals import array_literal, list_from_text, list_to_text, options_from_text
from mapstrata.functions.numbers import float_text, is_number_text, percent
from mapstrata.functions.text import (
    WHITE_SPACE,
    accents_folded,
    blank_to_null,
    catalog_name_normalized,
    missing_to_null,
    source_name_normalized,
    stripped,
    zero_padded,
)


def apply(spark, function, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r["out"] for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_white_space_is_all_of_it():
    assert sorted(WHITE_SPACE) == [chr(i) for i in range(0x110000) if chr(i).isspace()]


def test_strip_and_blanks(spark):
    values = ["", " ", "\t\n", " a b ", "　x\xa0", "\x1cq", "plain", None]
    assert apply(spark, stripped, values) == [v.strip() if v is not None else None for v in values]
    assert apply(spark, blank_to_null, values) == [v if v and v.strip() else None for v in values]


def test_missing_texts_only_when_exact(spark):
    assert apply(spark, missing_to_null, ["NA", " NA", "nan", "Nan", "", "-nan", "0", None]) == [
        None, " NA", None, "Nan", None, None, "0", None,
    ]


def test_zero_padding(spark):
    values = ["1", "12", "1234", "-1", "+7", "", "-", None, "á"]
    assert apply(spark, lambda c: zero_padded(c, 3), values) == [v.zfill(3) if v is not None else None for v in values]


def test_accents_and_names(spark):
    assert apply(spark, accents_folded, ["ÁÉÍÓÚÜÑáéíóúüñ", "Çà ê", "é", "xº"]) == ["AEIOUUNaeiouun", "Ca e", "e", "xo"]
    assert apply(spark, source_name_normalized, [" CATÁLOGO: SI _ NO "]) == ["CATALOGO SI_NO"]
    assert apply(spark, catalog_name_normalized, ["Cat Sí_No", "Concat x", "CATALOGO Z"]) == [
        "CATALOGO SI_NO", "CONCAT X", "CATALOGO Z",
    ]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1", True), ("-1.5", True), ("+.5", True), ("5.", True), ("1e3", True), ("1E-3", True), ("inf", True),
        ("-Infinity", True), ("1d", False), ("1f", False), ("nan", False), ("0x1", False), ("1_0", False),
        ("1,5", False), ("", False), ("x", False), ("1e400", False), ("18446744073709551615", True),
        ("18446744073709551616", False), ("-9223372036854775808", True), ("-9223372036854775809", False),
        ("99999999999999999999.5", True), ("1 2", False),
    ],
)
def test_number_texts(spark, text, number):
    assert apply(spark, is_number_text, [text]) == [number]


def test_float_texts(spark):
    values = [0.0, -0.0, 1.0, -2.5, 0.1, 0.001, 0.0001, 0.00012345, 0.00001, 1.5e-7, 9999999.0, 1e7, 12345678.9,
              123456789012345.6, 9007199254740993.0, 1e16, 1.5e17, 1e22, -1e-5, 5.75, 1 / 3]
    assert apply(spark, float_text, values, "double") == [str(v) for v in values]


def test_float_texts_are_the_shortest(spark):
    """Over all exponents, beside powers of two, where digits end in halves, and below the smallest number of full precision."""
    draw = random.Random(7)
    bits = [struct.unpack(">d", struct.pack(">Q", draw.getrandbits(64)))[0] for _ in range(20_000)]
    values = [x for x in bits if math.isfinite(x)]
    values += [draw.uniform(-1, 1) * 10 ** draw.uniform(14, 40) for _ in range(20_000)]
    values += [10 ** draw.uniform(25, 25.6) for _ in range(3000)]
    values += [2.0**i for i in range(-1074, 1024)] + [5e-324 * i for i in range(1, 300)]
    values += [float(f"{d}e{i}") for d in (1, 2, 9, 99, 123) for i in range(-323, 306)]
    values += [9007199254740993.0, 1e16, 9999999999999998.0, 9.655709520753062e16, 5e-324, 0.0001, 0.00009999, 0.0, -0.0, math.inf, -math.inf]
    assert apply(spark, float_text, values, "double") == [repr(v) for v in values]


def test_percent(spark):
    values = [0.12345, -0.0004, 0.0005, 1.0, 0.25050000000000006]
    found = apply(spark, lambda c: float_text(percent(c)), values, "double")
    assert found == [str(float(math.copysign(round(v * 100 * 10) / 10, v))) for v in values]


def test_list_texts(spark):
    texts = ["['SI ', 'NO']", "[1, 2, 99]", "[]", "['a', \"it's\"]", "[None, True, 'None']", "['\\xa0x', 'é']", None]
    lists = apply(spark, list_from_text, texts)
    assert lists == [["SI ", "NO"], ["1", "2", "99"], [], ["a", "it's"], ["None", "True", "None"], ["\xa0x", "é"], None]


def test_list_text_round_trip(spark):
    lists = [["a", "it's"], ['say "x"', "b'\"c"], [], ["back\\slash"], ["SI "]]
    texts = apply(spark, list_to_text, lists, "array<string>")
    assert texts == [str(items) for items in lists]
    assert apply(spark, list_from_text, texts) == lists


def test_options(spark):
    texts = ["{'options': {'1': 'Sí', '2': None}, 'n': True}", "{'type': 'int'}", "{'options': {}}", "{'options': {'1': True}}"]
    assert apply(spark, options_from_text, texts) == [{"1": "Sí", "2": None}, None, {}, {"1": "True"}]


def test_array_literal_drops_quotes(spark):
    assert apply(spark, array_literal, [["a'b", 'c"'], [], ["x", "y z"]], "array<string>") == ["{ab,c}", "{}", "{x,y z}"]


def test_words_in_quotes_stay(spark):
    texts = ["['a, None, b', 'c']", "['True', None]", "['back\\\\xe1']", '["it\'s None, True"]']
    assert apply(spark, list_from_text, texts) == [["a, None, b", "c"], ["True", "None"], ["back\\xe1"], ["it's None, True"]]
    texts = ["{'options': {'1': 'a: None, b', '2': None}}", "{'options': {1: 'uno', -2.5: 'x, 3: y'}}"]
    assert apply(spark, options_from_text, texts) == [{"1": "a: None, b", "2": None}, {"1": "uno", "-2.5": "x, 3: y"}]


@pytest.mark.parametrize("parser", [list_from_text, options_from_text])
@pytest.mark.parametrize("text", ["['1', '2'", "{'options': {'1': 'a'", "['a' 'b'", " "])
def test_unreadable_texts_fail(spark, parser, text):
    with pytest.raises(Exception):  # noqa: B017
        apply(spark, parser, [text])


def test_long_texts(spark):
    items = ["x" * 50_000, "it's " * 2000]
    assert apply(spark, list_from_text, [str(items)]) == [items]
