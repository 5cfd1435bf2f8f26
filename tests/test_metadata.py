"""Catalogues, survey options and dictionaries."""

import pytest

from mapstrata.operators import joins, metadata, translate
from mapstrata.session import local_table
from mapstrata.sinks.files import write_table
from mapstrata.sources import read_translations


def test_catalog_values(spark):
    catalogs = spark.createDataFrame(
        [
            ("Cat Sí_No", 2, "2", None, "NO "),
            ("Cat Sí_No", 1, "1", None, "SI "),
            ("CATALOGO ORIGEN", 1, "1", "USMER", "larga"),
            ("CATALOGO ORIGEN", 2, "99", None, "otra"),
            ("Cat Vacío", 1, "7", None, None),
        ],
        "catalog string, pos bigint, clave string, clasificacion string, descripcion string",
    )
    rows = [("a", "CATÁLOGO: SI _ NO"), ("b", "CATALOGO ORIGEN "), ("c", "CATALOGO VACIO"), ("d", "TEXTO"), ("e", None)]
    found = metadata.with_catalog_values(local_table(spark, ["var", "fuente"], rows), "fuente", catalogs)
    upper = {r["var"]: (r["fuente"], r[metadata.LABELS], r[metadata.KEYS]) for r in found.collect()}
    assert upper["b"] == ("CATALOGO ORIGEN", "['USMER', None]", "['1', '99']")
    assert upper["c"] == ("CATALOGO VACIO", "[]", "['7']")
    assert upper["d"] == ("TEXTO", "[]", "[]")
    assert upper["e"] == (None, "[]", "[]")
    assert upper["a"] == ("CATALOGO SI_NO", "['SI ', 'NO ']", "['1', '2']")


def test_survey_options(spark):
    rows = [
        ("p1", "Agua", "options", "{'options': {'1': 'Sí', '2': 'No'}}"),
        ("p2", "Cuartos", "abierta", "{'type': 'int'}"),
        ("municipio", "Municipio", "abierta", "{'options': {}}"),
    ]
    table = local_table(spark, ["var", "var_alias", "var_type", "values"], rows)
    found = {r["var"]: r.asDict() for r in metadata.with_option_lists(table).collect()}
    assert found["p1"]["posibles_valores_alias"] == "['1', '2']"
    assert found["p1"]["posibles_valores"] == "['Sí', 'No']"
    assert found["p1"]["options"] == {"1": "Sí", "2": "No"}
    assert found["p2"]["posibles_valores"] == "[]"
    assert found["p2"]["options"] is None
    assert found["municipio"]["var_type"] == "options"
    assert {r["dtype"] for r in found.values()} == {"str"}


@pytest.fixture
def described(spark):
    rows = [
        ("sexo", "Sexo", "[1, '2', 2, 3]", "['Mujer ', 'Otro', \"L'ultimo\"]"),
        ("sexo", "Segunda", "[1]", "['nunca']"),
        ("edad", "Edad", "[]", "[]"),
    ]
    return local_table(spark, ["var", "alias", "valores", "etiquetas"], rows)


def test_categorical_dictionary(described):
    """First description of a variable, shorter list, last of repeated values; labels keep blanks."""
    found = translate.categorical_dictionary(described, "var", "valores", "alias", "etiquetas", ["sexo", "edad", "x"])
    assert {r["variable"]: r["traduccion"] for r in found.collect()} == {
        "sexo-1": "Sexo-Mujer ",
        "sexo-2": "Sexo-L'ultimo",
    }


def test_merged_dictionaries(described):
    parts = [
        translate.total_dictionary(described),
        translate.numeric_dictionary(described, "var", "alias", "media", ["edad", "sexo"]),
        translate.numeric_dictionary(described, "var", "var", "media", ["edad"]),
    ]
    found = {r["variable"]: (r["traduccion"], r["part"]) for r in translate.merged_dictionaries(parts).collect()}
    assert found == {
        "conteo::total_datos": ("conteo::total_datos", 0),
        "media::edad": ("media::edad", 1),
        "media::sexo": ("media::Sexo", 1),
    }


def test_names_and_missing_codes(spark):
    dictionary = local_table(spark, ["variable", "traduccion"], [("a", "A1"), ("a", "A2"), ("b", "B")])
    codes = local_table(spark, ["code"], [("a",), ("c",), ("c",)])
    names = translate.last_names(dictionary, "variable", "traduccion")
    assert [tuple(r) for r in translate.named(codes, names).collect()] == [("a", "A2")]
    assert [tuple(r) for r in translate.codes_without_name(codes, dictionary, "variable").collect()] == [("c",)]


@pytest.mark.parametrize("broadcast", [None, 0])
def test_catalog_dictionary_equals_the_lists(spark, monkeypatch, broadcast):
    """Joined row by row, catalogues give what their lists give; also with a key twice and a catalogue without labels."""
    if broadcast is not None:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
    catalogs = spark.createDataFrame(
        [("Cat Uno", 1, "1", "a", "x"), ("Cat Uno", 2, "2", None, "y"), ("Cat Uno", 3, "1", "c", "z"),
         ("Cat Dos", 1, "1", None, "p"), ("Cat Dos", 2, None, None, "q"), ("Cat Tres", 1, "1", None, None)],
        "catalog string, pos bigint, clave string, clasificacion string, descripcion string",
    )
    rows = spark.createDataFrame(
        [("v", "V", "CATÁLOGO: UNO"), ("w", "W", "CATÁLOGO: UNO"), ("x", "X", "CATÁLOGO: DOS"), ("y", "Y", "CATÁLOGO: TRES"), ("z", "Z", "-")],
        "var string, alias string, fuente string",
    ).coalesce(1)
    found = metadata.catalog_dictionary(rows, "var", "alias", "fuente", catalogs)
    lists = metadata.with_catalog_values(rows, "fuente", catalogs)
    expected = translate.categorical_dictionary(lists, "var", metadata.KEYS, "alias", metadata.LABELS)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert found.count() == 6


@pytest.mark.parametrize("broadcast", [None, 0])
def test_names_join_gathers_no_code(spark, monkeypatch, broadcast):
    if broadcast is not None:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
    rows = spark.range(100).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id AS string)) AS code")
    names = spark.createDataFrame([("hot", "H"), ("1", "one")], "code string, name string")
    joined = translate.named(rows, names)
    assert sorted((r["id"], r["name"]) for r in joined.collect()) == sorted([(i, "H") for i in range(0, 100, 3)] + [(1, "one")])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert all("_salt" in line or "broadcast" in line for line in plan.split("\n") if "Join Inner" in line)


@pytest.mark.parametrize("suffix", ["", ".parquet"])
def test_order_over_files(spark, tmp_path, suffix):
    """The second, larger file is read first by Spark; its rows still come last."""
    path = f"{tmp_path}/several{suffix}"
    order = spark.createDataFrame([(0, "x", "first"), (1, "x", "last" * 5000)], "n int, variable string, traduccion string")
    write_table(order.repartitionByRange(2, "n").drop("n"), path)
    table = read_translations(spark, path, "traduccion", "variable", positions=True)
    assert translate.last_names(table, "variable", "traduccion").first()["name"] == "last" * 5000
    assert translate.first_description(table, "variable").first()["traduccion"] == "first"


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_catalog_pages_are_the_lists(spark, size):
    """Pages in order give the list of each catalogue, one of which has half of all entries; no page is longer than asked."""
    rows = [(f"Cat {'Uno' if i % 2 else i % 7}", i // 3, str(i), None if i % 14 in (0, 7) else f"c{i}", "d" if i % 14 else None) for i in range(400)]
    rows += [("Cat Nada", 1, "1", None, None), ("Cat Nada", 2, None, None, None), ("Cat Uno", None, None, "z", None)] * 2
    schema = "catalog string, pos bigint, clave string, clasificacion string, descripcion string"
    catalogs = spark.createDataFrame(rows, schema).repartition(6)
    whole = {r.catalog: (r.labels, r["keys"]) for r in metadata.catalog_lists(catalogs).collect()}
    labels, keys = {c: [] for c in whole}, {c: [] for c in whole}
    pages = sorted(metadata.catalog_pages(catalogs, size).collect(), key=lambda r: (r.catalog, r.page))
    for r in pages:
        labels[r.catalog] += r.labels
        keys[r.catalog] += r["keys"]
        assert 0 < len(r["keys"]) <= size
    assert whole == {c: (labels[c], keys[c]) for c in whole}
    assert [r.page for r in pages if r.catalog == "CATALOGO UNO"] == list(range(-(-len(keys["CATALOGO UNO"]) // size)))


@pytest.mark.parametrize(("size", "error"), [(0, ValueError), (True, TypeError), ("3", TypeError)])
def test_page_sizes(spark, size, error):
    with pytest.raises(error):
        metadata.catalog_pages(spark.createDataFrame([], "catalog string, pos bigint, clave string, clasificacion string, descripcion string"), size)
