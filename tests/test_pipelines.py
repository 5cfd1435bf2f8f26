"""Both pipelines from specification to files, and the stratifier's rules."""

import copy
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mapstrata.operators import cells, joins, order_stats
from mapstrata.plans.prepare import run_preparation
from mapstrata.plans.strata import Request, Stratifier, duplicated_bins, run_stratification
from mapstrata.session import local_table

METADATA = (
    'Nº,VARIABLE,FORMATO,VALORES,CLAVES\n1,ENTIDAD,x,[],[]\n2,SEXO,"dos\nlineas","[\'MUJER\', \'HOMBRE \']","[1, 2]"\n'
    '3,EDAD,NUM,[],[]\n4,AUSENTE,x,"[\'z\']",[1]\n'
)


@pytest.fixture
def registry(tmp_path):
    """Cases of 40 places with a padded code, sex 1/2/blank, and age."""
    rng = np.random.default_rng(3)
    places = [f"{i:02d}" for i in range(40)]
    frame = pd.DataFrame(
        {
            "ENTIDAD": rng.choice(places, 3000),
            "SEXO": rng.choice(["1", "2", "2", "2", " "], 3000),
            "EDAD": rng.integers(0, 100, 3000),
            "FECHA": "2020-01-01",
        }
    )
    frame.loc[frame.ENTIDAD == "07", "SEXO"] = ""
    frame.loc[frame.ENTIDAD == "11", "EDAD"] = None
    frame.to_csv(tmp_path / "datos.csv")
    (tmp_path / "meta.csv").write_text(METADATA)
    spec = {
        "ruta_csv_dataset": str(tmp_path / "datos.csv"),
        "ruta_csv_metadatos": str(tmp_path / "meta.csv"),
        "ruta_salida_dataset": str(tmp_path / "amplia"),
        "ruta_salida_diccionario_traducciones": str(tmp_path / "diccionario"),
        "columna_metadatos_nombres": "VARIABLE",
        "columna_metadatos_posibles_valores": "CLAVES",
        "columna_metadatos_posibles_valores_alias": "VALORES",
        "variables_identificadoras_list": ["ENTIDAD"],
        "variables_a_agrupar": [
            {
                "tipo_variables": "categorico",
                "variables_a_agrupar_list": [],
                "variables_a_agrupar_regex": ["^(?!EDAD)(?!FECHA).*"],
            },
            {
                "tipo_variables": "numerico",
                "operacion": "media",
                "variables_a_agrupar_list": ["EDAD"],
                "variables_a_agrupar_regex": [],
            },
            {
                "tipo_variables": "numerico",
                "operacion": "mediana",
                "variables_a_agrupar_list": ["EDAD"],
                "variables_a_agrupar_regex": [],
            },
        ],
    }
    return frame, spec


def expected_wide(frame):
    sex = frame.SEXO.str.strip().replace("", None)
    counts = pd.crosstab(frame.ENTIDAD, sex)
    edad = frame.groupby("ENTIDAD").EDAD
    wide = pd.DataFrame(
        {
            "conteo::total_datos": frame.groupby("ENTIDAD").size(),
            "media::EDAD": edad.mean(),
            "mediana::EDAD": edad.median(),
        }
    ).join(counts.rename(columns=lambda v: f"SEXO-{v}"), how="inner")
    return wide[["conteo::total_datos", "SEXO-1", "SEXO-2", "media::EDAD", "mediana::EDAD"]]


def test_both_pipelines(spark, tmp_path, registry):
    frame, spec = registry
    spec_file = tmp_path / "spec.json"
    spec_file.write_text(json.dumps(spec))
    prepared = run_preparation(spark, str(spec_file))
    wide = expected_wide(frame)
    written = spark.read.csv(spec["ruta_salida_dataset"], header=True)
    assert written.columns == ["ENTIDAD", *wide.columns]
    found = written.toPandas().set_index("ENTIDAD").astype(float)
    assert list(found.index) == sorted(found.index)
    pd.testing.assert_frame_equal(found, wide.astype(float), check_names=False)
    assert "07" not in found.index and prepared.skipped == []
    dictionary = spark.read.csv(spec["ruta_salida_diccionario_traducciones"], header=True)
    assert {tuple(r) for r in dictionary.collect()} == {
        ("conteo::total_datos", "conteo::total_datos"),
        ("SEXO-1", "SEXO-MUJER"),
        ("SEXO-2", "SEXO-HOMBRE "),
        ("media::EDAD", "media::EDAD"),
        ("mediana::EDAD", "mediana::EDAD"),
    }

    cut_spec = {
        "rutas_csv_escalas": {"mun": spec["ruta_salida_dataset"]},
        "ruta_csv_diccionario_traducciones": spec["ruta_salida_diccionario_traducciones"],
        "columna_diccionario_traducciones_nombres": "traduccion",
        "columna_diccionario_traducciones_alias": "variable",
        "variables_identificadoras": ["ENTIDAD"],
        "variables_excluidas_list": [],
        "variables_excluidas_regex": ["^SEXO-2"],
        "variables_a_procesar_regex": {"None": "^.*", "conteo::total_datos": "^SEXO"},
        "variables_a_procesar_list": {"None": ["media::EDAD", "SEXO-2"]},
        "q": 5,
        "ruta_csv_salida": str(tmp_path / "bins"),
    }
    result = run_stratification(spark, cut_spec)
    bins = spark.read.csv(str(tmp_path / "bins"), header=True).toPandas()
    assert list(bins.columns) == ["name", "code", "bin", "part", "interval_mun", "cells_mun"]
    order = list(dict.fromkeys(zip(bins.index, bins.code)))
    assert [c for _, c in order][0] == "SEXO-1"
    share = pd.qcut(wide["SEXO-1"] / wide["conteo::total_datos"], 5, duplicates="drop")
    first = bins[(bins.code == "SEXO-1") & bins.interval_mun.str.contains("%")].reset_index(drop=True)
    assert list(first.interval_mun) == [
        f"{(i.left * 100).round(1)}%:{(i.right * 100).round(1)}%" for i in share.cat.categories
    ]
    assert list(first.cells_mun) == ["{" + ",".join(share.index[share == i]) + "}" for i in share.cat.categories]
    median = bins[bins.code == "mediana::EDAD"]
    assert median.iloc[-1].interval_mun == "Sin clasificar" and median.iloc[-1].cells_mun == "{11}"
    repeated = {r["code"] for r in duplicated_bins(result).collect()}
    assert repeated == {"SEXO-1", "media::EDAD"}
    assert "SEXO-2" not in set(bins.code)


@pytest.mark.parametrize(
    ("change", "error"),
    [
        (lambda s: s.pop("ruta_csv_dataset"), ValueError),
        (lambda s: s.update(ruta_csv_dataset="/none.csv"), FileNotFoundError),
        (lambda s: s.update(columna_metadatos_nombres="nada"), KeyError),
        (lambda s: s.update(columna_metadatos_nombres=3), TypeError),
        (lambda s: s.update(variables_identificadoras_list="ENTIDAD"), TypeError),
        (lambda s: s.update(variables_identificadoras_list=["nada"]), KeyError),
        (lambda s: s["variables_a_agrupar"].append("x"), TypeError),
        (lambda s: s["variables_a_agrupar"][0].pop("tipo_variables"), ValueError),
        (lambda s: s["variables_a_agrupar"][0].update(tipo_variables="otro"), ValueError),
        (lambda s: s["variables_a_agrupar"][1].pop("operacion"), ValueError),
        (lambda s: s["variables_a_agrupar"][1].update(operacion="moda"), ValueError),
        (lambda s: s["variables_a_agrupar"][0].update(variables_a_agrupar_regex=["("]), ValueError),
        (lambda s: s["variables_a_agrupar"].append(s["variables_a_agrupar"][1]), ValueError),
    ],
)
def test_wrong_preparation_specs(spark, registry, change, error):
    spec = copy.deepcopy(registry[1])
    change(spec)
    with pytest.raises(error):
        run_preparation(spark, spec)


def test_optional_steps(spark, registry, tmp_path):
    spec = copy.deepcopy(registry[1])
    (tmp_path / "meta.csv").write_text(
        "VARIABLE,CLAVES,VALORES,TIPO,CLASE\nENTIDAD,[],[],str,a\nSEXO,[],[],string,b\nEDAD,[],[],float,a\nFECHA,[],[],str,c\n"
    )
    spec.update(columna_metadatos_tipos="TIPO", columna_metadatos_filtro_excluir="CLASE", valores_a_excluir=["b", "c"])
    spec["variables_a_agrupar"] = spec["variables_a_agrupar"][1:]
    prepared = run_preparation(spark, spec, write=False)
    assert prepared.wide.columns == ["ENTIDAD", "conteo::total_datos", "media::EDAD", "mediana::EDAD"]
    assert prepared.wide.count() == 40


# Rules of the stratifier


def scale(spark, rows=60, **columns):
    frame = pd.DataFrame({"ent": [f"{i:03d}" for i in range(rows)], "mun": "1"})
    for name, values in columns.items():
        frame[name] = values
    return spark.createDataFrame(frame)


def make(spark, scales, codes, **options):
    names = local_table(spark, ["variable", "traduccion"], [(c, c.upper()) for c in codes])
    return Stratifier(scales, names, "traduccion", "variable", ["ent", "mun"], **options)


@pytest.fixture
def stratifier(spark):
    table = scale(spark, x=[float(i % 17) for i in range(60)], y=[float(i % 4) for i in range(60)], t=["a"] * 60)
    small = scale(spark, 3, y=[1.0, 2.0, 3.0], z=[1.0, 2.0, 2.0])
    return make(spark, {"mun": table, "ent": small}, ["x", "y", "z", "t", "w"], excluded=["w"], excluded_regex=["^q"])


def test_exclusions(stratifier):
    assert stratifier.missing_in_dictionary == ["ent", "mun"]
    assert stratifier.excluded == ["ent", "mun", "w"]


def test_unit_names_join_all_ids(stratifier):
    rows = stratifier.process_variable(["ent"], "y", q=3).orderBy("bin").collect()
    assert [r["cells_ent"] for r in rows] == ["{0001}", "{0011}", "{0021}"]


def test_scales_without_the_variable_are_null(stratifier):
    rows = stratifier.process_variable(["mun", "ent"], "x", q=2).collect()
    assert {r["bin"] for r in rows} == {1, 2}
    assert all(r["interval_ent"] is None and r["cells_ent"] is None for r in rows)


def test_base_in_another_scale_only_gives_nothing(stratifier):
    rows = stratifier.process_variable(["mun", "ent"], "x", "z", q=2)
    assert rows.collect() == []
    assert rows.columns == ["name", "code", "bin", "part", "interval_mun", "cells_mun", "interval_ent", "cells_ent"]


def test_all_excluded_gives_an_empty_table(stratifier):
    for result in (stratifier.process_list(["mun"], {None: ["w"], "w": ["x"]}), stratifier.process_regex(["mun"], {None: "^w"})):
        assert result.collect() == []
        assert result.columns == ["request", "base", "name", "code", "bin", "part", "interval_mun", "cells_mun"]


def test_wrong_requests(stratifier):
    with pytest.raises(ValueError):
        stratifier.process_variable(["otra"], "x")
    with pytest.raises(TypeError):
        stratifier.process_variable("mun", "x")
    with pytest.raises(ValueError):
        stratifier.process_variable(["mun"], "w")
    with pytest.raises(ValueError):
        stratifier.process_variable(["mun"], "x", "w")
    with pytest.raises(ValueError):
        stratifier.process_variable(["mun"], "z")
    with pytest.raises(TypeError):
        stratifier.process_variable(["mun"], "t")
    with pytest.raises(ValueError):
        stratifier.process_variable(["mun"], "x", q=0)
    with pytest.raises(TypeError):
        stratifier.process_variable(["mun"], "x", q=2.0)
    with pytest.raises(ValueError):
        stratifier.process_list(["mun"], {})
    with pytest.raises(TypeError):
        stratifier.process_list(["mun"], {None: "x"})
    with pytest.raises(TypeError):
        stratifier.process_list(["mun"], {1: ["x"]})
    with pytest.raises(ValueError):
        stratifier.process_regex(["mun"], {None: "("})
    with pytest.raises(ValueError):
        stratifier.normalize("ent", "x")
    with pytest.raises(ValueError):
        stratifier.categorize("mun", "x", q=0)


def test_wrong_construction(spark):
    table = scale(spark, 3, x=[1.0, 2.0, 3.0])
    names = local_table(spark, ["variable", "traduccion"], [("x", "X")])
    for arguments, error in [
        (([], names, "traduccion", "variable", ["ent"]), TypeError),
        (({"m": "t"}, names, "traduccion", "variable", ["ent"]), TypeError),
        (({"m": table}, names, "nada", "variable", ["ent"]), ValueError),
        (({"m": table}, names, "traduccion", "variable", ["nada"]), ValueError),
        (({"m": table}, names, "traduccion", "variable", "ent"), TypeError),
        (({"m": table}, names, "traduccion", "variable", ["ent"], "x"), TypeError),
        (({"m": table}, names, "traduccion", "variable", ["ent"], [], ["("]), ValueError),
    ]:
        with pytest.raises(error):
            Stratifier(*arguments)


def test_infinite_values_fail(spark):
    stratifier = make(spark, {"m": scale(spark, 3, x=[1.0, 2.0, float("inf")])}, ["x"])
    with pytest.raises(Exception, match="infinite"):
        stratifier.process_variable(["m"], "x").collect()


def test_names_that_differ_in_case(spark):
    table = spark.createDataFrame([("1", "1", 1.0, 5.0), ("2", "1", 2.0, 6.0)], "ent string, mun string, `v-a` double, `v-A` double")
    stratifier = make(spark, {"m": table}, ["v-a", "v-A"])
    rows = stratifier.process_regex(["m"], {None: "^v"}, 2).collect()
    assert {(r["code"], r["bin"]): r["interval_m"] for r in rows} == {
        ("v-a", 1): "0.999:1.5", ("v-a", 2): "1.5:2.0", ("v-A", 1): "4.999:5.5", ("v-A", 2): "5.5:6.0",
    }


def test_large_scale_path_gives_the_same_rows(spark, stratifier, monkeypatch):
    """Many slices of units, whose texts are strung together, against one slice."""
    chosen = {None: ["x", "y"], "y": ["x"]}
    small = sorted(stratifier.process_list(["mun", "ent"], chosen, 5).collect(), key=lambda r: (r["request"], r["bin"]))
    monkeypatch.setattr(order_stats, "SMALL_GROUP", 0)
    monkeypatch.setattr(order_stats, "LARGE_GROUP", 7)
    large = sorted(stratifier.process_list(["mun", "ent"], chosen, 5).collect(), key=lambda r: (r["request"], r["bin"]))
    assert small == large


@pytest.mark.parametrize("slices", [1, 5])
def test_parts_of_bins(stratifier, monkeypatch, slices):
    """Units of a bin over several rows, ranked across slices, equal the one row cut by hand."""
    requests = [Request(None, "x"), Request("y", "x")]
    whole = stratifier.cut(["mun", "ent"], requests, 5).collect()
    if slices > 1:
        monkeypatch.setattr(order_stats, "SMALL_GROUP", 0)
        monkeypatch.setattr(cells, "UNITS_PER_SLICE", 12)
    found = {}
    for r in stratifier.cut(["mun", "ent"], requests, 5, units_per_part=7).collect():
        for level in ("mun", "ent"):
            if r[f"interval_{level}"] is not None:
                found[r["request"], r["bin"], level, r["part"]] = (r[f"interval_{level}"], r[f"cells_{level}"])
    expected = {}
    for r in whole:
        assert r["part"] == 0
        for level in ("mun", "ent"):
            if r[f"interval_{level}"] is None:
                continue
            units = r[f"cells_{level}"].strip("{}").split(",")
            for part in range(0, len(units), 7):
                text = "{" + ",".join(units[part : part + 7]) + "}"
                expected[r["request"], r["bin"], level, part // 7] = (r[f"interval_{level}"], text)
    assert found == expected
    assert max(part for *_, part in found) > 0
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    salted = stratifier.cut(["mun", "ent"], requests, 5, units_per_part=7)
    rows = stratifier.cut(["mun", "ent"], requests, 5, units_per_part=7).collect()
    assert sorted(map(str, salted.collect())) == sorted(map(str, rows))
    for wrong in (0, -1):
        with pytest.raises(ValueError):
            stratifier.cut(["mun"], requests, 5, units_per_part=wrong)
    with pytest.raises(TypeError):
        stratifier.cut(["mun"], requests, 5, units_per_part=2.5)


def test_bin_counts(stratifier):
    requests = [Request(None, "x"), Request("y", "x")]
    listed = {}
    for r in stratifier.cut(["mun", "ent"], requests, 5).collect():
        for level in ("mun", "ent"):
            if r[f"interval_{level}"] is not None:
                units = r[f"cells_{level}"].strip("{}")
                listed[r["request"], level, r["bin"]] = (r[f"interval_{level}"], len(units.split(",")) if units else 0)
    counted = stratifier.bin_counts(["mun", "ent"], requests, 5).collect()
    assert {(r["request"], r["scale"], r["bin"]): (r["interval"], r["units"]) for r in counted} == listed


def test_members_without_broadcast(stratifier, monkeypatch):
    """Beyond the broadcast, no join gathers all units of a request under one key, and the rows are the same."""
    requests = [Request(None, "x"), Request("y", "x")]
    usual = stratifier.members(["mun"], requests, 5)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    salted = stratifier.members(["mun"], requests, 5)
    assert sorted(map(str, usual.collect())) == sorted(map(str, salted.collect()))
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.split("\n") if "Join LeftOuter" in line]
    assert lines and all("_salt" in line for line in lines)


def test_members_agree_with_cells(stratifier):
    requests = [Request(None, "x"), Request("y", "x")]
    members = stratifier.members(["mun"], requests, 5)
    counted = members.groupBy("base", "bin", "interval").agg(F.count("*").alias("n")).collect()
    cells = stratifier.cut(["mun"], requests, 5).collect()
    listed = {(r["base"], r["bin"], r["interval_mun"]): len(r["cells_mun"].strip("{}").split(",")) for r in cells if r["cells_mun"] != "{}"}
    assert {(r["base"], r["bin"], r["interval"]): r["n"] for r in counted} == listed
