"""What runs leave behind, and how many jobs they take."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mapstrata.operators import gate
from mapstrata.plans import prepare
from mapstrata.plans.prepare import run_preparation
from mapstrata.plans.strata import run_stratification
from mapstrata.session import checkpoint_folder
from mapstrata.sinks import versions
from mapstrata.sources import read_scale, read_translations


def copies(spark):
    folder = checkpoint_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith(("microdata-", "scale-"))}


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        found = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def specification(folder, n_numeric):
    rng = np.random.default_rng(0)
    n = 500
    frame = pd.DataFrame({"geo": rng.integers(10, 30, n).astype(str), "sexo": rng.choice(["1", "2", "a\nb"], n)})
    for i in range(n_numeric):
        frame[f"x{i}"] = rng.integers(0, 9, n).astype(str) if i % 3 else rng.normal(size=n).round(3).astype(str)
    frame["mal"] = np.where(np.arange(n) == 77, "z", "1")
    frame.to_csv(f"{folder}/datos.csv", index=False)
    (folder / "meta.csv").write_text('var,val,ali\n' + "\n".join(f'{c},"[]","[]"' for c in frame.columns) + "\n")
    numeric = [f"x{i}" for i in range(n_numeric)] + ["mal"]
    block = {"variables_a_agrupar_list": [], "variables_a_agrupar_regex": []}
    return frame, {
        "ruta_csv_dataset": f"{folder}/datos.csv",
        "ruta_csv_metadatos": f"{folder}/meta.csv",
        "ruta_salida_dataset": f"{folder}/wide",
        "ruta_salida_diccionario_traducciones": f"{folder}/dic",
        "columna_metadatos_nombres": "var",
        "columna_metadatos_posibles_valores": "val",
        "columna_metadatos_posibles_valores_alias": "ali",
        "variables_identificadoras_list": ["geo"],
        "variables_a_agrupar": [
            {**block, "tipo_variables": "categorico", "variables_a_agrupar_list": ["sexo"]},
            {**block, "tipo_variables": "numerico", "operacion": "suma", "variables_a_agrupar_list": numeric},
        ],
    }


def test_jobs_do_not_grow_and_nothing_stays(spark, tmp_path):
    before, counts = copies(spark), []
    for n_numeric in (3, 90):
        folder = tmp_path / str(n_numeric)
        folder.mkdir()
        frame, spec = specification(folder, n_numeric)
        prepared, jobs = jobs_of(spark, f"preparation-{n_numeric}", lambda s=spec: run_preparation(spark, s))
        counts.append(jobs)
        assert prepared.skipped == ["mal"]
        found = {r.geo: r for r in prepared.wide.collect()}
        expected = frame.groupby("geo")
        for geo, rows in expected:
            assert found[geo]["conteo::total_datos"] == len(rows)
            assert found[geo]["suma::x1"] == rows.x1.astype(int).sum() and isinstance(found[geo]["suma::x1"], int)
            assert found[geo]["suma::x0"] == pytest.approx(rows.x0.astype(float).sum())
        names = spark.createDataFrame([(c, c) for c in prepared.wide.columns], "variable string, nombre string")
        names.coalesce(1).write.csv(f"{folder}/names", header=True)
        bins, _ = jobs_of(
            spark,
            f"bins-{n_numeric}",
            lambda f=folder: run_stratification(
                spark,
                {
                    "rutas_csv_escalas": {"g": f"{f}/wide"},
                    "ruta_csv_diccionario_traducciones": f"{f}/names",
                    "columna_diccionario_traducciones_nombres": "nombre",
                    "columna_diccionario_traducciones_alias": "variable",
                    "variables_identificadoras": ["geo"],
                    "variables_a_procesar_regex": {"None": "^suma"},
                    "q": 4,
                    "ruta_csv_salida": f"{f}/bins",
                },
            ),
        )
        assert bins.select("code").distinct().count() == n_numeric
    assert counts[0] == counts[1]
    assert copies(spark) == before


def test_copy_goes_when_a_run_fails(spark, tmp_path):
    _, spec = specification(tmp_path, 3)
    spec["variables_a_agrupar"] += [{**spec["variables_a_agrupar"][1]}]  # the same operation twice
    before = copies(spark)
    with pytest.raises(ValueError, match="asked for twice"):
        run_preparation(spark, spec)
    assert copies(spark) == before


@pytest.mark.parametrize("n", [1, 62, 63, 130])
def test_watched_gate_is_the_gate(spark, tmp_path, n):
    names = [f"v{i}" for i in range(n)]
    rows = [tuple(None if (i + j) % 5 == 0 else "x" if i % 7 == 3 and j == 2 else "1.5" if i % 4 == 1 else str(j) for i in range(n)) for j in range(9)]
    df = spark.createDataFrame([(*r, 1, 2.5) for r in rows], ", ".join(f"{v} string" for v in names) + ", k int, d double")
    variables = [*names, "k", "d"]
    observed, outcome = gate.watched(df, variables)
    observed.write.parquet(f"{tmp_path}/t")
    assert outcome() == gate.passed_gate(df, variables)
    observed, outcome = gate.watched(df.where(F.col("k") > 5), variables)
    observed.write.parquet(f"{tmp_path}/u")
    assert outcome().rows == 0 and outcome().passed == variables


def test_both_outputs_of_one_run(spark, tmp_path, monkeypatch):
    """A run that ends between its outputs leaves the pair before it; the next one replaces both; a stratification finds them."""
    frame, spec = specification(tmp_path, 3)
    folder = f"{tmp_path}/salida"
    spec |= {"carpeta_salida": folder, "ruta_salida_dataset": "amplia", "ruta_salida_diccionario_traducciones": "diccionario.parquet"}

    def pair():
        wide = read_scale(spark, f"{folder}#amplia", ["geo"])
        names = read_translations(spark, f"{folder}#diccionario.parquet", "traduccion", "variable")
        return sorted(map(tuple, wide.collect())), sorted(map(tuple, names.collect()))

    with pytest.raises(FileNotFoundError, match="no published output"):
        pair()
    run_preparation(spark, spec)
    first = pair()
    assert len(first[0]) == frame.geo.nunique() and first[1]

    frame.iloc[:300].to_csv(spec["ruta_csv_dataset"], index=False)
    with monkeypatch.context() as broken:
        broken.setattr(prepare, "write_dictionary", lambda *_: (_ for _ in ()).throw(RuntimeError("ended")))
        with pytest.raises(RuntimeError, match="ended"):
            run_preparation(spark, spec)
    assert pair() == first
    run_preparation(spark, spec)
    second = pair()
    assert second != first and second[1] == first[1]
    assert len(versions.remove_old_versions(folder)) == 2
    assert pair() == second
    bins = run_stratification(
        spark,
        {
            "rutas_csv_escalas": {"g": f"{folder}#amplia"},
            "ruta_csv_diccionario_traducciones": f"{folder}#diccionario.parquet",
            "columna_diccionario_traducciones_nombres": "traduccion",
            "columna_diccionario_traducciones_alias": "variable",
            "variables_identificadoras": ["geo"],
            "variables_a_procesar_list": {"None": ["conteo::total_datos"]},
            "q": 3,
            "ruta_csv_salida": f"{tmp_path}/bins",
        },
    )
    assert bins.where("part = 0").count() == 3
