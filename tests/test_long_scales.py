"""Stratification of long scales: equal to the wide form, for more codes than a table could have columns."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mapstrata import run_stratification
from mapstrata.operators import aggregate, joins
from mapstrata.plans.long_scale import LongScale
from mapstrata.plans.strata import Request, Stratifier

TOTAL = "conteo::total_datos"


def scale_frame(n=60, seed=1):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"geo": [f"{i:03d}" for i in range(n)], TOTAL: rng.integers(1, 50, n)})
    frame["sexo-1"] = rng.integers(0, 3, n)
    frame["sexo-2"] = rng.integers(0, 40, n)
    frame["suma::gasto"] = rng.normal(size=n).round(3)
    frame["mediana::edad"] = np.where(rng.random(n) < 0.2, np.nan, rng.integers(1, 90, n))
    frame["raro-9"] = np.where(np.arange(n) == 7, 5, 0)
    return frame


def tables(spark, frame):
    nullable = frame.astype(object).where(frame.notna(), None)
    wide = spark.createDataFrame(nullable.values.tolist(), "geo string, " + ", ".join(f"`{c}` {'long' if frame[c].dtype.kind == 'i' else 'double'}" for c in frame.columns[1:]))
    long = aggregate.lengthened(wide, ["geo"], list(frame.columns[1:]))
    return wide, long.where(F.col("code").rlike("::gasto|::edad") | (F.col("value") != 0)).repartition(5)


def dictionary(spark, codes):
    return spark.createDataFrame([(c, f"name of {c}") for c in codes], "code string, label string")


def stratifier(spark, scales, codes, **options):
    return Stratifier(scales, dictionary(spark, codes), "label", "code", ["geo"], **options)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


CHOSEN = {None: ["sexo-1", "suma::gasto", "mediana::edad", "raro-9"], TOTAL: ["sexo-1", "sexo-2"], "sexo-1": ["sexo-2", "sexo-1"]}


@pytest.mark.parametrize("broadcast", [True, False])
def test_equal_to_wide(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(joins, "SALTS", 3)
    frame = scale_frame()
    wide, long = tables(spark, frame)
    codes = list(frame.columns[1:])
    one, other = (stratifier(spark, {"g": s}, codes, excluded=["raro-9"]) for s in (wide, LongScale(long)))
    assert one.excluded == other.excluded
    assert rows(one.process_list(["g"], CHOSEN, 4, 7)) == rows(other.process_list(["g"], CHOSEN, 4, 7))
    assert rows(one.process_regex(["g"], {TOTAL: "^sexo", None: "::"}, 3)) == rows(other.process_regex(["g"], {TOTAL: "^sexo", None: "::"}, 3))
    requests = one.requests_from_lists(["g"], CHOSEN)
    assert rows(one.members(["g"], requests, 5)) == rows(other.members(["g"], requests, 5))
    assert rows(one.bin_counts(["g"], requests, 5)) == rows(other.bin_counts(["g"], requests, 5))
    for base in (None, TOTAL, "sexo-1"):
        assert rows(one.normalize("g", "sexo-2", base)) == rows(other.normalize("g", "sexo-2", base))
        assert rows(one.categorize("g", "sexo-2", base, 4)) == rows(other.categorize("g", "sexo-2", base, 4))


def test_scales_of_both_forms(spark):
    frame, small = scale_frame(), scale_frame(9, 2).drop(columns=["raro-9"])
    (wide, long), (small_wide, small_long) = tables(spark, frame), tables(spark, small)
    codes = list(frame.columns[1:])
    expected = stratifier(spark, {"a": wide, "b": small_wide}, codes).process_list(["a", "b"], CHOSEN, 4)
    for scales in ({"a": LongScale(long), "b": small_wide}, {"a": wide, "b": LongScale(small_long)}, {"a": LongScale(long), "b": LongScale(small_long)}):
        assert rows(stratifier(spark, scales, codes).process_list(["a", "b"], CHOSEN, 4)) == rows(expected)


def test_checks(spark):
    frame = scale_frame()
    _, long = tables(spark, frame)
    strata = stratifier(spark, {"g": LongScale(long)}, list(frame.columns[1:]))
    with pytest.raises(ValueError, match="none of the scales"):
        strata.cut(["g"], [Request(None, "sexo-3")], 3)
    with pytest.raises(ValueError, match="has no variable"):
        strata.categorize("g", "sexo-3")
    with pytest.raises(ValueError, match="no id column"):
        stratifier(spark, {"g": LongScale(long.withColumnRenamed("geo", "lugar"))}, [])
    with pytest.raises(ValueError, match="needs the column"):
        LongScale(long.drop("code"))
    doubled = stratifier(spark, {"g": LongScale(long.union(long))}, list(frame.columns[1:]))
    with pytest.raises(Exception, match="two values of one code"):
        doubled.process_variable(["g"], "sexo-1").collect()


def test_more_codes_than_columns(spark):
    """25,000 codes over 12 units, each unit having a third of them; a plan's size does not depend on them."""
    n_codes, n_units = 25_000, 12
    base = spark.range(n_codes).select(F.format_string("v-%05d", "id").alias("code"), F.explode(F.sequence(F.lit(0), F.lit(n_units - 1))).alias("u"))
    value = F.pmod(F.xxhash64("code", "u"), F.lit(97)).cast("double")
    long = base.select(F.format_string("%02d", "u").alias("geo"), "code", value.alias("value")).where(F.pmod(F.xxhash64("u", "code"), F.lit(3)) == 0)
    total = spark.range(n_units).select(F.format_string("%02d", "id").alias("geo"), F.lit(TOTAL).alias("code"), F.lit(100.0).alias("value"))
    names = spark.range(n_codes).select(F.format_string("v-%05d", "id").alias("code"), F.format_string("name %d", "id").alias("label"))
    strata = Stratifier({"g": LongScale(long.union(total))}, names.union(spark.createDataFrame([(TOTAL, TOTAL)], names.schema)), "label", "code", ["geo"])
    requests = strata.requests_from_regex(["g"], {TOTAL: "^v-"})
    assert len(requests) > 20_000
    counted = strata.bin_counts(["g"], requests, 3)
    assert len(counted._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    per_code = counted.groupBy("code").agg(F.sum("units").alias("n")).collect()
    assert len(per_code) == len(requests) and {r.n for r in per_code} == {n_units}
    chosen = [requests[0], requests[-1]]
    wide = long.where(F.col("code").isin([r.code for r in chosen])).union(total).groupBy("geo").pivot("code").agg(F.first("value")).na.fill(0.0)
    one = Stratifier({"g": wide}, names.union(spark.createDataFrame([(TOTAL, TOTAL)], names.schema)), "label", "code", ["geo"])
    picked = strata.members(["g"], requests, 3).where(F.col("code").isin([r.code for r in chosen]))
    assert rows(picked) == rows(one.members(["g"], chosen, 3))


def test_from_files(spark, tmp_path):
    frame = scale_frame()
    wide, long = tables(spark, frame)
    spec = {
        "ruta_csv_diccionario_traducciones": str(tmp_path / "names"),
        "columna_diccionario_traducciones_nombres": "label",
        "columna_diccionario_traducciones_alias": "code",
        "variables_identificadoras": ["geo"],
        "variables_a_procesar_list": {TOTAL: ["sexo-1", "sexo-2"], "None": ["mediana::edad", "suma::gasto"]},
        "q": 4,
    }
    dictionary(spark, frame.columns[1:]).write.csv(spec["ruta_csv_diccionario_traducciones"], header=True)
    wide.write.csv(f"{tmp_path}/wide", header=True)
    long.write.csv(f"{tmp_path}/long", header=True)
    long.write.parquet(f"{tmp_path}/long.parquet")
    expected = run_stratification(spark, {**spec, "rutas_csv_escalas": {"g": f"{tmp_path}/wide"}, "ruta_csv_salida": f"{tmp_path}/a"})
    for path in ("long", "long.parquet"):
        asked = {**spec, "rutas_csv_escalas": {"g": f"{tmp_path}/{path}"}, "ruta_csv_salida": f"{tmp_path}/b", "forma_larga": True}
        (tmp_path / "spec.json").write_text(json.dumps(asked))
        assert rows(run_stratification(spark, str(tmp_path / "spec.json"))) == rows(expected)
    spark.createDataFrame([("001", "sexo-1", "many")], "geo string, code string, value string").write.csv(f"{tmp_path}/bad", header=True)
    with pytest.raises(Exception, match="is no number"):
        run_stratification(spark, {**spec, "rutas_csv_escalas": {"g": f"{tmp_path}/bad"}, "ruta_csv_salida": f"{tmp_path}/c", "forma_larga": True, "variables_a_procesar_list": {"None": ["sexo-1"]}})
