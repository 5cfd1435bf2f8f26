"""Aggregation per unit against an independent computation in pandas."""

import pandas as pd
import pytest

from mapstrata.operators import aggregate
from mapstrata.operators.aggregate import TOTAL_CODE
from mapstrata.plans.prepare import Block, Preparation, aggregate_blocks, aggregate_blocks_long

ROWS = [
    # ent, mun, sexo, asma, edad, nota
    ("01", "001", "1", "a", "10", "1"),
    ("01", "001", "2", "A", "21", "x"),
    ("01", "001", "1 ", "a", None, "2"),
    (" 01", "001\t", "1", None, "30.5", "3"),
    ("01", "002", None, None, "7", "4"),
    ("02", "001", "2", "a", None, "5"),
    ("02", "001", "  ", "A", None, "6"),
    (None, "001", "1", "a", "5", "7"),
    ("02", "  ", "1", "a", "5", "8"),
    ("09", "003", "2", "1", "-4", "9"),
]
NAMES = ["ent", "mun", "sexo", "asma", "edad", "nota"]
IDS = ["ent", "mun"]


@pytest.fixture
def preparation(spark):
    df = spark.createDataFrame(ROWS, ", ".join(f"{n} string" for n in NAMES))
    metadata = spark.createDataFrame([("sexo", "['1']")], "var string, valores string")
    return Preparation(df, metadata, "var", "valores").blanks_to_null()


@pytest.fixture
def frame():
    frame = pd.DataFrame(ROWS, columns=NAMES)
    for name in NAMES:
        frame[name] = frame[name].map(lambda v: v.strip() or None if isinstance(v, str) else None)
    return frame


def rows(df):
    return {tuple(r[i] for i in IDS): {c: r[k] for k, c in enumerate(df.columns) if c not in IDS} for r in df.collect()}


def test_totals_drop_missing_ids(preparation, frame):
    expected = frame.groupby(IDS).size().to_dict()
    assert {k: v[TOTAL_CODE] for k, v in rows(preparation.group_totals(IDS)).items()} == expected


def test_categories_keep_case_and_drop_silent_units(preparation, frame):
    """Values that differ only in case are different columns; a unit without any value is gone."""
    melted = frame.melt(IDS, ["asma", "sexo"], "variable", "value").dropna()
    counts = melted.groupby([*IDS, "variable", "value"]).size()
    wide = preparation.group_categorical(IDS, ["sexo", "asma", "ent"])
    codes = [f"{v}-{x}" for v, x in sorted({(v, x) for *_, v, x in counts.index})]
    assert wide.columns == [*IDS, *codes]
    found = rows(wide)
    assert set(found) == {key[:2] for key in counts.index}
    for (ent, mun), values in found.items():
        for code, n in values.items():
            variable, value = code.split("-", 1)
            assert n == counts.get((ent, mun, variable, value), 0)
    assert ("01", "002") not in found


@pytest.mark.parametrize("operation", ["suma", "media", "mediana"])
def test_numbers(preparation, frame, operation):
    grouped = frame.assign(edad=frame.edad.astype(float)).dropna(subset=IDS).groupby(IDS).edad
    expected = {"suma": grouped.sum(), "media": grouped.mean(), "mediana": grouped.median()}[operation].to_dict()
    wide = preparation.group_numeric(IDS, ["edad", "nota", "mun"], operation)
    assert wide.columns == [*IDS, f"{operation}::edad"]
    found = {k: v[f"{operation}::edad"] for k, v in rows(wide).items()}
    assert set(found) == set(expected)
    for key, value in found.items():
        assert value == expected[key] if value is not None else pd.isna(expected[key])


def test_only_units_remain_when_nothing_is_numeric(preparation):
    wide = preparation.group_numeric(IDS, ["nota"], "media")
    assert wide.columns == IDS
    assert set(rows(wide)) == {("01", "001"), ("01", "002"), ("02", "001"), ("09", "003")}


def test_unknown_operation(preparation):
    with pytest.raises(ValueError):
        preparation.group_numeric(IDS, ["edad"], "moda")


def test_blocks_join_and_report_skipped(preparation):
    blocks = [
        Block(["sexo", "asma"], None),
        Block(["edad", "nota"], "media"),
        Block(["edad"], "mediana"),
        Block(["edad"], "suma"),
    ]
    wide, skipped = aggregate_blocks(preparation, IDS, blocks)
    assert skipped == ["nota"]
    assert wide.columns == [
        *IDS, TOTAL_CODE, "asma-1", "asma-A", "asma-a", "sexo-1", "sexo-2", "media::edad", "mediana::edad", "suma::edad",
    ]
    found = rows(wide)
    assert set(found) == {("01", "001"), ("02", "001"), ("09", "003")}
    assert found[("01", "001")] == {
        TOTAL_CODE: 4, "asma-1": 0, "asma-A": 1, "asma-a": 2, "sexo-1": 3, "sexo-2": 1,
        "media::edad": 20.5, "mediana::edad": 21.0, "suma::edad": 61.5,
    }
    assert found[("02", "001")]["mediana::edad"] is None
    assert found[("02", "001")]["suma::edad"] == 0.0


def test_same_operation_twice_is_an_error(preparation):
    with pytest.raises(ValueError):
        aggregate_blocks(preparation, IDS, [Block(["edad"], "media"), Block(["edad"], "media")])


def test_typed_columns_pass_the_gate_by_type(spark):
    df = spark.createDataFrame([("1", 1.5, True), ("1", float("nan"), False)], "u string, x double, flag boolean")
    wide = aggregate.numeric_wide(df, ["u"], ["x", "flag"], "media")
    assert [tuple(r) for r in wide.collect()] == [("1", 1.5, 0.5)]


def test_codes_that_collide_are_refused(spark):
    df = spark.createDataFrame([("u", "b-c", "c")], "id string, `a` string, `a-b` string")
    with pytest.raises(ValueError):
        aggregate.categorical_wide(df, ["id"], ["a", "a-b"])


def test_long_blocks_equal_wide_ones(preparation):
    blocks = [Block(["sexo"], None), Block(["edad", "nota"], "suma"), Block(["asma"], None)]
    wide, skipped = aggregate_blocks(preparation, IDS, blocks)
    long, also_skipped = aggregate_blocks_long(preparation, IDS, blocks)
    assert skipped == also_skipped == ["nota"]
    expected = {
        (*unit, code): float(value)
        for unit, values in rows(wide).items()
        for code, value in values.items()
        if value is not None and (value or "::" in code)
    }
    assert {(r["ent"], r["mun"], r["code"]): r["value"] for r in long.collect()} == expected


def test_more_values_than_columns(spark):
    """25,000 observed values in long form."""
    df = spark.range(50_000).selectExpr("cast(id % 3 AS string) AS ent", "cast(id % 25000 AS string) AS v", "cast(id AS string) AS x")
    metadata = spark.createDataFrame([("v", "[]")], "var string, valores string")
    long, _ = aggregate_blocks_long(Preparation(df, metadata, "var", "valores"), ["ent"], [Block(["v"], None), Block(["x"], "suma")])
    frame = df.toPandas()
    counts = frame.groupby(["ent", "v"]).size()
    expected = {(e, f"v-{v}"): float(n) for (e, v), n in counts.items()}
    expected |= {(e, "conteo::total_datos"): float(n) for e, n in frame.groupby("ent").size().items()}
    expected |= {(e, "suma::x"): float(n) for e, n in frame.astype({"x": int}).groupby("ent").x.sum().items()}
    assert {(r["ent"], r["code"]): r["value"] for r in long.collect()} == expected


def test_integer_sums_are_exact(spark):
    df = spark.createDataFrame(
        [("1", "9007199254740993", 2, "1.5"), ("1", "2", 2**62, None), ("2", None, None, "2")], "u string, a string, b bigint, c string"
    )
    found = {r["u"]: r for r in aggregate.numeric_wide(df, ["u"], ["a", "b", "c"], "suma").collect()}
    assert (found["1"]["suma::a"], found["1"]["suma::b"], found["1"]["suma::c"]) == (9007199254740995, 2**62 + 2, 1.5)
    assert (found["2"]["suma::a"], found["2"]["suma::b"], found["2"]["suma::c"]) == (0, 0, 2.0)
    assert isinstance(found["1"]["suma::a"], int) and isinstance(found["1"]["suma::c"], float)
