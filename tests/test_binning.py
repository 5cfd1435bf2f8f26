"""Quantile bins against pandas on columns of many shapes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mapstrata.operators import order_stats
from mapstrata.operators.binning import bin_grid, quantile_edges
from mapstrata.operators.order_stats import medians, order_statistics
from mapstrata.plans.strata import Request, Stratifier


def random_columns(seed, rows):
    rng = np.random.default_rng(seed)
    columns = {}
    for i in range(4):
        columns[f"ints{i}"] = rng.integers(0, 3 + 10 * i, rows).astype(float)
        columns[f"uniform{i}"] = rng.uniform(-5, 5, rows)
        columns[f"skewed{i}"] = np.round(rng.lognormal(0, 2 + i, rows), i)
        columns[f"zeros{i}"] = np.where(rng.uniform(size=rows) < 0.5 + i / 10, 0.0, rng.normal(size=rows))
        columns[f"tiny{i}"] = rng.uniform(0, 10.0 ** (-3 - i), rows)
        columns[f"large{i}"] = rng.uniform(0, 10.0 ** (7 + i), rows)
        columns[f"negative{i}"] = -rng.exponential(10.0**i, rows)
        holes = rng.normal(100, 0.01, rows)
        holes[rng.uniform(size=rows) < 0.2 * (i + 1)] = np.nan
        columns[f"holes{i}"] = holes
    columns["constant"] = np.full(rows, 7.0)
    columns["nothing"] = np.full(rows, np.nan)
    return pd.DataFrame(columns)


def expected_bins(series, q, as_percent):
    """Bin number per row and label per bin, as the cut of pandas gives them."""
    cut = pd.qcut(series, q, duplicates="drop")
    intervals = list(cut.cat.categories)
    numbers = [len(intervals) + 1 if code == -1 else code + 1 for code in cut.cat.codes]
    if as_percent:
        labels = [f"{(i.left * 100).round(1)}%:{(i.right * 100).round(1)}%" for i in intervals]
    else:
        labels = [f"{i.left}:{i.right}" for i in intervals]
    if cut.isna().any():
        labels.append("Sin clasificar")
    return numbers, labels


@pytest.mark.parametrize(("seed", "rows", "q", "small"), [(1, 97, 10, 0), (2, 23, 4, 1000), (3, 300, 7, 1000)])
def test_bins_equal_pandas(spark, monkeypatch, seed, rows, q, small):
    """Once with every group treated as large, otherwise as small ones."""
    monkeypatch.setattr(order_stats, "SMALL_GROUP", small)
    monkeypatch.setattr(order_stats, "LARGE_GROUP", max(small, 10))
    frame = random_columns(seed, rows)
    codes = list(frame.columns)
    frame.insert(0, "id", [f"{i:04d}" for i in range(rows)])
    frame["base"] = 1.0
    frame = frame.astype(object).where(frame.notna(), None)
    schema = "id string, " + ", ".join(f"{c} double" for c in [*codes, "base"])
    table = spark.createDataFrame(list(frame.itertuples(index=False, name=None)), schema)
    names = spark.createDataFrame([(c, c.upper()) for c in [*codes, "base"]], "variable string, traduccion string")
    stratifier = Stratifier({"mun": table}, names, "traduccion", "variable", ["id"])
    requests = [Request(base, c) for base in (None, "base") for c in codes]
    rows_found = stratifier.cut(["mun"], requests, q).collect()
    found = {(r["base"], r["code"], r["bin"]): (r["interval_mun"], r["cells_mun"]) for r in rows_found}
    expected = {}
    for request in requests:
        numbers, labels = expected_bins(frame[request.code].astype(float), q, request.base is not None)
        for number, label in enumerate(labels, 1):
            units = [u for u, n in zip(frame["id"], numbers) if n == number]
            expected[(request.base, request.code, number)] = (label, "{" + ",".join(units) + "}")
    assert found == expected


def test_edges_bit_equal_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {f"g{i}": rng.normal(size=rng.integers(1, 60)) * 10.0 ** rng.integers(-3, 6) for i in range(60)}
    rows = [(g, float(x)) for g, values in groups.items() for x in values]
    edges = quantile_edges(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", 10)
    found = {r["g"]: r["edges"] for r in edges.collect()}
    for g, values in groups.items():
        assert found[g] == sorted(set(pd.Series(values).quantile(np.linspace(0, 1, 11))))


@pytest.mark.parametrize(("broadcast", "slices"), [(100, 1024), (0, 1024), (100, 4), (0, 7)])
def test_one_group_larger_than_all_slices(spark, monkeypatch, broadcast, slices):
    """One key holds most rows, one value a third of them; both are cut in slices, with few slices a round several
    times, and ranked exactly."""
    monkeypatch.setattr(order_stats, "MOST_SLICES", slices)
    monkeypatch.setattr(order_stats, "LARGE_GROUP", 300)
    monkeypatch.setattr(order_stats, "BROADCAST_GROUPS", broadcast)
    place = F.col("id")
    rows = spark.range(40_000).select(
        F.when(place % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), place % 97)).alias("g"),
        F.when(place % 3 == 0, 777.0).otherwise(((place * 7919) % 20011).cast("double")).alias("x"),
    )
    stats = order_statistics(rows, ["g"], "x", ["0", "_n div 3", "_n div 2", "_n - 1", "_n - 1"])
    middle = {r["g"]: r["_median"] for r in medians(rows, ["g"], "x").collect()}
    frame = rows.toPandas()
    found = stats.collect()
    assert len(found) == frame.g.nunique()
    for row in found:
        values = np.sort(frame[frame.g == row["g"]].x.to_numpy())
        n = len(values)
        assert row["_n"] == n
        assert row["_found"] == [values[p] for p in (0, n // 3, n // 2, n - 1, n - 1)]
    assert middle == frame.groupby("g").x.median().to_dict()


def test_slices_cover_a_group_evenly(spark, monkeypatch):
    """Only wanted slices are ranked: far fewer rows than the group has."""
    monkeypatch.setattr(order_stats, "LARGE_GROUP", 100)
    rows = spark.range(50_000).select(F.lit("hot").alias("g"), F.sqrt("id").alias("x"))
    start = F.lit(0).cast("bigint")
    large = rows.groupBy("g").agg(F.count("*").alias("_held"))
    large = large.select("g", start.alias("_slice"), "_held", F.col("_held").alias("_n"), start.alias("_base"))
    unknown = F.lit(None).cast("bigint")
    rows = rows.withColumn("_slice", start).withColumn("_skipped", unknown).withColumn("_size", unknown)
    kept = order_stats._wanted_slices(rows, large, 1, ["g"], F.col("x"), ["_n div 2"])
    assert 0 < kept.count() < 50_000 / 50
    assert kept.select("_slice").distinct().count() == 1


def test_rows_held_to_rank_a_group_stay_few(spark, monkeypatch):
    """However large a group is, the rows that are moved and sorted for seven bins do not grow with it."""
    kept, wanted = [], order_stats._wanted_slices

    def counted(*args):
        kept.append(wanted(*args))
        return kept[-1]

    monkeypatch.setattr(order_stats, "_wanted_slices", counted)
    for size in (1_500_000, 6_000_000):
        values = spark.range(size).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % size).cast("double").alias("x"))
        edges = quantile_edges(values, ["g"], "x", 7).first()["edges"]
        assert np.allclose(edges, np.linspace(0, size - 1, 8), rtol=1e-12)
    assert len(kept) == 2
    assert all(0 < rows.count() < 1_000_000 for rows in kept)


def test_grid_keeps_empty_intervals(spark):
    values = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("a", 0.0), ("a", 10.0)], "g string, x double")
    grid = bin_grid(quantile_edges(values, ["g"], "x", 10), ["g"], F.lit(False))
    assert grid.count() == 4


def test_nan_is_no_value(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", float("nan")), ("b", float("nan"))], "g string, x double")
    assert {r["g"]: r["_median"] for r in medians(rows, ["g"], "x").collect()} == {"a": 1.5}
    assert [r["edges"] for r in quantile_edges(rows, ["g"], "x", 2).collect()] == [[1.0, 1.5, 2.0]]
