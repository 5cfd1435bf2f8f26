"""Quantile bins: edges, membership, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.functions.numbers import float_text, percent, rounded_to_significant
from mapstrata.operators.order_stats import order_statistics
from mapstrata.session import column

# Label of the bin of missing values; decimals that edge labels start and stop with.
UNCLASSIFIED = "Sin clasificar"
LABEL_DECIMALS = 3
MOST_DECIMALS = 19


def check_bins(q: int) -> None:
    if isinstance(q, bool) or not isinstance(q, int):
        raise TypeError("the number of bins must be an int")
    if q < 1:
        raise ValueError("the number of bins must be at least 1")


def _quantile_levels(q: int) -> list[float]:
    """Evenly spaced levels from 0 to 1, with the rounding of a percent scale and back."""
    step = 1 / q
    return [(i * step) * 100 / 100 for i in range(q)] + [1.0]


def _positions(q: int) -> list[str]:
    """Positions below, then above the fractional rank ``level * (_n - 1)`` of every level."""
    below = [f"cast(floor({level!r}D * (_n - 1)) AS bigint)" for level in _quantile_levels(q)]
    return below + [f"least({position} + 1, _n - 1)" for position in below]


def _interpolated(q: int) -> Column:
    """Quantiles of all levels from the values on both sides of their ranks."""

    def quantile(level: Column, i: Column) -> Column:
        rank = level * (F.col("_n") - 1).cast("double")
        weight = rank - F.floor(rank)
        a, b = F.get("_found", i), F.get("_found", i + (q + 1))
        return F.when(weight < 0.5, a + (b - a) * weight).otherwise(b - (b - a) * (1 - weight))

    return F.transform(F.array(*[F.lit(level) for level in _quantile_levels(q)]), quantile)


def quantile_edges(
    values: DataFrame, keys: list[str], value: str, q: int, most_rows: int | None = None
) -> DataFrame:
    """keys and ``edges``: the distinct quantiles i/q in ascending order, linearly interpolated."""
    check_bins(q)
    present = values.select(*[column(k) for k in keys], column(value)).filter(column(value).isNotNull())
    stats = order_statistics(present, keys, value, _positions(q), most_rows)
    edges = F.array_sort(F.array_distinct(_interpolated(q)))
    return stats.select(*[column(k) for k in keys], edges.alias("edges"))


def interval_count(edges: Column) -> Column:
    return F.coalesce(F.size(edges), F.lit(1)) - 1


def bin_number(value: Column, edges: Column) -> Column:
    """Ordinal of the interval (left, right] around a value, the lowest value being in the first;
    one past the last interval where there is no value or no interval."""
    count = interval_count(edges)
    position = F.greatest(F.lit(1), F.size(F.filter(edges, lambda edge: edge < value)))
    return F.when(value.isNull() | (count == 0), count + 1).otherwise(position)


def label_decimals(edges: Column) -> Column:
    """Fewest decimals, from three on, that keep the rounded edges apart; three if none does."""
    candidates = F.sequence(F.lit(LABEL_DECIMALS), F.lit(MOST_DECIMALS))

    def keeps_apart(decimals: Column) -> Column:
        rounded = F.transform(edges, lambda edge: rounded_to_significant(edge, decimals))
        return F.size(F.array_distinct(rounded)) == F.size(edges)

    return F.coalesce(F.get(F.filter(candidates, keeps_apart), F.lit(0)), F.lit(LABEL_DECIMALS))


def bin_grid(edges: DataFrame, keys: list[str], as_percent: Column) -> DataFrame:
    """keys, ``bin``, ``left``, ``right``, ``interval``: every interval, also those without members.

    Labels show rounded edges, the first one lowered by one unit of the last decimal so that it
    lies outside the interval. Each step is a column of its own: written as one nested expression
    over the edges array, the label text would be repeated dozens of times in the generated code.
    """
    groups = [column(k) for k in keys]
    spread = (
        edges.select(*groups, as_percent.alias("as_percent"), "edges", label_decimals(F.col("edges")).alias("decimals"))
        .select(*groups, "as_percent", "edges", "decimals", F.posexplode("edges").alias("i", "left"))
        .withColumn("right", F.get("edges", F.col("i") + 1))
        .filter(F.col("right").isNotNull())
    )
    lowered = F.when(F.col("i") == 0, F.pow(F.lit(10.0), -F.col("decimals").cast("double"))).otherwise(0.0)
    shown = spread.withColumn(
        "low", rounded_to_significant(F.col("left"), F.col("decimals")) - lowered
    ).withColumn("high", rounded_to_significant(F.col("right"), F.col("decimals")))
    scaled = shown.withColumns(
        {side: F.when(F.col("as_percent"), percent(F.col(side))).otherwise(F.col(side)) for side in ("low", "high")}
    )
    unit = F.when(F.col("as_percent"), "%").otherwise("")
    return scaled.select(
        *groups,
        (F.col("i") + 1).alias("bin"),
        "left",
        "right",
        F.concat(float_text(F.col("low")), unit, F.lit(":"), float_text(F.col("high")), unit).alias("interval"),
    )
