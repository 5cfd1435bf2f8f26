"""Geographic units listed per bin."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.functions.literals import unquoted
from mapstrata.operators import order_stats
from mapstrata.session import column, cut_lineage

# Units listed by one task for one bin, at most about this many.
UNITS_PER_SLICE = 200_000

# Units listed in one row of a bin unless the caller says otherwise; a bin has as many rows as it needs.
UNITS_PER_PART = 1_000_000


def unit_name(ids: list[str]) -> Column:
    """Ids of a unit joined without separator; a missing id reads ``nan``."""
    return F.concat(*[F.coalesce(column(i).cast("string"), F.lit("nan")) for i in ids])


def sliced_by_unit(scale: DataFrame, ids: list[str], units: int) -> DataFrame:
    """Units in id order over the partitions, ``slice`` telling which part of that order a row is in.

    The number of slices is set explicitly and grows with the table: each unit is multiplied by the
    number of requested variables afterwards, so the rows must stay spread over the cores, and the
    list of one bin in one slice must stay small. A table proven small is one slice and not moved.
    """
    if units <= order_stats.SMALL_GROUP:
        return scale.withColumn("slice", F.lit(0))
    shuffled = int(scale.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffled, math.ceil(units / UNITS_PER_SLICE))
    return scale.repartitionByRange(parts, *[column(i) for i in ids]).withColumn("slice", F.spark_partition_id())


def units_by_slice(members: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """keys, ``slice``, ``listed``: the units of one bin within one slice, in id order.

    All rows of a slice come from one partition, so the lists are built before the shuffle.
    """
    order = [column(i).cast("string").alias(f"id{n}") for n, i in enumerate(ids)]
    entry = F.struct(*order, unquoted(unit_name(ids)).alias("unit"))
    return (
        members.groupBy(*[column(k) for k in keys], "slice")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(
            *[column(k) for k in keys],
            "slice",
            F.transform("entries", lambda e: e["unit"]).alias("listed"),
        )
    )


def check_units_per_part(units_per_part: int) -> None:
    if isinstance(units_per_part, bool) or not isinstance(units_per_part, int):
        raise TypeError("the number of units per part must be an int")
    if units_per_part < 1:
        raise ValueError("the number of units per part must be at least 1")


def cells_by_part(slices: DataFrame, keys: list[str], units_per_part: int, most_units: int) -> DataFrame:
    """keys, ``part``, ``slice``, ``cells``: the units of a bin with ranks ``part * units_per_part`` on, as text.

    A unit's rank within its bin is its place in its slice plus the units of the slices before, which
    are summed from one count per slice; the lists themselves are never gathered per bin. The slices
    are written first, since a second evaluation might draw other range limits. ``most_units`` bounds the
    units of a bin; where one part surely holds them all, nothing is counted.
    """
    groups = [column(k) for k in keys]
    if most_units <= units_per_part:
        return slices.select(
            *groups, F.lit(0).cast("bigint").alias("part"), "slice", F.array_join("listed", ",").alias("cells")
        )
    written = cut_lineage(slices)
    earlier = Window.partitionBy(*groups).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.select(*groups, "slice", F.size("listed").alias("_held")).select(
        *groups, "slice", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before")
    )
    size = F.lit(units_per_part).cast("bigint")
    after = F.col("_before") + F.size("listed")
    low = F.greatest(F.col("part") * size, F.col("_before"))
    high = F.least((F.col("part") + 1) * size, after)
    return (
        written.join(starts, [*keys, "slice"])
        .withColumn("part", F.explode(F.sequence(F.floor(F.col("_before") / size), F.floor((after - 1) / size))))
        .withColumn("_listed", F.slice("listed", (low - F.col("_before") + 1).cast("int"), (high - low).cast("int")))
        .select(*groups, "part", "slice", F.array_join("_listed", ",").alias("cells"))
    )


def joined_slices(slice_column: str, cells: Column, present: Column) -> Column:
    """Aggregate that strings the slices of one part of a bin together, in order, as ``{a,b}``."""
    parts = F.sort_array(F.collect_list(F.when(present, F.struct(F.col(slice_column), cells.alias("cells")))))
    return F.concat(F.lit("{"), F.array_join(F.transform(parts, lambda p: p["cells"]), ","), F.lit("}"))
