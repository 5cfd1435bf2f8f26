"""Exact order statistics of any number of groups, whatever their sizes.

Sorting a group in one task fails once one group holds a third of the table, and moving or writing
every value of such a group is waste when only a few ranks are asked for. So large groups are
narrowed down first:

1. Count the groups (combined before the shuffle). Without large ones, go to step 4.
2. Cut each large group in slices at approximate quantiles. The cuts need not be exact; they are
   written to the shared folder, so that a lost executor cannot lead to other slices.
3. Count the rows per slice (combined before the shuffle). This gives the exact rank at which
   every slice starts, hence the slices that hold a wanted rank. All other rows are dropped where
   they are read.
   A group of more than MOST_SLICES times LARGE_GROUP rows has slices that are large themselves;
   steps 2 and 3 are done again on those that are wanted, until they are not.
4. Rank what is left: whole small groups and the wanted slices of large ones.

Equal values are counted together before they are moved, so a value that fills a slice is one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.session import column, cut_lineage

# Groups proven to have no more rows than this are sorted as one array each.
SMALL_GROUP = 50_000

# Groups with more rows than this are cut in slices of about this many rows, divided by FINER, each: the finer they are, the
# fewer rows share a slice with a wanted rank, and only those are moved and held to be ranked.
LARGE_GROUP = 500_000
FINER = 8

# Most slices a group is cut in at a time, and the accuracy of the cuts between them.
MOST_SLICES = 1024
CUT_ACCURACY = 10 * MOST_SLICES

# Up to this many large groups (out of at least LARGE_GROUP times as many rows) their cuts are
# broadcast; more of them are joined with salted keys.
BROADCAST_GROUPS = 100_000
SALTS = 64


def order_statistics(
    rows: DataFrame, keys: list[str], value: str, positions: list[str], most_rows: int | None = None
) -> DataFrame:
    """Sorted values at chosen positions.

    ``positions`` are SQL expressions of 0-based positions in terms of ``_n``, the row count of a
    group; they are evaluated for every distinct value, hence plain generated code and no lambdas.
    ``rows`` must hold neither null keys nor null values; NaN counts as no value. ``most_rows`` is a proven bound of the
    rows of any group, if the caller has one. Result: keys, ``_n`` and ``_found``, the values in
    the order of ``positions``.
    """
    groups = [column(key) for key in keys]
    x = column(value)
    present = rows.select(*groups, x).filter(~F.isnan(x))
    if most_rows is not None and most_rows <= SMALL_GROUP:
        return _from_arrays(present, groups, x, positions)

    nothing = F.lit(None).cast("bigint")
    start = F.lit(0).cast("bigint")
    sliced = present.withColumn("_slice", start).withColumn("_skipped", nothing).withColumn("_size", nothing)
    if most_rows is None or most_rows > LARGE_GROUP:
        held = F.count(F.lit(1)).alias("_held")
        counted = present.groupBy(*groups).agg(held).filter(F.col("_held") > LARGE_GROUP)
        large = cut_lineage(
            counted.select(*groups, start.alias("_slice"), "_held", F.col("_held").alias("_n"), start.alias("_base"))
        )
        count, biggest = large.agg(F.count(F.lit(1)), F.max("_held")).first()
        while count:
            sliced = _wanted_slices(sliced, large, count, keys, x, positions)
            biggest = math.ceil(biggest / MOST_SLICES)
            if biggest <= LARGE_GROUP:
                break
            sliced = cut_lineage(sliced)
            pieces = sliced.filter(F.col("_size").isNotNull()).groupBy(
                *groups, "_slice", F.col("_size").alias("_n"), F.col("_skipped").alias("_base")
            )
            large = cut_lineage(pieces.agg(held).filter(F.col("_held") > LARGE_GROUP))
            count = large.count()

    tallies = sliced.groupBy(*groups, "_slice", "_skipped", "_size", x).agg(F.count(F.lit(1)).alias("_copies"))
    piece = Window.partitionBy(*groups, "_slice")
    upto = F.sum("_copies").over(piece.orderBy(x).rowsBetween(Window.unboundedPreceding, 0))
    ranked = (
        tallies.withColumn("_n", F.coalesce("_size", F.sum("_copies").over(piece)))
        .withColumn("_upto", F.coalesce("_skipped", F.lit(0)) + upto)
        .withColumn("_from", F.col("_upto") - F.col("_copies"))
    )
    found = F.sort_array(F.collect_list(F.struct("_i", x)))
    return (
        ranked.select(*groups, "_n", "_from", "_upto", x, F.posexplode(_array(positions)).alias("_i", "_position"))
        .filter("_position >= _from AND _position < _upto")
        .groupBy(*groups)
        .agg(F.first("_n").alias("_n"), F.transform(found, lambda entry: entry[value]).alias("_found"))
    )


def _array(expressions: list[str]) -> Column:
    return F.expr(f"array({', '.join(expressions)})")


def _from_arrays(present: DataFrame, groups: list[Column], x: Column, positions: list[str]) -> DataFrame:
    return (
        present.groupBy(*groups)
        .agg(F.sort_array(F.collect_list(x)).alias("_sorted"))
        .withColumn("_n", F.size("_sorted").cast("bigint"))
        .select(*groups, "_n", _array([f"get(_sorted, cast({p} AS int))" for p in positions]).alias("_found"))
    )


def _joined(rows: DataFrame, few: DataFrame, keys: list[str], x: Column, count: int) -> DataFrame:
    """Left join that never gathers a large group: by broadcast, or salted by the value."""
    if count <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(few), keys, "left")
    spread = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(x), F.lit(SALTS)).cast("int"))
    return salted.join(spread, [*keys, "_salt"], "left").drop("_salt")


def _cuts(rows: DataFrame, large: DataFrame, count: int, keys: list[str], x: Column) -> DataFrame:
    """keys, ``_n``, ``_base`` and the ascending ``_cuts``, for each large piece.

    A piece gets as many slices as its size asks for, so all cuts together are at most as many as
    the table has rows, divided by LARGE_GROUP and times FINER, and one a piece.
    """
    groups = [column(key) for key in keys]
    levels = [i / MOST_SLICES for i in range(1, MOST_SLICES)]
    slices = F.least(F.ceil(F.col("_held") * FINER / LARGE_GROUP), F.lit(MOST_SLICES)).cast("int")
    picked = F.transform(
        F.sequence(F.lit(1), slices - 1),
        lambda i: F.get("_levels", F.floor(i * MOST_SLICES / slices).cast("int") - 1),
    )
    cuts = (
        _joined(rows, large, keys, x, count)
        .filter(F.col("_n").isNotNull())
        .groupBy(*groups, "_held", "_n", "_base")
        .agg(F.percentile_approx(x, levels, CUT_ACCURACY).alias("_levels"))
        .select(*groups, "_n", "_base", F.array_distinct(picked).alias("_cuts"))
    )
    return cut_lineage(cuts)


def _located(rows: DataFrame, x: Column) -> DataFrame:
    """``rows`` with ``_inner``, the number of cuts below the value, 0 without cuts. It is found by halving in plain generated
    code, one column a step, since each step uses the one before more than once."""
    located = rows.withColumn("_inner", F.lit(0))
    for bit in reversed(range(MOST_SLICES.bit_length())):
        further = F.col("_inner") + (1 << bit)
        located = located.withColumn("_inner", F.when(F.get("_cuts", further - 1) < x, further).otherwise(F.col("_inner")))
    return located


def _wanted_slices(
    rows: DataFrame, large: DataFrame, count: int, keys: list[str], x: Column, positions: list[str]
) -> DataFrame:
    """Rows of all that is not large, and of the slices of large pieces that hold a wanted position.

    ``rows``: keys, value, ``_slice``, ``_skipped`` (rows of the group below the slice), ``_size`` (rows of the group);
    the last two are null in groups that were never cut. ``large``: keys, ``_slice``, ``_held`` (rows of the slice),
    ``_n`` (rows of its group), ``_base`` (rows of the group below it).
    """
    groups, at = [column(key) for key in keys], [*keys, "_slice"]
    located = _located(_joined(rows, _cuts(rows, large, count, at, x), at, x, count), x)

    piece = Window.partitionBy(*groups, "_slice")
    ahead = F.sum("_held").over(piece.orderBy("_inner").rowsBetween(Window.unboundedPreceding, -1))
    wanted = (
        located.filter(F.col("_n").isNotNull())
        .groupBy(*groups, "_slice", "_inner", "_n", "_base")
        .agg(F.count(F.lit(1)).alias("_held"))
        .withColumn("_start", F.col("_base") + F.coalesce(ahead, F.lit(0)))
        .withColumn("_position", F.explode(_array(positions)))
        .filter("_position >= _start AND _position < _start + _held")
        .select(*groups, "_slice", "_inner", "_start")
        .distinct()
    )
    return (
        _joined(located, wanted, [*at, "_inner"], x, count)
        .filter(F.col("_n").isNull() | F.col("_start").isNotNull())
        .select(
            *groups,
            x,
            (F.col("_slice") * MOST_SLICES + F.col("_inner")).alias("_slice"),
            F.coalesce("_start", "_skipped").alias("_skipped"),
            F.coalesce("_n", "_size").alias("_size"),
        )
    )


def medians(rows: DataFrame, keys: list[str], value: str, most_rows: int | None = None) -> DataFrame:
    """Exact median per group: the middle value, or the mean of the two middle values."""
    stats = order_statistics(rows, keys, value, ["(_n - 1) div 2", "_n div 2"], most_rows)
    return stats.select(*[column(k) for k in keys], F.expr("(_found[0] + _found[1]) / 2").alias("_median"))
