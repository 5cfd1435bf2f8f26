"""Sums of doubles that are exact until they are rounded once, so they do not depend on the order of the rows.

A double is an integer times a power of two. Values are grouped by ``LIMB`` binary exponents, scaled to integers and added
up as decimals, before and after the shuffle. Per group that leaves a few limbs; these are carried into digits of ``LIMB`` bits, and
the highest ones are rounded to the nearest double, halves to even, as the sum of all values in unlimited precision would be.
Infinite values make the sum infinite, or NaN where both signs occur; NaN counts as no value. Groups may have 2**41 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.session import column

LIMB = 32
BASE = 1 << LIMB
# A value's exponent comes from its logarithm, which may be off by one; a double has 53 bits.
BITS = 54
DIGIT = "decimal(38,0)"


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2 ** exponent`` in two steps, so that neither factor leaves the range of a double."""
    half = F.floor(exponent / 2)
    return x * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (exponent - half).cast("double"))


def _carried(limbs: str, sign: str) -> str:
    """SQL: struct of the carry beyond the last limb and the digits from the lowest limb on, of ``sign`` times the limbs."""
    total = f"s.carry + coalesce(try_element_at({limbs}, j), 0BD) * {sign}"
    step = f"named_struct('t', cast({total} AS {DIGIT}))"
    digit = f"cast(pmod(x.t, {BASE}BD) AS {DIGIT})"
    carried = f"cast((x.t - {digit}) / {BASE}BD AS {DIGIT})"
    # transform over one element names an intermediate result within a lambda
    merged = f"transform(array({step}), x -> named_struct('carry', {carried}, 'digits', concat(s.digits, array({digit}))))[0]"
    start = f"named_struct('carry', cast(0 AS {DIGIT}), 'digits', cast(array() AS array<{DIGIT}>))"
    return f"aggregate(sequence(lowest, highest + 4), {start}, (s, j) -> {merged})"


def _highest(digits: str) -> str:
    """SQL: the place of the highest digit that is not 0, from 1 on, or 0."""
    return f"coalesce(array_max(transform(sequence(1, size({digits})), i -> if({digits}[i - 1] <> 0, i, 0))), 0)"


def exact_sums(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, ``total`` (nearest double of the exact sum) and ``n``, over non-null values."""
    groups = [column(k) for k in keys]
    x = F.col("_x")
    present = rows.select(*groups, column(value).alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    finite = F.abs(x) < float("inf")
    k = F.when(finite & (x != 0), F.floor((F.log2(F.abs(x)) - BITS) / LIMB)).otherwise(0).cast("int")
    scaled = present.withColumn("_k", k).withColumn("_v", F.when(finite, _scaled(x, F.col("_k") * -LIMB)).otherwise(0.0))
    high = F.floor(F.col("_v") / float(BASE))
    split = scaled.select(
        *groups, "_k", F.when(~finite, x).alias("_special"),
        high.cast("bigint").alias("_high"), (F.col("_v") - high.cast("double") * float(BASE)).cast("bigint").alias("_low"),
    )
    limbs = split.groupBy(*groups, "_k").agg(
        F.sum(F.col("_high").cast("decimal(18,0)")).cast("decimal(30,0)").alias("_high"),
        F.sum(F.col("_low").cast("decimal(18,0)")).cast("decimal(30,0)").alias("_low"),
        F.sum("_special").alias("_special"),
        F.count(F.lit(1)).alias("_n"),
    )
    # a high part counts one limb further up
    pair = F.array(F.struct(F.col("_k").alias("j"), F.col("_low").alias("v")), F.struct((F.col("_k") + 1).alias("j"), F.col("_high").alias("v")))
    held = limbs.groupBy(*groups).agg(
        F.flatten(F.collect_list(pair)).alias("_limbs"),
        F.sum("_special").alias("_special"),
        F.sum("_n").alias("n"),
        F.min("_k").alias("lowest"),
        (F.max("_k") + 1).alias("highest"),
    )
    summed = f"cast(aggregate(filter(_limbs, l -> l.j = j), cast(0 AS {DIGIT}), (a, l) -> cast(a + l.v AS {DIGIT})) AS {DIGIT})"
    by_limb = f"map_from_entries(transform(sequence(lowest, highest), j -> struct(j, {summed})))"
    digits = (
        held.withColumn("_by", F.expr(by_limb))
        .withColumn("_plus", F.expr(_carried("_by", "1BD")))
        .withColumn("_negative", F.expr("_plus.carry < 0"))
        .withColumn("_d", F.expr(f"if(_negative, {_carried('_by', '-1BD')}, _plus).digits"))
        .withColumn("_top", F.expr(_highest("_d")))
    )
    place = "coalesce(get(_d, _top - {0}), 0BD)"
    leading = f"cast({place.format(1)} * {BASE * BASE}BD + {place.format(2)} * {BASE}BD + {place.format(3)} AS {DIGIT})"
    bits = f"length(bin(cast({place.format(1)} AS bigint)))"
    # 62 of the leading bits; anything below them sets the last one, which keeps the one rounding that follows right
    kept = (
        digits.withColumn("_leading", F.expr(leading))
        .withColumn("_bits", F.expr(bits))
        .withColumn("_unit", F.expr(f"cast(shiftleft(1L, cast(_bits + 2 AS int)) AS {DIGIT})"))
        .withColumn("_below", F.expr(f"cast(_leading % _unit AS {DIGIT})"))
        .withColumn("_more", F.expr("_below <> 0 OR exists(slice(_d, 1, greatest(_top - 3, 0)), d -> d <> 0)"))
        .withColumn("_whole", F.expr("cast((_leading - _below) / _unit AS bigint) | if(_more, 1L, 0L)"))
    )
    exponent = F.col("lowest") * LIMB + (F.col("_top") - 3) * LIMB + F.col("_bits") + 2
    size = F.when(F.col("_top") == 0, 0.0).otherwise(_scaled(F.col("_whole").cast("double"), exponent))
    total = F.when(F.col("_negative"), -size).otherwise(size)
    return kept.select(*groups, F.coalesce("_special", total).alias("total"), "n")
