"""Aggregates per geographic unit.

The working form is long: ids, code, value. Wide tables, one column per code, are made only on
request, since their schema depends on the observed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.numbers import as_double, as_integer
from mapstrata.functions.text import stripped
from mapstrata.operators.exact_sums import exact_sums
from mapstrata.operators.gate import passed_gate
from mapstrata.operators.order_stats import medians
from mapstrata.session import column, cut_lineage, exact_names

# Code of the row count, and the aggregate operations by name.
TOTAL_CODE = "conteo::total_datos"
SUM, MEAN, MEDIAN = "suma", "media", "mediana"
OPERATIONS = (SUM, MEAN, MEDIAN)

# Column of long tables with the exact value of integers.
WHOLE = "whole"

# Type of sums of integers that 64 bits do not hold.
WIDE_INTEGER = "decimal(38,0)"


def numeric_code(operation: str, variable: str) -> str:
    return f"{operation}::{variable}"


def check_operation(operation: str) -> None:
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation {operation!r}; known ones are {', '.join(OPERATIONS)}")


@exact_names
def known_units(df: DataFrame, ids: list[str]) -> DataFrame:
    """Rows of an identified geographic unit, ids stripped; rows without an id belong to none."""
    types = {field.name: field.dataType for field in df.schema}
    cleaned = [
        (stripped(column(name)) if name in ids and isinstance(types[name], T.StringType) else column(name)).alias(name)
        for name in df.columns
    ]
    identified = reduce(Column.__and__, [column(i).isNotNull() for i in ids])
    return df.select(*cleaned).filter(identified)


def _others(ids: list[str], variables: list[str]) -> list[str]:
    return [v for v in dict.fromkeys(variables) if v not in ids]


def total_counts(df: DataFrame, ids: list[str]) -> DataFrame:
    """Rows per geographic unit."""
    return known_units(df, ids).groupBy(*[column(i) for i in ids]).agg(F.count(F.lit(1)).alias(TOTAL_CODE))


@exact_names
def melted(df: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    """One row per unit and non-null value of each variable; an id is not a variable."""
    chosen = _others(ids, variables)
    pairs = [
        F.struct(F.lit(v).alias("variable"), stripped(column(v).cast("string")).alias("value")) for v in chosen
    ]
    empty = F.array().cast("array<struct<variable:string,value:string>>")
    units = known_units(df, ids)
    return units.select(
        *[column(i) for i in ids], F.inline(F.array(*pairs) if pairs else empty).alias("variable", "value")
    ).filter(F.col("value").isNotNull())


def categorical_counts(df: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    """Rows per unit, variable and value. Counts are combined before the shuffle, so a unit or a
    value that holds much of the table costs no more than any other."""
    return (
        melted(df, ids, variables)
        .groupBy(*[column(i) for i in ids], "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_code() -> Column:
    return F.concat_ws("-", "variable", "value")


def observed_values(counts: DataFrame) -> DataFrame:
    """Distinct (variable, value) pairs."""
    return counts.select("variable", "value").distinct()


def ordered_codes(counts: DataFrame) -> dict[str, str]:
    """Codes of the observed pairs with their variable, ordered by variable, then value. They become column names, which a table's schema
    holds on the driver; the long forms never call this."""
    pairs = observed_values(counts).collect()
    ordered = sorted(pairs, key=lambda p: (p["variable"], p["value"]))
    codes = {f"{p['variable']}-{p['value']}": p["variable"] for p in ordered}
    if len(codes) < len(pairs):
        raise ValueError("two different (variable, value) pairs share one code")
    return codes


@exact_names
def widened_counts(counts: DataFrame, ids: list[str], codes: list[str]) -> DataFrame:
    """One column per code, zero where a unit has no such value."""
    units = [column(i) for i in ids]
    if not codes:
        return counts.select(*units).distinct()
    wide = counts.select(*units, value_code().alias("code"), "n").groupBy(*units).pivot("code", codes).agg(F.first("n"))
    return wide.select(*units, *[F.coalesce(column(c), F.lit(0)).cast("bigint").alias(c) for c in codes])


def long_counts(counts: DataFrame, ids: list[str], exact: bool = False) -> DataFrame:
    """ids, code, value of categorical counts; a count of zero has no row. ``exact`` as for ``lengthened``."""
    whole = [F.col("n").cast("bigint").alias(WHOLE)] if exact else []
    return counts.select(*[column(i) for i in ids], value_code().alias("code"), F.col("n").cast("double").alias("value"), *whole)


def units_with_all(counts: DataFrame, ids: list[str], blocks: list[list[str]]) -> DataFrame:
    """Units with some value in every block of variables, from one row per unit, variable and value."""
    seen = [F.bool_or(F.col("variable").isin(variables)).alias(f"_{n}") for n, variables in enumerate(blocks)]
    units = counts.groupBy(*[column(i) for i in ids]).agg(*seen)
    return units.filter(reduce(Column.__and__, [F.col(f"_{n}") for n in range(len(blocks))])).select(
        *[column(i) for i in ids]
    )


@exact_names
def categorical_wide(df: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    """Wide counts. The counts are written to the shared folder, so that finding the columns and
    filling them reads the microdata once."""
    counts = cut_lineage(categorical_counts(df, ids, variables))
    return widened_counts(counts, ids, list(ordered_codes(counts)))


def numeric_values(df: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    """Long numbers of variables that passed the gate: ids, variable, x (non-null)."""
    types = {field.name: field.dataType for field in df.schema}
    pairs = [
        F.struct(F.lit(v).alias("variable"), as_double(column(v), types[v]).alias("x")) for v in _others(ids, variables)
    ]
    units = known_units(df, ids)
    return units.select(*[column(i) for i in ids], F.inline(F.array(*pairs)).alias("variable", "x")).filter(
        F.col("x").isNotNull()
    )


def numeric_long(df: DataFrame, ids: list[str], variables: list[str], operation: str, exact: bool = False) -> DataFrame:
    """ids, code, value of one operation; a unit without any number gets 0 as sum and no row otherwise. ``exact`` as for
    ``lengthened``."""
    wide = numeric_wide(df, ids, variables, operation)
    codes = [c for c in wide.columns if c not in ids]
    return lengthened(wide, ids, codes, exact)


def numeric_wide(df: DataFrame, ids: list[str], variables: list[str], operation: str) -> DataFrame:
    """One column ``operation::variable`` per variable that holds numbers only.

    Variables with any other text are left out; with none left, the distinct units remain. Sums of
    variables that hold integers only are exact and integers, of 64 bits or, where some sum needs more, ``WIDE_INTEGER``.
    """
    check_operation(operation)
    gate = passed_gate(df, _others(ids, variables))
    return numeric_blocks(df, ids, {operation: gate.passed}, most_rows=gate.rows, integers=gate.integers)


def _fitted(wide: DataFrame, codes: list[str]) -> DataFrame:
    """``wide`` with those of the ``codes`` as bigint whose every value fits, the others as they are. The table is written to the
    shared folder, so that finding out reads the microdata once."""
    if not codes:
        return wide
    held = cut_lineage(wide)
    smallest, largest = (F.lit(str(bound)).cast(WIDE_INTEGER) for bound in (-(2**63), 2**63 - 1))
    beyond = [F.coalesce(F.bool_or((column(c) < smallest) | (column(c) > largest)), F.lit(False)) for c in codes]
    fits = {c for c, over in zip(codes, held.agg(F.array(*beyond).alias("beyond")).first()["beyond"]) if not over}
    return held.select(*[(column(c).cast("bigint") if c in fits else column(c)).alias(c) for c in held.columns])


@exact_names
def numeric_blocks(
    df: DataFrame,
    ids: list[str],
    by_operation: dict[str, list[str]],
    with_total: bool = False,
    most_rows: int | None = None,
    integers: frozenset[str] = frozenset(),
) -> DataFrame:
    """Totals, and sums of integers, in one aggregation; exact sums of other numbers, and medians, are joined to it.

    ``most_rows`` bounds the rows of the table, hence of any unit, if that is known. ``integers`` names variables
    that hold integers only; their sums are worked out at once, since a column of them is of 64 bits only if these hold all of
    it. Other sums are exact before they are rounded to a double, and means divide such a sum, so neither depends on how the
    rows are spread.
    """
    types = {field.name: field.dataType for field in df.schema}
    units = [column(i) for i in ids]
    known = known_units(df, ids)
    aggregates: list[Column] = [F.count(F.lit(1)).alias(TOTAL_CODE)] if with_total else []
    sums, means = by_operation.get(SUM, []), by_operation.get(MEAN, [])
    for v in sums:
        if v in integers:
            total = F.coalesce(F.sum(as_integer(column(v), types[v])), F.lit(0)).cast(WIDE_INTEGER)
            aggregates.append(total.alias(numeric_code(SUM, v)))
    for v in means:
        if v in integers:
            number = as_integer(column(v), types[v])
            aggregates.append((F.sum(number).cast("double") / F.count(number)).alias(numeric_code(MEAN, v)))
    base = known.groupBy(*units).agg(*aggregates) if aggregates else known.select(*units).distinct()
    base = _fitted(base, [numeric_code(SUM, v) for v in sums if v in integers])
    parts = [v for v in dict.fromkeys([*sums, *means]) if v not in integers]
    if parts:
        found = exact_sums(numeric_values(df, ids, parts), [*ids, "variable"], "x")
        wide = found.groupBy(*units).agg(
            *[F.max(F.when(F.col("variable") == v, F.struct("total", "n"))).alias(f"_{n}") for n, v in enumerate(parts)]
        )
        joined = base.join(wide, ids, "left")
        place = {v: f"_{n}" for n, v in enumerate(parts)}
        totals = [F.coalesce(F.col(place[v])["total"], F.lit(0.0)).alias(numeric_code(SUM, v)) for v in sums if v in place]
        averages = [(F.col(place[v])["total"] / F.col(place[v])["n"]).alias(numeric_code(MEAN, v)) for v in means if v in place]
        made = {**{numeric_code(SUM, v): v for v in sums}, **{numeric_code(MEAN, v): v for v in means}}
        joined = joined.select(*[column(c) for c in base.columns], *totals, *averages)
        first = [c for c in base.columns if c not in made]
        base = joined.select(*[column(c) for c in [*first, *made]])
    middle = by_operation.get(MEDIAN, [])
    if middle:
        found = medians(numeric_values(df, ids, middle), [*ids, "variable"], "x", most_rows)
        wide = found.groupBy(*units).agg(
            *[F.max(F.when(F.col("variable") == v, F.col("_median"))).alias(numeric_code(MEDIAN, v)) for v in middle]
        )
        base = base.join(wide, ids, "left")
    return base


@exact_names
def lengthened(wide: DataFrame, ids: list[str], codes: list[str], exact: bool = False) -> DataFrame:
    """Wide aggregates to ids, code, value; missing values have no row. With ``exact`` a column ``whole`` has the value of integer
    columns as it is, since a double holds integers up to 2**53 only; it is null for other numbers. It is of 64 bits unless one
    of those columns is wider."""
    types = {f.name: f.dataType for f in wide.schema}
    wider = {c for c in codes if types[c] == T.DecimalType(38, 0)}
    integers = {c for c in codes if isinstance(types[c], T.IntegralType)} | wider
    held = WIDE_INTEGER if wider else "bigint"
    whole = [(column(c) if c in integers else F.lit(None)).cast(held).alias(WHOLE) for c in codes]
    pairs = [
        F.struct(F.lit(c).alias("code"), column(c).cast("double").alias("value"), *([w] if exact else []))
        for c, w in zip(codes, whole)
    ]
    names = ["code", "value", *([WHOLE] if exact else [])]
    return wide.select(*[column(i) for i in ids], F.inline(F.array(*pairs)).alias(*names)).filter(F.col("value").isNotNull())


def joined_on_units(blocks: list[DataFrame], ids: list[str]) -> DataFrame:
    """Only units present in every block remain. Blocks hold one row per unit, so no join key is hot."""
    return reduce(lambda left, right: left.join(right, ids, "inner"), blocks)
