"""Scales in long form: one row per unit and code, for any number of codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.operators.columns import compiled
from mapstrata.operators.joins import joined_with_few
from mapstrata.session import column, local_table

CODE, VALUE = "code", "value"

# Codes of sums, means and medians. A unit without such a row has no value; it has 0 of any other code.
WITHOUT_VALUE = r"^(suma|media|mediana)::"


@dataclass(frozen=True)
class LongScale:
    """Units of a scale as ids, ``code``, ``value``, as ``forma_larga`` writes them. A unit of the scale is one with any row.
    Of codes that match ``without_value`` a missing row is a missing value, of all others it is a count of zero."""

    table: DataFrame
    without_value: str = WITHOUT_VALUE

    def __post_init__(self) -> None:
        for name in (CODE, VALUE):
            if name not in self.table.columns:
                raise ValueError(f"a long scale needs the column {name}")
        compiled(self.without_value)

    def codes(self) -> list[str]:
        """Codes of the scale, which the requests are chosen from: one per variable, however many units have it."""
        found = self.table.select(CODE).where(F.col(CODE).isNotNull()).distinct().collect()
        return sorted(row[CODE] for row in found)

    def zero_codes(self, codes: list[str]) -> set[str]:
        matcher = compiled(self.without_value)
        return {code for code in codes if not matcher.search(code)}


def _requested(spark, asked: list[tuple[int, str | None, str]], bases: list[str]) -> DataFrame:
    """code, ``uses``: the requests that cut a code (or -1) and its number as a base (or -1)."""
    rows = [(code, number, -1) for number, _, code in asked] + [(base, -1, n) for n, base in enumerate(bases)]
    each = local_table(spark, [CODE, "request", "base"], rows)
    return each.groupBy(CODE).agg(F.collect_list(F.struct("request", "base")).alias("uses"))


def gathered(scale: LongScale, ids: list[str], asked: list[tuple[int, str | None, str]]) -> DataFrame:
    """ids, ``held`` (request, value) and ``bases`` (base number to value): one row per unit of the scale.

    ``asked``: number, base and code of each request. Codes meet their requests in a broadcast or salted join, so a code
    that every unit has is no hot key, and no code becomes a column; a unit has at most as many entries as are asked for.
    """
    bases = sorted({base for _, base, _ in asked if base is not None})
    uses = _requested(scale.table.sparkSession, asked, bases)
    units = [column(i) for i in ids]
    number = F.col(VALUE).cast("double")
    rows = scale.table.select(*units, CODE, F.when(~F.isnan(number), number).alias(VALUE))
    size = sum(40 + len(code.encode()) + 16 for _, _, code in asked) + 100 * len(bases)
    met = joined_with_few(rows, uses, [CODE], units, "left", size)
    entry = F.when(F.col("uses").isNotNull() & F.col(VALUE).isNotNull(), F.struct("uses", VALUE))
    held = met.groupBy(*units).agg(F.collect_list(entry).alias("rows"))
    each = F.flatten(F.transform("rows", lambda r: F.transform(r["uses"], lambda u: F.struct(u["request"], u["base"], r[VALUE]))))
    used = held.select(*units, each.alias("each"))
    present = F.transform(F.filter("each", lambda e: e["request"] >= 0), lambda e: F.struct(e["request"], e[VALUE]))
    divisors = F.transform(F.filter("each", lambda e: e["base"] >= 0), lambda e: F.struct(e["base"], e[VALUE]))
    twice = F.size(F.array_distinct(F.transform("held", lambda h: h["request"]))) < F.size("held")
    failure = F.raise_error(F.lit("a unit of a long scale has two values of one code"))
    checked = used.select(*units, present.alias("held"), F.map_from_entries(divisors).alias("bases"))
    return checked.withColumn("held", F.when(twice, failure).otherwise(F.col("held")))


def spread(
    table: DataFrame, scale: LongScale, asked: list[tuple[int, str | None, str]], kept: list[str]
) -> DataFrame:
    """``kept`` columns, ``request``, ``as_percent`` and ``x``: every unit of ``gathered`` for every request in ``asked``, the
    missing ones filled in where the row is opened. Requests meet their base by number in a broadcast or salted join."""
    spark = table.sparkSession
    zero = scale.zero_codes([code for _, _, code in asked] + [base for _, base, _ in asked if base is not None])
    bases = {base: n for n, base in enumerate(sorted({base for _, base, _ in asked if base is not None}))}
    rows = [
        (number, bases.get(base, -1), int(code in zero), int(base in zero)) for number, base, code in asked
    ]
    requests = local_table(spark, ["request", "base", "code_zero", "base_zero"], rows or [(-1, -1, 0, 0)])
    highest = max((number for number, _, _ in asked), default=-1)
    numbers = F.sequence(F.lit(0), F.lit(highest)) if highest >= 0 else F.array().cast("array<int>")
    missing = F.array_except(numbers, F.transform("held", lambda h: h["request"]))
    nothing = F.lit(None).cast("double")
    every = F.concat("held", F.transform(missing, lambda r: F.struct(r.alias("request"), nothing.alias(VALUE))))
    opened = table.select(*[column(c) for c in kept], "bases", F.inline(every).alias("request", VALUE))
    spread_by = [column(c) for c in kept] or [F.col(VALUE)]
    met = joined_with_few(opened, requests, ["request"], spread_by, size=40 * len(rows))
    value = F.coalesce(VALUE, F.when(F.col("code_zero") == 1, 0.0))
    divisor = F.coalesce(F.try_element_at("bases", F.col("base")), F.when(F.col("base_zero") == 1, 0.0))
    quotient = F.when(F.col("base") < 0, value).otherwise(F.when(divisor != 0, value / divisor))
    return met.select(*[column(c) for c in kept], "request", (F.col("base") >= 0).alias("as_percent"), quotient.alias("x"))


