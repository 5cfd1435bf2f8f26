"""All-or-nothing numeric gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.numbers import INTEGER_PATTERN, is_number_text, is_numeric_type
from mapstrata.functions.text import stripped
from mapstrata.session import column, exact_names


@exact_names
def non_numeric_counts(df: DataFrame, variables: list[str]) -> DataFrame:
    """``variable``, ``rejected``, ``fractional``, ``rows``: how many non-null values of a text variable are no
    number, how many are not written as an integer, and the rows of the table.

    The cells are spread and counted per variable instead of one aggregate column each: with
    hundreds of variables those no longer compile to one piece of code.
    """
    names = list(dict.fromkeys(variables))
    cells = df.select(F.posexplode(F.array(*[column(v) for v in names])).alias("_i", "_raw"))
    texts = cells.select("_i", stripped(F.col("_raw")).alias("_text"))
    return (
        texts.groupBy("_i")
        .agg(
            F.count_if(F.col("_text").isNotNull() & ~is_number_text(F.col("_text"))).alias("rejected"),
            F.count_if(~F.col("_text").rlike(INTEGER_PATTERN)).alias("fractional"),
            F.count(F.lit(1)).alias("rows"),
        )
        .select(F.get(F.array(*[F.lit(v) for v in names]), F.col("_i")).alias("variable"), "rejected", "fractional", "rows")
    )


@dataclass(frozen=True)
class Gate:
    """Variables that hold numbers only, those of them that hold integers only, and the rows of the table if it was read."""

    passed: list[str]
    integers: frozenset[str]
    rows: int | None


def passed_gate(df: DataFrame, variables: list[str]) -> Gate:
    """Variables whose every non-null value is a number, in the given order.

    Typed numeric columns pass by their type. All text columns are checked in one aggregate, and
    one row of counts per variable is all that reaches the driver.
    """
    types = {field.name: field.dataType for field in df.schema}
    texts = [v for v in dict.fromkeys(variables) if isinstance(types[v], T.StringType)]
    counts = non_numeric_counts(df, texts).collect() if texts else []
    rejected = {row["variable"] for row in counts if row["rejected"]}
    passed = set(texts) - rejected
    rows = max((row["rows"] for row in counts), default=0) if texts else None
    kept = [v for v in variables if v in passed or is_numeric_type(types[v])]
    whole = {row["variable"] for row in counts if not row["fractional"]}
    integers = frozenset(v for v in kept if v in whole or isinstance(types[v], T.IntegralType))
    return Gate(kept, integers, rows)


# Variables whose outcomes fit in one number.
BITS = 62


@exact_names
def watched(df: DataFrame, variables: list[str]) -> tuple[DataFrame, Callable[[], Gate]]:
    """``df`` and the gate of its variables once a job has read all of it. The outcomes are metrics of that job, bits of a few
    numbers whatever the number of variables, so that a table which is written anyway is not read for the gate."""
    types = {field.name: field.dataType for field in df.schema}
    texts = [v for v in dict.fromkeys(variables) if isinstance(types[v], T.StringType)]
    metrics = [F.count(F.lit(1)).alias("rows")]
    for start in range(0, len(texts), BITS):
        rejected, fractional = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        for bit, v in enumerate(texts[start : start + BITS]):
            text = stripped(column(v))
            mask = F.lit(1 << bit).cast("bigint")
            rejected = rejected + F.when(text.isNotNull() & ~is_number_text(text), mask).otherwise(0)
            fractional = fractional + F.when(~text.rlike(INTEGER_PATTERN), mask).otherwise(0)
        metrics += [F.bit_or(rejected).alias(f"rejected_{start}"), F.bit_or(fractional).alias(f"fractional_{start}")]
    observation = Observation()
    observed = df.observe(observation, *metrics)

    def gate() -> Gate:
        found = observation.get
        flagged = {
            kind: {v for n, v in enumerate(texts) if (found[f"{kind}_{n - n % BITS}"] or 0) >> (n % BITS) & 1}
            for kind in ("rejected", "fractional")
        }
        kept = [v for v in variables if (v in texts and v not in flagged["rejected"]) or is_numeric_type(types[v])]
        whole = {v for v in texts if v not in flagged["fractional"]}
        integers = frozenset(v for v in kept if v in whole or isinstance(types[v], T.IntegralType))
        return Gate(kept, integers, found["rows"])

    return observed, gate


def numeric_variables(df: DataFrame, variables: list[str]) -> list[str]:
    return passed_gate(df, variables).passed
