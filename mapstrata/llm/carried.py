"""Columns that an operator carries along without reading them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def set_aside(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with names of its own for all columns but those in ``used``, so that none clashes with a column that an
    operator makes, and the way back to the columns of ``docs``. Types and nullability stay."""
    private = [c if c in used else f"__carried_{n}" for n, c in enumerate(docs.columns)]
    renamed = docs.select(*[_column(c).alias(p) for c, p in zip(docs.columns, private)])

    def back(result: DataFrame) -> DataFrame:
        return result.select(*[_column(p).alias(c) for c, p in zip(docs.columns, private)])

    return renamed, back


def carries_columns(*used: str) -> Callable[[Callable], Callable]:
    """For operators whose first argument and result have the same columns: all but ``used`` pass under names of their own."""

    def decorated(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            renamed, back = set_aside(docs, used)
            return back(operator(renamed, *args, **kwargs))

        return run

    return decorated
