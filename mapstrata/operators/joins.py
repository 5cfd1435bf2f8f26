"""Joins with a table that is usually small, on keys that a large table may repeat without bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.session import cut_lineage

# A table is broadcast up to this many bytes of its texts; beyond, it is repeated once per salt.
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


def bytes_of(few: DataFrame) -> int:
    """Bytes of all cells as text, with some for each row."""
    cells = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in few.columns]
    return few.select(F.sum(sum(cells, F.lit(32)).cast("bigint"))).first()[0] or 0


def joined_with_few(
    rows: DataFrame, few: DataFrame, keys: list[str], spread_by: list[Column], how: str = "inner", size: int | None = None
) -> DataFrame:
    """``rows`` with the columns of ``few``. No key gathers all its rows in one task: ``few`` is broadcast
    if its bytes, counted here unless given as ``size``, allow it; else the join is salted by ``spread_by``."""
    if size is None:
        few = cut_lineage(few)
        size = bytes_of(few)
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(few), keys, how)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
