"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule.
Policies (named, versioned sets of rules) and ablations only read the bits.

Null and empty texts have no words: all measurements are 0 and the word rule fails. Repeated rows are
judged each for itself. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.llm.words import as_bytes, map_rows, split_words

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim"]
SYMBOLS = [b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"]


@dataclass(frozen=True)
class QualityRule:
    """A rule that fails where ``fails``, SQL over the measurements, is true. Its bit never changes."""

    bit: int
    name: str
    fails: str


# Bits are never reused, so that old ledgers stay readable.
RULES = [
    QualityRule(0, "few_words", "n_words < 50"),
    QualityRule(1, "repeated_trigrams", "100 * n_repeat_words > 50 * n_words"),
    QualityRule(2, "symbols", "5 * n_symbols > n_words"),
    QualityRule(3, "exclamations", "2 * n_exclaim > n_words"),
    QualityRule(4, "repeated_lines", "2 * n_dup_lines > n_lines"),
    QualityRule(5, "long_words", "word_chars > 20 * n_words"),
    QualityRule(6, "short_words", "word_chars < 2 * n_words"),
]


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE_POLICY = Policy("base", 1, ("few_words", "repeated_trigrams"))
POLICY = Policy("default", 1, tuple(r.name for r in RULES))


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside ``width``-word windows that occur twice or more in the text, the first included."""
    n = len(words)
    if n <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    keys = ids[: n - width + 1]
    for k in range(1, width):
        # renumbered at each step, so that no product overflows however long the text is
        _, keys = np.unique(keys * len(numbers) + ids[k : n - width + 1 + k], return_inverse=True)
    twice = np.bincount(keys)[keys] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= twice
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = split_words(text)
    if not words:
        return (0,) * 2 + (sum(map((text or b"").count, SYMBOLS)),) + (0,) * 3 + ((text or b"").count(b"!"),)
    letters = np.frombuffer(b"".join(words), dtype=np.uint8)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(letters) - int(np.count_nonzero((letters & 0xC0) == 0x80)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        text.count(b"!"),
    )


def quality_ledger(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of ``docs``, the measurements and ``failed_bits``, one row per row of ``docs``."""
    fields = [docs.schema[name] for name in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{m} long" for m in MEASURES)])

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [measure(x) for x in batch.column(0).to_pylist()]
        columns = list(zip(*found)) if found else [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *(pa.array(c, pa.int64()) for c in columns)], [*keep, *MEASURES]
        )

    measured = map_rows(docs.select(as_bytes(text).alias("__text"), *keep), rows, schema)
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0) for r in RULES]
    total: Column = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("failed_bits", total.cast("long"))


def fails(policy: Policy) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) != 0


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only it rejects, which the policy
    without that rule would keep. Rows are first counted by bit pattern: at most 2 ** rules of them."""
    patterns = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    wanted = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit")) for r in RULES if r.name in policy.rules]
    each = patterns.select("bits", "n", F.explode(F.array(*wanted)).alias("r")).select("bits", "n", "r.*")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
