"""Mixing sources to target weights.

Documents get hash-random keys. Within each source the keys are cut in ranges; sums of sizes per range and
their running sums find the range in which the source's budget ends, and running sums inside that one range
find the exact place. A source whose budget exceeds its size is taken whole as often as it fits before.

Null sources are one source, ordered last. Null texts have size 0. Rows that repeat a doc_id are separate
documents; where the budget ends among rows of one key they share the rest in proportion to size. An empty
table gives an empty result; a corpus without words has targets of 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.llm.carried import carries_columns
from mapstrata.llm.words import map_rows, split_words, word_count
from mapstrata.session import cut_lineage

RANGE_DIGITS = 3  # hex digits of the key that name its range: 4,096 ranges per source
WEIGHTS = (5, 2, 1)
MOST_BROADCAST = 100_000


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def sized(docs: DataFrame, seed: str = "mix", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, source, size, key) of every document, written once."""
    return cut_lineage(docs.select(doc_id, "source", word_count("text").alias("size"), random_key(F.col(doc_id), seed).alias("key")))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3) -> DataFrame:
    """``sources``: (source, source_size), one row each. Adds weight and target: shares by weight, where a
    target stops at ``most_epochs`` times its size and the others share the excess by weight. The sources
    that stop are the first ones in order of size per weight, so one ordered pass finds them."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    weighted = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights)) + 1))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ordered = weighted.select(
        "*",
        F.row_number().over(by_ratio).alias("__place"),
        (F.sum("source_size").over(everything) - most_epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("__left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("__weights"),
    )
    # what one unit of weight gets if exactly the sources before this one have stopped
    level = F.col("__left") / F.col("__weights")
    goes_on = level * F.col("weight") <= most_epochs * F.col("source_size")
    first = F.min(F.when(goes_on, F.struct("__place", level.alias("level")))).over(everything)
    return ordered.withColumn("__first", first).select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("__place") >= F.col("__first.__place"), F.col("__first.level") * F.col("weight"))
        .otherwise((most_epochs * F.col("source_size")).cast("double"))
        .alias("target"),
    )


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3) -> DataFrame:
    """One row per source: its target, whole epochs, and where the last epoch ends: at ``cut_key``, whose rows
    (``cut_size`` words in all) still get ``cut_words`` words. ``rows``: the result of ``sized``."""
    ranges = rows.groupBy("source", F.substring("key", 1, RANGE_DIGITS).alias("range")).agg(F.sum("size").alias("n"))
    ranges = cut_lineage(ranges)
    wanted = targets(ranges.groupBy("source").agg(F.sum("n").alias("source_size")), weights, most_epochs)
    whole = F.round("target").cast("long")
    wanted = cut_lineage(
        wanted.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0))
        .withColumn("rest", whole - F.col("epochs") * F.col("source_size"))
    )

    def first_beyond(pieces: DataFrame, order: str) -> DataFrame:
        """Per source the piece in which the rest ends, and what is left for it."""
        w = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = pieces.join(wanted.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        upto = upto.drop("s").withColumn("upto", F.sum("n").over(w))
        return upto.where("upto > rest and upto - n <= rest")

    last_range = first_beyond(ranges, "range").select(F.col("source").alias("s"), "range")
    inside = rows.join(
        last_range, F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, RANGE_DIGITS) == F.col("range"))
    )
    # sums of the ranges before the last one come first, as one piece
    before = ranges.join(last_range.withColumnRenamed("range", "last"), F.col("source").eqNullSafe(F.col("s")))
    before = before.where("range < last").groupBy("source").agg(F.sum("n").alias("n")).select("source", F.lit("").alias("key"), "n")
    keys = inside.groupBy("source", "key").agg(F.sum("size").alias("n"))
    cut = first_beyond(before.unionByName(keys), "key").select(
        F.col("source").alias("s"),
        F.col("key").alias("cut_key"),
        F.col("n").alias("cut_size"),
        (F.col("rest") - (F.col("upto") - F.col("n"))).alias("cut_words"),
    )
    return wanted.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _small(plan: DataFrame) -> DataFrame:
    plan = cut_lineage(plan)
    return F.broadcast(plan) if plan.count() <= MOST_BROADCAST else plan


def allocated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds source_size, target, epochs, extra (words of the last, partial epoch) and taken to rows that have
    source, size and key. The plan, one row per source, is broadcast up to ``MOST_BROADCAST`` rows (counted); beyond
    it Spark joins by source and splits the large ones."""
    plan = _small(plan).select(F.col("source").alias("__s"), "source_size", "target", "epochs", "cut_key", "cut_size", "cut_words")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    extra = (
        F.when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), F.expr("size * cut_words div cut_size"))
        .otherwise(0)
        .cast("long")
    )
    return (
        joined.withColumn("extra", extra)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))
        .drop("cut_key", "cut_size", "cut_words")
    )


def first_words(text: bytes, n: int) -> bytes:
    """The text up to the end of its ``n``-th word."""
    rest = text.split(None, n)
    if len(rest) <= n:
        return text
    return text[: len(text) - len(rest[n])].rstrip(b" \t\n\r\x0b\x0c")


def _copies(columns: list[str]) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """Rows as often as the plan takes them whole, then those that it takes in part."""

    def copies(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = ("__epochs", "__cut_key", "__cut_size", "__cut_words", "__key")
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        whole: list[int] = []
        partial: list[int] = []
        shortened: list[bytes] = []
        for i, (text, epochs, cut_key, cut_size, cut_words, key) in enumerate(zip(texts, *(batch.column(c).to_pylist() for c in names))):
            size = len(split_words(text))
            if not size:
                continue
            extra = 0
            if cut_key is not None:
                extra = size if key < cut_key else size * cut_words // cut_size if key == cut_key else 0
            whole += [i] * (epochs + (extra == size))
            if 0 < extra < size:
                partial.append(i)
                shortened.append(first_words(text, extra))
        docs = batch.select(columns)
        if whole:
            yield docs.take(pa.array(whole, pa.int64()))
        if partial:
            docs = docs.take(pa.array(partial, pa.int64()))
            new = {"text": pa.array(shortened, pa.binary()).cast(pa.string())}
            if "n_chars" in columns:
                lengths = pa.array([len(x.decode("utf-8", "replace")) for x in shortened], pa.int64())
                new["n_chars"] = lengths.cast(docs.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, docs.column(c)) for c in columns], schema=docs.schema)

    return copies


@carries_columns("doc_id", "text", "source", "n_chars")
def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The mixed corpus: rows of ``docs`` once per whole epoch, and once more, whole or up to the last word
    that the budget holds, where the partial epoch takes them. Columns as in ``docs``; documents without a word go."""
    plan = _small(mix_plan(sized(docs, seed), weights, most_epochs))
    plan = plan.select(F.col("source").alias("__s"), *(F.col(c).alias(f"__{c}") for c in ("epochs", "cut_key", "cut_size", "cut_words")))
    keyed = docs.withColumn("__key", random_key(F.col("doc_id"), seed))
    joined = keyed.join(plan, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    return map_rows(joined, _copies(docs.columns), docs.schema)
