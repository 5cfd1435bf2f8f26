"""Delimited text with line breaks inside quotes, read in splits.

Spark reads lines in splits but not records, since whether a line begins one depends on all quotes before it in its file. Here
the quotes of every split are counted first; sums over the splits of a file tell which of them begin inside quotes. Then every
split puts its own records together. Only a record that crosses into another split is gathered, from the last lines of
one, the first of another and all lines of those between: at most one such record begins in a split.

Quotes must stand around fields and be doubled inside them, as every writer of such files does. Lines end with a line feed, or
a carriage return and a line feed. A file without any line of an odd number of quotes has no such record, and Spark's own
reader reads it. The number of splits bounds what is broadcast: 17 bytes for each.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.session import cut_lineage

# Tasks get the functions below with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

READER = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# Parts of a record that crosses splits, in the order in which one split may hold them.
WHOLE, ENDS, WITHIN, BEGINS = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _quotes(value: str) -> Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def split_states(lines: DataFrame) -> DataFrame:
    """file, block, ``split`` (hash of both), ``inside`` and ``ends_inside``: whether a split begins and ends inside quotes, and
    ``odd``, its lines with an odd number of quotes."""
    odd = F.count_if(_quotes("value") % 2 == 1).alias("odd")
    splits = cut_lineage(lines.groupBy("file", "block").agg(odd))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("odd").over(upto)
    return splits.select(
        "file", "block", "odd", F.xxhash64("file", "block").alias("split"),
        ((total - F.col("odd")) % 2 == 1).alias("inside"), (total % 2 == 1).alias("ends_inside"),
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of every split, and what it has of records that begin or end in others. The first record of a file, its header,
    is marked. Input: value, split, inside, first (whether the split is the first one of its file)."""
    names = ["split", "kind", "header", "record"]
    split, held, state = None, [], 0
    beginning, first = False, False

    def close(kind: int) -> pa.RecordBatch:
        nonlocal held, first, beginning
        row = [pa.array([split]), pa.array([kind], pa.int32()), pa.array([first and not beginning]), pa.array(["\n".join(held)])]
        first, held, beginning = first and beginning, [], False
        return pa.RecordBatch.from_arrays(row, names)

    def rest() -> Iterator[pa.RecordBatch]:
        """What is open when a split ends: the record that begins in it, or, if none ended, all its lines."""
        if held:
            yield close(WITHIN if beginning else BEGINS)

    for batch in batches:
        values, splits = batch.column(0), batch.column(1).to_numpy()
        odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.concatenate([[True], splits[1:] != splits[:-1], [True]])) if len(splits) else []
        for start, end in zip(cuts[:-1], cuts[1:]):
            if splits[start] != split:
                yield from rest()
                split, held = int(splits[start]), []
                state = int(batch.column(2)[int(start)].as_py())
                beginning, first = bool(state), batch.column(3)[int(start)].as_py()
            after = (state + np.cumsum(odd[start:end])) % 2
            ends = np.flatnonzero(after == 0)  # lines that end a record
            at = 0
            if len(ends) and (held or beginning):
                held += values.slice(start, int(ends[0]) + 1).to_pylist()
                yield close(ENDS if beginning else WHOLE)
                at = int(ends[0]) + 1
            if len(ends) and first and at <= ends[-1]:
                stop = int(ends[ends >= at][0]) + 1
                held = values.slice(start + at, stop - at).to_pylist()
                yield close(WHOLE)
                at = stop
            ends = ends[ends >= at]
            if len(ends):
                begins = np.concatenate([[at], ends[:-1] + 1])
                lone = begins == ends
                alone = values.slice(start, end - start).take(pa.array(ends[lone], pa.int64()))
                texts = [alone]
                if not lone.all():
                    lines = values.slice(start, int(ends[-1]) + 1).to_pylist()
                    texts.append(pa.array(["\n".join(lines[b : e + 1]) for b, e in zip(begins[~lone], ends[~lone])], pa.string()))
                for text in texts:
                    n = len(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, split)), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n, bool)), text.cast(pa.string())], names
                    )
                at = int(ends[-1]) + 1
            held += values.slice(start + at, end - start - at).to_pylist()
            state = int(after[-1])
    yield from rest()


PART = "split long, kind int, header boolean, record string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``header`` and ``record`` of every record of the files at a path, whatever line breaks it has inside quotes."""
    lines = _lines(spark, path)
    states = cut_lineage(split_states(lines))
    return _records(lines, states)


def _records(lines: DataFrame, states: DataFrame) -> DataFrame:
    known = lines.withColumn("split", F.xxhash64("file", "block")).select("value", "split", (F.col("block") == 0).alias("first"))
    begun = F.broadcast(states.select("split", "inside", "ends_inside"))
    unknown = F.raise_error(F.lit("the files or their splits have changed while they were read")).cast("boolean")
    lined = known.join(begun, "split", "left").withColumn("inside", F.coalesce("inside", unknown))
    fed = lined.select("value", "split", "inside", "first")
    whole = fed.mapInArrow(_parts, PART).where(F.col("kind") == WHOLE).select("header", "record")
    crossing = lined.where(F.col("inside") | F.col("ends_inside")).select("value", "split", "inside", "first")
    parts = crossing.mapInArrow(_parts, PART).where(F.col("kind") != WHOLE)
    placed = parts.join(F.broadcast(states.select("split", "file", "block")), "split")
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.last(F.when(F.col("kind") == BEGINS, F.col("block")), ignorenulls=True).over(order)
    pieces = F.sort_array(F.collect_list(F.struct("block", "kind", "record")))
    joined = (
        placed.withColumn("opened", opened)
        .groupBy("file", "opened")
        .agg(F.bool_or("header").alias("header"), F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"))
        .select("header", "record")
    )
    return whole.unionByName(joined)


def read_delimited(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All columns of delimited files with a header as text, in as many partitions as their size gives. Without ``multiline``
    every line is a record."""
    names = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, **READER).schema.names
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if not multiline:
        return spark.read.csv(path, schema=schema, header=True, enforceSchema=True, **READER)
    lines = _lines(spark, path)
    states = cut_lineage(split_states(lines))
    if not states.where("odd > 0").limit(1).count():
        return spark.read.csv(path, schema=schema, header=True, enforceSchema=True, **READER)
    records = _records(lines, states).where("NOT header")
    ended = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    written = records.select(ended.alias("record")).where("record <> ''")
    ddl = ", ".join(f"c{n} STRING" for n in range(len(names)))
    cells = written.select(F.from_csv("record", ddl, {**{k: str(v).lower() for k, v in READER.items()}, "multiLine": "true"}).alias("cells"))
    return cells.select(*[F.col(f"cells.c{n}").alias(name) for n, name in enumerate(names)])
