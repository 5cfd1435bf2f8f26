"""Loads that are published as a whole, with tasks that fail and run again."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mapstrata.sinks.staged import load_statements, published, read_loads, staged_load

ROOT = Path(__file__).resolve().parents[1]
SCHEMA = "id long, `a.b` string, x double, ok boolean, d date"


def table(spark):
    texts = ["plain", "", None, 'quo"ted', "two\nlines", "com,ma", " spaced ", "ñ"]
    rows = [(i, texts[i % 8], i / 7 if i % 5 else None, i % 2 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, `a.b` string, x double, ok boolean")
    return df.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_round_trip_and_second_load(spark, tmp_path):
    df = table(spark)
    folder = f"file://{tmp_path}/loads"
    staged_load(df.where("id < 150").repartition(6), folder)
    staged_load(df.where("id >= 150").repartition(2), folder)
    found = read_loads(spark, folder)
    assert found.schema == df.schema or found.dtypes == df.dtypes
    assert rows(found) == rows(df)
    assert sum(m["rows"] for m in published(folder)) == 200


def test_failed_load_leaves_nothing(spark, tmp_path):
    df = table(spark)
    folder = str(tmp_path / "loads")
    bad = F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="no"):
        staged_load(df.repartition(8, "id").withColumn("id", bad), folder, "one")
    assert published(folder) == []
    with pytest.raises(FileNotFoundError):
        read_loads(spark, folder)
    staged_load(df.repartition(8), folder, "one")
    assert rows(read_loads(spark, folder)) == rows(df)
    with pytest.raises(ValueError, match="published already"):
        staged_load(df, folder, "one")


def test_empty_load(spark, tmp_path):
    df = table(spark).where("false")
    staged_load(df, str(tmp_path))
    assert read_loads(spark, str(tmp_path)).dtypes == df.dtypes and read_loads(spark, str(tmp_path)).count() == 0


def test_tasks_that_run_again(tmp_path):
    """Every task fails on its first attempt after it has staged rows; each row is loaded once."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from mapstrata.sinks import staged
from mapstrata.sinks.staged import published, read_loads, staged_load
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
inner = staged.StagedWriter.write
def once(self, iterator):
    message = inner(self, iterator)
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")
    return message
staged.StagedWriter.write = once
df = spark.range(0, 400, 1, 4).selectExpr("id", "concat('t', id) AS t")
staged_load(df, {str(tmp_path)!r})
found = read_loads(spark, {str(tmp_path)!r})
assert sorted(r.id for r in found.collect()) == list(range(400)), found.count()
assert published({str(tmp_path)!r})[0]["rows"] == 400
print("whole")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "whole" in done.stdout, done.stderr[-2000:]
    staged = [p.name for p in tmp_path.glob("*.csv")]
    assert len(staged) == 8  # files of the failed attempts are there, and in no manifest


def test_statements_are_one_transaction(spark, tmp_path):
    df = table(spark)
    load = staged_load(df.repartition(3), str(tmp_path))
    statements = load_statements(df, "mapas.bins", str(tmp_path), load)
    assert statements[0] == "BEGIN" and statements[-1] == "COMMIT" and len(statements) == 6
    assert statements[1].startswith('CREATE TABLE IF NOT EXISTS "mapas"."bins" (\n    id BIGSERIAL PRIMARY KEY,')
    assert all(s.startswith('COPY "mapas"."bins" ("id", "a.b", "x", "ok", "d") FROM \'') for s in statements[2:-1])
    with pytest.raises(ValueError, match="not published"):
        load_statements(df, "bins", str(tmp_path), "other")


def test_executors_need_no_copy_of_the_package(tmp_path):
    """What tasks get can be loaded, and run, where the package is not installed."""
    from pyspark import cloudpickle

    from mapstrata.sinks.staged import StagedSource, StagedWriter
    from mapstrata.sources.records import _parts

    (tmp_path / "job").write_bytes(cloudpickle.dumps((_parts, StagedSource, StagedWriter(str(tmp_path), "x", []))))
    code = (
        "import pickle, sys; sys.modules['mapstrata'] = None; import pyarrow as pa; "
        "parts, source, writer = pickle.load(open('job', 'rb')); "
        "row = pa.RecordBatch.from_arrays([pa.array(['a']), pa.array([1]), pa.array([False]), pa.array([False])], ['value', 'split', 'inside', 'first']); "
        "print([b.num_rows for b in parts(iter([row]))], source.name()); writer.commit([None])"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert done.stdout.strip() == "[1] mapstrata_staged", done.stderr[-1500:]
