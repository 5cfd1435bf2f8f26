"""Session helpers: shared work folder, lineage cuts and column references."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost together with the executor that wrote it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the executors")
        folder = tempfile.mkdtemp(prefix="mapstrata-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def written_once(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read from there, and the folder it takes up."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with case_sensitive_names(spark):
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, in whatever store it is."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(java, True)


def located(folder: str) -> tuple[fs.FileSystem, str]:
    """File system of a folder, and the folder's path in it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def column(name: str) -> Column:
    """Reference to a column whose name may hold dots, dashes, colons or back-ticks."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def local_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """Small table of text and int columns known on the driver, as a local relation: Spark folds it
    into the plan, no Python worker reads it."""
    columns = list(zip(*rows)) if rows else [()] * len(names)
    arrays = {
        name: pa.array(values, pa.int32() if values and isinstance(values[0], int) else pa.string())
        for name, values in zip(names, columns)
    }
    return spark.createDataFrame(pa.table(arrays))


@contextmanager
def case_sensitive_names(spark: SparkSession) -> Iterator[None]:
    """Column names such as ``x-a`` and ``x-A`` are different while this is active."""
    setting = "spark.sql.caseSensitive"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def exact_names(build: Callable) -> Callable:
    """Resolve the columns of whatever ``build`` composes by exact name. Its first argument is a
    session, a DataFrame or an object with a ``sparkSession``."""

    @functools.wraps(build)
    def wrapped(first, *args, **kwargs):
        with case_sensitive_names(getattr(first, "sparkSession", first)):
            return build(first, *args, **kwargs)

    return wrapped
