"""Loads that readers see as a whole or not at all, whatever tasks fail or run twice on the way.

Every attempt of a task writes a file of its own name in the shared folder and answers with that name and its rows. Only the
answers of the attempts that Spark accepts reach the driver, which publishes them in one step: a manifest that names
the files comes into being by a rename. Files of other attempts are in no manifest; a load that fails has none and removes what
its tasks answered. Loads of one folder add up, and each is published once.

``load_statements`` gives the statements that bring published files into a database in one transaction.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from mapstrata import session
from mapstrata.session import column, located, quoted
from mapstrata.sinks.jdbc import create_table_statement, identifier
from mapstrata.sources.records import READER

# Tasks get the classes below with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(session)

FORMAT = "mapstrata_staged"
MANIFEST = ".load.json"


@dataclass
class Staged(WriterCommitMessage):
    """The file of one accepted task attempt; none where the task had no row."""

    file: str | None
    rows: int


class StagedWriter(DataSourceArrowWriter):
    """Files per task attempt, and one manifest per load."""

    def __init__(self, folder: str, load: str, fields: list[list[str]]) -> None:
        self.folder, self.load, self.fields = folder, load, fields

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        task = TaskContext.get()
        name = f"{self.load}-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.csv"
        files, folder = located(self.folder)
        rows, out = 0, None
        try:
            for batch in iterator:
                if out is None:
                    sink = files.open_output_stream(f"{folder}/{name}")
                    out = csv.CSVWriter(sink, batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
                sink.close()
        return Staged(name if rows else None, rows)

    def commit(self, messages: list[Staged | None]) -> None:
        files, folder = located(self.folder)
        accepted = [m for m in messages if m is not None]
        manifest = {"load": self.load, "fields": self.fields, "rows": sum(m.rows for m in accepted), "files": sorted(m.file for m in accepted if m.file)}
        draft = f"{folder}/.{self.load}.draft"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps(manifest).encode())
        files.move(draft, f"{folder}/{self.load}{MANIFEST}")

    def abort(self, messages: list[Staged | None]) -> None:
        files, folder = located(self.folder)
        for message in messages:
            if message is not None and message.file:
                files.delete_file(f"{folder}/{message.file}")


class StagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(self.options["folder"], self.options["load"], json.loads(self.options["fields"]))


def staged_load(df: DataFrame, folder: str, load: str | None = None) -> str:
    """Adds the rows of ``df`` to a folder that all executors share, all or none of them; the name of the load. A name that has been
    published already is refused, so a driver that starts again can repeat its load."""
    spark = df.sparkSession
    load = load or uuid.uuid4().hex
    files, path = located(folder)
    files.create_dir(path)
    if files.get_file_info(f"{path}/{load}{MANIFEST}").type != fs.FileType.NotFound:
        raise ValueError(f"the load {load} is published already")
    spark.dataSource.register(StagedSource)
    texts = df.select(*[column(f.name).cast("string").alias(f.name) for f in df.schema])
    fields = json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema])
    texts.write.format(FORMAT).options(folder=folder, load=load, fields=fields).mode("append").save()
    return load


def published(folder: str) -> list[dict]:
    """Manifests of the published loads of a folder, by name."""
    files, path = located(folder)
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    out = []
    for info in sorted(found, key=lambda i: i.base_name):
        if info.base_name.endswith(MANIFEST):
            with files.open_input_stream(info.path) as file:
                out.append(json.loads(file.read()))
    return out


def read_loads(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the published loads of a folder, in the types they were written in. Loads must have the same columns."""
    loads = published(folder)
    if not loads:
        raise FileNotFoundError(f"no load is published in {folder}")
    fields = loads[0]["fields"]
    if any(load["fields"] != fields for load in loads):
        raise ValueError("the loads of this folder have different columns")
    texts = T.StructType([T.StructField(name, T.StringType()) for name, _ in fields])
    paths = [f"{folder}/{file}" for load in loads for file in load["files"]]
    if not paths:
        return spark.createDataFrame([], ", ".join(f"{quoted(n)} {kind}" for n, kind in fields))
    # an empty cell without quotes is null, one in quotes is an empty text
    read = spark.read.csv(paths, schema=texts, header=True, multiLine=True, nullValue="\0null", emptyValue="", **READER)
    return read.select(*[column(name).cast(kind).alias(name) for name, kind in fields])


def load_statements(df: DataFrame, table: str, folder: str, load: str) -> list[str]:
    """Statements of one transaction that create the table where there is none and append a published load to it. ``df`` gives the
    columns; a name without a manifest is refused. They are texts to be run by whoever has the database."""
    found = [m for m in published(folder) if m["load"] == load]
    if not found:
        raise ValueError(f"the load {load} is not published")
    target = ".".join(map(identifier, table.split(".")))
    columns = ", ".join(identifier(f.name) for f in df.schema)
    path = folder.removeprefix("file://")
    copies = [
        f"COPY {target} ({columns}) FROM '" + f"{path}/{file}".replace("'", "''") + "' WITH (FORMAT csv, HEADER true)" for file in found[0]["files"]
    ]
    return ["BEGIN", create_table_statement(df, table, key="BIGSERIAL"), *copies, "COMMIT"]

