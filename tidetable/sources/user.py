"""Sources and sinks that a user supplies, through Spark's Python data source interface.

A `Script` says how far a source has got and gives the rows between two places; Spark calls it as a stream with
offsets: what a batch reads is fixed before it is read, split over tasks, and after a restart goes on behind the last committed
place. `FolderScript` is a script of parquet files that appear in a folder, in the order of their names. The sink writes one parquet file
per task and makes a batch visible by one commit file, so a batch that is tried again counts once.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# executors receive sources, scripts and sinks by value, so they need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Script:
    """What a user source has to say: places are whole numbers from 0 on."""

    def reached(self) -> int:
        """The place behind the last row that is there; never goes back."""
        raise NotImplementedError

    def batches(self, place: int) -> Iterator[pa.RecordBatch]:
        """The rows of one place."""
        raise NotImplementedError


@dataclass
class FolderScript(Script):
    """One place per parquet file of a folder that all tasks can reach; later files need later names."""

    path: str

    def _files(self) -> tuple[pyarrow.fs.FileSystem, list[str]]:
        system, root = filesystem(self.path)
        found = system.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
        return system, sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet"))

    def reached(self) -> int:
        return len(self._files()[1])

    def batches(self, place: int) -> Iterator[pa.RecordBatch]:
        system, files = self._files()
        with system.open_input_file(files[place]) as held:
            yield from pyarrow.parquet.ParquetFile(held, coerce_int96_timestamp_unit="us").iter_batches()


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or address, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path)
    return pyarrow.fs.LocalFileSystem(), path


def publish(source: str, path: str, prefix: str) -> None:
    """Move the parquet files of one folder into a script's folder, under names that begin with ``prefix``."""
    system, root = filesystem(source)
    target = filesystem(path)[1]
    for file in system.get_file_info(pyarrow.fs.FileSelector(root)):
        if file.base_name.endswith(".parquet"):
            system.move(file.path, f"{target}/{prefix}-{file.base_name}")


@dataclass
class _Place(InputPartition):
    place: int


class _Reader(DataSourceStreamReader):
    def __init__(self, script: Script, schema: pa.Schema):
        self.script, self.schema = script, schema

    def initialOffset(self) -> dict:
        return {"place": 0}

    def latestOffset(self) -> dict:
        return {"place": self.script.reached()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Place(place) for place in range(start["place"], end["place"])]

    def read(self, partition: _Place) -> Iterator[pa.RecordBatch]:
        for batch in self.script.batches(partition.place):
            yield from pa.Table.from_batches([batch]).select(self.schema.names).cast(self.schema).to_batches()

    def commit(self, end: dict) -> None:
        pass


def register_source(spark: SparkSession, name: str, schema: StructType, script: Script) -> None:
    """Make a script known as the streaming format ``name``; its rows are cast to the schema."""
    arrow = to_arrow_schema(schema)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return schema

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _Reader(script, arrow)

    spark.dataSource.register(Source)


@dataclass
class _Written(WriterCommitMessage):
    file: str | None


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = filesystem(self.path)
        system.create_dir(f"{root}/data", recursive=True)
        name, writer = f"{uuid.uuid4().hex}.parquet", None
        for batch in iterator:
            if writer is None:
                writer = pyarrow.parquet.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
        if writer is None:
            return _Written(None)
        writer.close()
        return _Written(name)

    def commit(self, messages: list[_Written | None], batchId: int) -> None:
        system, root = filesystem(self.path)
        system.create_dir(f"{root}/commits", recursive=True)
        draft = f"{root}/commits/{batchId}.{uuid.uuid4().hex}.draft"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps([m.file for m in messages if m is not None and m.file]).encode())
        system.move(draft, f"{root}/commits/{batchId:019d}.json")

    def abort(self, messages: list[_Written | None], batchId: int) -> None:
        """Files that no commit names are not read."""


class CommittedFiles(DataSource):
    """The streaming sink ``committed_files`` with option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _Writer(self.options["path"])


def committed_files_sink(spark: SparkSession, path: str):
    """A sink for `run.drain` and its like; `read_committed` reads what it holds.

    Each sink gets a name of its own: a new session copies the formats its parent knows, and a name known twice is an error.
    """
    name = f"committed_files_{uuid.uuid4().hex[:8]}"

    class Sink(CommittedFiles):
        @classmethod
        def name(cls) -> str:
            return name

    spark.dataSource.register(Sink)  # a stream copies the formats of its session when it starts
    active = SparkSession.getActiveSession()
    if active is not None and not active._jsparkSession.equals(spark._jsparkSession):  # formats of sinks are looked up in the active session
        try:
            active.dataSource.register(Sink)
        except AnalysisException as known:
            if known.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":  # copied from a session it was registered in
                raise
    return lambda writer: writer.format(name).option("path", path)


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of committed batches."""
    system, root = filesystem(path)
    names: list[str] = []
    for commit in system.get_file_info(pyarrow.fs.FileSelector(f"{root}/commits", allow_not_found=True)):
        if commit.base_name.endswith(".json"):
            with system.open_input_stream(commit.path) as held:
                names += json.loads(held.read())
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{name}" for name in names])
