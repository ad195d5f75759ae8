"""A connector whose appends happen whole or not at all: a Python data source for Spark.

Tasks write Parquet files that nobody reads yet. When all of them are done the driver moves one
small list of the files into ``commits``, and with that the append has happened; a task that
is repeated after a lost executor leaves a file that is in no list and is deleted. An append
that fails leaves no row.

    spark.dataSource.register(CommittedTables)
    df.write.format("committed").option("folder", shared).option("dbtable", "gold.FACT").mode("append").save()

The folder must be one that driver and executors share. Every committed file is a partition of
a scan. Columns that later appends bring are NULL in earlier files. A table without an append
has no columns. Scans read all columns: Spark passes this kind of source no projection.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "committed"


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


@dataclass
class File(InputPartition):
    path: str


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given as a path or an address, and the path there."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _commits(folder: str) -> list[dict]:
    """The finished appends in their order: one small file each."""
    files, path = _opened(f"{folder}/commits")
    listed = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    found = []
    for name in sorted(f.path for f in listed if f.path.endswith(".json")):
        with files.open_input_stream(name) as stream:
            found.append(json.loads(stream.read()))
    return sorted(found, key=lambda c: (c["number"], c["append"]))


class CommittedTables(DataSource):
    """Options: ``folder``, shared by driver and executors, and ``dbtable``, the table's name in it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _folder(self) -> str:
        return f"{self.options['folder'].rstrip('/')}/{self.options['dbtable']}"

    def schema(self) -> T.StructType:
        """The columns of all appends, in the order they came."""
        fields = {}
        for commit in _commits(self._folder()):
            for field in T.StructType.fromJson(commit["schema"]):
                fields.setdefault(field.name, field)
        return T.StructType(list(fields.values()))

    def reader(self, schema: T.StructType) -> CommittedReader:
        return CommittedReader(self._folder(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        if overwrite:
            raise ValueError("tables of this connector only take appends")
        return CommittedWriter(self._folder(), schema)


class CommittedReader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.wanted = folder, schema

    def partitions(self) -> list[File]:
        return [File(f"{self.folder}/{name}") for commit in _commits(self.folder) for name in commit["files"]]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a table without rows is read by one task
            return
        files, path = _opened(partition.path)
        arrow = to_arrow_schema(self.wanted)
        with files.open_input_file(path) as source:
            stored = pq.ParquetFile(source)
            present = [f.name for f in arrow if f.name in stored.schema_arrow.names]
            for batch in stored.iter_batches(columns=present):
                columns = [
                    batch.column(f.name).cast(f.type) if f.name in present else pa.nulls(batch.num_rows, f.type)
                    for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, schema: T.StructType):
        nullable = [T.StructField(f.name, f.dataType) for f in schema]
        self.folder, self.given, self.append = folder, T.StructType(nullable), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file, batch by batch; a task without rows writes none."""
        name, rows, out = f"data/{self.append}/{uuid.uuid4().hex}.parquet", 0, None
        files, path = _opened(f"{self.folder}/{name}")
        arrow = to_arrow_schema(self.given)
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        out = pq.ParquetWriter(path, arrow, filesystem=files, compression="zstd")
                    out.write_table(pa.Table.from_batches([batch]).cast(arrow))
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        """List the files of all tasks; moving the list to its place is the append."""
        written = [m for m in messages if m is not None and m.rows]
        number = max((c["number"] for c in _commits(self.folder)), default=0) + 1
        append = {
            "append": self.append,
            "number": number,
            "rows": sum(m.rows for m in written),
            "files": [m.file for m in written],
            "schema": self.given.jsonValue(),
        }
        files, path = _opened(f"{self.folder}/commits")
        files.create_dir(path, recursive=True)
        waiting = f"{path}/{self.append}.waiting"
        with files.open_output_stream(waiting) as stream:
            stream.write(json.dumps(append).encode())
        files.move(waiting, f"{path}/{number:012d}-{self.append}.json")
        self._delete_but({m.file.rsplit("/", 1)[1] for m in written})

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing of this append was listed: delete what its tasks wrote."""
        self._delete_but(set())

    def _delete_but(self, kept: set[str]) -> None:
        files, path = _opened(f"{self.folder}/data/{self.append}")
        for found in files.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if found.base_name not in kept:
                files.delete_file(found.path)
