"""Arrow IPC files as a data source of their own: read file by file, written all or nothing.

Tasks write whole record batches below `_temporary`; the commit on the driver moves the files into place, and an abort
deletes them, so a reader never sees a part of a write. Paths are those that Arrow's file systems know (local and
mounted ones, HDFS, S3, GCS); other ones are for the built-in formats.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

SUFFIX = ".arrow"
TEMPORARY = "_temporary"


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        # Hadoop writes local paths with one slash.
        path = f"file:///{rest.lstrip('/')}" if scheme == "file" else path
        return fs.FileSystem.from_uri(path.rstrip("/"))
    return fs.LocalFileSystem(), path.rstrip("/")


def _data_files(place: fs.FileSystem, path: str) -> list[str]:
    found = place.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(info.path for info in found if info.is_file and info.path.endswith(SUFFIX))


@dataclass
class File(InputPartition):
    path: str


class ArrowFiles(DataSource):
    """`spark.read.format("arrow").load(path)`; the schema is that of the first file, or the one that is given."""

    @classmethod
    def name(cls) -> str:
        return "arrow"

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("a path is needed")
        return path

    def schema(self) -> StructType:
        place, path = _located(self._path())
        files = _data_files(place, path)
        if not files:
            raise ValueError(f"there are no Arrow files at {path}; give a schema")
        with place.open_input_file(files[0]) as source:
            return from_arrow_schema(pa.ipc.open_file(source).schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowFilesReader(self._path(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowFilesWriter(self._path(), schema, overwrite)


class ArrowFilesReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path = path
        self.wanted = schema

    def partitions(self) -> list[File]:
        place, path = _located(self.path)
        return [File(file) for file in _data_files(place, path)]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        """Batches of one file, with the columns of the schema by name."""
        if partition is None:
            return
        place, _ = _located(self.path)
        wanted = to_arrow_schema(self.wanted)
        with place.open_input_file(partition.path) as source:
            reader = pa.ipc.open_file(source)
            for number in range(reader.num_record_batches):
                batch = reader.get_batch(number)
                columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(len(batch), f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class ArrowFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool) -> None:
        self.path = path
        self.kind = schema
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file per task that has rows. A task that is tried again writes another file, of which only one is committed."""
        place, path = _located(self.path)
        file, sink, writer = f"{path}/{TEMPORARY}/{self.job}/part-{uuid.uuid4().hex}{SUFFIX}", None, None
        schema = to_arrow_schema(self.kind)
        try:
            for batch in iterator:
                if writer is None:
                    place.create_dir(file.rpartition("/")[0], recursive=True)
                    sink = place.open_output_stream(file)
                    writer = pa.ipc.new_file(sink, schema)
                writer.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)], schema=schema))
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return Written([file] if writer is not None else [])

    def commit(self, messages: list[Written | None]) -> None:
        """New files first, then the old ones of an overwrite go: what fails in between leaves rows twice, never none."""
        place, path = _located(self.path)
        place.create_dir(path, recursive=True)
        before = _data_files(place, path) if self.overwrite else []
        new = [file for message in messages if message for file in message.files]
        if not new:
            # A schema has to be left for readers.
            new = [f"{path}/{TEMPORARY}/{self.job}/part-{uuid.uuid4().hex}{SUFFIX}"]
            place.create_dir(new[0].rpartition("/")[0], recursive=True)
            with place.open_output_stream(new[0]) as sink, pa.ipc.new_file(sink, to_arrow_schema(self.kind)):
                pass
        for file in new:
            place.move(file, f"{path}/{file.rpartition('/')[2]}")
        for file in before:
            place.delete_file(file)
        self._clean(place, path)
        with place.open_output_stream(f"{path}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(*_located(self.path))

    def _clean(self, place: fs.FileSystem, path: str) -> None:
        own = f"{path}/{TEMPORARY}/{self.job}"
        if place.get_file_info(own).type == fs.FileType.Directory:
            place.delete_dir(own)
        if not place.get_file_info(fs.FileSelector(f"{path}/{TEMPORARY}", allow_not_found=True)):
            if place.get_file_info(f"{path}/{TEMPORARY}").type == fs.FileType.Directory:
                place.delete_dir(f"{path}/{TEMPORARY}")
