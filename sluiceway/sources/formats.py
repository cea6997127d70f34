"""File formats: batch and stream reading and writing by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from sluiceway.functions.structs import root
from sluiceway.operators.codec import JSON_WRITE_OPTIONS
from sluiceway.operators.steps import import_object
from sluiceway.sources import storage
from sluiceway.sources.arrow_files import ArrowFiles

OVERWRITE = "overwrite"
APPEND = "append"
UPDATE = "update"


@dataclass(frozen=True)
class FileFormat:
    """A Spark data source for files, with the options this library reads and writes it by.

    `infer` holds options that apply only while no schema is given. `flat` formats cannot
    hold nested columns.
    """

    name: str
    read_options: Mapping[str, str] = field(default_factory=dict)
    write_options: Mapping[str, str] = field(default_factory=dict)
    infer: Mapping[str, str] = field(default_factory=dict)
    flat: bool = False

    def _configured(self, reader, schema, options):
        merged = dict(self.read_options)
        if schema is None:
            merged.update(self.infer)
        else:
            reader = reader.schema(schema)
        merged.update(options or {})
        return reader.format(self.name).options(**merged)

    def read(
        self,
        spark: SparkSession,
        path: str | list[str],
        schema: StructType | str | None = None,
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        return self._configured(spark.read, schema, options).load(path)

    @staticmethod
    def typed(df: DataFrame, schema: StructType | str) -> DataFrame:
        """Stored rows with the columns and types asked for."""
        wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        return df.select(*[root(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])

    def check_append(self, spark: SparkSession, path: str) -> None:
        if _is_stream_target(spark, path):
            raise ValueError(f"{path} was written by a stream, whose log hides all other files; append to another directory")

    def read_stream(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType | str | None = None,
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Stream over a directory; without a schema it is taken from the files present now."""
        if schema is None:
            schema = self.read(spark, path, None, options).schema
        return self._configured(spark.readStream, schema, options).load(path)

    def _check(self, df: DataFrame) -> None:
        if not self.flat:
            return
        nested = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType))
        ]
        if nested:
            raise ValueError(f"{self.name} cannot hold the nested columns {nested}")

    def write(
        self,
        df: DataFrame,
        path: str,
        operation: str = OVERWRITE,
        partition_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> None:
        if operation not in (OVERWRITE, APPEND):
            raise ValueError(f"operation {operation!r} is not supported by {self.name} files")
        self._check(df)
        if operation == APPEND:
            self.check_append(df.sparkSession, path)
        # An overwrite replaces all partitions, whatever the session's mode, unless the caller asks for it.
        mode = {"partitionOverwriteMode": "static"} if operation == OVERWRITE else {}
        writer = df.write.format(self.name).options(**{**self.write_options, **mode, **(options or {})})
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.mode(operation).save(path)

    def write_stream(
        self,
        df: DataFrame,
        path: str,
        operation: str = APPEND,
        partition_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> DataStreamWriter:
        """Writer on Spark's file sink, which commits every micro-batch exactly once."""
        if operation != APPEND:
            raise ValueError(f"operation {operation!r} is not supported for a stream into {self.name} files")
        self._check(df)
        if _is_batch_target(df.sparkSession, path):
            raise ValueError(f"{path} holds files of a batch, which the log of a stream would hide; stream into another directory")
        writer = df.writeStream.format(self.name).outputMode("append").option("path", path)
        writer = writer.options(**{**self.write_options, **(options or {})})
        return writer.partitionBy(*partition_by) if partition_by else writer


@dataclass(frozen=True)
class SourceFormat(FileFormat):
    """A format that is a Python data source: a class with a reader and a writer of its own, which Spark is told of on use."""

    source: type[DataSource] | None = None

    @classmethod
    def of(cls, source: type[DataSource], **options) -> SourceFormat:
        return cls(source.name(), source=source, **options)

    def read(self, spark: SparkSession, path, schema=None, options=None) -> DataFrame:
        spark.dataSource.register(self.source)
        return super().read(spark, path, schema, options)

    def read_stream(self, spark: SparkSession, path: str, schema=None, options=None) -> DataFrame:
        spark.dataSource.register(self.source)
        return super().read_stream(spark, path, schema, options)

    def write(self, df: DataFrame, path: str, operation: str = OVERWRITE, partition_by: Sequence[str] = (), options=None) -> None:
        if partition_by:
            raise ValueError(f"{self.name} files cannot be partitioned by columns")
        df.sparkSession.dataSource.register(self.source)
        super().write(df, path, operation, (), options)

    def write_stream(self, df: DataFrame, path: str, operation: str = APPEND, partition_by: Sequence[str] = (), options=None) -> DataStreamWriter:
        if partition_by:
            raise ValueError(f"{self.name} files cannot be partitioned by columns")
        df.sparkSession.dataSource.register(self.source)
        return super().write_stream(df, path, operation, (), options)


STREAM_LOG = "_spark_metadata"


def _is_stream_target(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, f"{path.rstrip('/')}/{STREAM_LOG}")


def _is_batch_target(spark: SparkSession, path: str) -> bool:
    """Whether a directory has data but no log of a stream. Versions of an updated table are data too."""
    names = storage.children(spark, path.rstrip("/"))
    return STREAM_LOG not in names and any(not name.startswith((".", "_")) for name in names)


# Text cuts timestamps to milliseconds unless told otherwise.
_TEXT = JSON_WRITE_OPTIONS
# CSV keeps line breaks, quotes and blanks at the ends of texts. Files are then read whole, not split by line; the option
# multiLine=false on reading turns that off for files known to have one row per line.
_WHOLE_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

PARQUET = FileFormat("parquet")
ORC = FileFormat("orc")
JSON = FileFormat("json", write_options=_TEXT)
CSV = FileFormat(
    "csv",
    read_options={"header": "true", **_WHOLE_TEXT, "multiLine": "true"},
    write_options={"header": "true", **_TEXT, **_WHOLE_TEXT},
    infer={"inferSchema": "true"},
    flat=True,
)

ARROW = SourceFormat.of(ArrowFiles)

_formats: dict[str, FileFormat] = {f.name: f for f in (PARQUET, ORC, JSON, CSV, ARROW)}


def register_format(fmt: FileFormat, name: str | None = None) -> None:
    """Make a format available under a name; any Spark data source can be given this way."""
    _formats[(name or fmt.name).lower()] = fmt


def unregister_format(name: str) -> None:
    _formats.pop(name.lower(), None)


def find_format(name: str | FileFormat) -> FileFormat:
    """Format by name without regard to case, or by the dotted path of a FileFormat or of a Python data source."""
    if isinstance(name, FileFormat):
        return name
    if isinstance(name, type) and issubclass(name, DataSource):
        return SourceFormat.of(name)
    known = _formats.get(name.lower())
    if known is not None:
        return known
    if "." not in name and ":" not in name:
        raise ValueError(f"unknown file format {name!r}; register it first")
    loaded = import_object(name)
    if isinstance(loaded, type) and issubclass(loaded, DataSource):
        return SourceFormat.of(loaded)
    loaded = loaded() if isinstance(loaded, type) else loaded
    if not isinstance(loaded, FileFormat):
        raise ValueError(f"{name!r} is neither a FileFormat nor a DataSource")
    return loaded
