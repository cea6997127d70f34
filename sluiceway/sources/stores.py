"""Stores: where a flow reads from and writes to, built from its description."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import BinaryType, StructType

from sluiceway.operators.codec import JSON, choose_format, decode, encode, inspect_raw
from sluiceway.operators.counts import RowCounts
from sluiceway.operators.envelope import ENVELOPE, wrap
from sluiceway.operators.governance import LOG
from sluiceway.operators.steps import flag, import_object
from sluiceway.sources import changelog, kafka, storage, tables
from sluiceway.sources.formats import APPEND, OVERWRITE, UPDATE, FileFormat, find_format

log = logging.getLogger(__name__)

BATCH = "batch"
STREAM = "stream"


class Store:
    """Base of all stores. A stream's `job` names it across restarts."""

    # True for stores that can only grow, whatever the write operation says.
    append_only = False
    # True while the schema of the data has to be taken from the data itself.
    needs_inference = False
    # False for a source whose micro-batches may come out of the order of changes.
    in_order = True
    # Columns that order the changes an update applies; the offset if there are none.
    order_by: str | Sequence[str] | None = None

    def location(self, spark: SparkSession) -> str | None:
        """URI of the directory the store lives in, if it has one."""
        return None

    def read(self, spark: SparkSession, flow_type: str) -> DataFrame:
        raise NotImplementedError

    def write(self, df: DataFrame, operation: str, data_type: str = LOG, tag: str | None = None) -> int | None:
        """Write a batch; returns the number of rows written if it is known."""
        raise NotImplementedError

    def write_stream(self, df: DataFrame, operation: str, job: str, data_type: str = LOG) -> DataStreamWriter:
        raise NotImplementedError

    def delete(self, spark: SparkSession) -> bool:
        """Delete all data of the store."""
        raise NotImplementedError


class FileStore(Store):
    """Files in one directory, on any file system that Hadoop can reach.

    `rebalance` shuffles rows for even files per partition value. Left open, this is done for
    partitioned writes whose rows come out of a shuffle by key, where each task would
    else write a file for every value. `buckets` lays out a table that is updated in so many hash
    buckets of its key; streams do so for a new table that is not partitioned by a part of the key.
    """

    def __init__(
        self,
        path: str,
        fmt: str | FileFormat,
        partition_by: Sequence[str] = (),
        schema: Any = None,
        options: Mapping[str, str] | None = None,
        rebalance: bool | None = None,
        buckets: int | None = None,
    ) -> None:
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.format = find_format(fmt)
        self.partition_by = tuple(partition_by)
        self.schema = schema
        self.options = storage.apart(path, options)
        self.rebalance = rebalance
        if self.buckets and self.partition_by:
            raise ValueError("a table has partitions or buckets, not both")

    def location(self, spark: SparkSession) -> str | None:
        with storage.hadoop_settings(self.options):
            return storage.qualified(spark, self.path)

    def read(self, spark: SparkSession, flow_type: str) -> DataFrame:
        with storage.hadoop_settings(self.options):
            if flow_type == STREAM:
                if tables.is_updated(spark, self.path):
                    raise ValueError(f"{self.path} is updated by versions or buckets and cannot be read as a stream")
                return self.format.read_stream(spark, self.path, self.schema, self.options)
            return tables.read_table(spark, self.path, self.format, self.schema, self.options)

    def write(self, df: DataFrame, operation: str, data_type: str = LOG, tag: str | None = None) -> int | None:
        with storage.hadoop_settings(self.options):
            if operation == UPDATE:
                return self._update(df, self.buckets)
            if self.rebalance:
                df = tables.balanced(df, self.partition_by)
            path = self.path
            if operation != OVERWRITE:
                if tables.is_bucketed(df.sparkSession, path):
                    raise ValueError(f"{path} is a table in buckets of its key: update it")
                path = tables.current_path(df.sparkSession, path)
                if tag is not None and operation == APPEND:
                    return tables.append_files(df, path, self.format, self.partition_by, self.options, tag)
            # Counted above any shuffle, where a task run again is not counted again.
            counts = RowCounts()
            self.format.write(counts.register(df), path, operation, self.partition_by, self.options)
            return counts.value()

    def _update(self, changes: DataFrame, buckets: int | None) -> int:
        return tables.update_table(
            changes,
            self.path,
            self.format,
            self.partition_by,
            self.order_by,
            self.schema,
            self.options,
            bool(self.partition_by) if self.rebalance is None else self.rebalance,
            buckets,
        )

    def write_stream(self, df: DataFrame, operation: str, job: str, data_type: str = LOG) -> DataStreamWriter:
        if operation != UPDATE:
            with storage.hadoop_settings(self.options):
                return self.format.write_stream(df, self.path, operation, self.partition_by, self.options)

        def update(batch: DataFrame, batch_id: int) -> None:
            if batch.isEmpty():
                return
            with storage.hadoop_settings(self.options):
                buckets = self.buckets
                if buckets is None and not self.partition_by and not tables.versions(batch.sparkSession, self.path):
                    # Each micro-batch rewrites what it touches only.
                    buckets = tables.buckets_of(batch.sparkSession, self.path)
                self._update(batch, buckets)

        return df.writeStream.foreachBatch(update)

    def delete(self, spark: SparkSession) -> bool:
        with storage.hadoop_settings(self.options):
            return storage.delete(spark, self.path)


class EnvelopeStore(Store):
    """Common part of the stores that hold serialized keys and values."""

    append_only = True

    def __init__(
        self,
        fmt: str = JSON,
        key_schema: str | None = None,
        value_schema: str | None = None,
        registry: Mapping[str, Mapping[int, str]] | None = None,
        raw: bool = False,
    ) -> None:
        self.format = fmt
        self.schemas = {"value_schema": value_schema, "key_schema": key_schema, "registry": registry}
        self.raw = raw
        self.needs_inference = fmt == JSON and value_schema is None
        if key_schema is not None and value_schema is None:
            raise ValueError("a key schema needs a value schema")

    def envelope(self, spark: SparkSession, flow_type: str) -> DataFrame:
        """Rows as they are stored."""
        raise NotImplementedError

    def append(self, df: DataFrame, tag: str | None = None) -> int | None:
        """Append serialized rows; returns their number if it is known."""
        raise NotImplementedError

    # Columns besides key and value that `append` makes use of.
    def carried(self, df: DataFrame) -> list[str]:
        return []

    def read(self, spark: SparkSession, flow_type: str) -> DataFrame:
        rows = self.envelope(spark, flow_type)
        if self.raw:
            if flow_type == STREAM:
                raise ValueError("raw reading is for batch flows")
            return inspect_raw(rows, fmt=self.format, **self.schemas)
        if flow_type == STREAM and self.needs_inference:
            return rows
        return decode(rows, self.format, **self.schemas)

    def serialized(self, df: DataFrame, data_type: str) -> DataFrame:
        """Rows ready to append; log data that is no envelope becomes the `value`."""
        if data_type == LOG and not self._is_envelope(df):
            df = wrap(df)
        return encode(df, self.format, keep=self.carried(df), **self.schemas)

    @staticmethod
    def _is_envelope(df: DataFrame) -> bool:
        """Rows as a topic holds them. Any other column means a table that happens to have a `value`."""
        if "value" not in df.columns or not set(df.columns) <= set(ENVELOPE.names):
            return False
        return isinstance(df.schema["value"].dataType, (StructType, BinaryType))

    def write(self, df: DataFrame, operation: str, data_type: str = LOG, tag: str | None = None) -> int | None:
        if operation != APPEND:
            log.warning("a topic only grows: the rows are appended")
        return self.append(self.serialized(df, data_type), tag)


class ChangeLogStore(EnvelopeStore):
    """A change log in files, see `sluiceway.sources.changelog`."""

    def __init__(
        self,
        path: str,
        partitions: int | None = None,
        order_by: str | Sequence[str] | None = None,
        max_files: int | None = None,
        options: Mapping[str, str] | None = None,
        **serialization: Any,
    ) -> None:
        super().__init__(**serialization)
        self.path = path.rstrip("/")
        self.partitions = partitions
        self.order_by = order_by
        self.max_files = max_files
        self.options = storage.apart(path, options)

    @property
    def in_order(self) -> bool:
        """Whether a later micro-batch of a stream holds later changes only."""
        return self.max_files is None

    def location(self, spark: SparkSession) -> str | None:
        with storage.hadoop_settings(self.options):
            return storage.qualified(spark, self.path)

    def envelope(self, spark: SparkSession, flow_type: str) -> DataFrame:
        with storage.hadoop_settings(self.options):
            if flow_type == STREAM:
                return changelog.stream_log(spark, self.path, self.max_files)
            return changelog.read_log(spark, self.path)

    def carried(self, df: DataFrame) -> list[str]:
        if self.order_by:
            return [self.order_by] if isinstance(self.order_by, str) else list(self.order_by)
        # Rows of another log keep their offsets.
        return ["offset"] if "offset" in df.columns else []

    def append(self, df: DataFrame, tag: str | None = None) -> int | None:
        with storage.hadoop_settings(self.options):
            return changelog.append_log(df, self.path, self.partitions, self.order_by, tag, bool(self.order_by) or None)

    def write_stream(self, df: DataFrame, operation: str, job: str, data_type: str = LOG) -> DataStreamWriter:
        def append(batch: DataFrame, batch_id: int) -> None:
            if not batch.isEmpty():
                self.write(batch, operation, data_type, tag=f"{job}#{batch_id}")

        return df.writeStream.foreachBatch(append)

    def delete(self, spark: SparkSession) -> bool:
        with storage.hadoop_settings(self.options):
            return storage.delete(spark, self.path)


class BrokerStore(EnvelopeStore):
    """A topic on a broker, see `sluiceway.sources.kafka`."""

    def __init__(self, brokers: str, topic: str, options: Mapping[str, str] | None = None, **serialization: Any):
        super().__init__(**serialization)
        self.brokers = brokers
        self.topic = topic
        self.options = dict(options or {})

    def envelope(self, spark: SparkSession, flow_type: str) -> DataFrame:
        read = kafka.stream_kafka if flow_type == STREAM else kafka.read_kafka
        return read(spark, self.brokers, self.topic, self.options)

    def append(self, df: DataFrame, tag: str | None = None) -> int | None:
        counts = RowCounts()
        kafka.append_kafka(counts.register(df), self.brokers, self.topic, self.options)
        return counts.value()

    def write_stream(self, df: DataFrame, operation: str, job: str, data_type: str = LOG) -> DataStreamWriter:
        return kafka.kafka_writer(self.serialized(df, data_type), self.brokers, self.topic, self.options)

    def delete(self, spark: SparkSession) -> bool:
        raise ValueError(f"topic {self.topic!r} is on a broker, which keeps and deletes its data by its own rules: delete it there")


def snake(name: str) -> str:
    """camelCase to snake_case."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def _settings(config: Mapping[str, Any], known: set[str], needed: set[str], store: str) -> dict[str, Any]:
    settings = {k if "." in k else snake(k): v for k, v in config.items()}
    unknown = {k for k in settings if k not in known and "." not in k}
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)} of store {store!r}, use {sorted(known)}")
    missing = needed - set(settings)
    if missing:
        raise ValueError(f"store {store!r} needs the settings {sorted(missing)}")
    return settings


FILE_SETTINGS = {"path", "data_format", "partition_by", "schema", "options", "rebalance", "buckets"}


def _file_arguments(s: Mapping[str, Any]) -> dict[str, Any]:
    return {
        "fmt": s["data_format"],
        "partition_by": s.get("partition_by") or (),
        "schema": s.get("schema"),
        "rebalance": flag(s["rebalance"]) if "rebalance" in s else None,
        "buckets": int(s["buckets"]) if s.get("buckets") else None,
    }


def _build_files(config: Mapping[str, Any], role: str) -> Store:
    s = _settings(config, FILE_SETTINGS, {"path", "data_format"}, "local")
    return FileStore(path=s["path"], options=s.get("options"), **_file_arguments(s))


def object_url(bucket: str, key: str, scheme: str = "s3a") -> str:
    return f"{scheme}://{bucket}/{key.lstrip('/')}"


def _build_objects(config: Mapping[str, Any], role: str) -> Store:
    """Files in a bucket, through the S3A file system; endpoint and credentials hold for this bucket."""
    known = (FILE_SETTINGS - {"path"}) | {
        "endpoint",
        "bucket",
        "object_key",
        "region",
        "access_key",
        "secret_key",
        "api_key",
        "service_instance",
        "scheme",
    }
    s = _settings(config, known, {"endpoint", "bucket", "object_key", "data_format"}, "s3")
    if "api_key" in s:
        log.warning("api_key is not used, give access_key and secret_key or configure the session")
    prefix = f"fs.s3a.bucket.{s['bucket']}."
    named = {"endpoint": "endpoint", "endpoint.region": "region", "access.key": "access_key", "secret.key": "secret_key"}
    options = {prefix + k: str(s[v]) for k, v in named.items() if v in s}
    options[prefix + "path.style.access"] = "true"
    options.update(s.get("options") or {})
    return FileStore(
        path=object_url(s["bucket"], s["object_key"], s.get("scheme", "s3a")), options=options, **_file_arguments(s)
    )


SERIALIZATION_SETTINGS = {
    "serialization_format",
    "data_format",
    "key_deserializer",
    "value_deserializer",
    "key_schema",
    "value_schema",
    "schemas",
    "raw",
}


def _registered(schemas: Mapping[str, Mapping[Any, str]] | None) -> dict[str, dict[int, str]] | None:
    """Registered schemas with numeric ids, which are text in JSON."""
    if schemas is None:
        return None
    return {part: {int(i): schema for i, schema in known.items()} for part, known in schemas.items()}


def _serialization(s: Mapping[str, Any]) -> dict[str, Any]:
    return {
        "fmt": choose_format(
            s.get("serialization_format"), s.get("data_format"), s.get("key_deserializer"), s.get("value_deserializer")
        ),
        "key_schema": s.get("key_schema"),
        "value_schema": s.get("value_schema"),
        "registry": _registered(s.get("schemas")),
        "raw": flag(s.get("raw", False)),
    }


def _build_log(config: Mapping[str, Any], role: str) -> Store:
    known = SERIALIZATION_SETTINGS | {"path", "partitions", "order_by", "max_files_per_trigger", "options"}
    s = _settings(config, known, {"path"}, "changelog")
    most = int(s["max_files_per_trigger"]) if s.get("max_files_per_trigger") else None
    return ChangeLogStore(s["path"], s.get("partitions"), s.get("order_by"), most, s.get("options"), **_serialization(s))


def _build_broker(config: Mapping[str, Any], role: str) -> Store:
    login = {
        "security_protocol": "protocol",
        "sasl_mechanism": "mechanism",
        "ssl_truststore_location": "truststore",
        "ssl_truststore_password": "truststore_password",
    }
    # Settings that name what is looked up or written elsewhere, and what to give instead.
    instead = {
        "schema_registry_url": "give registered schemas as 'schemas'",
        "ssl_truststore": "put the file on all executors and give 'sslTruststoreLocation'",
        "credentials": "give 'user' and 'password'",
        "secret_import": "give 'user' and 'password'",
    }
    known = SERIALIZATION_SETTINGS | {"kafka_brokers", "kafka_topic", "options", "user", "password"} | set(login) | set(instead)
    s = _settings(config, known, {"kafka_brokers", "kafka_topic"}, "kafka")
    for name in instead.keys() & s.keys():
        log.warning("the setting %r is not used: %s", name, instead[name])
    options = {}
    if s.get("user"):
        given = {login[k]: str(v) for k, v in s.items() if k in login}
        options = kafka.login_options(s["user"], s.get("password", ""), **given)
    options.update({k: str(v) for k, v in s.items() if "." in k})
    options.update(s.get("options") or {})
    return BrokerStore(s["kafka_brokers"], s["kafka_topic"], options, **_serialization(s))


Builder = Callable[[Mapping[str, Any], str], Store]

# The order decides when a description holds more than one.
_builders: dict[str, Builder] = {
    "s3": _build_objects,
    "cos": _build_objects,
    "kafka": _build_broker,
    "changelog": _build_log,
    "topic": _build_log,
    "local": _build_files,
    "files": _build_files,
}


def register_store(name: str, builder: Builder) -> None:
    """Make a store available under a key of `source` and `destination`."""
    _builders[name] = builder


def unregister_store(name: str) -> None:
    _builders.pop(name, None)


def build_store(config: Mapping[str, Any] | Store, role: str) -> Store:
    """Store for a `source` or `destination` entry: by a registered key, else by `class`."""
    if isinstance(config, Store):
        return config
    for name, builder in _builders.items():
        if name in config:
            return builder(config[name], role)
    if "class" in config:
        found = config["class"]
        found = import_object(found) if isinstance(found, str) else found
        return found({k: v for k, v in config.items() if k != "class"}, role)
    raise ValueError(f"{role}: no known store in {sorted(config)}, use one of {sorted(_builders)} or 'class'")


__all__ = [
    "BATCH",
    "STREAM",
    "BrokerStore",
    "ChangeLogStore",
    "EnvelopeStore",
    "FileStore",
    "Store",
    "build_store",
    "object_url",
    "register_store",
    "unregister_store",
]
