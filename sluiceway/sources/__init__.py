"""Reading and writing: formats, tables, change logs and stores."""

from sluiceway.sources.changelog import append_log, read_log, stream_log
from sluiceway.sources.formats import FileFormat, find_format, register_format, unregister_format
from sluiceway.sources.kafka import append_kafka, read_kafka, stream_kafka
from sluiceway.sources.stores import (
    BrokerStore,
    ChangeLogStore,
    FileStore,
    Store,
    build_store,
    register_store,
    unregister_store,
)
from sluiceway.sources.tables import read_table, update_table

__all__ = [
    "BrokerStore",
    "ChangeLogStore",
    "FileFormat",
    "FileStore",
    "Store",
    "append_kafka",
    "append_log",
    "build_store",
    "find_format",
    "read_kafka",
    "read_log",
    "read_table",
    "register_format",
    "register_store",
    "stream_kafka",
    "stream_log",
    "unregister_format",
    "unregister_store",
    "update_table",
]
