"""Topics on a broker, through Spark's Kafka connector where it is on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from sluiceway.operators.codec import ConnectorMissing

# Producer settings; a caller's options come after them and win.
PRODUCER_OPTIONS = {
    "kafka.compression.type": "gzip",
    "kafka.batch.size": "1048576",
    "kafka.linger.ms": "1000",
    "kafka.request.timeout.ms": "800000",
    "kafka.max.request.size": "16000000",
    "kafka.retry.backoff.ms": "1000",
    "kafka.retries": "300",
    "kafka.max.in.flight.requests.per.connection": "1",
}


# Login modules of the broker's client, per SASL mechanism.
LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}


def login_options(
    user: str,
    password: str,
    protocol: str = "SASL_SSL",
    mechanism: str = "SCRAM-SHA-512",
    truststore: str | None = None,
    truststore_password: str | None = None,
) -> dict[str, str]:
    """Connector options for a login by user and password."""
    module = LOGIN_MODULES.get(mechanism.upper())
    if module is None:
        raise ValueError(f"SASL mechanism {mechanism!r} is not supported, use one of {sorted(LOGIN_MODULES)}")
    name, secret = (text.replace("\\", "\\\\").replace('"', '\\"') for text in (user, password))
    options = {
        "kafka.security.protocol": protocol.upper(),
        "kafka.sasl.mechanism": mechanism.upper(),
        "kafka.sasl.jaas.config": f'{module} required username="{name}" password="{secret}";',
    }
    if truststore is not None:
        options["kafka.ssl.truststore.location"] = truststore
    if truststore_password is not None:
        options["kafka.ssl.truststore.password"] = truststore_password
    return options


def guarded(build):
    """What `build` gives; a missing connector is an error that says so."""
    try:
        return build()
    except AnalysisException as error:
        if "kafka" in str(error).lower() and "find" in str(error).lower():
            raise ConnectorMissing("Spark's Kafka connector is needed: add spark-sql-kafka to the class path") from error
        raise


def _options(brokers: str, options: Mapping[str, str] | None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, **(options or {})}


def read_kafka(spark: SparkSession, brokers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A topic from its earliest to its latest offset."""
    given = {"subscribe": topic, "startingOffsets": "earliest", "endingOffsets": "latest", **_options(brokers, options)}
    return guarded(lambda: spark.read.format("kafka").options(**given).load())


def stream_kafka(spark: SparkSession, brokers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A topic as a stream, from its earliest offset."""
    given = {"subscribe": topic, "startingOffsets": "earliest", **_options(brokers, options)}
    return guarded(lambda: spark.readStream.format("kafka").options(**given).load())


def append_kafka(df: DataFrame, brokers: str, topic: str, options: Mapping[str, str] | None = None) -> None:
    """Append serialized keys and values."""
    given = {**PRODUCER_OPTIONS, "topic": topic, **_options(brokers, options)}
    guarded(lambda: df.write.format("kafka").options(**given).save())


def kafka_writer(
    df: DataFrame, brokers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataStreamWriter:
    """Stream writer that appends serialized keys and values. Spark looks for the connector when it is started: see `guarded`."""
    given = {**PRODUCER_OPTIONS, "topic": topic, **_options(brokers, options)}
    return df.writeStream.format("kafka").options(**given)
