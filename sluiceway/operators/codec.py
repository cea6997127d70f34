"""Serialization of keys and values: JSON, and Avro where Spark's Avro module is present."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DecimalType,
    DoubleType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from sluiceway.functions.framing import frame, payload, schema_id
from sluiceway.functions.json_text import JSON_WRITE_OPTIONS
from sluiceway.functions.structs import replace_column, root

log = logging.getLogger(__name__)

JSON = "json"
AVRO = "avro"

# Deserializer classes in connector settings.
AVRO_DESERIALIZER = "io.confluent.kafka.serializers.KafkaAvroDeserializer"
JSON_DESERIALIZER = "io.confluent.kafka.serializers.json.KafkaJsonSchemaDeserializer"


class ConnectorMissing(RuntimeError):
    """A Spark module that is not on the class path is needed."""


def choose_format(
    serialization_format: str | None = None,
    data_format: str | None = None,
    key_deserializer: str | None = None,
    value_deserializer: str | None = None,
) -> str:
    """Serialization format from a store's settings, the most explicit first; JSON without any."""
    deserializer = key_deserializer or AVRO_DESERIALIZER
    if deserializer != (value_deserializer or AVRO_DESERIALIZER):
        raise ValueError("key and value must have the same deserializer")
    named = serialization_format or data_format
    if named is None and (key_deserializer or value_deserializer):
        named = JSON if deserializer == JSON_DESERIALIZER else AVRO
    named = (named or JSON).lower()
    if named not in (JSON, AVRO):
        raise ValueError(f"serialization format {named!r} is not supported, use json or avro")
    return named


def _check_schemas(key_schema: str | None, value_schema: str | None, registry: object) -> None:
    if key_schema is not None and value_schema is None:
        raise ValueError("a key schema needs a value schema")
    if registry is not None and (key_schema is not None or value_schema is not None):
        raise ValueError("give either schemas or a table of registered schemas, not both")


def _text(column: Column) -> Column:
    return column.cast("string")


FAIL = "fail"
KEEP = "keep"
MALFORMED = "malformed"


# Digits that a double always holds, and digits that a decimal can have.
DOUBLE_DIGITS, DECIMAL_DIGITS = 15, 38
# A number between the signs of JSON: a whole one, and one with more digits than a decimal.
_WHOLE = r"([:\[,]\s*-?[0-9]{1,37})(?=\s*[,}\]])"
_LONG = rf"([:\[,]\s*)(-?[0-9][0-9.]{{{DECIMAL_DIGITS},}}(?:[eE][+-]?[0-9]+)?)(?=\s*[,}}\]])"


def _long_numbers_quoted(text: Column) -> Column:
    """JSON in which numbers with more digits than a decimal are texts: as numbers they would be read as doubles. Digits
    within a text are left alone, as quotes around them would make it no JSON."""
    quoted = F.regexp_replace(text, _LONG, '$1"$2"')
    return F.when(text.rlike(f"[0-9][0-9.]{{{DECIMAL_DIGITS}}}") & F.try_parse_json(quoted).isNotNull(), quoted).otherwise(text)


def _parsed(column: str, schema: str | StructType, fields: Iterable[str] | None, long_numbers: bool = False) -> Column:
    """Decoded text; what is no JSON of the schema, empty text included, is an error, as is a field that is not listed."""
    text = _text(F.col(column))
    if long_numbers:
        text = _long_numbers_quoted(text)
    checked = F.when(F.trim(text) == "", F.raise_error(F.lit(f"empty text in {column}, which is no JSON")).cast("string")).otherwise(text)
    if fields is not None:
        unknown = F.array_except(F.json_object_keys(text), F.array(*[F.lit(name) for name in fields]).cast("array<string>"))
        found = F.concat(F.lit(f"{column} has fields that its schema lacks: "), F.array_join(unknown, ", "))
        checked = F.when(F.size(F.coalesce(unknown, F.array().cast("array<string>"))) > 0, F.raise_error(found).cast("string")).otherwise(checked)
    return F.from_json(checked, schema, {"mode": "FAILFAST"})


def _struct_of(schema: str | StructType) -> StructType:
    if isinstance(schema, StructType):
        return schema
    if schema.lstrip().startswith("{"):
        return StructType.fromJson(json.loads(schema))
    parsed = DataType.fromDDL(schema)
    if not isinstance(parsed, StructType):
        raise ValueError(f"malformed text can only be kept for structs, not {schema!r}")
    return parsed


def decode_json(
    df: DataFrame,
    value_schema: str | StructType,
    key_schema: str | StructType | None = None,
    malformed: str = FAIL,
    fields: Mapping[str, Iterable[str]] | None = None,
    long_numbers: bool = False,
) -> DataFrame:
    """Parse JSON `value` (and `key`) by schema: DDL, Spark schema JSON or a StructType.

    Text that is not JSON of the schema is an error, and so is empty text: neither may turn into a row of nulls or
    a delete. With `malformed="keep"` a value of that kind becomes a struct of nulls, so never a delete, and its text is kept
    in a column `malformed`, which is null for all other rows; keys always have to be right. `fields` lists, for
    "key" and "value", the only fields that may be there; others are errors. With `long_numbers` a field that is text keeps
    all digits of a number, however many.
    """
    if malformed not in (FAIL, KEEP):
        raise ValueError(f"malformed has to be {FAIL!r} or {KEEP!r}, not {malformed!r}")
    listed = fields or {}
    if malformed == FAIL:
        df = replace_column(df, "value", _parsed("value", value_schema, listed.get("value"), long_numbers).alias("value"))
    else:
        struct = _struct_of(value_schema)
        if MALFORMED in df.columns or MALFORMED in struct.names:
            raise ValueError(f"the data has a column {MALFORMED!r} already")
        text = _text(F.col("value"))
        # One more field takes the text of whatever cannot be parsed.
        wide = StructType([*struct.fields, StructField(MALFORMED, StringType())])
        found = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
        bad = F.when(F.trim(text) == "", text).otherwise(found.getField(MALFORMED))
        empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields])
        plain = F.struct(*[found.getField(f.name).alias(f.name) for f in struct.fields])
        value = F.when(text.isNull(), F.lit(None)).when(bad.isNotNull(), empty).otherwise(plain)
        df = replace_column(df.withColumn(MALFORMED, bad), "value", value.cast(struct).alias("value"))
    if key_schema is not None:
        df = replace_column(df, "key", _parsed("key", key_schema, listed.get("key"), long_numbers).alias("key"))
    return df


# Types as Spark prints them for variants; names in backticks and names before a colon are left alone.
_PRINTED = re.compile(r"`(?:[^`]|``)*`|\b(?:OBJECT(?=<)|VARIANT|VOID)(?!\s*:)")


def _type(printed: str) -> DataType:
    """The type that `schema_of_variant_agg` prints. Values of several types, and those that are always null, are text."""
    words = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
    return DataType.fromDDL(_PRINTED.sub(lambda found: words.get(found.group(), found.group()), printed))


def _pairs(a: DataType, b: DataType | None):
    """Types that stand in the same place of two types; None where the second one has another form."""
    if isinstance(a, StructType):
        other = {f.name: f.dataType for f in b.fields} if isinstance(b, StructType) else {}
        for f in a.fields:
            yield from _pairs(f.dataType, other.get(f.name))
    elif isinstance(a, ArrayType):
        yield from _pairs(a.elementType, b.elementType if isinstance(b, ArrayType) else None)
    else:
        yield a, b


def _exact(a: DataType, b: DataType | None) -> DataType:
    """`a` with its decimals as wide as their values need, which `b` tells: doubles if these hold all their digits."""
    if isinstance(a, StructType):
        other = {f.name: f.dataType for f in b.fields} if isinstance(b, StructType) else {}
        return StructType([StructField(f.name, _exact(f.dataType, other.get(f.name)), f.nullable) for f in a.fields])
    if isinstance(a, ArrayType):
        return ArrayType(_exact(a.elementType, b.elementType if isinstance(b, ArrayType) else None), a.containsNull)
    if not isinstance(a, DecimalType):
        return a
    if a.precision <= DOUBLE_DIGITS:
        return DoubleType()
    if isinstance(b, DecimalType):
        # There all numbers have a fraction, so the digits before it are those of the values.
        whole = b.precision - b.scale
        return DoubleType() if whole + a.scale <= DOUBLE_DIGITS else DecimalType(min(max(whole, 1) + a.scale, DECIMAL_DIGITS), a.scale)
    return a


def infer_json_schemas(df: DataFrame) -> tuple[str | None, str] | None:
    """(key schema, value schema) that fit all rows; None if no row has a value.

    One distributed aggregate over all rows: a field of any row is in the schema. Numbers keep all their digits: whole ones are
    bigints, those with a fraction in some row doubles as long as 15 digits do, else decimals, and text beyond the 38
    digits of a decimal. Values of several types stay text. Text that is no JSON does not count; it
    fails when it is decoded. A key that is always null is not decoded.
    """
    has_key = "key" in df.columns and df.schema["key"].dataType != NullType()
    texts = df.select(_text(F.col("value")).alias("value"), *([_text(F.col("key")).alias("key")] if has_key else []))
    parallel = df.sparkSession.sparkContext.defaultParallelism
    if not df.isStreaming and 2 * texts._jdf.rdd().getNumPartitions() <= parallel:
        # Parsing is most of the work: a small input in few files is dealt to all cores.
        texts = texts.repartition(parallel)
    texts = texts.select([_long_numbers_quoted(F.col(c)).alias(c) for c in texts.columns])
    kinds = [F.expr(f"schema_of_variant_agg(try_parse_json({c}))").alias(c) for c in texts.columns]
    found = texts.agg(*kinds, F.count("value").alias("values")).first()
    if not found["values"]:
        return None
    if found["value"] == "VOID":
        raise ValueError("cannot infer a schema: no value is JSON; give value_schema")
    types = {c: _type(found[c]) for c in texts.columns if found[c] != "VOID"}
    wide = {c for c, kind in types.items() if any(isinstance(a, DecimalType) and a.precision > DOUBLE_DIGITS for a, _ in _pairs(kind, None))}
    widths = {}
    if wide:
        # Beside fractions a whole number counts as one of 20 digits; with a fraction of its own it has the digits it has.
        kinds = [F.expr(f"schema_of_variant_agg(try_parse_json({c}))").alias(c) for c in wide]
        row = texts.select([F.regexp_replace(c, _WHOLE, "$1.0").alias(c) for c in wide]).agg(*kinds).first()
        widths = {c: _type(row[c]) for c in wide}
    schemas = {c: _exact(kind, widths.get(c)) for c, kind in types.items()}
    printed = {c: _ddl_of(kind) for c, kind in schemas.items()}
    return printed.get("key"), printed["value"]


def _ddl_of(kind: DataType) -> str:
    return kind.toDDL() if isinstance(kind, StructType) else kind.simpleString()


def decode_json_inferred(df: DataFrame) -> DataFrame:
    schemas = infer_json_schemas(df)
    if schemas is None:
        raise ValueError("cannot infer a schema: there is no row with a value; give value_schema")
    return decode_json(df, schemas[1], schemas[0], long_numbers=True)


def _encode_json(column: Column, data_type: DataType) -> Column:
    if isinstance(data_type, (StructType, ArrayType, MapType)):
        return F.to_json(column, JSON_WRITE_OPTIONS)
    if isinstance(data_type, (StringType, BinaryType)):
        return column
    return column.cast("string")


def _serialized(df: DataFrame) -> list[str]:
    if "value" not in df.columns:
        raise ValueError("the data has no column 'value'")
    return [c for c in ("key", "value") if c in df.columns]


def encode_json(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """`value`, and `key` if present, as JSON text; bytes and text pass unchanged, null stays null.

    `keep` names further columns to carry along, such as those that order an append.
    """
    encoded = [_encode_json(F.col(c), df.schema[c].dataType).alias(c) for c in _serialized(df)]
    return df.select(*encoded, *[root(c) for c in keep])


def _avro_functions():
    try:
        from pyspark.sql.avro import functions
    except ImportError as error:
        raise ConnectorMissing("Spark's Avro module is needed: add spark-avro to the class path") from error
    return functions


def _needs_avro(build):
    try:
        return build()
    except PySparkException as error:
        if "AVRO" in str(error).upper():
            raise ConnectorMissing("Spark's Avro module is needed: add spark-avro to the class path") from error
        raise


def _by_id(column: Column, schemas: Mapping[int, str], reader: str) -> Column:
    functions = _avro_functions()
    decoded = None
    for identifier, writer in schemas.items():
        # Every writer schema is read as the latest one, so that all branches have one type.
        value = functions.from_avro(payload(column), writer, {"avroSchema": reader})
        matches = schema_id(column) == identifier
        decoded = F.when(matches, value) if decoded is None else decoded.when(matches, value)
    unknown = F.raise_error(F.concat(F.lit("unknown schema id "), schema_id(column).cast("string")))
    return decoded.when(column.isNull(), None).otherwise(unknown)


def decode_avro(
    df: DataFrame,
    value_schema: str | None = None,
    key_schema: str | None = None,
    registry: Mapping[str, Mapping[int, str]] | None = None,
) -> DataFrame:
    """Parse Avro by given schemas, or by `registry`: {"value": {id: schema}, "key": {...}}.

    With a registry the payload is framed by its schema id; the highest id is the reader
    schema. A key without registered schemas stays bytes.
    """
    _check_schemas(key_schema, value_schema, registry)
    if registry is None and value_schema is None:
        raise ValueError("Avro needs a value schema or registered schemas")

    def build() -> DataFrame:
        out = df
        for name, schema in (("key", key_schema), ("value", value_schema)):
            if registry is not None and registry.get(name):
                known = registry[name]
                column = _by_id(F.col(name), known, known[max(known)])
            elif schema is not None:
                column = _avro_functions().from_avro(F.col(name), schema)
            else:
                continue
            out = replace_column(out, name, column.alias(name))
        return out

    return _needs_avro(build)


def encode_avro(
    df: DataFrame,
    value_schema: str | None = None,
    key_schema: str | None = None,
    registry: Mapping[str, Mapping[int, str]] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Write Avro by given schemas, or framed with the highest registered schema id."""
    _check_schemas(key_schema, value_schema, registry)
    names = _serialized(df)
    if registry is None and (value_schema is None or ("key" in names and key_schema is None)):
        raise ValueError("Avro needs schemas for all encoded columns, or registered schemas")

    def build() -> DataFrame:
        functions = _avro_functions()
        columns = []
        for name, schema in (("key", key_schema), ("value", value_schema)):
            if name not in names:
                continue
            if registry is not None:
                known = registry[name]
                latest = max(known)
                encoded = F.when(
                    F.col(name).isNotNull(), frame(functions.to_avro(F.col(name), known[latest]), latest)
                )
            else:
                encoded = F.when(F.col(name).isNotNull(), functions.to_avro(F.col(name), schema))
            columns.append(encoded.alias(name))
        return df.select(*columns, *[root(c) for c in keep])

    return _needs_avro(build)


def decode(
    df: DataFrame,
    fmt: str = JSON,
    value_schema: str | None = None,
    key_schema: str | None = None,
    registry: Mapping[str, Mapping[int, str]] | None = None,
) -> DataFrame:
    """Envelope bytes to structs. JSON without a schema is inferred, on batch data only."""
    if fmt == AVRO:
        return decode_avro(df, value_schema, key_schema, registry)
    _check_schemas(key_schema, value_schema, None)
    if value_schema is not None:
        return decode_json(df, value_schema, key_schema)
    if df.isStreaming:
        raise ValueError("a stream cannot be inferred here, give value_schema")
    return decode_json_inferred(df)


def encode(
    df: DataFrame,
    fmt: str = JSON,
    value_schema: str | None = None,
    key_schema: str | None = None,
    registry: Mapping[str, Mapping[int, str]] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Structs to serialized `key` and `value`."""
    if fmt == AVRO:
        return encode_avro(df, value_schema, key_schema, registry, keep)
    return encode_json(df, keep)


def inspect_raw(
    df: DataFrame,
    value_schema: str | None = None,
    key_schema: str | None = None,
    fmt: str = JSON,
    registry: Mapping[str, Mapping[int, str]] | None = None,
) -> DataFrame:
    """Debug view: the envelope as it is, plus decoded data and schema ids of key and value."""
    raw = df.withColumns({"data_key": F.col("key"), "data_value": F.col("value")})
    pair = raw.select(*[F.col(c).alias(f"_{c}") for c in df.columns], F.col("key"), F.col("value"))
    if fmt == JSON:
        pair = replace_column(pair, "key", payload(F.col("key")).alias("key"))
        pair = replace_column(pair, "value", payload(F.col("value")).alias("value"))
    decoded = decode(pair, fmt, value_schema, key_schema, registry)
    return decoded.select(
        *[F.col(f"_{c}").alias(c) for c in df.columns],
        F.col("key").alias("data_key"),
        F.col("value").alias("data_value"),
        schema_id(F.col("_key")).alias("key_schema_id"),
        schema_id(F.col("_value")).alias("value_schema_id"),
    )
