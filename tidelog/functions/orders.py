"""The order row: JSON encoding, tolerant decoding, type routing and the schema-id wire header."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.headers import header_text
from tidelog.plans.facts import attach
from tidelog.plans.once import compute_once

ORDER_SCHEMA = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("totalAmount", T.DecimalType(12, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("createdAt", T.TimestampType()),
])
ORDER_VIEW_SCHEMA = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("totalAmount", T.DecimalType(12, 2)),
])
TYPE_HEADER = "__TypeId__"
MAGIC = 0
_CORRUPT = "__corrupt"


def iso_instant(ts: Column) -> Column:
    """ISO text of an instant in UTC, with 0, 3 or 6 fraction digits as needed."""
    us = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(us == 0, "").when(us % 1000 == 0, F.concat(F.lit("."), F.lpad((us / 1000).cast("int").cast("string"), 3, "0"))) \
        .otherwise(F.concat(F.lit("."), F.lpad(us.cast("string"), 6, "0")))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def encode_order(order: Column) -> Column:
    """Order struct to JSON text: instants as ISO text, decimals exact, a null order stays null."""
    fields = F.struct(
        order["orderId"].alias("orderId"), order["customerId"].alias("customerId"),
        order["totalAmount"].cast("decimal(12,2)").alias("totalAmount"), order["currency"].alias("currency"),
        iso_instant(order["createdAt"]).alias("createdAt"))
    return F.when(order.isNotNull(), F.to_json(fields, {"ignoreNullFields": "false"}))


def encode_orders(df: DataFrame, order: str = "order") -> DataFrame:
    return df.withColumn("value", encode_order(F.col(order)))


def decode(df: DataFrame, schema: T.StructType, value: str = "value", out: str = "order") -> DataFrame:
    """One parse for good and bad rows: adds the struct and ``decode_error`` (null for a good row).

    Unknown fields are ignored and a null value passes as a null struct.
    """
    text = F.col(value).cast("string")
    # The JSON word null is a null order, not a broken one.
    content = F.when(F.trim(text) != "null", text)
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = compute_once(df, __p=F.from_json(content, wide, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}))
    broken = content.isNotNull() & (
        F.col(f"__p.{_CORRUPT}").isNotNull() | F.col("__p").isNull() | (F.trim(text) == ""))
    clean = F.when(~broken & F.col("__p").isNotNull(), F.struct(*[F.col(f"__p.{f.name}").alias(f.name) for f in schema.fields]))
    return parsed.withColumn("decode_error", F.when(broken, F.lit("DeserializationException"))).withColumn(out, clean).drop("__p")


def decode_orders(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows with their order, and bad rows with the original bytes and the reason."""
    decoded = decode(df, ORDER_SCHEMA, value)
    return (decoded.filter(F.col("decode_error").isNull()).drop("decode_error"),
            decoded.filter(F.col("decode_error").isNotNull()).drop("order"))


def route_by_type(df: DataFrame, mapping: Mapping[str, T.StructType], default: str | None = None,
                  use_header: bool = True, value: str = "value") -> DataFrame:
    """Decode each record with the schema its type token names: one struct column per token.

    ``default`` serves records without a token, or all records when the header is not used. A missing or unmapped
    token, or a value that does not parse, gives a ``route_error``.
    """
    token = header_text(F.col("headers"), TYPE_HEADER) if use_header else F.lit(None).cast("string")
    routed = compute_once(df, type_token=F.coalesce(token, F.lit(default)))
    text = F.col(value).cast("string")
    parses = {}
    for name, schema in mapping.items():
        wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
        parses[f"as_{name}"] = F.from_json(F.when(F.col("type_token") == name, text), wide, {"columnNameOfCorruptRecord": _CORRUPT})
    out = compute_once(routed, **parses)
    corrupt = F.coalesce(*[F.col(f"as_{n}")[_CORRUPT] for n in mapping])
    error = (
        F.when(F.col("type_token").isNull(), "no type token")
        .when(~F.col("type_token").isin(*mapping), "unknown type token")
        .when(corrupt.isNotNull(), "DeserializationException"))
    out = out.withColumn("route_error", error)
    for name, schema in mapping.items():
        fields = F.struct(*[F.col(f"as_{name}")[f.name].alias(f.name) for f in schema.fields])
        out = out.withColumn(f"as_{name}", F.when(F.col("route_error").isNull() & F.col(f"as_{name}").isNotNull(), fields))
    return out


def add_wire_header(body: Column, schema_id: Column) -> Column:
    """Magic byte 0, the schema id as 4 big-endian bytes, then the body."""
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")), body.cast("binary"))


def wire_header(df: DataFrame, value: str = "value") -> DataFrame:
    """Split a wire value into ``schema_id`` and ``body``; a wrong magic byte or a short value gives ``wire_error``."""
    v = F.col(value)
    short = F.octet_length(v) < 5
    magic = F.hex(F.substring(v, 1, 1))
    error = F.when(v.isNull(), None).when(short, "shorter than its header").when(magic != F.lit(f"{MAGIC:02X}"), "unknown magic byte")
    ok = error.isNull() & v.isNotNull()
    return df.select(
        "*", F.when(ok, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint")).alias("schema_id"),
        F.when(ok, F.expr(f"substring(`{value}`, 6)")).alias("body"), error.alias("wire_error"))


def resolve_writer(df: DataFrame, versions: DataFrame, schema_id: str = "schema_id") -> DataFrame:
    """Schema id to version label, ``?`` when unknown."""
    known = versions.select(F.col("id").alias(schema_id), F.col("label").alias("writer"))
    return attach(df, known, [schema_id]).withColumn("writer", F.coalesce("writer", F.lit("?")))


def decode_avro(df: DataFrame, schemas: Mapping[int, str], reader: str, body: str = "body", out: str = "record") -> DataFrame:
    """Bodies decoded by the writer schema of their id into the reader schema (JSON texts).

    Needs the session's Avro package. Each writer schema decodes only its own rows; an unknown id stays null.
    """
    from pyspark.sql.avro.functions import from_avro

    decoded = [
        from_avro(F.when(F.col("schema_id") == i, F.col(body)), writer, {"avroSchema": reader, "mode": "PERMISSIVE"})
        for i, writer in sorted(schemas.items())]
    return df.withColumn(out, F.coalesce(*decoded))


def subject_name(topic: Column, record: Column, strategy: Column) -> Column:
    """Registry subject of a value under the three naming strategies; null for an unknown one."""
    return (
        F.when(strategy == "topic", F.concat(topic, F.lit("-value")))
        .when(strategy == "record", record)
        .when(strategy == "topic-record", F.concat(topic, F.lit("-"), record)))
