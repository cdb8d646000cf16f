"""Record headers: an ordered array of (key, value bytes); on lookup the last one wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADERS_TYPE = "array<struct<key:string,value:binary>>"
SENT_AT = "sent-at"


def no_headers() -> Column:
    return F.array().cast(HEADERS_TYPE)


def header(name: str | Column, value: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(name.alias("key"), value.cast("string").cast("binary").alias("value"))


def header_value(headers: Column, name: str) -> Column:
    """Bytes of the last header called ``name``, null when there is none."""
    return F.try_element_at(F.filter(headers, lambda h: h["key"] == name), F.lit(-1))["value"]


def header_text(headers: Column, name: str) -> Column:
    return header_value(headers, name).cast("string")


def with_headers(df: DataFrame, values: dict[str, Column | str], headers: str = "headers") -> DataFrame:
    """Append headers. A ``topic``, ``partition`` or ``key`` entry routes the record: it sets that column and is
    not kept as a header."""
    routing = {k: v for k, v in values.items() if k in ("topic", "partition", "key")}
    kept = {k: v for k, v in values.items() if k not in routing}
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    added = F.array(*[header(k, as_column(v)) for k, v in kept.items()]) if kept else no_headers()
    current = F.coalesce(F.col(headers), no_headers()) if headers in df.columns else no_headers()
    out = df.withColumn(headers, F.concat(current, added).cast(HEADERS_TYPE))
    for name, value in routing.items():
        out = out.withColumn(name, as_column(value))
    return out


def stamp_sent_at(df: DataFrame, at: Column | None = None, headers: str = "headers") -> DataFrame:
    """Append a ``sent-at`` header holding epoch milliseconds."""
    at = F.current_timestamp() if at is None else at
    return with_headers(df, {SENT_AT: F.unix_millis(at)}, headers)


def header_bytes(headers: Column) -> Column:
    """Bytes that names and values of all headers take."""
    sizes = F.transform(headers, lambda h: F.octet_length(h["key"]) + F.coalesce(F.octet_length(h["value"]), F.lit(0)))
    return F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
