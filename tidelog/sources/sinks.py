"""Bulk writing, per-type encoding, and appends that become visible all at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.log import append_log, exists

# The codecs a log client offers, by the name the parquet writer uses.
CODECS = ("uncompressed", "lz4_raw", "snappy", "zstd", "gzip")

MARKER_SCHEMA = "txn_id string, outcome string, epoch int"


def write_bulk(df: DataFrame, path: str, codec: str = "zstd", max_rows: int = 0, mode: str = "errorifexists") -> None:
    """Few, large, compressed files. ``rebalance`` lets adaptive execution merge small output partitions and split
    large ones to the advisory size."""
    writer = df.hint("rebalance").write.mode(mode).option("compression", codec)
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.parquet(path)


def table_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of a table, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("bytes"))


def codec_report(df: DataFrame, folder: str, codecs: Sequence[str] = CODECS) -> DataFrame:
    """The same rows written once per codec: rows read back, files, bytes and share of the uncompressed bytes.

    The rows are worked out and spread over large files once, for the first codec. The others are written from those files, each
    piece of them by one task, so they are large as well and need no shuffle of their own.
    """
    spark = df.sparkSession
    reports = []
    rows = df
    for codec in codecs:
        path = f"{folder}/{codec}"
        if rows is df:
            write_bulk(df, path, codec)
            rows = spark.read.schema(df.schema).parquet(path)
        else:
            rows.write.option("compression", codec).parquet(path)
        back = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
        reports.append(table_bytes(spark, path).select(F.lit(codec).alias("codec"), back.alias("records"), "files", "bytes"))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    plain = out.agg(F.max(F.when(F.col("codec") == "uncompressed", F.col("bytes")))).scalar()
    return out.select("codec", "records", "files", "bytes", F.round(F.try_divide(F.col("bytes"), plain), 4).alias("rate"))


def write_by_type(df: DataFrame, type_column: str, raw: str, typed: Mapping[str, str]) -> DataFrame:
    """One binary ``value`` for mixed rows: raw bytes stay bytes, typed rows become JSON.

    ``raw`` is the column of undecoded bytes; ``typed`` maps a type token to the struct column it encodes.
    """
    value = F.when(F.col(type_column) == "bytes", F.col(raw).cast("binary"))
    for token, column in typed.items():
        value = value.when(F.col(type_column) == token, F.to_json(F.col(column)).cast("binary"))
    return df.withColumn("value", value)


def atomic_append(
    frames: Mapping[str, DataFrame], path: str, markers: str | None, txn_id: str, order: str, n: int,
    outcome: str = "commit", epoch: int = 0,
) -> None:
    """Append rows to several topics that become visible together.

    All frames are one append: each of their rows is worked out once, and one index file shows them all. The rows carry the
    transaction id. Without ``markers`` the outcome is in that same file (``segments.index_markers``). With the folder of a
    markers table it is a row there, written last: a job that dies before leaves an open transaction, which committed reads
    hide. All or nothing: a row that cannot be placed fails the call before anything is written.
    """
    tagged = [frame.withColumn("topic", F.lit(topic)) for topic, frame in frames.items()]
    rows = tagged[0]
    for frame in tagged[1:]:
        rows = rows.unionByName(frame, allowMissingColumns=True)
    append_log(rows, path, order, n, txn_id=txn_id, all_or_nothing=True, outcome=outcome if markers is None else None, epoch=epoch)
    if markers is not None:
        write_marker(rows.sparkSession, markers, txn_id, outcome, epoch)


def write_marker(spark: SparkSession, markers: str, txn_id: str, outcome: str, epoch: int = 0) -> None:
    spark.range(1).select(F.lit(txn_id).alias("txn_id"), F.lit(outcome).alias("outcome"),
                          F.lit(epoch).alias("epoch")).coalesce(1).write.mode("append").parquet(markers)


def read_markers(spark: SparkSession, markers: str) -> DataFrame:
    if not exists(spark, markers):
        return spark.createDataFrame([], MARKER_SCHEMA)
    return spark.read.schema(MARKER_SCHEMA).parquet(markers)
