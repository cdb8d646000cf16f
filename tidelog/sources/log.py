"""The log table: any dataset with (topic, partition, offset) coordinates.

On disk a log is parquet with ``topic`` and ``partition`` directories; ``offset`` and ``timestamp`` stay plain
columns, so a read from fixed partitions and offsets prunes directories and row groups. What ``append_log`` writes has a
segment index as well (``sources/segments.py``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.headers import HEADERS_TYPE, no_headers
from tidelog.functions.keys import key_partition
from tidelog.plans import scans
from tidelog.plans.facts import attach
from tidelog.plans.once import materialised
from tidelog.sources import segments
from tidelog.sources.segments import LogIndex

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
    T.StructField("txn_id", T.StringType()),
])


def as_log(
    df: DataFrame,
    topic: str,
    key: Column,
    value: Column,
    timestamp: Column,
    order: str,
    n: int,
    partition: Column | None = None,
    keep: Sequence[str] = (),
    chunk_rows: int = scans.CHUNK_ROWS,
) -> DataFrame:
    """Give a table log coordinates.

    The partition comes from the key hash unless ``partition`` says otherwise; rows without a key are spread over
    all partitions. Offsets are dense from 0 per partition, along ``order``, a column that is unique per row.
    ``keep`` carries further columns of ``df`` along.
    """
    # Never null, so that no null check is planned that would compute the hash a second time.
    by_key = F.coalesce(key_partition(key, n), F.pmod(F.xxhash64(order), F.lit(n)).cast("int"), F.lit(0))
    placed = scans.with_chunk(df, order, "__cut", chunk_rows).select(
        F.lit(topic).alias("topic"),
        (by_key if partition is None else partition).cast("int").alias("partition"),
        timestamp.cast("timestamp").alias("timestamp"),
        key.cast("string").alias("key"),
        value.alias("value"),
        F.col(order).alias("__order"),
        "__cut",
        *[F.col(c) for c in keep],
    )
    numbered = scans.scan(placed, ["topic", "partition"], ["__order"], F.col("__cut"), offset=scans.index())
    return numbered.select("topic", "partition", "offset", "timestamp", "key", "value", *keep)


def read_log(spark: SparkSession, path: str, topic: str | None = None, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """Bounded read: everything the table holds now. Of a log with an index the files that are in it, and no others."""
    if not LogIndex(path).exists():
        log = spark.read.schema(schema).parquet(path)
        return log if topic is None else log.filter(F.col("topic") == topic)
    picked = segments.log_index(spark, path)
    return segments.read_files(spark, path, picked if topic is None else picked.filter(F.col("topic") == topic), schema)


def read_log_stream(
    spark: SparkSession, path: str, topic: str | None = None, policy: str = "earliest",
    files_per_trigger: int | None = None, schema: T.StructType = LOG_SCHEMA,
    commits: DataFrame | None = None, group: str | None = None, starts: str | None = None,
) -> DataFrame:
    """Unbounded read, from where ``start_policy`` says: a partition's commit, else its begin (``earliest``), its
    present end (``latest``) or an error (``none``).

    Only ``earliest`` without commits needs no ``starts``: a folder beside the query's checkpoint that keeps the
    starting offsets. They are worked out once, by the first call, so a restart goes on where the first run began and
    what arrived in between is read. A partition that did not exist then is read whole.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(path)
    if topic is not None:
        stream = stream.filter(F.col("topic") == topic)
    if policy == "earliest" and commits is None:
        return stream
    if starts is None:
        raise ValueError(f"start policy {policy} needs a folder that keeps the starting offsets")
    if not exists(spark, starts):
        if commits is None:
            commits = spark.createDataFrame([], "topic string, partition int, committed bigint")
        begun = start_policy(log_ends(read_log(spark, path, topic, schema)), commits, policy, group)
        begun.select("topic", "partition", "start").coalesce(1).write.parquet(starts)
    begun = spark.read.parquet(starts).withColumnRenamed("start", "__start")
    return attach(stream, begun, ["topic", "partition"]).filter(
        F.col("__start").isNull() | (F.col("offset") >= F.col("__start"))).drop("__start")


def read_assigned(log: DataFrame, offsets: Mapping[int, int]) -> DataFrame:
    """Fixed partitions from fixed offsets, no group. The condition is literal, so it reaches the scan."""
    wanted = F.lit(False)
    for p, o in sorted(offsets.items()):
        wanted = wanted | ((F.col("partition") == p) & (F.col("offset") >= F.lit(o).cast("bigint")))
    return log.filter(wanted)


def log_ends(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"))


def commits_in_force(commits: DataFrame, group: str | None = None, order: str = "committed_at") -> DataFrame:
    """One committed offset per partition, for one group.

    A history (with the column ``order``) counts by its latest row. A table with a ``group`` column needs ``group``:
    the offsets of several groups are never mixed.
    """
    if "group" in commits.columns:
        if group is None:
            raise ValueError("the commits carry groups: name one")
        commits = commits.filter(F.col("group") == group)
    if order in commits.columns:
        return commits.groupBy("topic", "partition").agg(F.max_by("committed", order).alias("committed"))
    return commits.select("topic", "partition", "committed")


def start_policy(bounds: DataFrame, commits: DataFrame, policy: str, group: str | None = None) -> DataFrame:
    """Where a group starts in each partition: its commit, else the begin or the end of the partition.

    ``bounds`` has begin and end per (topic, partition), ``commits`` committed offsets, or a history of them, of one
    group or of several of which ``group`` names one. Under ``none`` a partition without a commit fails the query.
    """
    if policy not in ("earliest", "latest", "none"):
        raise ValueError(f"unknown start policy: {policy}")
    fallback = {
        "earliest": F.col("begin"),
        "latest": F.col("end"),
        "none": F.raise_error(F.concat(F.lit("no committed offset for "), F.col("topic"), F.lit("-"),
                                       F.col("partition").cast("string"))).cast("bigint"),
    }[policy]
    joined = bounds.join(commits_in_force(commits, group), ["topic", "partition"], "left")
    return joined.select("topic", "partition", "begin", "end", "committed",
                         F.when(F.col("committed").isNotNull(), F.col("committed")).otherwise(fallback).alias("start"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table is there."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def with_log_columns(df: DataFrame) -> DataFrame:
    """The frame with exactly the columns of ``LOG_SCHEMA``, missing ones empty."""
    empty = {"headers": no_headers(), "txn_id": F.lit(None).cast("string")}
    out = []
    for f in LOG_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else empty.get(f.name, F.lit(None))
        out.append(c.cast(HEADERS_TYPE if f.name == "headers" else f.dataType).alias(f.name))
    return df.select(*out)


def unplaceable(df: DataFrame, n: int) -> Column:
    """Why a row cannot be appended, null when it can."""
    return (
        F.when(F.col("topic").isNull(), "no topic")
        .when(F.col("partition").isNull(), "no partition")
        .when((F.col("partition") < 0) | (F.col("partition") >= n), "partition out of range")
    )


def require_placeable(frames: Iterable[DataFrame], n: int) -> None:
    """Raises, before anything is written, if some row of the frames cannot be appended."""
    for frame in frames:
        first = frame.select(unplaceable(frame, n).alias("reason")).filter(F.col("reason").isNotNull()).first()
        if first is not None:
            raise ValueError(f"a row cannot be appended: {first['reason']}")


def append_log(
    df: DataFrame, path: str, order: str, n: int, txn_id: str | None = None,
    chunk_rows: int = scans.CHUNK_ROWS, max_rows_per_file: int = 0,
    writer: tuple[str, int] | None = None, outcome: str | None = None, epoch: int = 0, all_or_nothing: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """Append rows that have a topic and a partition; they get the offsets after each partition's current end.

    Returns the rows that could not be placed, with a ``reason``; with ``all_or_nothing`` such a row fails the call before
    anything is written. Each row of ``df`` is worked out once: rows are written to the shared folder with the reason, and
    placed and refused ones are read from there. The ends come from the segment index, whatever the length of the log, and
    all files become visible with one index file, together with the transaction's ``outcome`` and the batch of a named
    ``writer`` if given. With ``rejects`` the refused rows are in that table, with the transaction's id, before. One writer per log at a time: a second one fails at its commit.
    """
    spark = df.sparkSession
    untyped = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, T.NullType)}
    staged = materialised(df.withColumns({**untyped, "reason": unplaceable(df, n)}))
    refused = staged.filter(F.col("reason").isNotNull())
    if all_or_nothing and (first := refused.select("reason").first()) is not None:
        raise ValueError(f"a row cannot be appended: {first['reason']}")
    if rejects is not None:
        refused.withColumn("txn_id", F.lit(txn_id)).write.mode("append").parquet(rejects)
    index = LogIndex(path)
    if not index.exists() and exists(spark, path):
        segments.adopt(spark, spark.read.schema(LOG_SCHEMA).parquet(path), path)
    state = index.state()
    good = staged.filter(F.col("reason").isNull()).drop("reason", "offset")
    cut = scans.with_chunk(good, order, "__cut", chunk_rows)
    numbered = scans.scan(cut, ["topic", "partition"], [order], F.col("__cut"), offset=scans.index())
    if state.ends:
        ends = spark.createDataFrame([(t, p, e) for (t, p), e in state.ends.items()], "topic string, partition int, __end long")
        numbered = attach(numbered, ends, ["topic", "partition"]).withColumn("offset", F.col("offset") + F.coalesce("__end", F.lit(0))).drop("__end")
    if txn_id is not None:
        numbered = numbered.withColumn("txn_id", F.lit(txn_id))
    segments.write_segments(with_log_columns(numbered), path, state.version, txn_id, max_rows_per_file or segments.SEGMENT_ROWS, writer, outcome, epoch)
    return refused


def kafka_log(spark: SparkSession, options: Mapping[str, str], streaming: bool = False) -> DataFrame:
    """The same columns from a Kafka source, where its package is deployed with the session.

    ``options`` are the source's own (``kafka.bootstrap.servers``, ``subscribe`` or ``assign``,
    ``startingOffsets``, ``startingTimestamp``, ``minOffsetsPerTrigger``, ``kafka.isolation.level``, ...).
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka").option("includeHeaders", "true")
    raw = reader.options(**options).load()
    return with_log_columns(raw.withColumn("key", F.col("key").cast("string")))
