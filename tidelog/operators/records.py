"""Projections, filters and side counters over records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.keys import key_family, key_number
from tidelog.plans.once import compute_once


def map_value(df: DataFrame, value: Column) -> DataFrame:
    """Replace the value, keep key and coordinates."""
    return df.withColumn("value", value)


def filter_records(df: DataFrame, keep: Column) -> DataFrame:
    """Drop records before the handler. Take progress from the unfiltered frame: dropped offsets count as done."""
    return df.filter(keep)


def filter_report(df: DataFrame, keep: Column, by: Sequence[str]) -> DataFrame:
    """Seen, discarded and delivered per group; a null predicate discards."""
    delivered = F.count_if(F.coalesce(keep, F.lit(False)))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("seen"),
        (F.count(F.lit(1)) - delivered).alias("discarded"),
        delivered.alias("delivered"))


def tap(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation | None]:
    """Count on the side without changing rows.

    Batch frames return the observation to read after an action; a stream reports the counters by ``name`` in
    each micro-batch's progress.
    """
    metrics = counters or {"records": F.count(F.lit(1))}
    columns = [c.alias(k) for k, c in metrics.items()]
    if df.isStreaming:
        return df.observe(name, *columns), None
    observation = Observation(name)
    return df.observe(observation, *columns), observation


def record_id(with_topic: bool = False) -> Column:
    """Stable id ``partition-offset``, prefixed with the topic where several are mixed."""
    parts = [F.col("partition").cast("string"), F.col("offset").cast("string")]
    return F.concat_ws("-", *([F.col("topic")] if with_topic else []), *parts)


def key_parts(df: DataFrame, key: str = "key") -> DataFrame:
    return df.withColumn("family", key_family(F.col(key))).withColumn("number", key_number(F.col(key)))


# Fixed pattern of the scripted keys: ok-<n>, flaky<k>-<n>, fatal-<n>, poison-<n>.
SCRIPT_KEY = r"^(ok|flaky(\d+)|fatal|poison)-(\d+)$"


def parse_plan(df: DataFrame, key: str = "key") -> DataFrame:
    """What a scripted key tells the handler to do: ``kind`` and ``failures``.

    A key outside the grammar, or null, gets a null kind and a ``plan_error``.
    """
    parts = compute_once(df, __word=F.regexp_extract(key, SCRIPT_KEY, 1),
                         __times=F.regexp_extract(key, SCRIPT_KEY, 2).try_cast("int"))
    word, times = F.col("__word"), F.col("__times")
    kind = (
        F.when(word == "ok", "OK").when(word == "fatal", "FATAL").when(word == "poison", "POISON")
        .when(times.isNotNull(), "FLAKY")
    )
    return compute_once(
        parts, kind=kind, failures=F.when(kind == "FLAKY", times).when(kind.isNotNull(), 0),
        plan_error=F.when(kind.isNull(), F.concat(F.lit("no script for key "), F.coalesce(F.col(key), F.lit("null")))),
    ).drop("__word", "__times")


def fails_on(attempt: Column) -> Column:
    """Whether the plan throws a retryable error on this 1-based attempt."""
    return (F.col("kind") == "FLAKY") & (attempt <= F.col("failures"))


def narrow(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Decode only the fields the consumer owns."""
    return df.withColumn("view", F.from_json(F.col(value).cast("string"), schema))
