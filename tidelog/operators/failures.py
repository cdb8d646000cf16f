"""Failure handling: classification, back-off, retries in place or through retry topics, dead letters.

A handler is a Column expression of the attempt number: it gives the error class of that attempt, null for
success. All attempts of a record are computed in its own row, so nothing waits and nothing is shuffled; back-off
is data (due times), not sleeping.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.headers import with_headers
from tidelog.operators.records import fails_on
from tidelog.plans import scans
from tidelog.plans.once import compute_once
from tidelog.sources.log import append_log

PART = ["topic", "partition"]
UNDECODABLE = "DeserializationException"
TRANSIENT = "TransientFailure"
FATAL = "IllegalArgumentException"


@dataclass(frozen=True)
class RetryPolicy:
    """Exponential back-off: the delay before retry i is min(initial * multiplier^(i-1), max_delay)."""

    initial_ms: int = 200
    multiplier: float = 2.0
    max_ms: int = 2000
    retries: int = 3
    fatal: tuple[str, ...] = (FATAL, UNDECODABLE)

    def delays(self) -> list[int]:
        return [int(min(self.initial_ms * self.multiplier ** i, self.max_ms)) for i in range(self.retries)]

    def delay(self, retry: Column) -> Column:
        """Wait before retry 1, 2, ...; the schedule is a literal, looked up by position."""
        return F.get(_longs(self.delays()), retry - 1)

    def due(self, attempt: Column) -> Column:
        """Time from the first attempt to this one."""
        return F.get(_longs([0, *accumulate(self.delays())]), attempt - 1)


def _longs(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values]).cast("array<bigint>")


def classify_error(error: Column, retryable: Sequence[str], fatal: Sequence[str], unknown: str = "retry") -> Column:
    """``ok``, ``retry`` or ``dead``; an undecodable record is dead before any handler sees it."""
    return (
        F.when(error.isNull(), "ok").when(error == UNDECODABLE, "dead").when(error.isin(*fatal), "dead")
        .when(error.isin(*retryable), "retry").otherwise(unknown)
    )


def backoff_schedule(df: DataFrame, policy: RetryPolicy) -> DataFrame:
    """One row per retry of each record: its delay and its due time after the first attempt."""
    retry = F.explode(F.sequence(F.lit(1), F.lit(policy.retries))).alias("retry")
    return df.select("*", retry).select(
        "*", policy.delay(F.col("retry")).alias("delay_ms"), policy.due(F.col("retry") + 1).alias("due_ms"))


def scripted_handler(attempt: Column) -> Column:
    """Error class of an attempt under the scripted keys (needs ``kind`` and ``failures``)."""
    return F.when(F.col("kind") == "POISON", UNDECODABLE).when(F.col("kind") == "FATAL", FATAL).when(fails_on(attempt), TRANSIENT)


def with_attempts(df: DataFrame, handler: Callable[[Column], Column], policy: RetryPolicy) -> DataFrame:
    """Add ``attempts``: (attempt, error, due_ms, delay_ms) up to the first success, fatal error or the last retry.

    An undecodable record keeps its error as attempt 0: no handler call happened.
    """
    waits = [0, *policy.delays()]
    dues = list(accumulate(waits))
    errors = compute_once(df, __errors=F.array(*[handler(F.lit(a)) for a in range(1, policy.retries + 2)]))
    error = [F.get("__errors", F.lit(i)) for i in range(policy.retries + 1)]
    tries = F.array(*[
        F.struct(F.lit(i + 1).alias("attempt"), e.alias("error"), F.lit(dues[i]).cast("bigint").alias("due_ms"),
                 F.lit(waits[i]).cast("bigint").alias("delay_ms")) for i, e in enumerate(error)])
    last = F.lit(policy.retries + 1)
    for i, e in reversed(list(enumerate(error[:-1]))):
        last = F.when(e.isNull() | e.isin(*policy.fatal), i + 1).otherwise(last)
    zero = F.lit(0).cast("bigint")
    poison = F.array(F.struct(F.lit(0).alias("attempt"), F.lit(UNDECODABLE).alias("error"), zero.alias("due_ms"), zero.alias("delay_ms")))
    attempts = F.when(error[0] == UNDECODABLE, poison).otherwise(F.slice(tries, F.lit(1), last))
    return compute_once(errors, attempts=attempts).drop("__errors")


def final_error(attempts: str = "attempts") -> Column:
    """Error a record ended with, null when it was processed in the end."""
    return F.element_at(F.col(attempts), -1)["error"]


def handler_calls(attempts: str = "attempts") -> Column:
    return F.size(F.filter(F.col(attempts), lambda t: t["attempt"] > 0))


def retry_in_place(log: DataFrame, handler: Callable[[Column], Column], policy: RetryPolicy,
                   chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """One row per handler call (and per undecodable record) when a failing record blocks its partition.

    A record starts when the back-offs of all records before it in the partition are over: a running sum along
    the offsets, so the order is kept without walking a partition in one task.
    """
    tried = with_attempts(log, handler, policy).withColumn(
        "__busy", F.element_at(F.col("attempts"), -1)["due_ms"])
    queued = scans.scan(tried, PART, ["offset"], scans.id_chunk("offset", chunk_rows),
                        __total=scans.running_sum(F.col("__busy")))
    final = final_error()
    rows = queued.select(*log.columns, final.alias("final_error"), (F.col("__total") - F.col("__busy")).alias("blocked_ms"),
                         F.explode("attempts").alias("a"))
    return rows.select(*log.columns, F.col("a.attempt").alias("attempt"), F.col("a.error").alias("error"),
                       (F.col("blocked_ms") + F.col("a.due_ms")).alias("due_ms"), "final_error")


def retry_topic_entries(log: DataFrame, handler: Callable[[Column], Column], policy: RetryPolicy) -> DataFrame:
    """One row per delivery when a failed record moves through retry topics: main, one per delay, then -dlt.

    The partition moves on, so a record's due time depends on its own failures only.
    """
    tried = with_attempts(log, handler, policy)
    dead = final_error().isNotNull()
    last = F.element_at(F.col("attempts"), -1)
    calls = F.transform(F.filter("attempts", lambda t: t["attempt"] > 0), lambda t: F.struct(
        t["attempt"].alias("attempt"), t["error"].alias("error"), t["due_ms"].alias("due_ms"),
        F.when(t["attempt"] == 1, F.col("topic")).otherwise(
            F.concat(F.col("topic"), F.lit("-retry-"), t["delay_ms"].cast("string"))).alias("via")))
    parked = F.array(F.struct(last["attempt"].alias("attempt"), last["error"].alias("error"), last["due_ms"].alias("due_ms"),
                              F.concat(F.col("topic"), F.lit("-dlt")).alias("via")))
    entries = F.explode(F.when(dead, F.concat(calls, parked)).otherwise(calls)).alias("e")
    return tried.select(*log.columns, entries).select(*log.columns, "e.attempt", "e.error", "e.due_ms", "e.via")


def dead_letters(failed: DataFrame, error: Column, cause: Column | None = None, message: Column | None = None) -> DataFrame:
    """What is published to ``<topic>-dlt``: key and value bytes untouched, same partition, the origin and the
    error alongside."""
    return failed.filter(error.isNotNull()).select(
        F.concat(F.col("topic"), F.lit("-dlt")).alias("topic"), "partition", "key", F.col("value").cast("binary").alias("value"),
        F.col("topic").alias("original_topic"), F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"), F.col("timestamp").alias("original_timestamp"),
        error.alias("error_class"), (error if cause is None else cause).alias("error_cause"),
        (F.lit(None).cast("string") if message is None else message).alias("error_message"))


def publish_dead_letters(dead: DataFrame, path: str, n: int, order: str = "__order") -> DataFrame:
    """Append dead letters to their ``<topic>-dlt`` log, in the original's partition, the origin and the error as
    headers. Returns the rows that could not be placed, as ``append_log`` does.

    Their order is by original offset; ``order`` may name another unique integer column.
    """
    sent = with_headers(dead, {
        "original-topic": F.col("original_topic"),
        "original-partition": F.col("original_partition").cast("string"),
        "original-offset": F.col("original_offset").cast("string"),
        "error-class": F.col("error_class"),
        "error-cause": F.col("error_cause"),
        "error-message": F.col("error_message"),
    })
    if order == "__order":
        # Offsets are unique per partition, and offsets are handed out per partition.
        sent = sent.withColumn(order, F.col("original_offset"))
    return append_log(sent.withColumn("timestamp", F.col("original_timestamp")), path, order, n)
