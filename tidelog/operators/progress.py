"""What has been read, committed and finished, how far behind a group is, and where a replay starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.plans import scans
from tidelog.plans.facts import attach, seek
from tidelog.plans.once import materialised
from tidelog.sources.log import commits_in_force

PART = ["topic", "partition"]


def bounds(log: DataFrame) -> DataFrame:
    """Begin, end (last + 1) and record count per partition."""
    return log.groupBy(*PART).agg(
        F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"), F.count(F.lit(1)).alias("records"))


def next_offsets(batch: DataFrame) -> DataFrame:
    """Offset to commit per partition; an empty batch commits nothing."""
    return batch.groupBy(*PART).agg((F.max("offset") + 1).alias("committed"))


def latest_commits(commits: DataFrame, order: str = "committed_at") -> DataFrame:
    """The commit in force per group and partition: the latest row, even when it moves back."""
    return commits.groupBy("group", *PART).agg(F.max_by("committed", order).alias("committed"))


def rewind(commits: DataFrame, log_bounds: DataFrame, group: str, at: Column, order: str = "committed_at") -> DataFrame:
    """Commit rows plus new ones that set every partition of one group back to its begin."""
    back = log_bounds.select(F.lit(group).alias("group"), *PART, F.col("begin").alias("committed"), at.alias(order))
    return commits.unionByName(back)


def lag(log_bounds: DataFrame, commits: DataFrame, group: str | None = None) -> DataFrame:
    """Records a group has not committed yet, per partition and in total (``topic`` and ``partition`` null).

    ``commits`` may be a history, and may hold several groups of which ``group`` names one."""
    joined = log_bounds.join(commits_in_force(commits, group), PART, "left")
    behind = joined.select(*PART, (F.col("end") - F.coalesce("committed", F.lit(0))).alias("behind"))
    sets = [[F.col("topic"), F.col("partition")], []]
    return behind.groupingSets(sets, "topic", "partition").agg(F.sum("behind").alias("lag"))


def offsets_for_time(log: DataFrame, at: Column) -> DataFrame:
    """First offset with a timestamp at or after ``at`` per partition, its end where there is none."""
    # The time is a filter of its own, so that it reaches the scan; the ends read offsets alone.
    after = log.filter(F.col("timestamp") >= at).groupBy(*PART).agg(F.min("offset").alias("__first"))
    ends = log.groupBy(*PART).agg((F.max("offset") + 1).alias("end"))
    return ends.join(after, PART, "left").select(*PART, F.coalesce("__first", "end").alias("start"), "end")


def last_n_offsets(log_bounds: DataFrame, n: int) -> DataFrame:
    return log_bounds.select(*PART, F.greatest(F.col("begin"), F.col("end") - n).alias("start"), "end")


def last_n(log: DataFrame, n: int) -> DataFrame:
    """The last n offsets of each partition, clamped to its begin. Bounds and a seek, no ranking."""
    return seek(log, last_n_offsets(bounds(log), n), "start")


def replay(log: DataFrame, from_time: Column | None = None, last: int | None = None,
           offsets: DataFrame | None = None) -> DataFrame:
    """Re-read without moving any group: from a time, the last n, given starts, or (default) the begin."""
    if from_time is not None:
        return seek(log, offsets_for_time(log, from_time), "start")
    if last is not None:
        return last_n(log, last)
    if offsets is not None:
        return seek(log, offsets, "start")
    return log


def done_watermark(log: DataFrame, done: DataFrame) -> DataFrame:
    """Per partition the first offset that is not done; its end when all are. Acks may come in any order."""
    marks = done.select(*PART, "offset").distinct().withColumn("__done", F.lit(True))
    return log.select(*PART, "offset").join(marks, [*PART, "offset"], "left").groupBy(*PART).agg(
        F.coalesce(F.min(F.when(F.col("__done").isNull(), F.col("offset"))), F.max("offset") + 1).alias("watermark"),
        (F.max("offset") + 1).alias("end"))


def first_failures(attempts: DataFrame, failed: Column) -> DataFrame:
    """First failed offset per partition; partitions without a failure have no row."""
    return attempts.filter(failed).groupBy(*PART).agg(F.min("offset").alias("failed_at"))


def stop_at_failure(attempts: DataFrame, failed: Column) -> DataFrame:
    """Rows strictly before their partition's first failure: a failed record stops its partition."""
    joined = attach(attempts, first_failures(attempts, failed), PART)
    return joined.filter(F.col("failed_at").isNull() | (F.col("offset") < F.col("failed_at"))).drop("failed_at")


def failure_report(attempts: DataFrame, failed: Column) -> DataFrame:
    """Per partition: what a group may commit, the first failure if any, rows handled and rows left."""
    joined = attach(attempts.withColumn("__failed", F.coalesce(failed, F.lit(False))),
                    first_failures(attempts, failed), PART)
    before = F.col("failed_at").isNull() | (F.col("offset") < F.col("failed_at"))
    return joined.groupBy(*PART).agg(
        F.max("failed_at").alias("failed_at"),
        F.coalesce(F.max("failed_at"), F.max("offset") + 1).alias("commit"),
        F.count_if(before).alias("handled"), F.count_if(~before).alias("left"))


def nack_deliveries(log: DataFrame, nacked: Column, at: Column, pause_ms: int, max_rows: int,
                    chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Every call a listener sees when polls bring at most ``max_rows`` records and each nacked record is nacked once.

    A nack ends its poll: the records before it are acked, those after it were never seen, and after the pause the next
    poll begins with the nacked record. Between two nacks polls follow one another from the first of them, so a
    record's poll follows from the last nack before it: no poll is played through. Rows: (topic, partition, offset,
    poll, attempt, t_ms, action), one per call.
    """
    chunk = scans.id_chunk("offset", chunk_rows)
    placed = materialised(scans.scan(log.select(*PART, "offset", nacked.alias("__nack"), at.cast("bigint").alias("__at")),
                                     PART, ["offset"], chunk, __i=scans.index()))
    stops = scans.scan(placed.filter("__nack").select(*PART, "offset", "__i"), PART, ["offset"], chunk, __from=scans.previous(F.col("__i")))
    polls = F.floor((F.col("__i") - F.coalesce("__from", F.lit(0))) / max_rows) + 1
    stops = scans.scan(materialised(stops.select(*PART, "offset", polls.alias("__polls"))), PART, ["offset"], chunk,
                       __sum=scans.running_sum(F.col("__polls")), __k=scans.index())
    marked = placed.join(stops.select(*PART, "offset", "__sum", (F.col("__k") + 1).alias("__k")), [*PART, "offset"], "left")
    last = F.when(F.col("__sum").isNotNull(), F.struct(F.col("__i").alias("i"), F.col("__sum").alias("polls"), F.col("__k").alias("k")))
    rows = scans.scan(materialised(marked), PART, ["offset"], chunk, __last=scans.last_known(last))
    poll = F.coalesce("__last.polls", F.lit(0)) + F.floor((F.col("__i") - F.coalesce("__last.i", F.lit(0))) / max_rows) + 1
    nacks = F.coalesce("__last.k", F.lit(0))

    def call(number: Column, attempt: int, pauses: Column, action: str) -> Column:
        return F.struct(number.cast("bigint").alias("poll"), F.lit(attempt).alias("attempt"),
                        (F.col("__at") + pauses * pause_ms).alias("t_ms"), F.lit(action).alias("action"))

    calls = F.when(F.coalesce("__nack", F.lit(False)), F.array(call(poll - 1, 1, nacks - 1, "nacked"), call(poll, 2, nacks, "acked"))).otherwise(
        F.array(call(poll, 1, nacks, "acked")))
    return rows.select(*PART, "offset", F.inline(calls))


def batches(log: DataFrame, max_rows: int, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Number each partition's records into consecutive batches of at most ``max_rows``."""
    numbered = scans.scan(log, PART, ["offset"], scans.id_chunk("offset", chunk_rows), __i=scans.index())
    return numbered.withColumn("batch", F.floor(F.col("__i") / max_rows).cast("bigint")).drop("__i")


def batch_report(log: DataFrame, max_rows: int) -> DataFrame:
    """Calls, mean and largest batch per partition.

    Consecutive batches are full except the last, so the sizes follow from the record count alone."""
    n = F.count(F.lit(1))
    calls = F.ceil(n / max_rows).cast("bigint")
    return log.groupBy(*PART).agg(
        calls.alias("calls"), F.round(n / calls, 4).alias("mean_size"), F.least(n, F.lit(max_rows)).alias("largest"))


def offset_ranges(batch: DataFrame, by: list[str]) -> DataFrame:
    """``p0[0..499] p2[0..152]`` per group of rows. The text has one part per partition, not per record.

    Partitions of different topics are never put together: where ``by`` has no topic, parts read ``topic:p0[..]``."""
    named = "topic" in batch.columns and "topic" not in by
    spans = batch.groupBy(*by, *(["topic"] if named else []), "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    part = F.concat(*([F.col("topic"), F.lit(":")] if named else []), F.lit("p"), F.col("partition").cast("string"), F.lit("["), F.col("lo").cast("string"), F.lit(".."),
                    F.col("hi").cast("string"), F.lit("]"))
    ordered = F.array_sort(F.collect_list(F.struct(*(["topic"] if named else []), "partition", part.alias("text"))))
    return spans.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda s: s["text"]), " ").alias("ranges"))


def first_seen(deliveries: DataFrame, order: str) -> DataFrame:
    """First offset each partition delivered, its end, and the count from there to the end."""
    ends = deliveries.groupBy(*PART).agg(F.min_by("offset", order).alias("first"), (F.max("offset") + 1).alias("end"))
    return ends.withColumn("to_end", F.col("end") - F.col("first"))


def uncommitted_exposure(positions: DataFrame, commits: DataFrame, chunk: Column) -> DataFrame:
    """Per group and tick: position, committed offset and their difference, summed over the partitions.

    ``positions`` has (group, topic, partition, tick, position), one row per tick; ``commits`` has (group, topic,
    partition, tick, committed). A commit counts from its tick on. ``chunk`` is an expression over ``tick``.
    """
    at_tick = commits.groupBy("group", *PART, "tick").agg(F.max("committed").alias("committed"))
    events = positions.select("group", *PART, "tick", "position", F.lit(None).cast("bigint").alias("committed")).unionByName(
        at_tick.withColumn("position", F.lit(None).cast("bigint")))
    merged = events.groupBy("group", *PART, "tick").agg(
        F.max("position").alias("position"), F.max("committed").alias("committed"))
    known = scans.scan(merged, ["group", *PART], ["tick"], chunk, in_force=scans.last_known(F.col("committed")))
    return known.filter(F.col("position").isNotNull()).groupBy("group", "tick").agg(
        F.sum("position").alias("position"), F.sum(F.coalesce("in_force", F.lit(0))).alias("committed"),
        F.sum(F.col("position") - F.coalesce("in_force", F.lit(0))).alias("exposed"))
