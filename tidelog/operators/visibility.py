"""Which records belong to committed transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.keys import key_family
from tidelog.plans import scans
from tidelog.plans.facts import attach

PART = ["topic", "partition"]


def with_outcome(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Each record with its transaction's outcome: commit, abort, open, or null outside a transaction."""
    # attach() spreads one long transaction, and the records outside any, over many tasks when it has to shuffle.
    ended = markers.select("txn_id", F.col("outcome").alias("__end"))
    return attach(log, ended, ["txn_id"]).withColumn(
        "outcome", F.when(F.col("txn_id").isNotNull(), F.coalesce("__end", F.lit("open")))).drop("__end")


def last_stable_offsets(log: DataFrame, markers: DataFrame) -> DataFrame:
    """First offset of the oldest open transaction per partition, for the partitions that have one.

    Starts from the transactions: their first offsets per partition, combined before the shuffle, without those that
    have a marker. Only four columns of the log are read and no record is judged.
    """
    starts = log.filter(F.col("txn_id").isNotNull()).groupBy(*PART, "txn_id").agg(F.min("offset").alias("first"))
    left_open = starts.join(markers.select("txn_id"), "txn_id", "left_anti")
    return left_open.groupBy(*PART).agg(F.min("first").alias("last_stable"))


def with_visibility(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Each record with ``visible``: whether a committed read returns it."""
    judged = with_outcome(log, markers)
    judged = attach(judged, last_stable_offsets(log, markers), PART)
    below = F.col("last_stable").isNull() | (F.col("offset") < F.col("last_stable"))
    ended_well = F.col("outcome").isNull() | (F.col("outcome") == "commit")
    return judged.withColumn("visible", below & ended_well).select(*log.columns, "visible")


def read_committed(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Records of committed transactions and records outside any, below the last stable offset.

    Committed records above an open transaction stay hidden: a reader must not pass it.
    """
    return with_visibility(log, markers).filter("visible").drop("visible")


def read_uncommitted(log: DataFrame) -> DataFrame:
    """Everything that is physically in the log, aborted and open records included."""
    return log


def visibility_report(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Per isolation level: records seen and the sorted key families among them."""
    judged = with_visibility(log, markers).select(key_family(F.col("key")).alias("family"), "visible")
    # Counted per family first, so the lists below hold families, not records; both levels from the same pass.
    families = judged.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.count_if("visible").alias("n_visible"))
    levels = F.explode(F.array(
        F.struct(F.lit("read_uncommitted").alias("isolation"), F.col("n").alias("n")),
        F.struct(F.lit("read_committed").alias("isolation"), F.col("n_visible").alias("n"))))
    return families.select("family", levels.alias("l")).groupBy(F.col("l.isolation").alias("isolation")).agg(
        F.sum("l.n").alias("records"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("l.n") > 0, F.col("family")))), ",").alias("families"))


def fence_zombies(log: DataFrame, order: str = "log_order", chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Writes whose epoch is not below the highest epoch seen before them for their transactional id.

    Writes without a transactional id or without an epoch are no one's zombies and pass.
    """
    tracked = scans.scan_measured(log.filter(F.col("transactional_id").isNotNull()), ["transactional_id"], order, chunk_rows,
                                  __highest=scans.running_max(F.col("epoch")))
    kept = tracked.filter(F.col("epoch").isNull() | (F.col("epoch") >= F.col("__highest"))).drop("__highest")
    return kept.unionByName(log.filter(F.col("transactional_id").isNull()))
