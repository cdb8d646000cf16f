"""A queue worker on a stream: each micro-batch is worked through in rounds until no record of it is open."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidelog.operators.queue import ACCEPT, REJECT, RELEASE
from tidelog.sources.log import exists

ROUNDS = "batch_id bigint, delivery int, acks bigint, left bigint"


def by_decision(decide: Callable[[Column], Column], took_us: Callable[[Column], Column] | None = None) -> Callable[[DataFrame, int], DataFrame]:
    """A worker whose answer, and the time it takes, are expressions of the delivery number."""
    def work(rows: DataFrame, delivery: int) -> DataFrame:
        n = F.lit(delivery)
        return rows.withColumns({"type": decide(n), "took_us": (took_us(n) if took_us else F.lit(0)).cast("bigint")})
    return work


def queue_worker_stream(records: DataFrame, path: str, work: Callable[[DataFrame, int], DataFrame], limit: int, checkpoint: str,
                        lock_us: int | None = None) -> DataStreamWriter:
    """Work through a stream of records as a queue; ``read_acks`` has one row per delivery under ``path``.

    ``work(rows, delivery)`` answers all open records of a round: it returns their columns with ``type`` (null if the worker
    failed, which counts as RELEASE) and, where locks expire, ``took_us``. Released records, and those whose answer came
    after ``lock_us``, are delivered again in the next round, until nothing is open or ``limit`` deliveries end it. A late answer
    is kept with ``applied`` false.

    A round is one job: it reads what the round before left open and writes its acks, so nothing is held in memory or in
    state, whatever the size of a batch. The table of rounds says which are finished. After a crash the same micro-batch comes back,
    finished rounds are read instead of worked through again, and the interrupted one is overwritten: the worker may see its records
    twice, the acks have them once. The records must not have columns of the acks' names.
    """
    taken = {"type", "took_us", "applied", "batch_id", "delivery"} & set(records.columns)
    if taken:
        raise ValueError(f"the acks have columns of these names: {sorted(taken)}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rounds = read_rounds(spark, path).filter(F.col("batch_id") == batch_id)
        # At most one row per delivery of this one batch.
        finished = {r["delivery"]: r["left"] for r in rounds.collect()}
        opened = batch
        for delivery in range(1, limit + 1):
            at = f"{path}/acks/batch_id={batch_id}/delivery={delivery}"
            if delivery not in finished:
                finished[delivery] = _round(work, opened, delivery, lock_us, at, path, batch_id)
            if not finished[delivery]:
                return
            opened = spark.read.parquet(at).filter(_left_open()).drop("type", "took_us", "applied").select(batch.columns)

    return records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def _left_open() -> Column:
    return ~F.col("applied") | (F.col("type") == RELEASE)


def _round(work: Callable[[DataFrame, int], DataFrame], opened: DataFrame, delivery: int, lock_us: int | None, at: str, path: str, batch_id: int) -> int:
    """Deliver the open records once; the number of those still open afterwards."""
    spark = opened.sparkSession
    answers = work(opened, delivery)
    if "took_us" not in answers.columns:
        answers = answers.withColumn("took_us", F.lit(0).cast("bigint"))
    in_time = F.lit(True) if lock_us is None else F.coalesce(F.col("took_us") <= lock_us, F.lit(False))
    answers.withColumns({"type": F.coalesce("type", F.lit(RELEASE)), "applied": in_time}).write.mode("overwrite").parquet(at)
    total = spark.read.parquet(at).agg(F.count(F.lit(1)).alias("acks"), F.count_if(_left_open()).alias("left")).first()
    spark.createDataFrame([(batch_id, delivery, total["acks"], total["left"])], ROUNDS).coalesce(1).write.mode("append").parquet(f"{path}/rounds")
    return total["left"]


def read_rounds(spark: SparkSession, path: str) -> DataFrame:
    """Finished rounds: batch_id, delivery, acks, and how many records were still open after it."""
    at = f"{path}/rounds"
    return spark.read.schema(ROUNDS).parquet(at).distinct() if exists(spark, at) else spark.createDataFrame([], ROUNDS)


def read_acks(spark: SparkSession, path: str) -> DataFrame | None:
    """All acks of finished rounds, with batch_id and delivery; None before the first."""
    if not exists(spark, f"{path}/rounds"):
        return None
    table = spark.read.parquet(f"{path}/acks")
    acks = table.withColumns({"batch_id": F.col("batch_id").cast(T.LongType()), "delivery": F.col("delivery").cast(T.IntegerType())})
    return acks.join(read_rounds(spark, path).select("batch_id", "delivery"), ["batch_id", "delivery"], "left_semi")


def worker_states(acks: DataFrame, ids: Sequence[str], limit: int) -> DataFrame:
    """Per record: acknowledged, archived or available, its deliveries, and how many answers counted or came too late."""
    last = F.max(F.struct("delivery", F.when(F.col("applied"), F.col("type")).alias("type")))
    per = acks.groupBy(*ids).agg(last.alias("last"), F.count_if("applied").alias("applied"), F.count_if(~F.col("applied")).alias("expired"))
    kind = F.col("last.type")
    state = F.when(kind == ACCEPT, "acknowledged").when((kind == REJECT) | (F.col("last.delivery") >= limit), "archived").otherwise("available")
    return per.select(*ids, state.alias("state"), F.col("last.delivery").alias("deliveries"), "applied", "expired")
