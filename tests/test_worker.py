"""The queue worker on a stream: published counts, expired locks, crashes between and inside rounds."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.operators import queue
from tidelog.streaming import deliver as d
from tidelog.streaming import worker


def jobs(spark, folder, n, files):
    spark.range(0, n, 1, files).withColumnRenamed("id", "job").write.parquet(folder + "/in")
    return spark.readStream.schema("job bigint").option("maxFilesPerTrigger", 1).parquet(folder + "/in")


def explicit(n):
    return queue.scripted_decision("explicit", F.col("job"), n)


def test_published_counts(spark, folder):
    stream = jobs(spark, folder, 3000, 3)
    d.drain(worker.queue_worker_stream(stream, folder + "/w", worker.by_decision(explicit), 5, folder + "/c"))
    acks = worker.read_acks(spark, folder + "/w")
    got = queue.outcome_counts(acks, ["job"]).first()
    assert (got["accepted"], got["released"], got["rejected"], got["max_delivery"], got["distinct_records"]) == (2940, 420, 60, 2, 3000)
    states = worker.worker_states(acks, ["job"], 5).groupBy("state").count().collect()
    assert {r["state"]: r["count"] for r in states} == {"acknowledged": 2940, "archived": 60}
    rounds = worker.read_rounds(spark, folder + "/w")
    assert rounds.agg(F.sum("acks")).first()[0] == 3420 and rounds.count() == 6


def test_a_worker_that_never_answers_is_stopped_by_the_limit(spark, folder):
    stream = jobs(spark, folder, 40, 1)
    slow = worker.by_decision(lambda n: F.when(F.col("job") % 2 == 0, queue.ACCEPT), lambda n: F.when(F.col("job") % 4 == 0, 9).otherwise(1))
    d.drain(worker.queue_worker_stream(stream, folder + "/w", slow, 3, folder + "/c", lock_us=5))
    acks = worker.read_acks(spark, folder + "/w")
    states = {r["job"]: tuple(r)[1:] for r in worker.worker_states(acks, ["job"], 3).collect()}
    assert states == {i: ("acknowledged", 1, 1, 0) if i % 4 == 2 else ("archived", 3, 0, 3) if i % 4 == 0 else ("archived", 3, 3, 0) for i in range(40)}


@pytest.mark.parametrize("where", ["before", "inside"])
def test_restart_between_rounds(spark, folder, where):
    """A round that was finished is not worked through again; one that died leaves no acks."""
    stream, calls = jobs(spark, folder, 300, 1), []
    script = worker.by_decision(explicit)

    def work(rows, delivery):
        calls.append(delivery)
        if calls == [1, 2]:
            if where == "before":
                raise RuntimeError("the driver dies between rounds")
            return script(rows, delivery).withColumn("type", F.when(F.col("job") == 280, F.raise_error(F.lit("a task dies"))).otherwise(F.col("type")))
        return script(rows, delivery)

    def writer():
        return worker.queue_worker_stream(stream, folder + "/w", work, 5, folder + "/c")

    with pytest.raises(StreamingQueryException):
        d.drain(writer())
    assert worker.read_acks(spark, folder + "/w").count() == 300
    d.drain(writer())
    assert calls == [1, 2, 2]
    batch = queue.queue_worker(spark.range(300).withColumnRenamed("id", "job"), explicit, 5)
    assert sorted(map(tuple, worker.read_acks(spark, folder + "/w").select("job", "delivery", "type").collect())) == sorted(
        map(tuple, batch.select("job", "delivery", "type").collect()))


def test_nothing_to_do(spark, folder):
    assert worker.read_acks(spark, folder + "/w") is None
    assert worker.read_rounds(spark, folder + "/w").count() == 0
    stream = jobs(spark, folder, 20, 1)
    with pytest.raises(ValueError, match="delivery"):
        worker.queue_worker_stream(stream.withColumn("delivery", F.lit(1)), folder + "/w", worker.by_decision(explicit), 5, folder + "/c")
    d.drain(worker.queue_worker_stream(stream.filter("job < 0"), folder + "/w", worker.by_decision(explicit), 5, folder + "/c"))
    assert worker.read_acks(spark, folder + "/w") is None or worker.read_acks(spark, folder + "/w").count() == 0
