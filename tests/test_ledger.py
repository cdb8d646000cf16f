"""Runs of handled offsets against sets of offsets."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import audit, ledger, progress
from tidelog.sources import log as source
from tidelog.streaming import deliver as d

PLACE = "topic string, partition int, offset long"


def plain_runs(places):
    out = []
    for t, p, o in sorted(set(places), key=lambda x: (str(x[0]), str(x[1]), x[2])):
        if out and out[-1][:2] == (t, p) and out[-1][3] == o:
            out[-1] = (t, p, out[-1][2], o + 1)
        else:
            out.append((t, p, o, o + 1))
    return sorted(out, key=str)


def random_places(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice(["a", None]), rng.choice([0, 1, None]), int(rng.triangular(0, 200, 20))) for _ in range(n)]


@pytest.mark.parametrize("chunk_rows", [1, 7, 1000])
def test_runs_of_positions(spark, chunk_rows):
    places = random_places(chunk_rows)
    got = ledger.runs_of(spark.createDataFrame([*places, ("a", 0, None)], PLACE), chunk_rows)
    assert sorted(map(tuple, got.collect()), key=str) == plain_runs(places)


def test_runs_that_overlap_touch_nest_or_are_empty(spark):
    rows = [("t", 0, 0, 5), ("t", 0, 5, 9), ("t", 0, 2, 3), ("t", 0, 20, 30), ("t", 0, 25, 40), ("t", 0, 50, 50), ("t", 1, 1, 2), ("t", 1, 1, 2)]
    df = spark.createDataFrame(rows, ledger.RUN_SCHEMA)
    for chunk_rows in (1, 4, 100):
        assert sorted(map(tuple, ledger.merge_runs(df, chunk_rows).collect())) == [("t", 0, 0, 9), ("t", 0, 20, 40), ("t", 1, 1, 2)]
    assert ledger.merge_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk_rows", [1, 9, 1000])
def test_skip_runs_equals_the_anti_join(spark, chunk_rows):
    done = spark.createDataFrame([p for p in random_places(1, 150) if None not in p], PLACE)
    asked = spark.createDataFrame(random_places(2) + [("a", 0, None), ("a", 5, 3)], PLACE).withColumn("more", F.lit("x"))
    want = audit.skip_handled(asked, done, ["topic", "partition", "offset"])
    runs = ledger.runs_of(done, chunk_rows)
    got = ledger.skip_runs(asked, runs, chunk_rows)
    named = [tuple(r) for r in got.filter(F.col("topic").isNotNull() & F.col("partition").isNotNull()).collect()]
    both = [tuple(r) for r in want.filter(F.col("topic").isNotNull() & F.col("partition").isNotNull()).collect()]
    assert got.columns == asked.columns and sorted(named, key=str) == sorted(both, key=str)
    assert ledger.skip_runs(asked, runs.limit(0), chunk_rows).count() == asked.distinct().count()


def test_watermark_of_runs_equals_the_join(spark):
    log = spark.range(300).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.floor(F.col("id") / 3).alias("offset"))
    done = log.filter(((F.col("partition") == 0) & (F.col("offset") != 40)) | ((F.col("partition") == 1) & (F.col("offset") > 0)))
    for handled in (done, log, log.limit(0)):
        got = ledger.watermark_of_runs(progress.bounds(log), ledger.runs_of(handled, 16))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, progress.done_watermark(log, handled).collect()))


def test_a_ledger_grows_with_gaps_not_records(spark, folder):
    store = ledger.RunLedger(spark, folder + "/ledger", 50)
    for i in range(18):
        before = store.parts()
        store.add(spark.createDataFrame([("t", 0, i * 1000, (i + 1) * 1000)] + ([("t", 1, i * 10, i * 10 + 5)] if i % 2 else []), ledger.RUN_SCHEMA))
        assert before.count() >= 0
    assert sorted((v.first, v.last) for v in store.versions()) == [(0, 15), (16, 16), (17, 17)]
    runs = sorted(map(tuple, store.runs().collect()))
    assert runs[0] == ("t", 0, 0, 18_000) and len(runs) == 1 + 9
    # 1 run of partition 0 and 8 of partition 1 in the merged version, then what came after it.
    assert store.parts().count() == 9 + 1 + 2


def test_data_without_a_marker_is_not_read(spark, folder):
    store = ledger.RunLedger(spark, folder + "/ledger")
    store.add(spark.createDataFrame([("t", 0, 0, 5)], ledger.RUN_SCHEMA))
    spark.createDataFrame([("t", 0, 5, 9)], ledger.RUN_SCHEMA).write.parquet(f"{store.base}/data/000000000001-000000000001-dead")
    assert [tuple(r) for r in store.runs().collect()] == [("t", 0, 0, 5)]
    assert store.add(spark.createDataFrame([("t", 0, 7, 9)], ledger.RUN_SCHEMA)) == 1


def test_at_most_once_keeps_runs_and_no_batches(spark, folder):
    rows = spark.range(500).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    source.with_log_columns(rows).write.partitionBy("topic", "partition").parquet(folder + "/log")
    spark.createDataFrame([("t", 0, o) for o in range(100)], PLACE).write.parquet(folder + "/started")
    for run in (1, 2):
        stream = source.read_log_stream(spark, folder + "/log").select("topic", "partition", "offset")
        d.drain(d.deliver(stream, d.append_effect(folder + "/effects"), d.AT_MOST_ONCE, f"{folder}/checkpoint{run}", started=folder + "/started"))
    assert sorted(r["offset"] for r in spark.read.parquet(folder + "/effects").collect()) == list(range(100, 500))
    assert [tuple(r) for r in ledger.RunLedger(spark, folder + "/started").runs().collect()] == [("t", 0, 0, 500)]
    assert not os.path.exists(folder + "/started-batches")
