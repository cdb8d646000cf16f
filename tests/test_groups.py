"""Null groups, several groups, topics and sparse orders."""

import pytest
from pyspark.sql import functions as F

from tidelog.operators import audit, progress, runs, visibility
from tidelog.plans import scans
from tidelog.sources import log as source


def test_retries_keep_records_without_producer(spark):
    rows = [("t", 0, 5, "p", 1, "a"), ("t", 0, 7, "p", 1, "b"), ("t", 0, 8, None, 1, "c"), ("t", 0, 9, None, 1, "d"), ("t", 0, 10, "p", None, "e")]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, producer_id string, sequence int, value string")
    assert sorted(r["value"] for r in audit.dedup_retries(log).collect()) == ["a", "c", "d", "e"]
    bare = audit.dedup_retries(log.drop("value"))
    assert sorted(r["offset"] for r in bare.collect()) == [5, 8, 9, 10]


def test_writes_without_id_are_not_fenced(spark):
    rows = [("a", 5, 1), ("a", 4, 2), ("a", None, 3), (None, 9, 4), (None, 1, 5), ("a", 5, 6)]
    log = spark.createDataFrame(rows, "transactional_id string, epoch int, log_order bigint")
    for chunk in (1, 2, 100):
        assert sorted(r["log_order"] for r in visibility.fence_zombies(log, chunk_rows=chunk).collect()) == [1, 3, 4, 5, 6]


def test_percentile_of_a_null_group(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(1, 6)] + [("a", 7.0)], "run string, v double")
    got = {r["run"]: (r["n"], r["value"]) for r in runs.rank_percentile(df, "v", [0.5], ["run"]).collect()}
    assert got == {None: (5, 3.0), "a": (1, 7.0)}


def test_scan_carries_null_groups_over_chunks(spark):
    df = spark.createDataFrame([(g, i) for g in (None, "", "a") for i in range(20)], "g string, i bigint")
    out = scans.scan(df, ["g"], ["i"], scans.id_chunk("i", 3), n=scans.index(), before=scans.previous(F.col("i")))
    assert out.columns == ["g", "i", "n", "before"]
    assert all(r["n"] == r["i"] and r["before"] == (r["i"] - 1 if r["i"] else None) for r in out.collect()) and out.count() == 60


def test_groups_commit_for_themselves(spark):
    bounds = spark.createDataFrame([("t", 0, 0, 70)], "topic string, partition int, begin bigint, end bigint")
    commits = spark.createDataFrame([("a", "t", 0, 50, 1), ("a", "t", 0, 60, 2), ("b", "t", 0, 10, 1)], "group string, topic string, partition int, committed bigint, committed_at int")
    total = lambda g: progress.lag(bounds, commits, g).filter("topic is null").first()["lag"]
    assert (total("a"), total("b")) == (10, 60)
    assert [r["start"] for r in source.start_policy(bounds, commits, "latest", "a").collect()] == [60]
    for call in (lambda: progress.lag(bounds, commits), lambda: source.start_policy(bounds, commits, "latest")):
        with pytest.raises(ValueError, match="groups"):
            call()


def test_ranges_of_two_topics_stay_apart(spark):
    log = spark.createDataFrame([("b", 0, 5, 1), ("b", 0, 6, 1), ("a", 0, 90, 1)], "topic string, partition int, offset bigint, batch int")
    assert progress.offset_ranges(log, ["batch"]).first()["ranges"] == "a:p0[90..90] b:p0[5..6]"
    assert {r["topic"]: r["ranges"] for r in progress.offset_ranges(log, ["topic"]).collect()} == {"a": "p0[90..90]", "b": "p0[5..6]"}


@pytest.mark.parametrize("ids", [[i * 1_000_000 for i in range(3000)], [i * i * i for i in range(3000)]])
def test_sparse_orders_give_bounded_chunks(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    sizes = [r["count"] for r in scans.with_chunk(df, "id", "c", 300).groupBy("c").count().collect()]
    assert len(sizes) <= 20 and max(sizes) <= 600
    log = source.as_log(df, "t", F.col("id").cast("string"), F.col("id").cast("string"), F.lit("2024-01-01").cast("timestamp"), "id", 3, keep=["id"], chunk_rows=300)
    rows = log.collect()
    for p in range(3):
        part = sorted((r["offset"], r["id"]) for r in rows if r["partition"] == p)
        assert [o for o, _ in part] == list(range(len(part))) and [i for _, i in part] == sorted(i for _, i in part)
