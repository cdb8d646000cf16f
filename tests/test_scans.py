"""Chunked scans against plain windows over the same rows, and size-checked joins in both of their forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.plans import facts, scans


def rows_with_hot_group(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randrange(4)}"
        out.append((group, i, rng.choice([None, rng.randrange(100)]), rng.random() * 10))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("chunk_rows", [1, 3, 17, 1000])
def test_scan_equals_window(spark, chunk_rows):
    df = spark.createDataFrame(rows_with_hot_group(300, chunk_rows), "g string, o long, v int, x double")
    got = scans.scan(df, ["g"], ["o"], scans.id_chunk("o", chunk_rows),
                     i=scans.index(), s=scans.running_sum(F.col("v")), m=scans.running_max(F.col("v")),
                     k=scans.last_known(F.col("v")), p=scans.previous(F.col("v")), f=scans.following(F.col("v")))
    w = Window.partitionBy("g").orderBy("o")
    u = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", (F.row_number().over(w) - 1).cast("long").alias("i"), F.coalesce(F.sum("v").over(u), F.lit(0)).alias("s"),
                     F.max("v").over(u).alias("m"), F.last("v", ignorenulls=True).over(u).alias("k"),
                     F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("f"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("rows", [1, 4, 10_000])
def test_scan_over_any_ordered_type(spark, rows):
    df = spark.createDataFrame([(("a" if i % 3 else "b"), i / 7.0) for i in range(100)], "g string, at double")
    cut = scans.with_chunk(df, "at", "cut", rows)
    got = scans.scan(cut, ["g"], ["at"], F.col("cut"), i=scans.index()).drop("cut")
    w = Window.partitionBy("g").orderBy("at")
    want = df.withColumn("i", (F.row_number().over(w) - 1).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_chunks_are_bounded_and_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 3 + 10).alias("id"))
    sizes = df.groupBy(scans.id_chunk("id", 100).alias("c")).agg(F.count("*").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 100
    cut = scans.with_value_chunk(df, "id", "c", 100).groupBy("c").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    spans = sorted((r["lo"], r["hi"], r["n"]) for r in cut.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert max(s[2] for s in spans) < 300


def test_attach_is_the_same_when_it_has_to_shuffle(spark):
    rows = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("offset"))
    few = spark.createDataFrame([(i, f"f{i}") for i in range(5)], "k long, label string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = facts.attach(rows, few, ["k"], how)
        large = facts.attach(rows, few, ["k"], how, limit=2)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.select(*small.columns).collect()))


def test_attach_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "k string, offset long")
    few = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, label string")
    for limit in (1, 10):
        got = facts.attach(rows, few, ["k"], limit=limit)
        assert sorted((r["offset"], r["label"]) for r in got.collect()) == [(1, None), (2, "x")]


def test_seek_is_the_same_as_a_join(spark, monkeypatch):
    log = spark.range(600).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"),
                                  F.floor(F.col("id") / 3).alias("offset"))
    starts = spark.createDataFrame([("t", 0, 150, 180), ("t", 1, 199, None)], "topic string, partition int, start long, stop long")
    literal = sorted(map(tuple, facts.seek(log, starts, "start", "stop").collect()))
    monkeypatch.setattr(facts, "SEEK_LIMIT", 1)
    assert sorted(map(tuple, facts.seek(log, starts, "start", "stop").collect())) == literal
    assert len(literal) == 31


def test_seek_reaches_the_parquet_scan(spark, folder):
    log = spark.range(900).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"))
    log.write.partitionBy("topic", "partition").parquet(folder + "/log")
    read = spark.read.parquet(folder + "/log")
    starts = spark.createDataFrame([("t", 1, 800)], "topic string, partition int, start long")
    plan = facts.seek(read, starts, "start")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(offset,800)" in plan
    assert "Join" not in plan
