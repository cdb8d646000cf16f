"""Chunks by value and ranks by selection, over values that are hard to cut."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tidelog.operators import partitioning, runs, timelines
from tidelog.plans import scans

HARD = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 1.0, 1.0000000000000002, 0.9999999999999999, 2.0, 1e15, 1e300, -1e300, 1.7976931348623157e308, math.inf, -math.inf]


def test_codes_never_decrease(spark):
    rng = random.Random(3)
    values = HARD + [struct.unpack("d", rng.randbytes(8))[0] for _ in range(4000)] + [2.0 ** k for k in range(-1074, 1024)]
    values += [math.nextafter(2.0 ** k, way) for k in range(-1000, 1000, 7) for way in (0, math.inf)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    rows = df.select("v", scans.order_code(df, "v").alias("c")).orderBy(F.col("v").asc_nulls_first(), "c").collect()
    codes = [r["c"] for r in rows]
    assert codes == sorted(codes) and codes[0] == -(1 << 62) and codes[-1] - codes[1] < 1 << 63
    for kind, values in (("bigint", [-(2 ** 63), -1, 0, 1, 2 ** 63 - 1]), ("int", [-5, 7]), ("decimal(20,2)", [1, 2])):
        other = spark.createDataFrame([(str(v),) for v in values], "s string").select(F.col("s").cast(kind).alias("v"))
        codes = [r["c"] for r in other.select("v", scans.order_code(other, "v").alias("c")).orderBy("v").collect()]
        assert codes == sorted(codes) and codes[0] < codes[-1]


@pytest.mark.parametrize("shape", ["even", "steep", "ties", "one", "none"])
def test_chunks_of_values(spark, shape):
    rng = random.Random(5)
    values = {"even": [i * 1.5 for i in range(2000)], "steep": [2.0 ** (i / 3) * (-1) ** i for i in range(2000)],
              "ties": [7.0] * 1500 + [rng.random() for _ in range(500)] + [math.nan, None], "one": [3.0] * 500, "none": []}[shape]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cut = scans.with_value_chunk(df, "v", "c", 50)
    sizes = cut.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_distinct("v").alias("d")).orderBy("c").collect()
    assert sum(r["n"] for r in sizes) == len(values)
    assert all(r["n"] < 100 or r["d"] <= 50 for r in sizes) and len(sizes) <= max(1, 2 * len(values) // 50 + 1)
    seen = [r for r in sizes if r["lo"] is not None]
    assert all(a["hi"] < b["lo"] or math.isnan(b["lo"]) for a, b in zip(seen, seen[1:]))


def test_ranks_of_a_thousand_groups_with_ties_and_gaps(spark, monkeypatch):
    monkeypatch.setattr(runs, "BINS", 8)
    rng = random.Random(7)
    rows = []
    for g in range(1000):
        rows += [(g, rng.choice([1.0, 1.0, rng.random(), rng.lognormvariate(0, 40), None])) for _ in range(rng.randrange(1, 12))]
    rows += [(-1, rng.choice(HARD + [math.nan])) for _ in range(600)] + [(None, float(i)) for i in range(200)] + [(-2, None)]
    df = spark.createDataFrame(rows, "g long, v double")
    held = {}
    for g, v in rows:
        held.setdefault(g, []).extend([] if v is None else [v])
    for r in runs.rank_percentile(df, "v", [0.0, 0.3, 0.5, 1.0], ["g"], 20).collect():
        ordered = sorted(held[r["g"]], key=lambda v: (math.isnan(v), v))
        want = ordered[min(len(ordered) - 1, math.floor(r["p"] * (len(ordered) - 1) + 0.5))] if ordered else math.nan
        assert r["n"] == len(ordered) and (r["value"] == want or math.isnan(want) and math.isnan(r["value"])), r
    assert runs.rank_percentile(df, "v", [0.5], ["g"], 20).count() == len(held)


def test_ranks_of_the_whole_table(spark):
    df = spark.range(1001).select((F.col("id") * 10 ** 9).alias("v"))
    assert [tuple(r) for r in runs.rank_percentile(df, "v", [0.5], [], 10).collect()] == [(0.5, 1001, 5e11)]
    assert runs.rank_percentile(df.limit(0), "v", [0.5], []).count() == 0


def test_orders_far_apart(spark):
    df = spark.range(4000).select((F.col("id") * 1_000_003).alias("o"), (F.col("id") % 3).alias("k"))
    numbered = partitioning.number_records(df, "o", "i", ("k",), chunk_rows=100).collect()
    assert all(r["i"] == r["o"] // 1_000_003 // 3 for r in numbered) and len(numbered) == 4000
    assert "__cut" not in partitioning.number_records(df, "o", "i", ("k",)).columns
    tries = timelines.attempt_no(df, ["k"], "o", chunk_rows=100).agg(F.max("attempt"), F.count_distinct("k", "attempt")).first()
    assert tuple(tries) == (1334, 4000)
