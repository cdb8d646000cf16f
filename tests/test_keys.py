"""The two forms of the key hash, against each other and against a plain loop."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import keys
from tidelog.sources import log as source


def plain(data: bytes) -> int:
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = (0x9747B28C ^ len(data)) & mask
    full = len(data) // 4 * 4
    for i in range(0, full, 4):
        k = int.from_bytes(data[i:i + 4], "little") * m & mask
        k = (k ^ (k >> 24)) * m & mask
        h = (h * m & mask) ^ k
    if full < len(data):
        h = (h ^ int.from_bytes(data[full:], "little")) * m & mask
    h = (h ^ (h >> 13)) * m & mask
    return h ^ (h >> 15)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=30))
def test_arrow_hash_equals_a_plain_loop(texts):
    texts = [None if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    got = keys.hash_arrow(pa.array(texts, pa.string())).to_pylist()
    assert got == [None if t is None else plain(t.encode()) for t in texts]


def test_sliced_columns_and_long_keys():
    column = pa.array(["a", "bb", None, "x" * 5001, "é" * 7, ""])
    assert keys.hash_arrow(column.slice(2)).to_pylist() == [None, plain(b"x" * 5001), plain(("é" * 7).encode()), plain(b"")]


def test_expression_equals_arrow(spark):
    texts = ["", "a", "ab", "abc", "abcd", "abcde", "customer-19", "Ünïcödé-key", "x" * 333, None]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    for r in df.select(keys.murmur2(F.col("k")).alias("a"), keys.murmur2_expression(F.col("k")).alias("b")).collect():
        assert r["a"] == r["b"]


def test_rows_without_a_key_are_spread(spark):
    rows = spark.range(600).select("id", F.lit(None).cast("string").alias("k"))
    log = source.as_log(rows, "t", F.col("k"), F.lit("v"), F.timestamp_seconds("id"), "id", 6, chunk_rows=100)
    sizes = [r["count"] for r in log.groupBy("partition").count().collect()]
    assert len(sizes) == 6 and min(sizes) > 60
    assert log.groupBy("partition").agg((F.max("offset") + 1 == F.count("*")).alias("dense")).filter(~F.col("dense")).count() == 0


def test_salting_keeps_totals_and_spreads_only_hot_keys(spark):
    from tidelog.operators import partitioning

    rows = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise("cold").alias("key"))
    totals = {r["base_key"]: (r["records"], r["total"], r["shards"]) for r in partitioning.salted_totals(
        partitioning.salt_hot_keys(rows, F.col("key") == "hot", F.col("id"), 8), F.col("id")).collect()}
    assert totals["hot"][:2] == (500, 249_500) and totals["hot"][2] == 8
    assert totals["cold"] == (500, 250_000, 1)
