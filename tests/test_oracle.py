"""Every registered query against its SQL, with chunks small enough that each ordered scan spans several."""

import pytest

from compare import differences
from tidelog import oracle, workloads
from tidelog.queries import QUERIES

def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, smallest, monkeypatch, name):
    monkeypatch.setattr(workloads, "QUERY_CHUNK", 300)
    assert differences(QUERIES[name](spark, smallest), oracle.SQL[name], smallest) == ""


def test_codec_report(spark, folder, smallest):
    from tidelog.sources import sinks

    rows = {r["codec"]: r for r in sinks.codec_report(spark.read.parquet(f"{smallest}/lineitem.parquet"), folder).collect()}
    assert set(rows) == {"uncompressed", "lz4_raw", "snappy", "zstd", "gzip"} and len({r["records"] for r in rows.values()}) == 1
    assert rows["uncompressed"]["rate"] == 1.0
    assert 0 < rows["zstd"]["bytes"] < rows["uncompressed"]["bytes"]


def test_codec_report_shuffles_the_rows_once(spark, folder, smallest, monkeypatch):
    from tidelog.sources import sinks

    spread = []
    bulk = sinks.write_bulk
    monkeypatch.setattr(sinks, "write_bulk", lambda df, path, codec, **more: spread.append(codec) or bulk(df, path, codec, **more))
    table = spark.read.parquet(f"{smallest}/lineitem.parquet")
    sinks.codec_report(table, folder, ("zstd", "uncompressed", "gzip")).collect()
    assert spread == ["zstd"]
    for codec in ("uncompressed", "gzip"):
        back = spark.read.parquet(f"{folder}/{codec}")
        assert back.schema == table.schema and back.exceptAll(table).isEmpty() and table.exceptAll(back).isEmpty()


def test_register_gate_accepts_the_first_candidate_of_each_subject(spark, smallest):
    rows = QUERIES["register_gate"](spark, smallest).toPandas().sort_values(["subject", "candidate"])
    assert rows.groupby("subject").first()["accepted"].all()
    assert (rows.loc[~rows["accepted"], "reason"].notna()).all()
    accepted = rows[rows["accepted"]]
    assert (accepted.groupby("subject").cumcount() + 1 == accepted["version"].astype(int)).all()


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert sum(r["sent"] for r in rows) == 1000
    assert sum(r["missing"] for r in rows) == 91
