"""The pipeline against a plain version: SQL for the first four stages, the tokenizer itself for the last."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tidelog.llm import oracle
from tidelog.llm.common import written


@pytest.fixture(scope="module")
def plain(smallest):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{smallest}/{t}.parquet'")
    con.execute(f"CREATE TABLE s0 AS WITH {oracle.measures('documents')} SELECT documents.* FROM documents JOIN judged USING (doc_id) WHERE NOT base_failed AND verdict")
    con.execute(f"CREATE TABLE s1 AS WITH {oracle.lines('s0')} SELECT s0.* REPLACE (kept AS text, length(kept) AS n_chars) FROM s0 JOIN cleaned USING (doc_id)")
    con.execute(f"CREATE TABLE s2 AS WITH RECURSIVE {oracle.near('s1')} SELECT s1.* FROM s1 JOIN near USING (doc_id) WHERE doc_id = class_id")
    con.execute(f"CREATE TABLE s3 AS WITH {oracle.hits('s2', 'benchmark')} SELECT s2.* FROM s2 JOIN dw USING (doc_id) LEFT JOIN hit USING (doc_id) WHERE NOT (coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w))")
    return con


def test_stages(spark, smallest, plain):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = written(stage(spark, docs, smallest))
        assert docs.columns == columns
        assert sorted(map(tuple, docs.collect())) == sorted(plain.execute(f"SELECT * FROM s{k}").fetchall())
    assert 0 < docs.count() < plain.execute("SELECT count(*) FROM s0").fetchone()[0]
    packed = corpus_pipeline.STAGES[4][1](spark, docs, smallest).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in plain.execute("SELECT doc_id, text FROM s3").fetchall():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], np.uint32)
        want += [(i, n, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())) for n, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(tuple, packed[["doc_id", "piece", "start", "length", "ids_crc32"]].to_numpy().tolist())) == sorted(want)


def test_run_gives_what_the_stages_give(spark, smallest, plain):
    assert {r.doc_id for r in corpus_pipeline.run(spark, smallest).collect()} == {i for i, in plain.execute("SELECT doc_id FROM s3").fetchall()}


def test_odd_rows_and_empty_tables(spark, smallest):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    odd = spark.createDataFrame([(None, "a " * 60, None, None, None), (1, None, None, "s", 0), (1, None, None, "s", 0), (2, "", "en", "s", 0), (3, "x" * 100_000, "en", "s", 5),
                                 (4, " ".join(f"w{k}" for k in range(90)), None, None, None), (4, " ".join(f"w{k}" for k in range(90)), None, None, None)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, odd, smallest).collect()
        kept = sorted(r.doc_id or 0 for r in rows)
        assert kept == {"quality_rules": [4, 4], "near_duplicates": [0, 1, 2, 3, 4]}.get(name) or (name not in ("quality_rules", "near_duplicates") and set(kept) == {0, 1, 2, 3, 4}), name
        assert stage(spark, docs.limit(0), smallest).count() == 0
