"""Scores by steps: the same for any step, with small temporary arrays."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidelog.llm import lm


def rows(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(0), F.col("id") % 17), lambda i: F.concat(F.lit("w"), (i * F.col("id") % 23).cast("string")))).alias("text"))
    out = lm.score(docs, F.col("doc_id") % 7 == 2, F.col("doc_id") % 7 == 3)
    return {r["doc_id"]: r for r in out.collect()}


def test_any_step_gives_the_same_scores(spark, monkeypatch):
    whole = rows(spark)
    monkeypatch.setattr(lm, "STEP", 50)
    stepped = rows(spark)
    assert len(whole) == 300 and whole.keys() == stepped.keys()
    for k, r in whole.items():
        assert tuple(r)[:5] == tuple(stepped[k])[:5]
        assert np.allclose([r.base_score, r.score], [stepped[k].base_score, stepped[k].score], rtol=1e-12, atol=0)


def test_a_shard_adds_up_in_little_memory(monkeypatch):
    rng = np.random.default_rng(1)
    asked = [np.unique(rng.integers(0, 1 << 20, 40_000).astype(np.uint64)) for _ in range(40)]
    monkeypatch.setattr(lm, "written", lambda df: df)
    taken = {}

    class Requests:
        def groupBy(self, *by):
            return self

        def applyInPandas(self, act, schema):
            taken["act"] = act

    lm._answers(Requests())
    frame = pd.DataFrame({"batch": [str(i) for i in range(40)], "codes": [lm._press_sorted(x) for x in asked],
                          "counts": [lm._press(np.ones(len(x), np.uint32)) for x in asked]})
    tracemalloc.start()
    out = taken["act"]((2, 0), frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    total = np.bincount(np.concatenate(asked).astype(np.int64))
    for x, answer in zip(asked, out.counts, strict=False):
        assert (lm._open(answer) == total[x]).all()
    assert out.types.iloc[-1] == (total > 0).sum() and out.tokens.iloc[-1] == total.sum()
    assert peak < 40 * sum(map(len, asked))
