"""Joining rows to small per-partition facts (bounds, commits, watermarks) without shuffling the rows.

How many facts there are follows from the data, so it is measured before anything is broadcast: at most
``limit + 1`` of them are fetched. Within the limit, and within ``FACT_BYTES``, they become a local table that is
broadcast, or literal predicates that reach the parquet scan. Beyond it the join is an ordinary one, each fact once;
adaptive execution splits the rows of a hot partition over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACT_LIMIT = 20_000
FACT_BYTES = 16 << 20
SEEK_LIMIT = 512


def fetch_small(facts: DataFrame, limit: int = FACT_LIMIT) -> pa.Table | None:
    """The facts as a local table, or None when there are more than ``limit`` or they are too large to broadcast."""
    table = facts.limit(limit + 1).toArrow()
    return table if table.num_rows <= limit and table.nbytes <= FACT_BYTES else None


def attach(
    rows: DataFrame,
    facts: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int = FACT_LIMIT,
) -> DataFrame:
    """Join ``rows`` to ``facts`` on equal keys (inner, left, left_semi or left_anti)."""
    table = fetch_small(facts, limit)
    if table is not None:
        local = rows.sparkSession.createDataFrame(table, schema=facts.schema)
        return rows.join(F.broadcast(local), list(on), how)
    return rows.join(facts, list(on), how)


def seek(rows: DataFrame, starts: DataFrame, start: str, stop: str | None = None) -> DataFrame:
    """Rows at or after each partition's ``start`` offset (and before ``stop``).

    ``starts`` has one row per (topic, partition). With few partitions the condition is a literal predicate, so
    a log table is read with its partition directories and row groups pruned, as a consumer's seek would.
    """
    table = fetch_small(starts, SEEK_LIMIT)
    if table is None:
        keyed = attach(rows, starts.select("topic", "partition", F.col(start).alias("__start"),
                                           (F.col(stop) if stop else F.lit(None).cast("bigint")).alias("__stop")),
                       ["topic", "partition"], "inner")
        inside = (F.col("offset") >= F.col("__start")) & (
            F.col("__stop").isNull() | (F.col("offset") < F.col("__stop")))
        return keyed.filter(inside).select(*rows.columns)
    wanted: Column = F.lit(False)
    for r in table.to_pylist():
        one = (F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"])
        if r[start] is not None:
            one = one & (F.col("offset") >= F.lit(r[start]).cast("bigint"))
        if stop is not None and r[stop] is not None:
            one = one & (F.col("offset") < F.lit(r[stop]).cast("bigint"))
        wanted = wanted | one
    return rows.filter(wanted)
