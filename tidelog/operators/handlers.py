"""Python handlers over records, for what a Column expression cannot say.

A handler gets a pandas frame and returns one with the given schema. It runs inside tasks on Arrow batches; Spark
decides where. ``guard`` keeps an exception from failing the task: it becomes a status on the row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.plans.once import materialised
from tidelog.plans.scans import CHUNK, CHUNK_ROWS, id_chunk

PART = ["topic", "partition"]
STATUS = "status string, error_class string, error_message string"


def guard(handle: Callable[[dict], None]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A frame handler that calls ``handle`` with each record as a dict, in order, and reports ok or error per record."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        status, kind, message = [], [], []
        names = list(frame.columns)
        for values in frame.itertuples(index=False, name=None):
            try:
                handle(dict(zip(names, values)))
                outcome = ("ok", None, None)
            except Exception as e:  # noqa: BLE001 - a handler may raise anything
                outcome = ("error", type(e).__name__, str(e))
            status.append(outcome[0])
            kind.append(outcome[1])
            message.append(outcome[2])
        return frame.assign(status=status, error_class=pd.Series(kind, index=frame.index, dtype=object),
                            error_message=pd.Series(message, index=frame.index, dtype=object))
    return run


def guarded_schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", " + STATUS


def _apply(handler: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield handler(frame)
    return run


def process_in_order(df: DataFrame, handler: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                     chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Call the handler on records in offset order.

    A partition is handed out as consecutive stretches of offsets, so a partition holding a third of the log is
    still shared by many tasks. Inside a stretch the order is kept; a stretch starts without state from the one
    before. Use ``stop_at_failure`` on the result to drop what follows a partition's first failed record.

    The handled rows are written to the shared folder first: the handler runs once per record, however often the
    result is read, and every reader sees the same outcomes.
    """
    columns = df.columns
    stretched = df.withColumn(CHUNK, id_chunk("offset", chunk_rows)).repartition(*PART, CHUNK)
    ordered = stretched.sortWithinPartitions(*PART, "offset").select(*columns)
    return materialised(ordered.mapInPandas(_apply(handler), schema))


def process_in_batches(df: DataFrame, handler: Callable[[pd.DataFrame], pd.DataFrame], schema: str, n: int) -> DataFrame:
    """One handler call per at most ``n`` records of an input split."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for frame in frames:
            waiting = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            while len(waiting) >= n:
                yield handler(waiting.iloc[:n].reset_index(drop=True))
                waiting = waiting.iloc[n:]
        if waiting is not None and len(waiting):
            yield handler(waiting.reset_index(drop=True))
    return df.mapInPandas(run, schema)


def process_unordered(df: DataFrame, handler: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                      parallelism: int | None = None) -> DataFrame:
    """Independent records, as many tasks as asked for, no order. ``parallelism`` lifts the cap of the log's
    partition count."""
    spread = df.repartition(parallelism) if parallelism else df
    return spread.mapInPandas(_apply(handler), schema)


def call_report(handled: DataFrame) -> DataFrame:
    """Records, failures and failed error classes per partition of a guarded result."""
    return handled.groupBy(*PART).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("status") == "error").alias("failed"))
