"""Progress of streaming queries as rows."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelog.sources.log import exists

PROGRESS_SCHEMA = ("query string, run string, batch_id bigint, input_rows bigint, start_offset string, end_offset string, "
                   "lag bigint, duration_ms bigint, observed string")


def progress_row(p: dict) -> tuple:
    """One micro-batch. ``lag`` is what the source still holds, where it reports that."""
    sources = p.get("sources") or []
    lag = None
    for s in sources:
        behind = (s.get("metrics") or {}).get("maxOffsetsBehindLatest") or (s.get("metrics") or {}).get("numFilesOutstanding")
        if behind is not None:
            lag = max(lag or 0, int(behind))
    text = lambda key: json.dumps([s.get(key) for s in sources])
    return (p.get("name") or p["id"], p["runId"], int(p["batchId"]), int(p["numInputRows"]), text("startOffset"), text("endOffset"),
            lag, int(p.get("batchDuration") or 0), json.dumps(p.get("observedMetrics") or {}))


def progress_table(spark: SparkSession, path: str, query: StreamingQuery | None = None) -> DataFrame:
    """All micro-batches that a recorder has flushed to a table, of one query's run if given, each once."""
    if not exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    rows = spark.read.schema(PROGRESS_SCHEMA).parquet(path)
    return rows if query is None else rows.filter(F.col("run") == str(query.runId))


class ProgressRecorder(StreamingQueryListener):
    """Collects progress of all queries of a session; ``flush`` appends it to a table.

    Rows per micro-batch, not per record; none is ever dropped. With ``spark`` and ``path`` every ``every`` rows are
    flushed by themselves, so the driver holds no more than that.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None, every: int = 1000):
        self._rows: list[tuple] = []
        self._spark, self._path, self._every = spark, path, every
        self._lock = threading.Lock()
        self._ended: set[str] = set()
        self.started = 0
        self.terminated = 0

    def onQueryStarted(self, event) -> None:
        self.started += 1

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(progress_row(json.loads(event.progress.json)))
            full = self._path is not None and len(self._rows) >= self._every
        if full:
            self.flush(self._spark, self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.terminated += 1
        self._ended.add(str(event.runId))

    def wait_for_end(self, query: StreamingQuery) -> None:
        """Until the reports of an ended query are all in: they come after its end, in order."""
        while str(query.runId) not in self._ended:
            time.sleep(0.05)

    def flush(self, spark: SparkSession, path: str) -> int:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return len(rows)
