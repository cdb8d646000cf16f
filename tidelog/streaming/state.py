"""Keyed state: retry topics with timers and the queue state of a stream of acks.

A call of a state variable is a message to the JVM and back, and a group of rows is a frame of its own, so neither is made per
record. Ids are spread over ``buckets`` groups by their hash. A group takes its rows of a micro-batch at once, and keeps records
that are read together under one state entry: those that wait for the same time, or the ids of one of ``SLOTS`` slots. Only
entries that a micro-batch or a timer concerns are read and written. Both need the RocksDB state store (``use_rocksdb``), as
``transformWithState`` does. The number of buckets belongs to the checkpoint: keep it.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.failures import UNDECODABLE, RetryPolicy
from tidelog.operators.queue import ACCEPT, REJECT, RELEASE, RENEW

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETRY_ENTRIES = "id string, payload string, attempt int, error string, via string"
SETTLED = ("acknowledged", "archived")
QUEUE_STATES = "id string, state string, deliveries int, applied bigint, refused bigint, expired bigint"

BUCKETS = 2048
#: Entries that a bucket's ids are kept in.
SLOTS = 4
#: Records under one entry of those that wait.
HELD = 1000


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket")


class RetryProcessor(StatefulProcessor):
    """Holds failed records until their next attempt is due, then tries again, then parks them."""

    def __init__(self, topic: str, handler: Callable[[str, str, int], str | None], policy: RetryPolicy):
        self.topic, self.handler, self.policy = topic, handler, policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # By the time at which they are due: JSON of the (id, payload) that wait for the same attempt.
        self.waiting = handle.getMapState("waiting", "due_ms bigint, place int", "attempt int, held string")

    def _hold(self, held: list[tuple[str, str]], attempt: int, due_ms: int) -> None:
        place = 0
        for at in range(0, len(held), HELD):
            while self.waiting.containsKey((due_ms, place)):
                place += 1
            self.waiting.updateValue((due_ms, place), (attempt, json.dumps(held[at:at + HELD])))
        self.handle.registerTimer(due_ms)

    def _try(self, records: Iterable[tuple[str, str]], attempt: int) -> tuple[pd.DataFrame, list[tuple[str, str]]]:
        """Deliveries of the records, and those that are to be tried again."""
        delays = self.policy.delays()
        via = self.topic if attempt == 1 else f"{self.topic}-retry-{delays[attempt - 2]}"
        rows, held = [], []
        for id_, payload in records:
            error = self.handler(id_, payload, attempt)
            if error != UNDECODABLE:
                rows.append((id_, payload, attempt, error, via))
            if error is not None and (error in self.policy.fatal or attempt > self.policy.retries):
                rows.append((id_, payload, 0 if error == UNDECODABLE else attempt, error, f"{self.topic}-dlt"))
            elif error is not None:
                held.append((id_, payload))
        return pd.DataFrame(rows, columns=["id", "payload", "attempt", "error", "via"]), held

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, waiting = timerValues.getCurrentProcessingTimeInMs(), []
        for frame in rows:
            out, held = self._try(zip(_plain(frame["id"]), _plain(frame["payload"])), 1)
            waiting += held
            yield out
        if waiting:
            self._hold(waiting, 1, now + self.policy.delays()[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        due = sorted((int(k[0]), int(k[1])) for k in self.waiting.keys() if int(k[0]) <= expiredTimerInfo.getExpiryTimeInMs())
        again = defaultdict(list)
        for k in due:
            attempt, held = self.waiting.getValue(k)
            self.waiting.removeKey(k)
            out, failed = self._try(json.loads(held), int(attempt) + 1)
            again[int(attempt) + 1] += failed
            yield out
        for attempt, failed in again.items():
            if failed:
                self._hold(failed, attempt, now + self.policy.delays()[attempt - 1])

    def close(self) -> None:
        pass


def _plain(column: pd.Series) -> list:
    """Values with None where there is none."""
    return column.astype(object).where(column.notna(), None).tolist()


def retry_topics(stream: DataFrame, topic: str, handler: Callable[[str, str, int], str | None], policy: RetryPolicy,
                 buckets: int = BUCKETS) -> DataFrame:
    """Deliver (id, payload) rows with retries after processing-time delays; one row per delivery.

    A failed record leaves the stream and comes back when due, so the order of one key's records is given up.
    """
    return stream.select("id", "payload", _bucket(buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=RetryProcessor(topic, handler, policy), outputStructType=RETRY_ENTRIES,
        outputMode="append", timeMode="ProcessingTime")


class QueueProcessor(StatefulProcessor):
    """Folds the acks of each record, in arrival order, into its queue state."""

    def __init__(self, limit: int, lock_us: int, forget_ms: int | None = None):
        self.limit, self.lock_us, self.forget_ms = limit, lock_us, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # JSON of [id, delivery, alive_us, lapsed, ended, applied, refused, expired] of the ids of a slot.
        self.records = handle.getMapState("records", "slot int", "held string")
        # JSON of the ids that settled, by the time at which they are forgotten.
        self.settled = handle.getMapState("settled", "due_ms bigint", "held string")

    def _read(self, slot: int) -> dict[str, list]:
        held = self.records.getValue((slot,))
        return {} if held is None else {r[0]: r[1:] for r in json.loads(held[0])}

    def _write(self, slot: int, held: dict[str, list]) -> None:
        if held:
            self.records.updateValue((slot,), (json.dumps([[id_, *r] for id_, r in held.items()]),))
        else:
            self.records.removeKey((slot,))

    def _fold(self, record: list, acks: list[tuple]) -> list:
        delivery, alive, lapsed, ended, applied, refused, expired = record
        for d, delivered, acked, kind in acks:
            if d != delivery:
                expired += int(delivery > 0 and ended is None)
                delivery, alive, lapsed, ended = d, delivered, False, None
            if acked is None or kind is None:
                continue
            lapsed = lapsed or acked - alive > self.lock_us
            if lapsed or ended is not None:
                refused += 1
                continue
            applied += 1
            alive = acked
            if kind != RENEW:
                ended = kind
        return [delivery, alive, lapsed, ended, applied, refused, expired]

    def _state(self, delivery: int, lapsed: bool, ended: str | None) -> str:
        if ended == ACCEPT:
            return "acknowledged"
        if ended == REJECT:
            return "archived"
        if ended == RELEASE or lapsed:
            return "archived" if delivery >= self.limit else "available"
        return "acquired"

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        acks = pd.concat(list(rows)).sort_values("seq", kind="stable")
        by_slot: dict[int, dict[str, list]] = defaultdict(lambda: defaultdict(list))
        for id_, ack in zip(_plain(acks["id"]), zip(*(_plain(acks[c]) for c in ("delivery", "delivered_us", "acked_us", "type")))):
            by_slot[_slot(id_)][id_].append(ack)
        out, settled = [], []
        for slot, ids in by_slot.items():
            held = self._read(slot)
            for id_, own in ids.items():
                record = self._fold(held.get(id_, [0, 0, False, None, 0, 0, 0]), own)
                held[id_] = record
                delivery, _, lapsed, ended, applied, refused, expired = record
                state = self._state(delivery, lapsed, ended)
                out.append((id_, state, delivery, applied, refused, expired + int(ended is None and lapsed)))
                if state in SETTLED:
                    settled.append(id_)
            self._write(slot, held)
        if self.forget_ms is not None and settled:
            due = timerValues.getCurrentProcessingTimeInMs() + self.forget_ms
            before = self.settled.getValue((due,))
            self.settled.updateValue((due,), (json.dumps([*(json.loads(before[0]) if before else ()), *settled]),))
            self.handle.registerTimer(due)
        yield pd.DataFrame(out, columns=["id", "state", "deliveries", "applied", "refused", "expired"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A settled record takes no further ack, so nothing has changed since its timer was set.
        due = (expiredTimerInfo.getExpiryTimeInMs(),)
        settled = self.settled.getValue(due)
        by_slot = defaultdict(set)
        for id_ in json.loads(settled[0]) if settled else ():
            by_slot[_slot(id_)].add(id_)
        for slot, ids in by_slot.items():
            self._write(slot, {id_: r for id_, r in self._read(slot).items() if id_ not in ids})
        self.settled.removeKey(due)
        return iter(())

    def close(self) -> None:
        pass


def _slot(id_: str | None) -> int:
    return zlib.crc32((id_ or "").encode()) % SLOTS


def queue_state_stream(acks: DataFrame, limit: int, lock_us: int, forget_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Current state per record id after each micro-batch (update mode).

    ``acks`` has (id, delivery, delivered_us, acked_us, type, seq). A delivery that nobody answered yet is
    acquired until a later delivery of the record shows that its lock expired. With ``forget_ms`` a settled record
    leaves the state that long after it settled, so the state holds open records only; choose it well beyond the lock,
    as an ack that comes later still would open the record anew. Without it every record stays.
    """
    # Numbers without nulls stay whole numbers in a frame: an ack without a time counts for as little as one without a type,
    # and one whose delivery has no time is not late.
    rows = acks.select(F.col("id"), "delivery", F.coalesce("delivered_us", "acked_us", F.lit(0)).alias("delivered_us"), F.coalesce("acked_us", F.lit(0)).alias("acked_us"),
                       F.when(F.col("acked_us").isNotNull(), F.col("type")).alias("type"), "seq", _bucket(buckets))
    return rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=QueueProcessor(limit, lock_us, forget_ms), outputStructType=QUEUE_STATES,
        outputMode="update", timeMode="None" if forget_ms is None else "ProcessingTime")


def latest_states(updates: DataFrame, order: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Last update per id of a table of appended queue states."""
    fields = ["state", "deliveries", "applied", "refused", "expired"]
    last = updates.groupBy("id").agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("s"))
    return last.select("id", *[F.col(f"s.{f}").alias(f) for f in fields])
