"""Queue semantics: every record is acknowledged on its own, released ones come back, locks expire."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.plans import scans
from tidelog.plans.once import materialised
from tidelog.plans.once import compute_once

ACCEPT, RELEASE, REJECT, RENEW = "ACCEPT", "RELEASE", "REJECT", "RENEW"
TYPE_CODES = {ACCEPT: 0, RELEASE: 1, REJECT: 2}
_HELD, _EXPIRED = 4, 5


def type_code(kind: Column) -> Column:
    return F.when(kind == ACCEPT, TYPE_CODES[ACCEPT]).when(kind == RELEASE, TYPE_CODES[RELEASE]).otherwise(TYPE_CODES[REJECT])


def worker_distribution(deliveries: DataFrame) -> DataFrame:
    """Records per worker and the sorted partitions they came from."""
    per = deliveries.groupBy("worker", "partition").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("worker").agg(
        F.sum("n").alias("records"),
        F.array_join(F.array_sort(F.collect_set("partition")).cast("array<string>"), ",").alias("partitions"))


def delivery_totals(deliveries: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Deliveries, distinct records and records delivered more than once."""
    per_id = deliveries.groupBy(*ids).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.sum("n").alias("deliveries"), F.count(F.lit(1)).alias("distinct_records"),
                      F.count_if(F.col("n") > 1).alias("redelivered_records"))


def outcome_counts(acks: DataFrame, ids: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Accepted, released and rejected acks, redeliveries, highest delivery count and distinct records."""
    ids, by = list(ids), list(by)
    is_ = lambda t: F.count_if(F.col("type") == t)
    # Per record first, so distinct records are a plain count afterwards.
    per_id = acks.groupBy(*by, *[c for c in ids if c not in by]).agg(
        is_(ACCEPT).alias("a"), is_(RELEASE).alias("l"), is_(REJECT).alias("j"),
        F.count_if(F.col("delivery") > 1).alias("r"), F.max("delivery").alias("m"))
    return per_id.groupBy(*by).agg(
        F.sum("a").alias("accepted"), F.sum("l").alias("released"), F.sum("j").alias("rejected"),
        F.sum("r").alias("redelivered"), F.max("m").alias("max_delivery"), F.count(F.lit(1)).alias("distinct_records"))


def scripted_decision(policy: str, number: Column, delivery: Column) -> Column:
    """The scripted deciders: ``explicit`` over sequence numbers, ``manual`` and ``recoverer`` over offsets."""
    first = delivery == 1
    if policy == "explicit":
        return F.when(number % 50 == 0, REJECT).when((number % 7 == 0) & first, RELEASE).otherwise(ACCEPT)
    if policy == "manual":
        return F.when(number % 10 == 3, REJECT).when((number % 10 == 7) & first, RELEASE).otherwise(ACCEPT)
    if policy == "recoverer":
        return F.when((number % 10 == 5) & first, RELEASE).when(number % 10 == 9, REJECT).otherwise(ACCEPT)
    raise ValueError(f"unknown policy: {policy}")


def recover(error: Column, transient: Sequence[str]) -> Column:
    """Ack for a handler error by its class: transient ones are released, everything else is rejected."""
    return F.when(error.isNull(), ACCEPT).when(error.isin(*transient), RELEASE).otherwise(REJECT)


def queue_worker(records: DataFrame, decide: Callable[[Column], Column], limit: int) -> DataFrame:
    """Deliver every record until it is accepted, rejected or was delivered ``limit`` times; one row per ack.

    ``decide`` maps the delivery count to an ack; null (the decider failed) counts as RELEASE. All deliveries of
    a record are worked out in its own row, without a shuffle.
    """
    types = compute_once(records, __types=F.array(*[F.coalesce(decide(F.lit(d)), F.lit(RELEASE)) for d in range(1, limit + 1)]))
    kind = [F.get("__types", F.lit(i)) for i in range(limit)]
    tries = F.array(*[F.struct(F.lit(i + 1).alias("delivery"), k.alias("type")) for i, k in enumerate(kind)])
    last = F.lit(limit)
    for i, k in reversed(list(enumerate(kind[:-1]))):
        last = F.when(k != RELEASE, i + 1).otherwise(last)
    return types.select(*records.columns, F.inline(F.slice(tries, F.lit(1), last)))


def judge_acks(acks: DataFrame, ids: Sequence[str], order: str, lock_us: int,
               chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Add ``applied`` to every ack: false when the lock had expired or the delivery was already settled.

    ``acks`` has the ids, delivery, delivered_us, acked_us, type and ``order``, the unique order in which acks
    arrived; a delivery nobody answered is one row with a null type. Each RENEW that arrives in time starts the
    lock anew, so a lock is lost at the first gap longer than ``lock_us``.
    """
    group = [*ids, "delivery"]
    cut = scans.with_chunk(acks, order, "__cut", chunk_rows)
    answered = scans.scan(cut, group, [order], F.col("__cut"), __since=scans.previous(F.col("acked_us")),
                          __settled=scans.running_sum(F.when(F.col("type") != RENEW, 1).otherwise(0)))
    gap = F.col("acked_us") - F.coalesce("__since", F.col("delivered_us"))
    own = F.when(F.col("type") != RENEW, 1).otherwise(0)
    late = answered.withColumn("__late", (gap > lock_us).cast("int")).withColumn("__settled", F.col("__settled") - own)
    lapsed = scans.scan(materialised(late), group, [order], F.col("__cut"), __lapsed=scans.running_max(F.coalesce("__late", F.lit(0))))
    applied = F.col("type").isNotNull() & (F.col("__lapsed") == 0) & (F.col("__settled") == 0)
    return lapsed.withColumn("applied", applied).drop("__since", "__settled", "__late", "__lapsed", "__cut")


def queue_state(acks: DataFrame, ids: Sequence[str], order: str, limit: int, lock_us: int, now_us: int | None = None,
                chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Final state per record: acknowledged, archived, available or acquired, with its deliveries and acks.

    ACCEPT settles a record, REJECT archives it, RELEASE and an expired lock make it available again until
    ``limit`` deliveries archive it. A delivery nobody answered in time has expired; ``now_us`` decides for the
    last one (default: it has).
    """
    ids = list(ids)
    group = [*ids, "delivery"]
    placed = scans.scan_measured(acks, group, order, chunk_rows, __i=scans.index(), __since=scans.previous(F.col("acked_us")))
    final = F.col("type").isNotNull() & (F.col("type") != RENEW)
    late = F.col("acked_us") - F.coalesce("__since", F.col("delivered_us")) > lock_us
    # Acks count from the first one up to the settling one, unless an earlier gap lost the lock: both are positions,
    # so a few minima per delivery replace a look at its acks one by one.
    # The settling ack's type travels in the low digits of its position, so all of these are numbers that aggregate
    # in place.
    answered = F.count("type")
    settled = F.min(F.when(final, F.col("__i") * 4 + type_code(F.col("type"))))
    lost_at = F.min(F.when(late, F.col("__i")))
    per_delivery = placed.groupBy(*group).agg(
        answered.alias("__n"), settled.alias("__s"), lost_at.alias("__lost"),
        F.coalesce(F.max("acked_us"), F.max("delivered_us")).alias("__alive"),
    ).withColumn("__settled", F.floor(F.col("__s") / 4)).withColumn(
        "applied", F.least(F.col("__n"), F.col("__settled") + 1, F.col("__lost"))).withColumn(
        "refused", F.col("__n") - F.col("applied"))
    ended = F.col("__settled").isNotNull() & (F.col("__lost").isNull() | (F.col("__settled") < F.col("__lost")))
    held = F.lit(False) if now_us is None else F.col("__lost").isNull() & (F.lit(now_us) <= F.col("__alive") + lock_us)
    outcome = F.when(ended, F.col("__s") % 4).when(held, _HELD).otherwise(_EXPIRED)
    per_id = per_delivery.withColumn("__outcome", outcome).groupBy(*ids).agg(
        F.max(F.col("delivery") * 8 + F.col("__outcome")).alias("__last"), F.max("delivery").alias("deliveries"),
        F.sum("applied").alias("applied"), F.sum("refused").alias("refused"),
        F.count_if(F.col("__outcome") == _EXPIRED).alias("expired"))
    last = F.col("__last") % 8
    state = (
        F.when(last == TYPE_CODES[ACCEPT], "acknowledged").when(last == TYPE_CODES[REJECT], "archived")
        .when(last == _HELD, "acquired").when(F.col("deliveries") >= limit, "archived").otherwise("available")
    )
    return per_id.select(*ids, state.alias("state"), "deliveries", "applied", "refused", "expired")
