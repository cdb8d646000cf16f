"""Run and event analytics: throughput, rank percentiles, metrics, outages, counter rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.headers import SENT_AT, header_bytes, header_text
from tidelog.plans import scans
from tidelog.plans.facts import attach
from tidelog.plans.once import materialised

MIB = 1_048_576
#: Bins of a round of ``rank_percentile``.
BINS = 4096


def rank_percentile(df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str],
                    cut_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Exact percentile as the value at index ``round(p * (n - 1))`` of the sorted values; NaN for an empty group.

    A selection without a sort. The table is read once, for its keys, the value and the value's place on a line of integers
    (``scans.order_code``). Around each wanted index lies an interval of that line, at first the group's range. A round counts
    the rows of an interval in ``BINS`` equal bins and goes on in the one that holds the index, until an interval holds at
    most ``cut_rows`` rows or a single place. Only the rows of these last intervals are put in order, equal values as one.
    """
    by = list(by)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    thin = materialised(df.select(F.struct(F.lit(0).alias("_"), *by).alias("__g"), F.col(column).alias("__v"), scans.order_code(df, column).alias("__code")))
    present = thin.filter(F.col("__v").isNotNull())
    groups = materialised(thin.groupBy("__g").agg(
        F.count("__v").alias("n"), F.min(F.when(F.col("__v").isNotNull(), F.col("__code"))).alias("__low"), F.max("__code").alias("__high")))
    rank = F.least(F.floor(F.col("p") * (F.col("n") - 1) + 0.5), F.col("n") - 1).cast("bigint")
    states = groups.filter(F.col("n") > 0).select("__g", "n", "__low", "__high", wanted).select(
        "__g", "p", "__low", "__high", F.col("n").alias("__m"), rank.alias("__rank"))

    def inside(intervals: DataFrame) -> DataFrame:
        held = attach(present, intervals.select("__g", "__low", "__high").distinct(), ["__g"], "inner")
        return held.filter((F.col("__code") >= F.col("__low")) & (F.col("__code") <= F.col("__high")))

    interval = ["__g", "__low", "__high"]
    whole = Window.partitionBy(*interval)
    wide = (F.col("__m") > cut_rows) & (F.col("__low") < F.col("__high"))
    while not states.filter(wide).isEmpty():
        width = F.expr(f"(__high - __low) div {BINS} + 1")
        bins = inside(states.filter(wide)).withColumn("__width", width).groupBy(*interval, "__width", F.expr("(__code - __low) div __width").alias("__bin")).agg(
            F.count(F.lit(1)).alias("__c"))
        upto = bins.withColumn("__upto", F.sum("__c").over(whole.orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        low = F.col("__low") + F.col("__bin") * F.col("__width")
        # Greater than the rest of the line by less than a width, so the sum does not overflow.
        narrowed = states.filter(wide).join(upto, interval).filter(
            (F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__c"))).select(
            "__g", "p", low.alias("__low"), F.least(low + F.col("__width") - 1, "__high").alias("__high"),
            F.col("__c").alias("__m"), (F.col("__rank") - F.col("__upto") + F.col("__c")).alias("__rank"))
        states = materialised(narrowed.unionByName(states.filter(~wide)))
    values = inside(states).groupBy(*interval, "__v").agg(F.count(F.lit(1)).alias("__c"))
    upto = values.withColumn("__upto", F.sum("__c").over(whole.orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = states.join(upto, interval).filter(
        (F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__c"))).select("__g", "p", "__v")
    return groups.select("__g", "n", wanted).join(found, ["__g", "p"], "left").select(
        *[F.col("__g").getField(c).alias(c) for c in by], "p", "n", F.coalesce(F.col("__v").cast("double"), F.lit(float("nan"))).alias("value"))


def approx_percentile(df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Approximate percentiles in one aggregation, where exact ranks are not needed."""
    return df.groupBy(*by).agg(F.percentile_approx(column, list(probabilities), 10_000).alias("values"))


def run_summary(acks: DataFrame, cut_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Per run: records, bytes, elapsed, throughput, errors and latency ranks.

    ``acks`` has (run, sent_us, latency_ms, bytes, failed). Bytes count acknowledged records only; latencies
    count every record.
    """
    done_us = F.col("sent_us") + F.round(F.col("latency_ms") * 1000).cast("bigint")
    totals = acks.groupBy("run").agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.when(~F.col("failed"), F.col("bytes"))), F.lit(0)).cast("bigint").alias("bytes"),
        ((F.max(done_us) - F.min("sent_us")) / 1000.0).alias("elapsed_ms"),
        F.count_if("failed").alias("errors"),
        F.max("latency_ms").alias("max_ms"))
    ranks = rank_percentile(acks, "latency_ms", [0.5, 0.99], ["run"], cut_rows).groupBy("run").agg(
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("p50_ms"),
        F.max(F.when(F.col("p") == 0.99, F.col("value"))).alias("p99_ms"))
    seconds = F.col("elapsed_ms") / 1000.0
    return totals.join(ranks, "run").select(
        "run", "records", "bytes", "elapsed_ms",
        F.try_divide("records", seconds).alias("records_per_s"),
        F.try_divide(F.col("bytes") / MIB, seconds).alias("mib_per_s"),
        "errors", "p50_ms", "p99_ms", "max_ms")


def client_level(tags: Column) -> Column:
    """Whether a sample belongs to the client as a whole: no tag, or only ``client-id``."""
    return (F.size(tags) == 0) | ((F.size(tags) == 1) & F.map_contains_key(tags, "client-id"))


def metric_table(metrics: DataFrame, names: Sequence[str], at: str) -> DataFrame:
    """One row per run, one column per metric: the latest client-level sample, NaN where there is none."""
    kept = metrics.filter(client_level(F.col("tags")) & F.col("name").isin(*names))
    wide = kept.groupBy("run").pivot("name", list(names)).agg(F.max_by("value", at))
    runs = metrics.select("run").distinct()
    return runs.join(wide, "run", "left").select(
        "run", *[F.coalesce(F.col(n), F.lit(float("nan"))).alias(n) for n in names])


def metric_sum(metrics: DataFrame, name: str, like: str) -> DataFrame:
    """Sum of one metric over the clients whose id contains ``like``."""
    matching = metrics.filter((F.col("name") == name) & F.contains(F.col("tags")["client-id"], F.lit(like)))
    return matching.groupBy("run").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("samples"))


def node_id(tags: Column) -> Column:
    """Number of a ``node-<id>`` tag, null outside 0..99 (coordinator connections use other ids)."""
    n = F.regexp_extract(F.try_element_at(tags, F.lit("node-id")), r"^node-(\d+)$", 1).try_cast("bigint")
    return F.when((n >= 0) & (n < 100), n)


def bytes_by_node(metrics: DataFrame, name: str) -> DataFrame:
    """Sum of a per-node metric by run and node."""
    return metrics.filter(F.col("name") == name).withColumn("node", node_id(F.col("tags"))).filter(
        F.col("node").isNotNull()).groupBy("run", "node").agg(F.sum("value").alias("bytes"))


def weighted_mean(timers: DataFrame, by: Sequence[str], total: str = "total", count: str = "count") -> DataFrame:
    """Total time over total count, NaN when nothing was counted; never a mean of means."""
    return timers.groupBy(*by).agg(F.coalesce(
        F.try_divide(F.sum(total).cast("double"), F.sum(count)), F.lit(float("nan"))).alias("mean"))


def transit_latency(log: DataFrame, consumed_ms: Column, by: Sequence[str] = ()) -> DataFrame:
    """Records with a ``sent-at`` header and the mean of consume time minus send time; 0 when there are none."""
    sent = header_text(F.col("headers"), SENT_AT).try_cast("bigint")
    took = log.select(*by, F.when(sent.isNotNull(), consumed_ms - sent).alias("__ms"))
    return took.groupBy(*by).agg(F.count("__ms").alias("stamped"),
                                 F.coalesce(F.avg("__ms"), F.lit(0.0)).alias("mean_ms"))


def wire_size(df: DataFrame, formats: dict[str, Column], headers: str | None = None) -> DataFrame:
    """Mean value and header bytes per record, one row per format, from one pass over the records."""
    sizes = [F.struct(F.lit(n).alias("format"), F.octet_length(c).alias("bytes")) for n, c in formats.items()]
    hdr = header_bytes(F.col(headers)) if headers else F.lit(0)
    tall = df.select(F.explode(F.array(*sizes)).alias("s"), hdr.alias("h"))
    return tall.groupBy(F.col("s.format").alias("format")).agg(
        F.count("s.bytes").alias("records"), F.avg("s.bytes").alias("value_bytes"), F.avg("h").alias("header_bytes"))


def outage_timeline(acks: DataFrame, labels: DataFrame | None = None, every_s: int = 1,
                    chunk_ticks: int = 86_400) -> DataFrame:
    """Per run and tick: sent, acked, failed and retried, as deltas and running totals, and whether acks lag.

    ``acks`` has (run, sent_us, done_us, failed, retries); ``labels`` has (run, tick, label).
    """
    tick = lambda us: F.floor(us / (every_s * 1_000_000)).cast("bigint")
    sent = acks.select("run", tick(F.col("sent_us")).alias("tick"), F.lit(1).alias("sent"), F.lit(0).alias("acked"),
                       F.lit(0).alias("failed"), F.lit(0).alias("retried"))
    done = acks.select("run", tick(F.col("done_us")).alias("tick"), F.lit(0).alias("sent"),
                       F.when(F.col("failed"), 0).otherwise(1).alias("acked"), F.col("failed").cast("int").alias("failed"),
                       F.col("retries").cast("int").alias("retried"))
    names = ["sent", "acked", "failed", "retried"]
    ticks = sent.unionByName(done).groupBy("run", "tick").agg(*[F.sum(c).alias(c) for c in names])
    running = scans.scan(ticks, ["run"], ["tick"], scans.id_chunk("tick", chunk_ticks),
                         **{f"{c}_total": scans.running_sum(F.col(c)) for c in names})
    out = running.withColumn("lagging", F.col("acked_total") + F.col("failed_total") < F.col("sent_total"))
    if labels is None:
        return out.withColumn("label", F.lit(None).cast("string"))
    return out.join(labels.groupBy("run", "tick").agg(F.max("label").alias("label")), ["run", "tick"], "left")


def head_of_line(attempts: DataFrame) -> DataFrame:
    """Slowest innocent record per strategy: what the ok records paid for the failing ones."""
    return attempts.groupBy("strategy").agg(
        F.coalesce(F.max(F.when(F.col("kind") == "OK", F.col("since_send"))), F.lit(0)).alias("slowest_ok"),
        F.count_if(F.col("kind") == "OK").alias("ok_records"))


def counter_rate(samples: DataFrame, by: Sequence[str], order: str, at_us: str, total: str, window_s: int,
                 chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Rate of a cumulative counter over the elapsed time and over a fixed trailing window.

    A total below the one before means the counter restarted and counts from 0. The fixed window divides by its
    full length, so it reports short runs too low.
    """
    by = list(by)
    steps = scans.scan_measured(samples, by, order, chunk_rows, __prev=scans.previous(F.col(total)))
    grown = F.when(F.col("__prev").isNull(), 0).when(F.col(total) < F.col("__prev"), F.col(total)).otherwise(
        F.col(total) - F.col("__prev"))
    ends = samples.groupBy(*by).agg(F.max(at_us).alias("__end"))
    inside = F.col(at_us) > F.col("__end") - window_s * 1_000_000
    # One end per source; with few sources it is broadcast, with many the join keys are spread.
    judged = attach(steps.withColumn("__grown", grown), ends, by)
    return judged.groupBy(*by).agg(
        F.sum("__grown").alias("increase"),
        ((F.max(at_us) - F.min(at_us)) / 1_000_000).alias("elapsed_s"),
        F.try_divide(F.sum("__grown"), (F.max(at_us) - F.min(at_us)) / 1_000_000).alias("rate_elapsed"),
        (F.sum(F.when(inside, F.col("__grown")).otherwise(0)) / window_s).alias("rate_window"))
