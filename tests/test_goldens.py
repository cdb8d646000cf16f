"""Published deterministic counts of the delivery scenarios."""

from pyspark.sql import functions as F

from tidelog.functions import keys
from tidelog.functions.headers import no_headers
from tidelog.operators import audit, failures, partitioning, progress, queue, records, runs, timelines, visibility
from tidelog.sources import generate, log as source, sinks


def log_of(spark, n, key, partitions, topic="t"):
    rows = spark.range(n).select("id", F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 1000).alias("ts"))
    return source.as_log(rows, topic, key, F.concat(F.lit("v"), F.col("id").cast("string")), F.col("ts"), "id", partitions,
                         keep=("id",), chunk_rows=1000)


def spread(log):
    return [r["records"] for r in partitioning.partition_spread(log).orderBy("partition").collect()]


def test_hash_vectors(spark):
    df = spark.createDataFrame([("21",), ("foobar",), ("abc",)], "k string")
    assert [r[0] for r in df.select(keys.murmur2_signed(F.col("k"))).collect()] == [-973932308, -790332482, 479470107]


def test_key_spread_with_and_without_a_hot_key(spark):
    even = log_of(spark, 30_000, generate.customer_key(F.col("id"), 20), 6)
    assert spread(even) == [4500, 10500, 6000, 3000, 4500, 1500]
    hot = log_of(spark, 30_000, F.when(F.col("id") % 100 < 50, "customer-hot").otherwise(generate.customer_key(F.col("id"), 20)), 6)
    assert spread(hot) == [2400, 20100, 3000, 1500, 2400, 600]
    report = partitioning.moved_keys_report(even).first()
    assert (report["distinct_keys"], report["moved_keys"]) == (20, 0)
    assert partitioning.hot_keys(hot, 1).first()["share"] == 50.0


def test_end_offsets_replay_and_seeks(spark):
    log = log_of(spark, 6000, generate.customer_key(F.col("id"), 100), 3)
    ends = {r["partition"]: r["end"] for r in progress.bounds(log).collect()}
    assert ends == {0: 1860, 1: 2520, 2: 1620}
    last = progress.last_n(log, 100).groupBy("partition").agg(F.min("offset").alias("lo"), F.count("*").alias("n")).collect()
    assert {r["partition"]: (r["lo"], r["n"]) for r in last} == {0: (1760, 100), 1: (2420, 100), 2: (1520, 100)}
    start = F.timestamp_micros(F.lit(1_700_000_000_000_000))
    assert progress.replay(log, from_time=start - F.expr("interval 1 hour")).count() == 6000
    assert progress.replay(log, from_time=start + F.expr("interval 1 hour")).count() == 0
    assert progress.replay(log).count() == 6000
    filtered = records.filter_report(log, F.col("offset") % 2 == 0, ["topic"]).first()
    assert (filtered["seen"], filtered["discarded"], filtered["delivered"]) == (6000, 3000, 3000)


def test_start_policies(spark):
    log = log_of(spark, 3000, generate.customer_key(F.col("id"), 100), 3)
    none_yet = spark.createDataFrame([], "topic string, partition int, committed long")
    bounds = progress.bounds(log)
    total = lambda policy: source.start_policy(bounds, none_yet, policy).agg(F.sum("start")).first()[0]
    assert total("earliest") == 0
    assert total("latest") == 3000
    try:
        total("none")
    except Exception as e:  # noqa: BLE001
        assert "no committed offset" in str(e)
    else:
        raise AssertionError("none must fail without a commit")
    committed = bounds.select("topic", "partition", F.lit(7).cast("long").alias("committed"))
    assert {r["start"] for r in source.start_policy(bounds, committed, "none").collect()} == {7}


def test_nack_order(spark):
    batch = spark.createDataFrame([("t", 0, o) for o in range(6)], "topic string, partition int, offset long")
    # The first poll holds offsets 0 to 4, the nacked one is 3; the next poll starts there.
    first = progress.nack_deliveries(batch, F.col("offset") == 3, F.lit(0), 1000, 5)
    seen = [(r["offset"], r["attempt"], r["action"]) for r in first.orderBy("poll", "offset").collect()]
    assert seen == [(0, 1, "acked"), (1, 1, "acked"), (2, 1, "acked"), (3, 1, "nacked"), (3, 2, "acked"), (4, 1, "acked"), (5, 1, "acked")]


def test_nacks_by_playing_the_polls(spark):
    nacks, size, total = {3, 4, 11, 12, 29}, 5, 40
    batch = spark.createDataFrame([("t", 0, o) for o in range(total)], "topic string, partition int, offset long")
    want, position, poll, t, done = [], 0, 0, 0, set()
    while position < total:
        poll += 1
        for o in range(position, min(total, position + size)):
            if o in nacks - done:
                want.append((poll, o, 1, t, "nacked"))
                done.add(o)
                position, t = o, t + 1000
                break
            want.append((poll, o, 2 if o in done else 1, t, "acked"))
        else:
            position += size
    for chunk in (4, 1000):
        got = progress.nack_deliveries(batch, F.col("offset").isin(*nacks), F.lit(0), 1000, size, chunk)
        assert sorted((r["poll"], r["offset"], r["attempt"], r["t_ms"], r["action"]) for r in got.collect()) == sorted(want)


def scripted(spark, names, topic="t", partition=0):
    rows = spark.createDataFrame([(topic, partition, i, k, "{not json" if k.startswith("poison") else "{}") for i, k in enumerate(names)],
                                 "topic string, partition int, offset long, key string, value string")
    return records.parse_plan(rows.withColumn("timestamp", F.timestamp_micros(F.lit(0).cast("long"))))


def test_blocking_retries(spark):
    log = scripted(spark, ["ok-1", "ok-2", "flaky2-3", "fatal-4", "ok-5", "flaky9-6", "ok-7", "poison-8"])
    rows = failures.retry_in_place(log, failures.scripted_handler, failures.RetryPolicy(), chunk_rows=2).collect()
    assert sum(r["attempt"] > 0 for r in rows) == 12
    assert {r["key"] for r in rows if r["final_error"]} == {"fatal-4", "flaky9-6", "poison-8"}
    due = sorted((r["attempt"], r["due_ms"]) for r in rows if r["key"] == "flaky9-6")
    assert [b - a for (_, a), (_, b) in zip(due, due[1:])] == [200, 400, 800]
    assert next(r["due_ms"] for r in rows if r["key"] == "ok-7") == 600 + 1400


def test_non_blocking_retries(spark):
    log = scripted(spark, ["ok-1", "flaky2-2", "flaky9-3", "ok-4"])
    policy = failures.RetryPolicy(initial_ms=1000, max_ms=10_000)
    rows = failures.retry_topic_entries(log, failures.scripted_handler, policy).collect()
    assert len(rows) == 10
    assert [r["key"] for r in rows if r["via"] == "t-dlt"] == ["flaky9-3"]
    assert [r["via"] for r in sorted((r for r in rows if r["key"] == "flaky9-3"), key=lambda r: (r["attempt"], r["via"] == "t-dlt"))] == [
        "t", "t-retry-1000", "t-retry-2000", "t-retry-4000", "t-dlt"]
    assert [r["due_ms"] for r in rows if r["key"] == "flaky2-2"] == [0, 1000, 3000]
    head = runs.head_of_line(log.select(F.lit("s").alias("strategy"), "kind", F.col("offset").alias("since_send"))).first()
    assert (head["slowest_ok"], head["ok_records"]) == (3, 2)


def test_dead_letter_after_three_attempts(spark):
    log = scripted(spark, ["flaky9-1"])
    tried = failures.with_attempts(log, failures.scripted_handler, failures.RetryPolicy(retries=2))
    assert tried.select(failures.handler_calls()).first()[0] == 3
    dead = failures.dead_letters(tried, failures.final_error()).first()
    assert (dead["topic"], dead["key"], bytes(dead["value"]), dead["original_topic"], dead["error_class"]) == (
        "t-dlt", "flaky9-1", b"{}", "t", failures.TRANSIENT)


def test_queue_outcomes(spark):
    jobs = spark.range(3000).select("id", F.lit(0).alias("partition"), F.col("id").alias("offset"))
    explicit = queue.queue_worker(jobs, lambda d: queue.scripted_decision("explicit", F.col("id"), d), 5)
    r = queue.outcome_counts(explicit, ["id"]).first()
    assert (r["accepted"], r["released"], r["rejected"], r["max_delivery"]) == (2940, 420, 60, 2)
    recovered = queue.queue_worker(jobs, lambda d: queue.scripted_decision("recoverer", F.col("offset"), d), 5)
    r = queue.outcome_counts(recovered, ["id"]).first()
    assert (r["accepted"], r["released"], r["rejected"]) == (2700, 300, 300)


def test_a_decider_that_never_settles_stops_at_the_limit(spark):
    jobs = spark.range(3)
    acks = queue.queue_worker(jobs, lambda d: F.lit(None).cast("string"), 4)
    assert acks.count() == 12 and {r["type"] for r in acks.collect()} == {"RELEASE"}


def lock_run(spark, lock_us, deliveries):
    # One poll acquires 40 records, all acks go out after the slow record's 3 s.
    rows = [(i, d, (d - 1) * 4_000_000, (d - 1) * 4_000_000 + 3_100_000, "ACCEPT", d * 100 + i) for d in range(1, deliveries + 1) for i in range(40)]
    acks = spark.createDataFrame(rows, "id int, delivery int, delivered_us long, acked_us long, type string, seq long")
    return acks, queue.queue_state(acks, ["id"], "seq", limit=2, lock_us=lock_us, chunk_rows=30)


def test_lock_expiry(spark):
    acks, state = lock_run(spark, 2_000_000, 2)
    r = state.agg(F.sum("deliveries"), F.count("*"), F.sum("refused"), F.sum("applied")).first()
    assert tuple(r) == (80, 40, 80, 0)
    assert queue.judge_acks(acks, ["id"], "seq", 2_000_000).filter("applied").count() == 0
    _, state = lock_run(spark, 10_000_000, 1)
    r = state.agg(F.sum("deliveries"), F.count("*"), F.sum("refused"), F.sum("applied")).first()
    assert tuple(r) == (40, 40, 0, 40)
    assert {r["state"] for r in state.collect()} == {"acknowledged"}


def test_committed_visibility(spark, folder):
    def rows(prefix):
        return spark.range(10).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("key"), F.lit("v").alias("value"),
                                      (F.col("id") % 3).cast("int").alias("partition"), F.current_timestamp().alias("timestamp"), "id")
    path, marks = folder + "/log", folder + "/markers"
    sinks.atomic_append({"out": rows("aborted-")}, path, marks, "t1", "id", 3, outcome="abort")
    sinks.atomic_append({"out": rows("committed-")}, path, marks, "t2", "id", 3)
    log, ended = source.read_log(spark, path), sinks.read_markers(spark, marks)
    report = {r["isolation"]: (r["records"], r["families"]) for r in visibility.visibility_report(log, ended).collect()}
    assert report == {"read_uncommitted": (20, "aborted,committed"), "read_committed": (10, "committed")}
    # An open transaction hides what is committed above it in the same partition.
    source.append_log(rows("open-").withColumn("topic", F.lit("out")), path, "id", 3, txn_id="t3")
    sinks.atomic_append({"out": rows("later-")}, path, marks, "t4", "id", 3)
    log, ended = source.read_log(spark, path), sinks.read_markers(spark, marks)
    assert visibility.read_committed(log, ended).count() == 10
    offsets = log.groupBy("partition").agg(F.countDistinct("offset").alias("d"), F.max("offset").alias("m"), F.count("*").alias("n")).collect()
    assert all(r["d"] == r["n"] == r["m"] + 1 for r in offsets)


def test_records_outside_transactions_stay_visible(spark):
    log = spark.createDataFrame([("t", 0, 0, None), ("t", 0, 1, "open"), ("t", 0, 2, None), ("t", 1, 0, None)],
                                "topic string, partition int, offset long, txn_id string")
    ended = spark.createDataFrame([], "txn_id string, outcome string, epoch int")
    got = {(r["partition"], r["offset"]) for r in visibility.read_committed(log, ended).collect()}
    assert got == {(0, 0), (1, 0)}


def test_partitions_lost_when_members_join(spark):
    eager = [("eager", 1, "A", "assigned", [0, 1, 2, 3, 4, 5]), ("eager", 3, "A", "revoked", [0, 1, 2, 3, 4, 5]), ("eager", 4, "A", "assigned", [0, 1, 2]),
             ("eager", 6, "A", "revoked", [0, 1, 2]), ("eager", 7, "A", "assigned", [0, 1])]
    incremental = [("inc", 1, "A", "assigned", [0, 1, 2, 3, 4, 5]), ("inc", 3, "A", "revoked", [3, 4, 5]), ("inc", 6, "A", "revoked", [2])]
    events = spark.createDataFrame(eager + incremental, "group string, at long, member string, action string, partitions array<int>")
    marks = spark.createDataFrame([(g, at, m) for g in ("eager", "inc") for at, m in ((2, "B joins"), (5, "C joins"))], "group string, at long, mark string")
    cost = {(r["group"], r["segment"]): r["revoked"] for r in timelines.rebalance_cost(events, marks, "at", chunk_rows=2).collect()}
    assert (cost["eager", 1], cost["eager", 2]) == (6, 3)
    assert (cost["inc", 1], cost["inc", 2]) == (3, 1)


def test_outage_verification(spark):
    sent = spark.range(36_000).select(F.concat(F.lit("seq-"), F.col("id").cast("string")).alias("key"))
    r = audit.delivery_audit(sent, sent, ["key"]).first()
    assert (r["sent"], r["delivered"], r["distinct_seen"], r["extra_copies"], r["missing"]) == (36_000, 36_000, 36_000, 0, 0)


def test_done_watermark_cases(spark):
    log = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(3)], "topic string, partition int, offset long")
    attempts = log.withColumn("failed", (F.col("partition") == 0) & (F.col("offset") == 1))
    handled = progress.stop_at_failure(attempts, F.col("failed"))
    assert {(r["partition"], r["offset"]) for r in handled.collect()} == {(0, 0), (1, 0), (1, 1), (1, 2)}
    marks = {r["partition"]: r["watermark"] for r in progress.done_watermark(log, handled).collect()}
    assert marks == {0: 1, 1: 3}
    out_of_order = log.filter("partition = 1 or offset = 2")
    assert {r["partition"]: r["watermark"] for r in progress.done_watermark(log, out_of_order).collect()} == {0: 0, 1: 3}
    done = spark.createDataFrame([("t", 0, 4)], "topic string, partition int, offset long")
    assert progress.next_offsets(done).first()["committed"] == 5
    assert progress.next_offsets(done.filter("offset < 0")).count() == 0


def test_tenant_rules(spark):
    vip = spark.createDataFrame([("vip-1",), ("vip-acme",), ("vip-",)], "key string")
    others = spark.range(200).select(generate.customer_key(F.col("id"), 200).alias("key"))
    nulls = spark.range(500).select(F.lit(None).cast("string").alias("key"))
    rows = vip.unionByName(others).unionByName(nulls).withColumn("topic", F.lit("t")).withColumn("seq", F.monotonically_increasing_id())
    placed = partitioning.assign_tenants(rows, 6, "seq", chunk_rows=40)
    got = placed.collect()
    assert {r["partition"] for r in got if (r["key"] or "").startswith("vip-")} == {0}
    assert {r["partition"] for r in got if (r["key"] or "").startswith("customer-")} == {1, 2, 3, 4, 5}
    turns = [sum(1 for r in got if r["key"] is None and r["partition"] == p) for p in range(6)]
    assert turns == [0, 100, 100, 100, 100, 100]
    assert {r["partition"] for r in partitioning.assign_tenants(rows, 1, "seq").collect()} == {0}


def test_fixture_counts(spark):
    """Counts computed independently for the derived inputs at sf0.01."""
    from tidelog import queries

    sf = "/root/testdata/sf0.01"
    get = lambda name: queries.QUERIES[name](spark, sf)
    assert [r["end"] for r in get("bounds").orderBy("partition").collect()] == [1458, 3481, 2048, 1009, 1417, 587]
    audit_total = get("delivery_audit").agg(F.sum("missing"), F.sum("repeated_ids")).first()
    assert tuple(audit_total) == (910, 700)
    assert [r["watermark"] for r in get("done_watermark").orderBy("partition").collect()] == [9, 212, 100, 0, 91, 15]
    overruns = {r["partition"]: r["count"] for r in get("poll_overruns").groupBy("partition").count().collect()}
    assert overruns == {0: 17, 3: 20, 4: 22, 5: 11}
    assert get("idle_periods").count() == 244
    assert no_headers() is not None
