"""The registered queries as plain SQL over the given tables, for checking results in another engine."""

from __future__ import annotations

SQL: dict[str, str] = {}

USER_KEY = "'customer-' || (user_id % 20)"
VIP_KEY = f"CASE WHEN event_id % 10 = 0 THEN 'vip-' || (event_id % 3) ELSE {USER_KEY} END"
RETRY_KEY = ("CASE event_id % 10 WHEN 0 THEN 'fatal-' || event_id WHEN 1 THEN 'poison-' || event_id "
             "WHEN 2 THEN 'flaky2-' || event_id WHEN 3 THEN 'flaky9-' || event_id ELSE 'ok-' || event_id END")
EVENT_JSON = "'{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\",\"value\":' || value || '}'"


def hashes(source: str, column: str) -> str:
    """CTEs ending in ``hashed(key, h)``: unsigned murmur2 of each distinct ASCII key."""
    return f"""
keys AS (SELECT DISTINCT {column} AS key FROM {source} WHERE {column} IS NOT NULL),
key_bytes AS (
  SELECT key, length(key)::BIGINT AS n,
         list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i::BIGINT, 1))::BIGINT) AS b FROM keys),
key_words AS (
  SELECT key, n, b, list_transform(range(0, n // 4), lambda i: b[i*4+1] + b[i*4+2]*256 + b[i*4+3]*65536 + b[i*4+4]*16777216) AS w
  FROM key_bytes),
mixed AS (
  SELECT key, n, b, list_transform(list_transform(w, lambda x: (x * 1540483477) % 4294967296),
                                   lambda x: (xor(x, x >> 24) * 1540483477) % 4294967296) AS w FROM key_words),
body AS (
  SELECT key, n, b, list_reduce(w, lambda h, x: xor((h * 1540483477) % 4294967296, x), xor(2538058380, n)) AS h FROM mixed),
tailed AS (
  SELECT key, CASE WHEN n % 4 = 0 THEN h ELSE (xor(h, b[n - n % 4 + 1]
           + CASE WHEN n % 4 > 1 THEN b[n - n % 4 + 2] * 256 ELSE 0 END
           + CASE WHEN n % 4 > 2 THEN b[n - n % 4 + 3] * 65536 ELSE 0 END) * 1540483477) % 4294967296 END AS h FROM body),
folded AS (SELECT key, (xor(h, h >> 13) * 1540483477) % 4294967296 AS h FROM tailed),
hashed AS (SELECT key, xor(h, h >> 15) AS h FROM folded)"""


def log6(key: str = USER_KEY, n: int = 6) -> str:
    """CTEs ending in ``log6``: events with partition and dense offset."""
    return f"""
ev AS (SELECT *, {key} AS key FROM events),
{hashes('ev', 'key')},
log6 AS (
  SELECT 'events' AS topic, ((h & 2147483647) % {n})::INT AS "partition", ev.key, event_id, ts, epoch_us(ts) AS ts_us,
         user_id, event_type, value, props,
         row_number() OVER (PARTITION BY (h & 2147483647) % {n} ORDER BY event_id) - 1 AS "offset"
  FROM ev JOIN hashed ON ev.key = hashed.key)"""


def on_log(name: str, body: str, key: str = USER_KEY, more: str = "") -> None:
    SQL[name] = f"WITH {log6(key)}{',' + more if more else ''}\n{body}"


ENDS = """
ends AS (SELECT topic, "partition", min("offset") AS "begin", max("offset") + 1 AS "end", count(*) AS records FROM log6 GROUP BY ALL),
commits AS (SELECT topic, "partition", floor(0.8 * "end")::BIGINT AS committed FROM ends WHERE "partition" <> 5)"""

# ---- sources and sinks ------------------------------------------------------------------------------------------

on_log("as_log", 'SELECT topic, "partition", "offset", key, event_id, ts_us FROM log6')
on_log("append_then_read_log", 'SELECT topic, "partition", "offset", key, event_id FROM log6')
on_log("log_index", """SELECT topic, "partition", min("offset") AS "begin", max("offset") + 1 AS "end", count(*) AS records, min(ts_us) AS first_us,
max(ts_us) AS last_us, count(DISTINCT day(ts) // 8) AS appends FROM log6 GROUP BY ALL""")
on_log("seek_by_index", """SELECT 'time' AS replay, l."partition", l."offset", event_id FROM log6 l
JOIN (SELECT "partition" AS p, min("offset") AS s FROM log6 WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1) ON l."partition" = p WHERE l."offset" >= s
UNION ALL SELECT 'last', l."partition", l."offset", event_id FROM log6 l JOIN (SELECT "partition" AS p, count(*) AS n FROM log6 GROUP BY 1) ON l."partition" = p
WHERE l."offset" >= n - 100""")
SQL["append_reports_unplaceable"] = """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'no partition' ELSE 'partition out of range' END AS reason
FROM events WHERE event_id % 17 = 0 OR event_id % 19 = 0"""
on_log("read_assigned", """SELECT "partition", "offset", event_id FROM log6
WHERE ("partition" = 0 AND "offset" >= 100) OR ("partition" = 1 AND "offset" >= 500) OR "partition" = 3""")
on_log("start_policy_earliest", """SELECT e.topic, e."partition", committed, coalesce(committed, "begin") AS "start"
FROM ends e LEFT JOIN commits c ON e."partition" = c."partition\"""", more=ENDS)
on_log("start_policy_latest", """SELECT e.topic, e."partition", committed, coalesce(committed, "end") AS "start"
FROM ends e LEFT JOIN commits c ON e."partition" = c."partition\"""", more=ENDS)
on_log("start_policy_none", """SELECT topic, "partition", "end" // 2 AS committed, "end" // 2 AS "start" FROM ends""", more=ENDS)
SQL["with_headers"] = """
SELECT 'routed' AS topic, event_id, 3 AS n_headers, upper(event_type) AS type_header, event_id::VARCHAR AS trace_header,
       NULL::VARCHAR AS absent_header FROM events"""
SQL["stamp_sent_at"] = "SELECT event_id, (epoch_us(ts) // 1000)::VARCHAR AS sent_at FROM events"
SQL["top_up"] = f"""
WITH total AS (SELECT count(*) AS n FROM events),
ids AS (SELECT 'customer-' || (i % 100) AS key FROM (
  SELECT unnest(range((SELECT n // 3 FROM total))) AS i UNION ALL SELECT unnest(range((SELECT n - n // 3 FROM total))))),
{hashes('ids', 'key')}
SELECT 'seed' AS topic, ((h & 2147483647) % 6)::INT AS "partition", 0::BIGINT AS "begin", count(*) AS "end", count(*) AS records
FROM ids JOIN hashed USING (key) GROUP BY ALL"""
SQL["gen_orders"] = """
SELECT o_orderkey AS seq, 'ORD-' || o_orderkey AS "orderId", 'customer-' || (o_orderkey % 20) AS "customerId",
       (((10 + o_orderkey % 990 + (o_orderkey % 100) * 100)::DECIMAL(18,0) / 100)::DECIMAL(12,2))::VARCHAR AS "totalAmount",
       'EUR' AS currency, epoch_us(o_orderdate) AS created_us FROM orders"""
SQL["gen_payload"] = """
SELECT event_id AS seq, 'customer-' || (event_id % 100) AS key,
       '{"seq":' || event_id || ',"station":"' || ['harbour', 'ridge', 'meadow', 'quarry', 'delta'][event_id % 5 + 1] || '","readings":['
       || array_to_string(list_transform(range(1, 93), lambda i: 1000 + (event_id * 37 + i * 101) % 9000), ',') || ']}' AS value FROM events"""
SQL["gen_random"] = """
SELECT event_id AS seq, 'customer-' || (event_id % 100) AS key,
       left(list_reduce(list_transform(range(0, 3), lambda i: rtrim(to_base64(unhex(sha256('0:' || event_id || ':' || i))), '=')),
                        lambda a, x: a || x), 100) AS value FROM events"""
SQL["write_by_type"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'bytes' ELSE 'order' END AS kind,
       CASE WHEN o_orderkey % 3 = 0 THEN '{not json' ELSE '{"orderId":"ORD-' || o_orderkey || '","currency":"EUR"}' END AS value FROM orders"""
SQL["atomic_append"] = """
SELECT CASE event_type WHEN 'error' THEN 'clicks' ELSE event_type || 's' END AS topic, count(*) AS records,
       'read_uncommitted' AS isolation FROM events GROUP BY 1
UNION ALL
SELECT event_type || 's' AS topic, count(*) AS records, 'read_committed' AS isolation
FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1"""

# ---- projections and filters ------------------------------------------------------------------------------------

on_log("map_value", 'SELECT "partition", "offset", key, upper(event_type) AS value FROM log6')
on_log("filter_records", """SELECT topic, "partition", count(*) FILTER ("offset" % 2 = 0) AS delivered, max("offset") + 1 AS committed
FROM log6 GROUP BY ALL""")
on_log("filter_report", """SELECT topic, "partition", count(*) AS seen, count(*) FILTER ("offset" % 2 = 1) AS discarded,
count(*) FILTER ("offset" % 2 = 0) AS delivered FROM log6 GROUP BY ALL""")
on_log("record_id", """SELECT event_id, "partition" || '-' || "offset" AS id, topic || '-' || "partition" || '-' || "offset" AS full_id FROM log6""")
SQL["key_parts"] = f"""
SELECT event_id, {VIP_KEY} AS key, CASE WHEN event_id % 10 = 0 THEN 'vip' ELSE 'customer' END AS family,
       CASE WHEN event_id % 10 = 0 THEN event_id % 3 ELSE user_id % 20 END AS number FROM events"""
SQL["parse_plan"] = f"""
WITH k AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN {USER_KEY} WHEN event_id % 89 = 0 THEN NULL ELSE {RETRY_KEY} END AS key FROM events)
SELECT event_id, key,
       CASE WHEN key LIKE 'ok-%' THEN 'OK' WHEN key LIKE 'fatal-%' THEN 'FATAL' WHEN key LIKE 'poison-%' THEN 'POISON'
            WHEN key LIKE 'flaky%' THEN 'FLAKY' END AS kind,
       CASE WHEN key LIKE 'flaky2%' THEN 2 WHEN key LIKE 'flaky9%' THEN 9
            WHEN key LIKE 'ok-%' OR key LIKE 'fatal-%' OR key LIKE 'poison-%' THEN 0 END::INT AS failures,
       CASE WHEN key IS NULL OR key LIKE 'customer%' THEN 'no script for key ' || coalesce(key, 'null') END AS plan_error FROM k"""
SQL["narrow"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 29 <> 0 THEN 'ORD-' || o_orderkey END AS "orderId",
       CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 29 <> 0 THEN o_totalprice::DECIMAL(12,2)::VARCHAR END AS "totalAmount" FROM orders"""

# ---- partitioning and skew --------------------------------------------------------------------------------------

SQL["key_partition"] = f"""
WITH {hashes('customer', 'c_name')}
SELECT c_custkey, (CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INT AS hash,
       ((h & 2147483647) % 6)::INT AS p6, ((h & 2147483647) % 100)::INT AS p100
FROM customer JOIN hashed ON c_name = key"""
SQL["tenant_partition"] = f"""
WITH ev AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE {VIP_KEY} END AS key FROM events),
{hashes('ev', 'key')},
turns AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS turn FROM ev WHERE key IS NULL)
SELECT ev.event_id, ev.key,
       (CASE WHEN ev.key IS NULL THEN turn % 5 + 1 WHEN ev.key LIKE 'vip-%' THEN 0 ELSE (h & 2147483647) % 5 + 1 END)::INT AS "partition"
FROM ev LEFT JOIN hashed ON ev.key = hashed.key LEFT JOIN turns ON ev.event_id = turns.event_id"""
SQL["round_robin_partition"] = """
SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) % 6)::INT AS "partition" FROM events"""
SQL["salted_totals"] = f"""
SELECT {USER_KEY} AS base_key, count(*) AS records, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY 1"""
on_log("partition_spread", """SELECT "partition", count(*) AS records, round(100.0 * count(*) / (SELECT count(*) FROM log6), 1) AS share
FROM log6 GROUP BY 1""")
SQL["moved_keys"] = f"""
WITH ev AS (SELECT ts, {USER_KEY} AS key FROM events),
{hashes('ev', 'key')},
placed AS (SELECT ev.key, (h & 2147483647) % CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 6 ELSE 4 END AS p FROM ev JOIN hashed ON ev.key = hashed.key)
SELECT key, count(DISTINCT p) AS partitions, count(*) AS records FROM placed GROUP BY 1 HAVING count(DISTINCT p) > 1"""
on_log("moved_keys_report", """SELECT count(*) AS distinct_keys, count(*) FILTER (p > 1) AS moved_keys
FROM (SELECT key, count(DISTINCT "partition") AS p FROM log6 GROUP BY 1)""")
SQL["hot_keys"] = f"""
SELECT {USER_KEY} AS key, count(*) AS records, round(100.0 * count(*) / (SELECT count(*) FROM events), 2) AS share
FROM events GROUP BY 1 ORDER BY records DESC, key LIMIT 5"""

# ---- joins and visibility ---------------------------------------------------------------------------------------

on_log("skip_handled", 'SELECT event_id, "partition", "offset" FROM log6 WHERE event_id % 3 <> 0')

TXN_KEY = "'t' || ((event_id // 50) % 7) || '-' || (user_id % 20)"
TXN = """
outcomes AS (
  SELECT event_id // 50 AS txn, CASE WHEN event_id // 50 = (SELECT max(event_id) // 50 - 5 FROM events) THEN 'open'
         WHEN (event_id // 50) % 7 = 0 THEN 'abort' ELSE 'commit' END AS outcome FROM events GROUP BY ALL),
judged AS (SELECT log6.*, outcome FROM log6 JOIN outcomes ON event_id // 50 = txn),
stable AS (SELECT "partition" AS p, min("offset") AS lso FROM judged WHERE outcome = 'open' GROUP BY 1),
visible AS (SELECT judged.* FROM judged LEFT JOIN stable ON "partition" = p WHERE outcome = 'commit' AND (lso IS NULL OR "offset" < lso))"""
on_log("read_committed", 'SELECT "partition", "offset", event_id FROM visible', TXN_KEY, TXN)
on_log("visibility_report", """
SELECT 'read_uncommitted' AS isolation, count(*) AS records,
       (SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT regexp_replace(key, '-\\d+$', '') AS f FROM log6)) AS families FROM log6
UNION ALL
SELECT 'read_committed', count(*),
       (SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT regexp_replace(key, '-\\d+$', '') AS f FROM visible)) FROM visible""",
       TXN_KEY, TXN)
on_log("eos_check", """
SELECT count(*) AS committed_rows, count(DISTINCT key || ':' || (event_id % 3)) AS distinct_rows,
       count(*) - count(DISTINCT key || ':' || (event_id % 3)) AS duplicates, (SELECT count(*) FROM log6) AS all_rows FROM visible""",
       TXN_KEY, TXN)
on_log("lag", """
SELECT e.topic, e."partition", ("end" - coalesce(committed, 0))::BIGINT AS lag FROM ends e LEFT JOIN commits c ON e."partition" = c."partition"
UNION ALL
SELECT NULL, NULL, sum("end" - coalesce(committed, 0))::BIGINT FROM ends e LEFT JOIN commits c ON e."partition" = c."partition\"""", more=ENDS)
on_log("offsets_for_time", """
SELECT topic, "partition", coalesce(min("offset") FILTER (ts >= TIMESTAMP '2024-01-30 20:00:00'), max("offset") + 1) AS "start",
       max("offset") + 1 AS "end" FROM log6 GROUP BY ALL""")

# Deliveries of the explicit script: delivery 1, and delivery 2 of what was released.
DELIVERIES = """
acks AS (
  SELECT topic, "partition", "offset", event_id, ts_us, 1 AS delivery,
         CASE WHEN event_id % 50 = 0 THEN 'REJECT' WHEN event_id % 7 = 0 THEN 'RELEASE' ELSE 'ACCEPT' END AS type,
         'w' || (event_id % 4) AS worker FROM log6
  UNION ALL
  SELECT topic, "partition", "offset", event_id, ts_us, 2, 'ACCEPT', 'w' || ((event_id + 1) % 4) FROM log6
  WHERE event_id % 50 <> 0 AND event_id % 7 = 0)"""
on_log("reacquired", """SELECT event_id, worker, delivery FROM acks a WHERE delivery > 1 AND worker <> 'w0' AND EXISTS (
  SELECT 1 FROM acks h WHERE h.worker = 'w0' AND h.delivery = 1 AND h."partition" = a."partition" AND h."offset" = a."offset")""", more=DELIVERIES)
SQL["resolve_writer"] = """
SELECT coalesce('v' || n_nationkey, '?') AS writer, count(*) AS records FROM events LEFT JOIN nation ON event_id % 30 = n_nationkey GROUP BY 1"""

# ---- aggregations -----------------------------------------------------------------------------------------------

on_log("bounds", 'SELECT * FROM ends', more=ENDS)
on_log("next_offsets", """SELECT topic, "partition", max("offset") + 1 AS committed FROM log6 WHERE event_id % 101 <> 7 GROUP BY ALL""")
on_log("delivery_audit", """
SELECT "partition", sum(sent)::BIGINT AS sent, sum(seen)::BIGINT AS delivered, count(*) FILTER (seen > 0) AS distinct_seen,
       count(*) FILTER (sent > 0 AND seen = 0) AS missing, count(*) FILTER (seen > 1) AS repeated_ids,
       sum(greatest(seen - 1, 0))::BIGINT AS extra_copies, count(*) FILTER (sent = 0 AND seen > 0) AS unexpected
FROM per_id GROUP BY 1""", more="""
per_id AS (SELECT "partition", event_id, 1 AS sent,
                  CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 13 = 0 THEN 2 ELSE 1 END AS seen FROM log6)""")
SQL["delivery_audit_lineitem"] = """
WITH s AS (SELECT o_orderkey AS id, count(*) AS sent FROM orders GROUP BY 1),
d AS (SELECT l_orderkey AS id, count(*) AS seen FROM lineitem GROUP BY 1),
b AS (SELECT coalesce(sent, 0) AS sent, coalesce(seen, 0) AS seen FROM s FULL JOIN d USING (id))
SELECT sum(sent)::BIGINT AS sent, sum(seen)::BIGINT AS delivered, count(*) FILTER (seen > 0) AS distinct_seen,
       count(*) FILTER (sent > 0 AND seen = 0) AS missing, count(*) FILTER (seen > 1) AS repeated_ids,
       sum(greatest(seen - 1, 0))::BIGINT AS extra_copies, count(*) FILTER (sent = 0 AND seen > 0) AS unexpected FROM b"""
SQL["run_summary"] = """
WITH r AS (SELECT event_type AS run, epoch_us(ts) AS sent_us, value, length(props) AS bytes, event_id % 40 = 0 AS failed,
                  epoch_us(ts) + round(value * 1000)::BIGINT AS done_us,
                  row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events),
a AS (SELECT run, count(*) AS records, (sum(bytes) FILTER (NOT failed))::BIGINT AS bytes,
             (max(done_us) - min(sent_us)) / 1000.0 AS elapsed, count(*) FILTER (failed) AS errors, max(value) AS max_ms,
             max(value) FILTER (i = floor(0.5 * (n - 1) + 0.5)) AS p50_ms, max(value) FILTER (i = floor(0.99 * (n - 1) + 0.5)) AS p99_ms
      FROM r GROUP BY 1)
SELECT run, records, bytes, round(elapsed::DOUBLE, 6) AS elapsed_ms, round(records / (elapsed / 1000.0)::DOUBLE, 6) AS records_per_s,
       round((bytes / 1048576.0::DOUBLE) / (elapsed / 1000.0)::DOUBLE, 6) AS mib_per_s, errors, round(p50_ms, 6) AS p50_ms,
       round(p99_ms, 6) AS p99_ms, round(max_ms, 6) AS max_ms FROM a"""
SQL["rank_percentile"] = """
WITH r AS (SELECT l_suppkey, l_extendedprice AS v, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) - 1 AS i,
                  count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem),
ps AS (SELECT unnest([0.0, 0.25, 0.5, 0.99, 1.0])::DOUBLE AS p)
SELECT l_suppkey, p, n, v AS value FROM r, ps WHERE i = floor(p * (n - 1) + 0.5)"""
on_log("worker_distribution", """
SELECT worker, count(*) AS records, (SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT "partition" AS p FROM acks x WHERE x.worker = a.worker)) AS partitions
FROM acks a GROUP BY 1""", more=DELIVERIES)
on_log("delivery_totals", """
SELECT count(*) AS deliveries, count(DISTINCT event_id) AS distinct_records, count(*) FILTER (delivery = 2) AS redelivered_records FROM acks""",
       more=DELIVERIES)
on_log("outcome_counts", """
SELECT "partition", count(*) FILTER (type = 'ACCEPT') AS accepted, count(*) FILTER (type = 'RELEASE') AS released,
       count(*) FILTER (type = 'REJECT') AS rejected, count(*) FILTER (delivery > 1) AS redelivered, max(delivery) AS max_delivery,
       count(DISTINCT "offset") AS distinct_records FROM acks GROUP BY 1""", more=DELIVERIES)
SQL["metric_table"] = """
WITH kept AS (SELECT event_type AS run, 'm' || (event_id % 4) AS name, value, event_id FROM events WHERE event_id % 2 = 0)
SELECT e.run, coalesce((SELECT max_by(value, event_id) FROM kept k WHERE k.run = e.run AND name = 'm0'), 'nan'::DOUBLE) AS m0,
       coalesce((SELECT max_by(value, event_id) FROM kept k WHERE k.run = e.run AND name = 'm1'), 'nan'::DOUBLE) AS m1,
       coalesce((SELECT max_by(value, event_id) FROM kept k WHERE k.run = e.run AND name = 'm2'), 'nan'::DOUBLE) AS m2,
       coalesce((SELECT max_by(value, event_id) FROM kept k WHERE k.run = e.run AND name = 'm3'), 'nan'::DOUBLE) AS m3
FROM (SELECT DISTINCT event_type AS run FROM events) e"""
SQL["metric_sum"] = """
SELECT event_type AS run, sum(round(value * 100)::BIGINT)::BIGINT AS total, count(*) AS samples FROM events
WHERE event_id % 4 = 2 AND user_id % 5 = 3 GROUP BY 1"""
SQL["bytes_by_node"] = """
SELECT event_type AS run, event_id % 3 + 1 AS node, sum(round(value * 100)::BIGINT)::BIGINT AS bytes FROM events
WHERE event_id % 4 = 1 GROUP BY 1, 2"""
SQL["weighted_mean"] = """
SELECT event_type, round(sum(round(value * 100)::BIGINT)::DOUBLE / sum(event_id % 5), 6) AS mean FROM events GROUP BY 1"""
on_log("transit_latency", """
SELECT "partition", count(*) FILTER (event_id % 4 <> 0) AS stamped,
       coalesce(round(avg(event_id % 1000) FILTER (event_id % 4 <> 0), 6), 0) AS mean_ms FROM log6 GROUP BY 1""")

ORDER_JSON = ("'{\"orderId\":\"ORD-' || o_orderkey || '\",\"customerId\":\"customer-' || (o_custkey % 20) || '\",\"totalAmount\":' "
              "|| o_totalprice::DECIMAL(12,2) || ',\"currency\":\"EUR\",\"createdAt\":\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '\"}'")
SQL["wire_size"] = f"""
SELECT 'json' AS format, count(*) AS records, round(avg(length({ORDER_JSON})), 6) AS value_bytes, 15.0::DOUBLE AS header_bytes FROM orders
UNION ALL
SELECT 'narrow', count(*), round(avg(length('{{"orderId":"ORD-' || o_orderkey || '","currency":"EUR"}}')), 6), 15.0::DOUBLE FROM orders"""

# ---- ordered analytics ------------------------------------------------------------------------------------------

on_log("batches", """SELECT "partition", "offset", (row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1) // 500 AS batch
FROM log6 WHERE event_id % 101 <> 7""")
on_log("batch_report", """SELECT topic, "partition", ((records + 499) // 500)::BIGINT AS calls,
round(records / ((records + 499) // 500)::DOUBLE, 4) AS mean_size, least(records, 500) AS largest FROM ends""", more=ENDS)
on_log("last_n", """SELECT l."partition", "offset", event_id FROM log6 l JOIN ends e ON l."partition" = e."partition" WHERE "offset" >= "end" - 100""", more=ENDS)
on_log("replay_from_time", """SELECT l."partition", l."offset", event_id FROM log6 l
JOIN (SELECT "partition" AS p, min("offset") AS s FROM log6 WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1) ON l."partition" = p
WHERE l."offset" >= s""")
on_log("rewind", """SELECT 'g' AS "group", topic, "partition", 0::BIGINT AS committed FROM ends
UNION ALL SELECT 'h', topic, "partition", committed FROM commits""", more=ENDS)
on_log("done_watermark", """SELECT topic, "partition", coalesce(min("offset") FILTER (event_id % 101 = 7), max("offset") + 1) AS watermark,
max("offset") + 1 AS "end" FROM log6 GROUP BY ALL""")
SQL["ledger_watermark"] = SQL["done_watermark"]
SQL["skip_handled_by_runs"] = SQL["skip_handled"]
on_log("ledger_runs", """SELECT topic, "partition", min("offset") AS "begin", max("offset") + 1 AS "end" FROM (
SELECT *, "offset" - row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS island FROM log6 WHERE event_id % 101 <> 7)
GROUP BY topic, "partition", island""")
FAILED = """
f AS (SELECT "partition" AS p, min("offset") AS failed_at FROM log6 WHERE event_id % 1009 = 900 GROUP BY 1)"""
on_log("stop_at_failure", """SELECT "partition", "offset", event_id FROM log6 LEFT JOIN f ON "partition" = p
WHERE failed_at IS NULL OR "offset" < failed_at""", more=FAILED)
on_log("failure_report", """SELECT topic, "partition", max(failed_at) AS failed_at, coalesce(max(failed_at), max("offset") + 1) AS "commit",
count(*) FILTER (failed_at IS NULL OR "offset" < failed_at) AS handled, count(*) FILTER ("offset" >= failed_at) AS "left"
FROM log6 LEFT JOIN f ON "partition" = p GROUP BY ALL""", more=FAILED)
on_log("attempt_no", "SELECT event_id, delivery, delivery::BIGINT AS attempt FROM acks", more=DELIVERIES)
on_log("attempt_report", """
SELECT topic, "partition", count(*) AS records, sum(n)::BIGINT AS deliveries, count(*) FILTER (n > 1) AS redelivered, max(n) AS max_attempt
FROM (SELECT topic, "partition", "offset", count(*) AS n FROM acks GROUP BY ALL) GROUP BY ALL""", more=DELIVERIES)
on_log("first_seen", """SELECT topic, "partition", greatest("begin", "end" - 100) AS "first", "end",
"end" - greatest("begin", "end" - 100) AS to_end FROM ends""", more=ENDS)
on_log("uncommitted_exposure", """
SELECT 'g' AS "group", tick, sum(position)::BIGINT AS position, sum(committed)::BIGINT AS committed, sum(position - committed)::BIGINT AS exposed
FROM (SELECT d."partition", d.tick, position,
             coalesce((SELECT max("offset") + 1 FROM log6 c WHERE c."partition" = d."partition" AND c."offset" % 10 = 9
                       AND epoch(c.ts)::BIGINT // 86400 <= d.tick), 0) AS committed
      FROM (SELECT "partition", floor(epoch(ts) / 86400)::BIGINT AS tick, max("offset") + 1 AS position FROM log6 GROUP BY ALL) d)
GROUP BY ALL""")
on_log("poll_overruns", """
SELECT "partition", "offset", ts_us AS poll_us, gap_us FROM (
  SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY "partition" ORDER BY "offset") AS gap_us FROM log6 WHERE "offset" % 50 = 0)
WHERE gap_us > 86400000000""")
on_log("idle_periods", """
SELECT "partition", "offset", ts_us AS idle_from_us, nxt AS idle_to_us, nxt - ts_us AS idle_us FROM (
  SELECT *, lead(ts_us) OVER (PARTITION BY "partition" ORDER BY "offset") AS nxt FROM log6) WHERE nxt - ts_us >= 7200000000""")
SQL["pause_intervals"] = """
WITH s AS (SELECT event_type AS source, event_id, CASE WHEN value > 100 THEN 1 WHEN value < 5 THEN 0 END AS x FROM events),
c AS (SELECT *, lag(x) OVER (PARTITION BY source ORDER BY event_id) AS b FROM s WHERE x IS NOT NULL),
e AS (SELECT source, event_id, x, lead(event_id) OVER (PARTITION BY source ORDER BY event_id) AS nxt FROM c WHERE x <> coalesce(b, 0))
SELECT source, event_id AS paused_at, nxt AS resumed_at FROM e WHERE x = 1"""
SQL["fence_zombies"] = """
WITH l AS (SELECT CASE WHEN event_id % 89 <> 0 THEN 't-' || (user_id % 3) END AS transactional_id, event_id AS log_order,
                  CASE WHEN event_id % 97 = 0 THEN greatest(event_id // 500 - 1, 0) ELSE event_id // 500 END AS epoch FROM events)
SELECT transactional_id, epoch, log_order FROM (
  SELECT *, max(epoch) OVER (PARTITION BY transactional_id ORDER BY log_order) AS top FROM l) WHERE transactional_id IS NULL OR epoch >= top"""
on_log("dedup_retries", """SELECT "partition", "offset", event_id, CASE WHEN event_id % 13 <> 0 THEN 'p' || (event_id % 3) END AS producer_id, event_id // 3 AS sequence FROM log6
UNION ALL SELECT "partition", "offset" + 1000000000, event_id, NULL, event_id // 3 FROM log6 WHERE event_id % 91 = 0""")
SQL["rebalance_cost"] = """
WITH e AS (SELECT 'g' || (user_id % 10) AS "group", event_id AS pos, 'm' || (user_id % 3) AS member,
                  CASE WHEN event_type IN ('click', 'view') THEN 'assigned' WHEN event_type = 'error' THEN 'LOST' ELSE 'revoked' END AS action,
                  event_id % 6 + 1 AS moved, event_id % 25 = 0 AS is_mark FROM events),
s AS (SELECT *, (sum(is_mark::INT) OVER (PARTITION BY "group" ORDER BY pos))::BIGINT AS segment FROM e)
SELECT "group", segment, member, (sum(CASE WHEN action = 'revoked' THEN moved ELSE 0 END))::BIGINT AS revoked,
       (sum(CASE WHEN action = 'LOST' THEN moved ELSE 0 END))::BIGINT AS lost,
       (sum(CASE WHEN action = 'assigned' THEN moved ELSE 0 END))::BIGINT AS gained,
       count(*) FILTER (action = 'assigned') AS assignments,
       (sum(CASE WHEN action = 'assigned' THEN moved ELSE -moved END))::BIGINT AS net
FROM s WHERE NOT is_mark GROUP BY ALL"""
SQL["outage_timeline"] = """
WITH r AS (SELECT event_type AS run, epoch_us(ts) // 3600000000 AS s, (epoch_us(ts) + round(value * 1000)::BIGINT) // 3600000000 AS d,
                  event_id % 40 = 0 AS failed, event_id % 3 AS retries FROM events),
t AS (SELECT run, s AS tick, 1 AS sent, 0 AS acked, 0 AS failed, 0 AS retried FROM r
      UNION ALL SELECT run, d, 0, CASE WHEN failed THEN 0 ELSE 1 END, failed::INT, retries FROM r),
g AS (SELECT run, tick, sum(sent)::BIGINT AS sent, sum(acked)::BIGINT AS acked, sum(failed)::BIGINT AS failed, sum(retried)::BIGINT AS retried
      FROM t GROUP BY ALL),
c AS (SELECT *, (sum(sent) OVER q)::BIGINT AS sent_total, (sum(acked) OVER q)::BIGINT AS acked_total, (sum(failed) OVER q)::BIGINT AS failed_total,
             (sum(retried) OVER q)::BIGINT AS retried_total FROM g WINDOW q AS (PARTITION BY run ORDER BY tick)),
l AS (SELECT DISTINCT event_type AS run, epoch_us(ts) // 3600000000 AS tick, 'stop' AS label FROM events WHERE event_id % 500 = 0)
SELECT c.*, acked_total + failed_total < sent_total AS lagging, label FROM c LEFT JOIN l ON c.run = l.run AND c.tick = l.tick"""

# The scripted retry log: partitions by event number, calls per record, total back-off per record (200/400/800 ms).
RETRY = f"""
rl AS (
  SELECT event_id, {RETRY_KEY} AS key, ts, event_type, value, (event_id % 6)::INT AS "partition",
         row_number() OVER (PARTITION BY event_id % 6 ORDER BY event_id) - 1 AS "offset",
         CASE event_id % 10 WHEN 0 THEN 'FATAL' WHEN 1 THEN 'POISON' WHEN 2 THEN 'FLAKY' WHEN 3 THEN 'FLAKY' ELSE 'OK' END AS kind,
         CASE event_id % 10 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 1 END AS calls,
         CASE event_id % 10 WHEN 0 THEN 'IllegalArgumentException' WHEN 1 THEN 'DeserializationException' WHEN 3 THEN 'TransientFailure' END AS final_error,
         CASE event_id % 10 WHEN 2 THEN 600 WHEN 3 THEN 1400 ELSE 0 END AS busy
  FROM events),
blocked AS (SELECT *, (sum(busy) OVER (PARTITION BY "partition" ORDER BY "offset"))::BIGINT - busy AS blocked_ms FROM rl),
tries AS (
  SELECT b.*, a::INT AS attempt,
         CASE WHEN kind = 'POISON' OR kind = 'FATAL' THEN final_error WHEN kind = 'FLAKY' AND (a < calls OR event_id % 10 = 3) THEN 'TransientFailure' END AS error,
         (200 * (power(2, greatest(a - 1, 0)) - 1))::BIGINT AS waited
  FROM blocked b, (SELECT unnest([0, 1, 2, 3, 4]) AS a) WHERE (a BETWEEN 1 AND calls) OR (a = 0 AND kind = 'POISON'))"""
SQL["head_of_line"] = f"""WITH {RETRY}
SELECT 'blocking' AS strategy, max(blocked_ms) AS slowest_ok, count(*) AS ok_records FROM blocked WHERE kind = 'OK'
UNION ALL SELECT 'non-blocking', 0, count(*) FROM blocked WHERE kind = 'OK'"""
SQL["counter_rate"] = """
WITH r AS (SELECT event_type, event_id, epoch_us(ts) AS at_us, event_id % 5 + 1 AS n,
                  row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS i,
                  max(epoch_us(ts)) OVER (PARTITION BY event_type) AS last_us,
                  (sum(event_id % 5 + 1) OVER (PARTITION BY event_type, ts::DATE ORDER BY event_id))::BIGINT AS total FROM events),
d AS (SELECT *, lag(total) OVER (PARTITION BY event_type ORDER BY event_id) AS prev FROM r),
g AS (SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN total < prev THEN total ELSE total - prev END AS grown FROM d)
SELECT event_type, sum(grown)::BIGINT AS increase, round((max(at_us) - min(at_us)) / 1000000.0::DOUBLE, 6) AS elapsed_s,
       round(sum(grown) / ((max(at_us) - min(at_us)) / 1000000.0::DOUBLE), 6) AS rate_elapsed,
       round((sum(grown) FILTER (at_us > last_us - 86400000000)) / 86400.0::DOUBLE, 6) AS rate_window FROM g GROUP BY 1"""

# ---- sorts, limits, sets ----------------------------------------------------------------------------------------

on_log("offset_ranges", """
SELECT batch, string_agg(t || ':p' || p || '[' || (lo + d) || '..' || (hi + d) || ']', ' ' ORDER BY t, p) AS ranges
FROM (SELECT event_id // 500 AS batch, "partition" AS p, min("offset") AS lo, max("offset") AS hi FROM log6 GROUP BY ALL),
     (VALUES ('copies', 1), ('events', 0)) AS c(t, d) GROUP BY 1""")
SQL["timeline"] = f"""WITH {RETRY}
SELECT blocked_ms + waited AS due_ms, "partition", "offset", attempt, key, error FROM tries
ORDER BY due_ms, "partition", "offset", attempt LIMIT 50"""
SQL["assignment_delta"] = """
WITH h AS (SELECT 'm' || (user_id % 50) AS member, event_id % 37 AS p, max((ts < TIMESTAMP '2024-01-16')::INT) AS b,
                  max((ts >= TIMESTAMP '2024-01-16')::INT) AS a FROM events GROUP BY ALL)
SELECT member, count(*) FILTER (a = 1 AND b = 0) AS gained, count(*) FILTER (a = 0 AND b = 1) AS lost,
       count(*) FILTER (a = 1 AND b = 1) AS kept FROM h GROUP BY 1"""

# ---- serialization and schemas ----------------------------------------------------------------------------------

SQL["encode_orders"] = f"SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 THEN {ORDER_JSON} END AS value FROM orders"
SQL["decode_orders_good"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 THEN 'ORD-' || o_orderkey END AS "orderId",
       CASE WHEN o_orderkey % 31 <> 0 THEN 'customer-' || (o_custkey % 20) END AS "customerId",
       CASE WHEN o_orderkey % 31 <> 0 THEN o_totalprice::DECIMAL(12,2)::VARCHAR END AS "totalAmount",
       CASE WHEN o_orderkey % 31 <> 0 THEN 'EUR' END AS currency,
       CASE WHEN o_orderkey % 31 <> 0 THEN epoch_us(o_orderdate) END AS created_us
FROM orders WHERE o_orderkey % 31 = 0 OR o_orderkey % 29 <> 0"""
SQL["decode_orders_bad"] = """
SELECT o_orderkey, '{not json' AS value, 'DeserializationException' AS reason FROM orders WHERE o_orderkey % 31 <> 0 AND o_orderkey % 29 = 0"""
SQL["route_by_type"] = """
WITH r AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'order' WHEN o_orderkey % 3 = 1 THEN 'view'
                  ELSE 'legacy' END AS type_token, o_orderkey % 31 <> 0 AND o_orderkey % 29 = 0 AS broken, o_orderkey % 31 = 0 AS empty FROM orders)
SELECT o_orderkey, type_token, CASE WHEN type_token = 'order' AND NOT broken AND NOT empty THEN 'customer-' || (o_custkey % 20) END AS order_customer,
       CASE WHEN type_token = 'view' AND NOT broken AND NOT empty THEN 'ORD-' || o_orderkey END AS view_order,
       CASE WHEN type_token IS NULL THEN 'no type token' WHEN type_token = 'legacy' THEN 'unknown type token' WHEN broken THEN 'DeserializationException' END AS route_error
FROM r"""
SQL["route_by_default"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 29 <> 0 THEN 'ORD-' || o_orderkey END AS view_order,
       CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 29 = 0 THEN 'DeserializationException' END AS route_error FROM orders"""
SQL["route_remapped"] = """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'no type token' WHEN o_orderkey % 3 = 2 THEN 'unknown type token'
                  WHEN o_orderkey % 31 <> 0 AND o_orderkey % 29 = 0 THEN 'DeserializationException' END AS route_error FROM orders)
SELECT o_orderkey, CASE WHEN route_error IS NULL AND o_orderkey % 31 <> 0 THEN 'ORD-' || o_orderkey END AS order_id, route_error FROM r"""
SQL["wire_header"] = """
SELECT event_id, CASE WHEN event_id % 23 <> 0 AND event_id % 29 <> 0 THEN event_id % 70000 END AS schema_id,
       CASE WHEN event_id % 23 <> 0 AND event_id % 29 <> 0 THEN event_type END AS body,
       CASE WHEN event_id % 23 = 0 THEN 'shorter than its header' WHEN event_id % 29 = 0 THEN 'unknown magic byte' END AS wire_error FROM events"""
SQL["subject_name"] = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'events.' || event_type || '-value' WHEN 1 THEN 'shop.Event'
       ELSE 'events.' || event_type || '-shop.Event' END AS subject FROM events"""

FIELDS = """
fields AS (
  SELECT 'user-' || user_id AS subject, ((day(ts) - 1) // 5)::INT AS version, event_type AS field,
         CASE min(event_id) % 11 WHEN 0 THEN 'long' WHEN 1 THEN 'string' ELSE 'int' END AS type, min(event_id) % 2 = 0 AS dflt
  FROM events GROUP BY ALL),
vers AS (SELECT subject, version, row_number() OVER (PARTITION BY subject ORDER BY version) AS k FROM (SELECT DISTINCT subject, version FROM fields)),
f AS (SELECT fields.*, k FROM fields JOIN vers USING (subject, version))"""
SQL["schema_compat"] = f"""WITH {FIELDS},
pairs AS (
  SELECT coalesce(n.subject, o.subject) AS subject, coalesce(n.k, o.k + 1) AS k, coalesce(n.field, o.field) AS field,
         CASE WHEN o.field IS NULL AND NOT n.dflt THEN 'READER_FIELD_MISSING_DEFAULT_VALUE'
              WHEN n.type <> o.type AND NOT (n.type = 'long' AND o.type = 'int') THEN 'TYPE_MISMATCH' END AS b,
         CASE WHEN n.field IS NULL AND NOT o.dflt THEN 'READER_FIELD_MISSING_DEFAULT_VALUE'
              WHEN n.type <> o.type AND NOT (o.type = 'long' AND n.type = 'int') THEN 'TYPE_MISMATCH' END AS w
  FROM f n FULL JOIN f o ON n.subject = o.subject AND n.k = o.k + 1 AND n.field = o.field),
verdict AS (
  SELECT v.subject, v.version, v.k, min(field) FILTER (b IS NOT NULL AND v.k > 1) AS bf, min(field) FILTER (w IS NOT NULL AND v.k > 1) AS wf,
         arg_min(b, field) FILTER (b IS NOT NULL AND v.k > 1) AS br, arg_min(w, field) FILTER (w IS NOT NULL AND v.k > 1) AS wr
  FROM vers v JOIN pairs p ON v.subject = p.subject AND v.k = p.k GROUP BY ALL)
SELECT subject, version, bf IS NULL AS backward, br AS backward_reason, bf AS backward_field, wf IS NULL AS forward, wr AS forward_reason,
       wf AS forward_field, CASE WHEN bf IS NULL AND wf IS NULL THEN 'FULL' WHEN bf IS NULL THEN 'BACKWARD' WHEN wf IS NULL THEN 'FORWARD' ELSE 'NONE' END AS satisfies
FROM verdict"""
SQL["codec_report"] = """
SELECT codec, (SELECT count(*) FROM lineitem) AS records, codec <> 'uncompressed' AS smaller
FROM (SELECT unnest(['uncompressed', 'lz4_raw', 'snappy', 'zstd', 'gzip']) AS codec)"""
SQL["register_gate"] = f"""WITH RECURSIVE {FIELDS},
pairs AS (
  SELECT n.subject, n.k, o.k AS old, f.field, x.type AS nt, x.dflt AS nd, y.type AS ot, y.dflt AS od
  FROM vers n JOIN vers o ON n.subject = o.subject AND o.k < n.k
  JOIN (SELECT DISTINCT subject, field FROM f) f ON f.subject = n.subject
  LEFT JOIN f x ON x.subject = n.subject AND x.k = n.k AND x.field = f.field
  LEFT JOIN f y ON y.subject = n.subject AND y.k = o.k AND y.field = f.field),
problems AS (
  SELECT subject, k, old, 0 AS way, field, CASE WHEN ot IS NULL THEN 'READER_FIELD_MISSING_DEFAULT_VALUE' ELSE 'TYPE_MISMATCH' END AS reason FROM pairs
  WHERE nt IS NOT NULL AND (ot IS NULL AND NOT nd OR ot <> nt AND NOT (nt = 'long' AND ot = 'int'))
  UNION ALL
  SELECT subject, k, old, 1, field, CASE WHEN nt IS NULL THEN 'READER_FIELD_MISSING_DEFAULT_VALUE' ELSE 'TYPE_MISMATCH' END FROM pairs
  WHERE ot IS NOT NULL AND (nt IS NULL AND NOT od OR ot <> nt AND NOT (ot = 'long' AND nt = 'int'))),
offers AS (
  SELECT v.subject, v.version, v.k, ['BACKWARD', 'FORWARD', 'FULL', 'BACKWARD_TRANSITIVE', 'FORWARD_TRANSITIVE', 'FULL_TRANSITIVE', 'NONE'][
           CAST(regexp_extract(v.subject, '[0-9]+$') AS INT) % 7 + 1] AS level,
         coalesce((SELECT list({{'old': old, 'way': way, 'field': field, 'reason': reason}} ORDER BY old, way, field) FROM problems p
                   WHERE p.subject = v.subject AND p.k = v.k), []) AS ps FROM vers v),
gate AS (
  SELECT subject, version, k, [k] AS accepted, true AS ok, NULL::VARCHAR AS reason, NULL::VARCHAR AS field FROM offers WHERE k = 1
  UNION ALL
  SELECT subject, version, k, CASE WHEN hit IS NULL THEN list_append(accepted, k) ELSE accepted END, hit IS NULL, hit.reason, hit.field FROM (
    SELECT o.subject, o.version, o.k, g.accepted, list_filter(o.ps, lambda p:
             list_contains(CASE WHEN o.level LIKE '%TRANSITIVE' THEN g.accepted ELSE g.accepted[-1:] END, p.old)
             AND (p.way = 0 AND (o.level LIKE 'BACKWARD%' OR o.level LIKE 'FULL%') OR p.way = 1 AND (o.level LIKE 'FORWARD%' OR o.level LIKE 'FULL%')))[1] AS hit
    FROM gate g JOIN offers o ON o.subject = g.subject AND o.k = g.k + 1))
SELECT subject, CAST(version AS BIGINT) AS candidate, ok AS accepted, CASE WHEN ok THEN CAST(len(accepted) AS INT) END AS version, reason, field FROM gate"""
SQL["schema_compat_transitive"] = f"""WITH {FIELDS},
b AS (  -- own fields without a default that some earlier version lacks, and own fields some earlier type does not fit
  SELECT n.subject, n.k, count(*) FILTER (NOT n.dflt AND (SELECT count(*) FROM f o WHERE o.subject = n.subject AND o.field = n.field AND o.k < n.k) < n.k - 1) AS missing,
         count(*) FILTER (EXISTS (SELECT 1 FROM f o WHERE o.subject = n.subject AND o.field = n.field AND o.k < n.k
                                  AND n.type <> o.type AND NOT (n.type = 'long' AND o.type = 'int'))) AS bt,
         count(*) FILTER (EXISTS (SELECT 1 FROM f o WHERE o.subject = n.subject AND o.field = n.field AND o.k < n.k
                                  AND n.type <> o.type AND NOT (o.type = 'long' AND n.type = 'int'))) AS wt
  FROM f n GROUP BY ALL),
w AS (
  SELECT v.subject, v.k, count(DISTINCT o.field) AS missing FROM vers v JOIN f o ON o.subject = v.subject AND o.k < v.k AND NOT o.dflt
  WHERE NOT EXISTS (SELECT 1 FROM f n WHERE n.subject = v.subject AND n.k = v.k AND n.field = o.field) GROUP BY ALL)
SELECT v.subject, v.version, b.missing + bt = 0 AS backward_transitive, coalesce(w.missing, 0) + wt = 0 AS forward_transitive,
       b.missing + bt = 0 AND coalesce(w.missing, 0) + wt = 0 AS full_transitive, b.missing + bt AS backward_problems,
       coalesce(w.missing, 0) + wt AS forward_problems
FROM vers v JOIN b ON v.subject = b.subject AND v.k = b.k LEFT JOIN w ON v.subject = w.subject AND v.k = w.k"""
SQL["read_as"] = """
WITH r AS (SELECT *, 'v' || (o_orderkey % 5 + 1) AS writer FROM orders),
j AS (SELECT *, CASE writer WHEN 'v3' THEN 'READER_FIELD_MISSING_DEFAULT_VALUE customerId' WHEN 'v4' THEN 'TYPE_MISMATCH currency'
             WHEN 'v5' THEN 'unknown writer schema' END AS reject_reason FROM r)
SELECT o_orderkey, reject_reason, CASE WHEN reject_reason IS NULL THEN 'ORD-' || o_orderkey END AS "r_orderId",
       CASE WHEN reject_reason IS NULL THEN 'customer-' || (o_custkey % 20) END AS "r_customerId",
       CASE WHEN reject_reason IS NULL THEN 'USD' END AS r_currency,
       CASE WHEN reject_reason IS NULL THEN CASE writer WHEN 'v1' THEN 'web' ELSE 'mobile' END END AS r_channel FROM j"""

# ---- failure handling -------------------------------------------------------------------------------------------

SQL["classify_error"] = """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'FATAL' WHEN 1 THEN 'POISON' WHEN 2 THEN 'FLAKY' WHEN 3 THEN 'FLAKY' ELSE 'OK' END AS kind,
       CASE event_id % 10 WHEN 0 THEN 'dead' WHEN 1 THEN 'dead' WHEN 2 THEN 'retry' WHEN 3 THEN 'retry' ELSE 'ok' END AS verdict FROM events"""
SQL["backoff_schedule"] = """
SELECT event_id, r AS retry, d AS delay_ms, c AS due_ms FROM events, (VALUES (1, 200::BIGINT, 200::BIGINT), (2, 400, 600), (3, 700, 1300), (4, 700, 2000)) t(r, d, c)"""
SQL["retry_in_place"] = f"""WITH {RETRY}
SELECT event_id, "partition", attempt, error, blocked_ms + waited AS due_ms, final_error FROM tries"""
SQL["retry_topics"] = f"""WITH {RETRY}
SELECT event_id, attempt, error, waited * 5 AS due_ms,
       CASE WHEN attempt = 1 THEN 'orders' ELSE 'orders-retry-' || (1000 * power(2, attempt - 2))::INT END AS via FROM tries WHERE attempt > 0
UNION ALL
SELECT event_id, calls::INT, final_error, CASE WHEN kind = 'FLAKY' THEN 7000 ELSE 0 END, 'orders-dlt' FROM rl WHERE final_error IS NOT NULL"""
SQL["dead_letters"] = f"""WITH {RETRY}
SELECT 'orders-dlt' AS topic, "partition", key,
       upper(hex(encode(CASE WHEN kind = 'POISON' THEN '{{not json' ELSE {EVENT_JSON} END))) AS value_hex, 'orders' AS original_topic,
       "offset" AS original_offset, epoch_us(ts) AS original_us, final_error AS error_class, kind || ' by script: ' || key AS error_message
FROM rl WHERE final_error IS NOT NULL"""
SQL["publish_dead_letters"] = f"""WITH {RETRY}
SELECT "partition", row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS "offset", key,
       upper(hex(encode(CASE WHEN kind = 'POISON' THEN '{{not json' ELSE {EVENT_JSON} END))) AS value_hex,
       "offset" AS original_offset, final_error AS error_class
FROM rl WHERE final_error IS NOT NULL"""
on_log("nack", """
SELECT l."partition", l."offset", (coalesce(polls, 0) + (l."offset" - coalesce(a, 0)) // 300 + 1)::BIGINT AS poll,
       CASE WHEN l."offset" = a THEN 2 ELSE 1 END AS attempt, (coalesce(k, 0) * 1000)::BIGINT AS t_ms, 'acked' AS action
FROM log6 l ASOF LEFT JOIN n ON l."partition" = p AND l."offset" >= a
UNION ALL
SELECT p, a, polls::BIGINT, 1, ((k - 1) * 1000)::BIGINT, 'nacked' FROM n""",
       more="""
n AS (SELECT p, a, sum((a - before) // 300 + 1) OVER (PARTITION BY p ORDER BY a) AS polls, row_number() OVER (PARTITION BY p ORDER BY a) AS k
      FROM (SELECT "partition" AS p, "offset" AS a, lag("offset", 1, 0) OVER (PARTITION BY "partition" ORDER BY "offset") AS before
            FROM log6 WHERE "offset" % 400 IN (250, 260)))""")

# ---- queue ------------------------------------------------------------------------------------------------------

on_log("queue_worker", "SELECT event_id, delivery, type, worker FROM acks", more=DELIVERIES)
on_log("queue_recoverer", """
SELECT count(*) FILTER ("offset" % 10 <> 9) AS accepted, count(*) FILTER ("offset" % 10 = 5) AS released,
       count(*) FILTER ("offset" % 10 = 9) AS rejected, count(*) FILTER ("offset" % 10 = 5) AS redelivered,
       CASE WHEN count(*) FILTER ("offset" % 10 = 5) > 0 THEN 2 ELSE 1 END AS max_delivery, count(*) AS distinct_records FROM log6""")


def queue_state(name: str, applied: str, renewals: str = "0", renewals_applied: str = "0") -> None:
    """``applied`` says whether the final ack of a delivery counts."""
    on_log(name, f"""
SELECT "partition", "offset",
       CASE WHEN last_applied AND last_type = 'ACCEPT' THEN 'acknowledged' WHEN last_applied AND last_type = 'REJECT' THEN 'archived'
            WHEN deliveries >= 2 THEN 'archived' ELSE 'available' END AS state, deliveries, applied, refused, expired
FROM (SELECT "partition", "offset", max(delivery) AS deliveries, (sum(ok::INT + ra))::BIGINT AS applied,
             (sum((NOT ok)::INT + r - ra))::BIGINT AS refused, count(*) FILTER (NOT ok) AS expired,
             arg_max(ok, delivery) AS last_applied, arg_max(type, delivery) AS last_type
      FROM (SELECT *, {applied} AS ok, {renewals} AS r, {renewals_applied} AS ra FROM acks) GROUP BY 1, 2)""", more=DELIVERIES)


queue_state("queue_state_short_lock", "event_id % 20 <> 0")
queue_state("queue_state_long_lock", "true")
queue_state("queue_state_renewed", "event_id % 20 <> 0 OR event_id % 60 <> 0", "(event_id % 20 = 0)::INT",
            "(event_id % 20 = 0 AND event_id % 60 <> 0)::INT")

on_log("judge_acks", "SELECT event_id, delivery, type, event_id % 20 <> 0 AS applied FROM acks", more=DELIVERIES)
SQL["recover"] = """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'REJECT' WHEN 1 THEN 'REJECT' WHEN 2 THEN 'RELEASE' WHEN 3 THEN 'RELEASE' ELSE 'ACCEPT' END AS type FROM events"""

# ---- handlers ---------------------------------------------------------------------------------------------------

on_log("process_in_order", """SELECT "partition", "offset", event_id, 'ok' AS status FROM log6 LEFT JOIN f ON "partition" = p
WHERE failed_at IS NULL OR "offset" < failed_at""", more=FAILED)
SQL["process_in_batches"] = "SELECT event_id, event_id * 2 AS twice, true AS calls_ok FROM events"
SQL["process_unordered"] = "SELECT event_id, event_id * 2 AS twice FROM events"

# ---- streams ----------------------------------------------------------------------------------------------------

SQL["stream_exactly_once"] = "SELECT event_id, upper(event_type) AS value FROM events"
SQL["stream_dedup"] = "SELECT event_id, user_id FROM events"
SQL["stream_commit_every_n"] = """
SELECT count(*) AS records, count(*) - 1 AS last_seen, true AS bounded FROM events"""
SQL["stream_row_limits"] = """
WITH n AS (SELECT count(*) AS n, (count(*) + 8) // 9 AS most FROM events)
SELECT k AS batch_id, least(most, n - k * most) AS records, least(most, n - k * most) AS input_rows, n - least(n, (k + 1) * most) AS lag
FROM n, range(9) r(k) WHERE k * most < n"""
SQL["stream_paced"] = "SELECT count(*) AS records, count(DISTINCT event_id) AS events, true AS paced FROM events"
SQL["stream_append_segments"] = f"""WITH {log6()}
SELECT topic, "partition", 0 AS "begin", count(*) AS "end", count(*) AS records, NULL AS reason FROM log6 WHERE event_id % 17 <> 0 GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, NULL, count(*), 'no partition' FROM events WHERE event_id % 17 = 0"""
SQL["stream_rate_limits"] = "SELECT count(*) AS records, 3 AS batches FROM events"
SQL["stream_append_rejects"] = """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'no partition' WHEN event_id % 19 = 0 THEN 'partition out of range' END AS reason FROM events"""
SQL["stream_at_least_once"] = "SELECT event_id, 2 AS effects FROM events"
SQL["stream_at_most_once"] = "SELECT event_id, 1 AS effects FROM events"
SQL["stream_effectively_once"] = "SELECT event_id, 1 AS effects FROM events"
SQL["stream_retry_entries"] = SQL["retry_topics"]
SQL["stream_retry_topics"] = f"""WITH {RETRY}
SELECT event_id, attempt, error,
       CASE WHEN attempt = 1 THEN 'orders' ELSE 'orders-retry-' || (1000 * power(2, attempt - 2))::INT END AS via FROM tries WHERE attempt > 0
UNION ALL
SELECT event_id, calls::INT, final_error, 'orders-dlt' FROM rl WHERE final_error IS NOT NULL"""
on_log("stream_queue_state", """
SELECT event_id, CASE WHEN last_ok AND last_type = 'ACCEPT' THEN 'acknowledged' WHEN last_ok AND last_type = 'REJECT' THEN 'archived'
       WHEN deliveries >= 2 THEN 'archived' ELSE 'available' END AS state, deliveries, applied, refused, expired
FROM (SELECT event_id, max(delivery) AS deliveries, count(*) FILTER (ok) AS applied, count(*) FILTER (NOT ok) AS refused,
             count(*) FILTER (NOT ok) AS expired, arg_max(ok, delivery) AS last_ok, arg_max(type, delivery) AS last_type
      FROM (SELECT *, event_id % 20 <> 0 AS ok FROM acks) GROUP BY 1)""", more=DELIVERIES)
SQL["stream_queue_worker"] = """
SELECT event_id, 1 AS delivery, CASE WHEN event_id % 50 = 0 THEN 'REJECT' WHEN event_id % 7 = 0 THEN 'RELEASE' ELSE 'ACCEPT' END AS type,
       event_id % 20 <> 0 AS applied FROM events
UNION ALL
SELECT event_id, 2, CASE WHEN event_id % 50 = 0 THEN 'REJECT' ELSE 'ACCEPT' END, true
FROM events WHERE event_id % 20 = 0 OR (event_id % 7 = 0 AND event_id % 50 <> 0)"""
SQL["stream_progress"] = "SELECT count(*) AS input_rows, count(*) FILTER (event_type = 'error') AS errors FROM events"
on_log("stream_append_log", 'SELECT topic, "partition", count(*) AS records, count(*) AS offsets, count(*) AS "end" FROM log6 GROUP BY ALL')
on_log("stream_read_log", 'SELECT "partition", "offset", event_type AS value FROM log6')
