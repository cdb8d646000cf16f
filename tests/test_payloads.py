"""JSON, type routing, wire headers, schema rules, percentiles and metrics on small cases."""

import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from tidelog.functions import headers as hdr
from tidelog.functions import orders as fo
from tidelog.operators import records, runs, schemas

ORDER = {"orderId": "ORD-1", "customerId": "customer-7", "totalAmount": "149.90", "currency": "EUR", "createdAt": "2026-09-21T10:15:30Z"}


def one_order(spark):
    raw = spark.createDataFrame([tuple(ORDER.values())], list(ORDER))
    return raw.select(F.struct("orderId", "customerId", F.col("totalAmount").cast("decimal(12,2)").alias("totalAmount"), "currency",
                               F.col("createdAt").cast("timestamp").alias("createdAt")).alias("order"))


def test_order_round_trip(spark):
    encoded = fo.encode_orders(one_order(spark))
    assert encoded.first()["value"] == ('{"orderId":"ORD-1","customerId":"customer-7","totalAmount":149.90,"currency":"EUR",'
                                        '"createdAt":"2026-09-21T10:15:30Z"}')
    good, bad = fo.decode_orders(encoded.select(F.col("value").cast("binary").alias("value")))
    assert good.select("order").first() == one_order(spark).first()
    assert bad.count() == 0


def test_tolerant_decode(spark):
    values = [b'{"orderId":"ORD-2","channel":"web"}', b"not json", None, b"", b"null", b'{"orderId":"O","totalAmount":"x"}', b'{"totalAmount":0.1}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value binary")
    good, bad = fo.decode_orders(df)
    by_id = {r["i"]: r["order"] for r in good.collect()}
    assert set(by_id) == {0, 2, 4, 6}
    assert by_id[0]["orderId"] == "ORD-2" and by_id[2] is None and by_id[4] is None
    assert str(by_id[6]["totalAmount"]) == "0.10"
    lost = {r["i"]: bytes(r["value"]) for r in bad.collect()}
    assert lost == {1: b"not json", 3: b"", 5: b'{"orderId":"O","totalAmount":"x"}'}


def test_headers_last_one_wins(spark):
    df = hdr.with_headers(hdr.with_headers(spark.range(1), {"a": "1"}), {"a": "2", "key": "k"})
    r = df.select("key", hdr.header_text(F.col("headers"), "a").alias("a"), F.size("headers").alias("n")).first()
    assert (r["key"], r["a"], r["n"]) == ("k", "2", 2)


def test_script_grammar(spark):
    df = spark.createDataFrame([("ok-1",), ("flaky2-7",), ("fatal-3",), ("poison-9",), ("customer-1",), (None,), ("xok-1",), ("ok-1x",)], "key string")
    got = [(r["kind"], r["failures"], r["plan_error"] is not None) for r in records.parse_plan(df).collect()]
    assert got == [("OK", 0, False), ("FLAKY", 2, False), ("FATAL", 0, False), ("POISON", 0, False)] + [(None, None, True)] * 4


def test_wire_header(spark):
    df = spark.createDataFrame([(b"\x00\x00\x01\x11\x70body",), (b"\x01\x00\x00\x00\x05x",), (b"\x00\x00",), (None,), (b"\x00\x00\x00\x00\x07",)], "value binary")
    got = [(r["schema_id"], None if r["body"] is None else bytes(r["body"]), r["wire_error"]) for r in fo.wire_header(df).collect()]
    assert got == [(70000, b"body", None), (None, None, "unknown magic byte"), (None, None, "shorter than its header"),
                   (None, None, None), (7, b"", None)]


V1 = [("orderId", "string", False), ("customerId", "string", False), ("totalAmount", "decimal(12,2)", False), ("currency", "string", True), ("createdAt", "timestamp", False)]
CHANNEL, SALES_REP = ("channel", "string", True), ("salesRep", "string", False)


def versions(spark, subject, *field_lists):
    rows = [(subject, v, *f) for v, fields in enumerate(field_lists, 1) for f in fields]
    return spark.createDataFrame(rows, "subject string, version int, field string, type string, has_default boolean")


def without(fields, name):
    return [f for f in fields if f[0] != name]


def test_schema_matrix(spark):
    retyped = [("currency", "int", False) if f[0] == "currency" else f for f in V1]
    cases = {"channel": V1 + [CHANNEL], "salesRep": V1 + [SALES_REP], "customer": without(V1, "customerId"), "retyped": retyped}
    table = None
    for name, fields in cases.items():
        one = versions(spark, name, V1, fields)
        table = one if table is None else table.unionByName(one)
    got = {r["subject"]: r for r in schemas.schema_compat(table).filter("version = 2").collect()}
    assert got["channel"]["satisfies"] == "FULL"
    assert (got["salesRep"]["satisfies"], got["salesRep"]["backward_reason"], got["salesRep"]["backward_field"]) == (
        "FORWARD", schemas.MISSING_DEFAULT, "salesRep")
    assert (got["customer"]["satisfies"], got["customer"]["forward_field"]) == ("BACKWARD", "customerId")
    assert got["retyped"]["backward_reason"] == schemas.TYPE_MISMATCH and got["retyped"]["satisfies"] == "NONE"


def test_transitive_looks_at_all_versions(spark):
    # Version 3 brings back a field without a default that version 1 lacks; version 2 has it.
    table = versions(spark, "s", V1, V1 + [("note", "string", True)], V1 + [("note", "string", False)])
    plain = {r["version"]: r for r in schemas.schema_compat(table).collect()}
    every = {r["version"]: r for r in schemas.schema_compat_transitive(table).collect()}
    assert plain[3]["backward"] and not every[3]["backward_transitive"]
    assert every[2]["full_transitive"]


def test_register_gate(spark):
    v2 = V1 + [CHANNEL]
    def offer(subject, third, fourth):
        return versions(spark, subject, V1, v2, third, fourth).withColumnRenamed("version", "candidate").withColumn("candidate", F.col("candidate").cast("long"))
    offers = offer("b", v2 + [SALES_REP], without(v2, "customerId")).unionByName(offer("f", without(v2, "customerId"), v2 + [SALES_REP]))
    levels = spark.createDataFrame([("b", "BACKWARD"), ("f", "FORWARD")], "subject string, level string")
    got = {(r["subject"], r["candidate"]): (r["accepted"], r["version"], r["reason"]) for r in schemas.register_gate(offers, levels).collect()}
    for s in ("b", "f"):
        assert got[s, 1] == (True, 1, None) and got[s, 2] == (True, 2, None)
        assert got[s, 3] == (False, None, schemas.MISSING_DEFAULT)
        assert got[s, 4] == (True, 3, None)


def test_reader_matrix(spark):
    v1 = {"orderId": "string", "customerId": "string"}
    v2 = {**v1, "channel": "string"}
    dropped, grown = {k: v for k, v in v2.items() if k != "customerId"}, {**v2, "salesRep": "string"}
    full = {"orderId": "ORD", "customerId": "c", "channel": "mobile", "salesRep": "SR-7"}
    def read(third, reader):
        rows = spark.createDataFrame([Row(writer=w, payload=full) for w in ("v1", "v2", "v3")])
        out = schemas.read_as(rows, {"v1": v1, "v2": v2, "v3": third}, reader)
        return {r["writer"]: r for r in out.collect()}
    as_v1 = [("orderId", "string", None, False), ("customerId", "string", None, False)]
    channel = ("channel", "string", "web", True)
    got = read(dropped, as_v1)
    assert [got[w]["reject_reason"] for w in ("v1", "v2", "v3")] == [None, None, f"{schemas.MISSING_DEFAULT} customerId"]
    got = read(dropped, [as_v1[0], channel])
    assert [got[w]["r_channel"] for w in ("v1", "v2", "v3")] == ["web", "mobile", "mobile"]
    got = read(grown, as_v1)
    assert [got[w]["reject_reason"] for w in ("v1", "v2", "v3")] == [None, None, None]
    got = read(grown, [*as_v1, channel, ("salesRep", "string", None, False)])
    assert [got[w]["reject_reason"] for w in ("v1", "v2", "v3")] == [f"{schemas.MISSING_DEFAULT} salesRep"] * 2 + [None]
    assert got["v3"]["r_salesRep"] == "SR-7"


def test_rank_percentile_by_brute_force(spark):
    values = {"a": [5.0] * 50 + [float(i) for i in range(31)], "b": [1.5], "c": [], "d": [2.0, 1.0]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    for cut in (1, 7, 1000):
        for r in runs.rank_percentile(df, "v", ps, ["g"], cut).collect():
            ordered = sorted(values[r["g"]])
            if not ordered:
                assert math.isnan(r["value"])
                continue
            assert r["value"] == ordered[min(len(ordered) - 1, math.floor(r["p"] * (len(ordered) - 1) + 0.5))], r


def test_empty_and_missing_metrics_are_nan(spark):
    m = spark.createDataFrame([("r1", "a", {"client-id": "c"}, 1.0, 1), ("r1", "a", {"client-id": "c", "node-id": "node-1"}, 9.0, 2),
                               ("r2", "a", {"topic": "t"}, 5.0, 3), ("r1", "a", {}, 2.0, 4)],
                              "run string, name string, tags map<string,string>, value double, at long")
    got = {r["run"]: r for r in runs.metric_table(m, ["a", "b"], "at").collect()}
    assert got["r1"]["a"] == 2.0 and math.isnan(got["r1"]["b"]) and math.isnan(got["r2"]["a"])
    nodes = spark.createDataFrame([("r", "b", {"node-id": n}, 1.0) for n in ("node-1", "node-1", "node-2147483647", "node--1", "x")] + [("r", "b", {}, 4.0)],
                                  "run string, name string, tags map<string,string>, value double")
    assert [(r["node"], r["bytes"]) for r in runs.bytes_by_node(nodes, "b").collect()] == [(1, 2.0)]
    timers = spark.createDataFrame([("x", 10, 4), ("x", 2, 0), ("y", 0, 0)], "n string, total long, count long")
    means = {r["n"]: r["mean"] for r in runs.weighted_mean(timers, ["n"]).collect()}
    assert means["x"] == 3.0 and math.isnan(means["y"])


def test_transit_latency_without_stamped_records(spark):
    df = spark.range(3).withColumn("headers", hdr.no_headers())
    r = runs.transit_latency(df, F.lit(5)).first()
    assert (r["stamped"], r["mean_ms"]) == (0, 0.0)


def test_tap_counts_without_changing_rows(spark):
    tapped, seen = records.tap(spark.range(10), "t", even=F.count_if(F.col("id") % 2 == 0))
    assert tapped.count() == 10
    assert seen.get["even"] == 5
