"""Schema evolution over a table of schema versions.

``fields`` has one row per (subject, version, field) with type, has_default and default_value. Versions are
numbered as registered; gaps are allowed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING_DEFAULT = "READER_FIELD_MISSING_DEFAULT_VALUE"
TYPE_MISMATCH = "TYPE_MISMATCH"

# The writer types each reader type accepts besides itself.
PROMOTIONS = {
    "long": ["int"],
    "float": ["int", "long"],
    "double": ["int", "long", "float"],
    "string": ["bytes"],
    "bytes": ["string"],
}


def readable(reader: Column, writer: Column) -> Column:
    """Whether a value written as one type can be read as the other."""
    ok = reader == writer
    for to, sources in PROMOTIONS.items():
        ok = ok | ((reader == to) & writer.isin(*sources))
    return ok


def numbered_versions(fields: DataFrame) -> DataFrame:
    """Fields with ``k``, the version's place among the subject's registered versions (1, 2, ...)."""
    versions = fields.select("subject", "version").distinct()
    places = versions.withColumn("k", F.row_number().over(Window.partitionBy("subject").orderBy("version")))
    return fields.join(places, ["subject", "version"])


def _verdict(prefix: str, problem: Column, field: Column) -> list[Column]:
    first = F.min(F.when(problem.isNotNull(), F.struct(field.alias("field"), problem.alias("reason"))))
    return [first.isNull().alias(prefix), first["reason"].alias(f"{prefix}_reason"), first["field"].alias(f"{prefix}_field")]


def schema_compat(fields: DataFrame) -> DataFrame:
    """Each version against the one registered before it.

    ``backward``: the new version reads the old one's data; ``forward``: the old one reads the new one's. With the
    first problem by field name, and the level both together satisfy. The first version is FULL. Old and new
    fields meet in one aggregation by field, so no pairs of versions are built.
    """
    own = numbered_versions(fields).select("subject", "version", "k", "field", "type", "has_default")
    last = own.groupBy("subject").agg(F.max("k").alias("__last"))
    labels = own.select("subject", "k", "version").distinct()
    new = own.select("subject", "k", "field", F.struct("type", "has_default").alias("n"))
    old = own.join(last, "subject").filter(F.col("k") < F.col("__last")).select(
        "subject", (F.col("k") + 1).alias("k"), "field", F.struct("type", "has_default").alias("o"))
    empty = F.lit(None).cast("struct<type:string,has_default:boolean>")
    both = new.withColumn("o", empty).unionByName(old.withColumn("n", empty)).groupBy("subject", "k", "field").agg(
        F.max("n").alias("n"), F.max("o").alias("o"))
    n, o = F.col("n"), F.col("o")
    later = F.col("k") > 1
    backward = F.when(later & n.isNotNull() & o.isNull() & ~n["has_default"], MISSING_DEFAULT).when(
        later & n.isNotNull() & o.isNotNull() & ~readable(n["type"], o["type"]), TYPE_MISMATCH)
    forward = F.when(later & o.isNotNull() & n.isNull() & ~o["has_default"], MISSING_DEFAULT).when(
        later & n.isNotNull() & o.isNotNull() & ~readable(o["type"], n["type"]), TYPE_MISMATCH)
    verdicts = both.groupBy("subject", "k").agg(
        *_verdict("backward", backward, F.col("field")), *_verdict("forward", forward, F.col("field")))
    level = F.when(F.col("backward") & F.col("forward"), "FULL").when(F.col("backward"), "BACKWARD").when(
        F.col("forward"), "FORWARD").otherwise("NONE")
    return verdicts.join(labels, ["subject", "k"]).select(
        "subject", "version", "backward", "backward_reason", "backward_field", "forward", "forward_reason",
        "forward_field", level.alias("satisfies"))


def schema_compat_transitive(fields: DataFrame) -> DataFrame:
    """Each version against **all** versions registered before it.

    Works on the history of each field (who had it, with which types, first without a default) instead of on
    pairs of versions, so its cost is linear in the number of field rows.
    """
    own = numbered_versions(fields).select("subject", "version", "k", "field", "type", "has_default")
    before = Window.partitionBy("subject", "field").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    history = own.select(
        "*", F.count(F.lit(1)).over(before).alias("had"),
        F.collect_set("type").over(before).alias("types"),
        F.coalesce(F.max((~F.col("has_default")).cast("int")).over(before), F.lit(0)).alias("needed"))
    judged = history.select(
        "subject", "version", "k", "needed",
        (~F.col("has_default") & (F.col("had") < F.col("k") - 1)).alias("b_missing"),
        F.exists("types", lambda t: ~readable(F.col("type"), t)).alias("b_type"),
        F.exists("types", lambda t: ~readable(t, F.col("type"))).alias("f_type"))
    per_version = judged.groupBy("subject", "version", "k").agg(
        F.count_if("b_missing").alias("b_missing"), F.count_if("b_type").alias("b_type"),
        F.count_if("f_type").alias("f_type"), F.sum("needed").alias("needed_here"))
    # Fields some earlier version had without a default; those not present here cannot be read by that version.
    needs = own.filter(~F.col("has_default")).groupBy("subject", "field").agg(F.min("k").alias("k")).groupBy("subject", "k").agg(
        F.count(F.lit(1)).alias("new_needs"))
    upto = Window.partitionBy("subject").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    all_needs = per_version.join(needs, ["subject", "k"], "left").withColumn(
        "needed_all", F.coalesce(F.sum(F.coalesce("new_needs", F.lit(0))).over(upto), F.lit(0)))
    f_missing = F.col("needed_all") - F.col("needed_here")
    backward = (F.col("b_missing") == 0) & (F.col("b_type") == 0)
    forward = (f_missing == 0) & (F.col("f_type") == 0)
    return all_needs.select(
        "subject", "version", backward.alias("backward_transitive"), forward.alias("forward_transitive"),
        (backward & forward).alias("full_transitive"),
        (F.col("b_missing") + F.col("b_type")).alias("backward_problems"), (f_missing + F.col("f_type")).alias("forward_problems"))


def register_gate(candidates: DataFrame, levels: DataFrame) -> DataFrame:
    """Accept or refuse candidate schemas in order; only accepted ones become versions to compare with.

    ``candidates`` has (subject, candidate, field, type, has_default), ``levels`` (subject, level), default
    BACKWARD. Each answer depends on the one before it, so one subject's candidate list, which is metadata of a
    few rows per schema, is one group.
    """
    rows = candidates.join(levels, "subject", "left").withColumn("level", F.coalesce("level", F.lit("BACKWARD")))
    schema = "subject string, candidate bigint, accepted boolean, version int, reason string, field string"
    return rows.groupBy("subject").applyInPandas(_gate_subject, schema)


def _problem(reader: dict, writer: dict) -> tuple[str, str] | None:
    for field, (kind, has_default) in sorted(reader.items()):
        if field not in writer:
            if not has_default:
                return MISSING_DEFAULT, field
        elif kind != writer[field][0] and writer[field][0] not in PROMOTIONS.get(kind, ()):
            return TYPE_MISMATCH, field
    return None


def _gate_subject(rows: pd.DataFrame) -> pd.DataFrame:
    level = rows["level"].iloc[0]
    accepted: list[dict] = []
    out = []
    for candidate, part in rows.sort_values("candidate").groupby("candidate", sort=True):
        new = {f: (t, bool(d)) for f, t, d in zip(part["field"], part["type"], part["has_default"])}
        against = accepted if level.endswith("_TRANSITIVE") else accepted[-1:]
        problem = None
        for old in against:
            if level.startswith(("BACKWARD", "FULL")):
                problem = problem or _problem(new, old)
            if level.startswith(("FORWARD", "FULL")):
                problem = problem or _problem(old, new)
        if problem is None:
            accepted.append(new)
        reason, field = problem or (None, None)
        out.append((rows["subject"].iloc[0], int(candidate), problem is None,
                    len(accepted) if problem is None else None, reason, field))
    return pd.DataFrame(out, columns=["subject", "candidate", "accepted", "version", "reason", "field"]).astype({"version": "Int32"})


def read_as(df: DataFrame, writers: Mapping[str, Mapping[str, str]], reader: Sequence[tuple[str, str, str | None, bool]],
            writer: str = "writer", payload: str = "payload") -> DataFrame:
    """Resolve rows to a reader schema: skip unknown fields, fill defaults, reject what cannot be read.

    ``writers`` maps each writer version to its fields and types; ``reader`` lists (field, type, default,
    has_default). Which fields are present, defaulted or missing is known per version beforehand, so the rows are
    read in one pass. ``payload`` is a map of field to text.
    """
    reason: Column = F.lit(None).cast("string")
    for version, fields in writers.items():
        for name, kind, _, has_default in sorted(reader):
            if name not in fields and not has_default:
                problem = f"{MISSING_DEFAULT} {name}"
            elif name in fields and fields[name] != kind and fields[name] not in PROMOTIONS.get(kind, ()):
                problem = f"{TYPE_MISMATCH} {name}"
            else:
                continue
            reason = F.when(reason.isNull() & (F.col(writer) == version), F.lit(problem)).otherwise(reason)
    unknown = ~F.col(writer).isin(*writers) | F.col(writer).isNull()
    judged = df.withColumn("reject_reason", F.when(unknown, "unknown writer schema").otherwise(reason))
    out = judged
    for name, _, default, _ in reader:
        has = [v for v, fields in writers.items() if name in fields]
        value = F.when(F.col(writer).isin(*has), F.try_element_at(F.col(payload), F.lit(name))).otherwise(F.lit(default))
        out = out.withColumn(f"r_{name}", F.when(F.col("reject_reason").isNull(), value))
    return out
