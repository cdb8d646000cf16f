"""Ordered computations over groups of any size.

A log has few partitions, and one of them may hold a third of all rows, so
``Window.partitionBy(partition).orderBy(offset)`` would put that third into one task. Here a group is cut into
consecutive *chunks* of bounded length. Each chunk is computed on its own, each chunk also leaves one summary
row, a window over the summaries alone gives what every chunk inherits from the chunks around it, and a join on
(group, chunk) merges the two. The data is shuffled once, by (group, chunk); the summaries shrink it by the
chunk length.

The chunk expression must never decrease along the order. It is computed from the data, never from task or
partition numbers, so a recomputed task lands on the same chunks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.plans.facts import attach
from tidelog.plans.once import materialised

CHUNK_ROWS = 250_000
BLOCK_PIECES = 1024
CHUNK = "__chunk"
_FIRST = "__first"
_LAST = "__last"


def id_chunk(id_column: str | Column, rows: int = CHUNK_ROWS) -> Column:
    """Chunk of a column whose integer values are unique: at most ``rows`` rows can share a chunk."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.floor(c / F.lit(rows)).cast("bigint")


def with_chunk(df: DataFrame, column: str, out: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Add a chunk number that follows the order of a unique column of any integer, float or time type.

    Integers that lie densely (their span is within four times their number, as one aggregate tells) are divided.
    Sparse ones and other types are cut where the values lie.
    """
    if isinstance(df.schema[column].dataType, T.IntegralType):
        low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
        if n == 0 or high - low < 4 * n:
            return df.withColumn(out, id_chunk(column, rows))
    return with_value_chunk(df, column, out, rows)


def with_value_chunk(df: DataFrame, column: str, out: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of less than twice ``rows`` rows, or of a single value, however many there are.

    The range of the values (as ``order_code``) is cut evenly, in four times as many pieces as there would be full chunks. A
    piece that holds too many rows is cut again, between its own least and greatest value, until none does: each round is an
    aggregate of that column, and only pieces to be cut again are joined to the rows. At last neighbours are put together up
    to a chunk's size. Cuts are tables, so their number has no limit.
    """
    coded = df.withColumn("__code", order_code(df, column))
    low, high, n = coded.agg(F.min("__code"), F.max("__code"), F.count(F.lit(1))).first()
    if n <= rows or low == high:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    width = (high - low) // (4 * -(-n // rows)) + 1
    cut = coded.withColumn(out, F.expr(f"{low}L + (__code - {low}L) div {width}L * {width}L"))
    while True:
        pieces = materialised(cut.groupBy(out).agg(F.count(F.lit(1)).alias("__n"), F.min("__code").alias("__low"), F.max("__code").alias("__high")))
        full = pieces.filter((F.col("__n") > rows) & (F.col("__low") < F.col("__high")))
        if full.isEmpty():
            break
        again = full.select(out, "__low", F.expr(f"(__high - __low) div (4 * ((__n - 1) div {rows} + 1)) + 1").alias("__width"))
        inside = F.coalesce(F.expr("__low + (__code - __low) div __width * __width"), F.col(out))
        cut = attach(cut, again, [out]).withColumn(out, inside).drop("__low", "__width")
    # Windows of so many even pieces (and what became of them), so that no task orders them all.
    block = F.expr(f"(__low - {low}L) div {width}L div {BLOCK_PIECES}")
    before = Window.partitionBy("__block").orderBy("__low").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.expr(f"coalesce(__before, 0L) div {rows}")
    numbered = pieces.withColumn("__block", block).withColumn("__before", F.sum("__n").over(before)).withColumn("__group", filled)
    joint = Window.partitionBy("__block", "__group")
    merged = numbered.select(out, F.min(out).over(joint).alias("__merged"))
    return attach(cut, materialised(merged), [out]).select(*[c for c in df.columns if c != out], F.col("__merged").alias(out))


def order_code(df: DataFrame, column: str) -> Column:
    """A 64-bit integer that never decreases as the value grows; differences of two codes do not overflow.

    Null comes first and NaN last, as Spark sorts them. Values that lie very close may share a code: integers next to each
    other, and doubles that agree in 50 bits of their fraction. Whoever needs exact results compares the values inside one code.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        code = F.shiftright(F.unix_micros(c.cast("timestamp")), 1)
    elif isinstance(kind, T.DateType):
        code = F.unix_date(c).cast("bigint")
    elif isinstance(kind, T.IntegralType):
        code = F.shiftright(c.cast("bigint"), 1)
    else:
        x = c.cast("double")
        size = F.abs(x)
        # The logarithm may round to the power above or below; within one power the fraction is exact and kept in bounds,
        # so the code still never decreases. Infinity is above every power.
        power = F.least(F.floor(F.log2(size)), F.lit(1023))
        half = F.pow(F.lit(2.0), F.floor(power / 2))
        fraction = size / half / F.pow(F.lit(2.0), power - F.floor(power / 2)) - 1
        steps = F.floor(F.least(F.greatest(fraction, F.lit(0.0)), F.lit(1 - 2.0 ** -50)) * F.lit(2.0 ** 50)).cast("bigint")
        above = F.when(size == 0, F.lit(0).cast("bigint")).when(size == math.inf, F.lit(2100 << 50)).otherwise((power + 1076).cast("bigint") * (1 << 50) + steps)
        code = F.when(F.isnan(x), F.lit(2101 << 50)).otherwise(F.when(x < 0, -above).otherwise(above))
    return F.when(c.isNull(), F.lit(-(1 << 62))).otherwise(code)


@dataclass(frozen=True)
class Step:
    """One output of a scan. ``kind`` is one of index, sum, max, last_known, previous, following."""

    kind: str
    column: Column | None = None


def index() -> Step:
    """0-based position of the row in its group."""
    return Step("index")


def running_sum(column: Column) -> Step:
    return Step("sum", column)


def running_max(column: Column) -> Step:
    return Step("max", column)


def last_known(column: Column) -> Step:
    """Latest non-null value up to and including this row."""
    return Step("last_known", column)


def previous(column: Column) -> Step:
    """Value of the row just before, null on the first row."""
    return Step("previous", column)


def following(column: Column) -> Step:
    """Value of the row just after, null on the last row."""
    return Step("following", column)


def _filler(kind: T.DataType) -> Column:
    """Some value of a type, to stand where a key is null."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit("").cast(kind) if isinstance(kind, (T.StringType, T.BinaryType)) else F.lit(0).cast(kind)


def join_null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], more: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """An equi-join under which the null groups of both sides meet; the key columns come from the left."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in (*by, *more)})
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in by] + [F.col(c) == F.col(f"__r_{c}") for c in more]
    return left.join(renamed, same, how).drop(*[f"__r_{c}" for c in (*by, *more)])


def scan(df: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column, **steps: Step) -> DataFrame:
    """Add one column per step, computed along ``order`` inside each group of ``by``.

    Rows with a null in ``by`` form groups like any others. ``order`` must identify a row inside its group.
    """
    kept = df.columns
    # Keys without nulls: every shuffle, window and join below then has the same ones, and null groups meet.
    nulls = sum((F.col(c).isNull().cast("int") * 2 ** i for i, c in enumerate(by)), F.lit(0))
    filled = {f"__by_{i}": F.coalesce(F.col(c), _filler(df.schema[c].dataType)) for i, c in enumerate(by)}
    chunked = df.withColumns({**filled, "__nulls": nulls, CHUNK: chunk})
    by = [*filled, "__nulls"]
    keys = by + [CHUNK]
    inside = Window.partitionBy(*keys).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*by).orderBy(CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    # One order column stays as it is: numbers then aggregate in place, where a struct would need a sort.
    place = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(o) for o in order])

    local, summary, carry, merged = [], [], [], []
    kinds = {s.kind for s in steps.values()}
    if "previous" in kinds:
        local.append((F.row_number().over(inside) == 1).alias(_FIRST))
    if "following" in kinds:
        local.append(F.lead(F.lit(1)).over(inside).isNull().alias(_LAST))
    for name, step in steps.items():
        here, total, inherit = f"__here_{name}", f"__total_{name}", f"__carry_{name}"
        c = step.column
        if step.kind == "index":
            local.append(F.row_number().over(inside).cast("bigint").alias(here))
            summary.append(F.count(F.lit(1)).alias(total))
            carry.append(F.sum(total).over(before).alias(inherit))
            out = F.col(here) - 1 + F.coalesce(F.col(inherit), F.lit(0))
        elif step.kind == "sum":
            local.append(F.sum(c).over(so_far).alias(here))
            summary.append(F.sum(c).alias(total))
            carry.append(F.sum(total).over(before).alias(inherit))
            out = F.coalesce(F.col(here), F.lit(0)) + F.coalesce(F.col(inherit), F.lit(0))
        elif step.kind == "max":
            local.append(F.max(c).over(so_far).alias(here))
            summary.append(F.max(c).alias(total))
            carry.append(F.max(total).over(before).alias(inherit))
            out = F.greatest(F.col(here), F.col(inherit))
        elif step.kind == "last_known":
            local.append(F.last(c, ignorenulls=True).over(so_far).alias(here))
            summary.append(F.max_by(c, F.when(c.isNotNull(), place)).alias(total))
            carry.append(F.last(total, ignorenulls=True).over(before).alias(inherit))
            out = F.coalesce(F.col(here), F.col(inherit))
        elif step.kind == "previous":
            local.append(F.lag(c).over(inside).alias(here))
            summary.append(F.max_by(c, place).alias(total))
            carry.append(F.lag(total).over(across).alias(inherit))
            out = F.when(F.col(_FIRST), F.col(inherit)).otherwise(F.col(here))
        elif step.kind == "following":
            local.append(F.lead(c).over(inside).alias(here))
            summary.append(F.min_by(c, place).alias(total))
            carry.append(F.lead(total).over(across).alias(inherit))
            out = F.when(F.col(_LAST), F.col(inherit)).otherwise(F.col(here))
        else:
            raise ValueError(f"unknown step: {step.kind}")
        merged.append(out.alias(name))

    carries = chunked.groupBy(*keys).agg(*summary).select(*keys, *carry)
    rows = chunked.select("*", *local)
    return rows.join(carries, keys, "left").select(*[c for c in kept if c not in steps], *merged)


def scan_measured(df: DataFrame, by: Sequence[str], order: str, rows: int = CHUNK_ROWS, **steps: Step) -> DataFrame:
    """A scan along a column of the caller's, whose values may lie densely or far apart: they are looked at before they are cut."""
    return scan(with_chunk(df, order, "__cut", rows), by, [order], F.col("__cut"), **steps).drop("__cut")
