"""Incremental, reversible line deduplication.

State is a folder of numbered versions. Each holds an exact reference-count table (line key, number of documents that hold
it) in shards, and a cuckoo filter per shard with the keys that reached the threshold. Inserting documents adds to the
counts, deleting them subtracts; keys that cross the threshold are put into or taken out of the filters, so deleting
documents gives back the state before they came. Cleaning asks the filters first, in the scan of the documents, and only
lines that a filter may hold travel to the exact table, which decides.

A line's key is the line stripped of white space at both ends, A-Z in lower case. Keys are compared by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import SPACES, lower_ascii, row_key
from tidelog.session import shared_folder

SLOTS = 4
KICKS = 500
#: Filters are broadcast to the scan up to this size. Beyond it every line goes to the exact table; results are the same.
FILTER_BYTES = 64 << 20


def _alternate(bucket: np.ndarray | int, mark: np.ndarray | int, mask: int):
    return bucket ^ ((mark * 0x5BD1E995) & mask)


def _marks(h2: np.ndarray) -> np.ndarray:
    return ((h2.view(np.uint64) >> np.uint64(48)) | np.uint64(1)).astype(np.int64)


class CuckooFilter:
    """Marks of 16 bits in buckets of four; what finds no place after KICKS moves goes to a list that is also searched."""

    def __init__(self, buckets: np.ndarray, rest: list[tuple[int, int]]):
        self.buckets, self.rest = buckets, rest
        self.mask = len(buckets) - 1

    @classmethod
    def empty(cls, keys: int) -> CuckooFilter:
        size = 1 << max(3, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.8))))
        return cls(np.zeros((size, SLOTS), dtype=np.uint16), [])

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        n, kept = np.frombuffer(data[:16], dtype=np.int64)
        end = 16 + int(n) * SLOTS * 2
        rest = np.frombuffer(data[end:end + int(kept) * 16], dtype=np.int64).reshape(-1, 2)
        return cls(np.frombuffer(data[16:end], dtype=np.uint16).reshape(-1, SLOTS).copy(), [tuple(map(int, x)) for x in rest])

    def data(self) -> bytes:
        rest = np.array(self.rest, dtype=np.int64).reshape(-1, 2)
        return np.array([len(self.buckets), len(rest)], dtype=np.int64).tobytes() + self.buckets.tobytes() + rest.tobytes()

    def _place(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.buckets[bucket] == 0)
        if len(free):
            self.buckets[bucket, free[0]] = mark
        return bool(len(free))

    def insert(self, h1: int, mark: int) -> None:
        bucket = h1 & self.mask
        if self._place(bucket, mark) or self._place(_alternate(bucket, mark, self.mask), mark):
            return
        for kick in range(KICKS):
            slot = kick % SLOTS
            mark, self.buckets[bucket, slot] = int(self.buckets[bucket, slot]), mark
            bucket = _alternate(bucket, mark, self.mask)
            if self._place(bucket, mark):
                return
        self.rest.append((min(bucket, _alternate(bucket, mark, self.mask)), mark))

    def delete(self, h1: int, mark: int) -> None:
        """Takes one copy of the key's mark out. The key must be in the filter."""
        first = h1 & self.mask
        second = _alternate(first, mark, self.mask)
        for bucket in (first, second):
            at = np.flatnonzero(self.buckets[bucket] == mark)
            if len(at):
                self.buckets[bucket, at[0]] = 0
                return
        if (min(first, second), mark) in self.rest:
            self.rest.remove((min(first, second), mark))

    def may_hold(self, h1: np.ndarray, marks: np.ndarray) -> np.ndarray:
        first = h1 & self.mask
        second = _alternate(first, marks, self.mask)
        wide = marks.astype(np.uint16)[:, None]
        found = (self.buckets[first] == wide).any(axis=1) | (self.buckets[second] == wide).any(axis=1)
        if self.rest:
            low = np.minimum(first, second)
            for bucket, mark in self.rest:
                found |= (low == bucket) & (marks == mark)
        return found


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


class LineDedup:
    """The state in a folder. spark.checkpoint.dir names the shared folder unless folder is given."""

    def __init__(self, spark: SparkSession, folder: str | None = None, min_docs: int = 10, min_chars: int = 1, shards: int = 256):
        self.spark, self.folder = spark, folder or shared_folder(spark)
        self.min_docs, self.min_chars, self.shards = min_docs, min_chars, shards
        self.version = 0

    def _keys(self, docs: DataFrame, text: str) -> DataFrame:
        """One row for each document and distinct key of its lines: shard, h1, h2."""
        keys = F.filter(F.transform(_lines(F.col(text)), _line_key), lambda k: F.char_length(k) >= max(1, self.min_chars))
        pairs = F.transform(F.array_distinct(keys), lambda k: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2")))
        return docs.select(F.explode_outer(pairs).alias("k")).where("k is not null").select(
            F.pmod("k.h1", F.lit(self.shards)).cast("int").alias("shard"), "k.h1", "k.h2")

    def _table(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/v{self.version}/{kind}")

    def insert(self, docs: DataFrame, text: str = "text") -> LineDedup:
        """Counts the lines of docs in. Every row is a document, repeated rows too; null and empty texts have no keys."""
        return self._apply(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineDedup:
        """Takes the lines of docs, which must have been inserted, out of the counts again."""
        return self._apply(docs, text, -1)

    def _apply(self, docs: DataFrame, text: str, sign: int) -> LineDedup:
        change = self._keys(docs, text).groupBy("shard", "h1", "h2").agg((F.count("*") * sign).alias("change"))
        if self.version:
            change = (change.select("shard", "h1", "h2", "change", F.lit(0).cast("long").alias("before"))
                      .unionByName(self._table("counts").select("shard", "h1", "h2", F.lit(0).cast("long").alias("change"), F.col("n").alias("before")))
                      .groupBy("shard", "h1", "h2").agg(F.sum("change").alias("change"), F.sum("before").alias("before")))
        else:
            change = change.withColumn("before", F.lit(0).cast("long"))
        target = f"{self.folder}/v{self.version + 1}"
        merged = change.select("shard", "h1", "h2", F.col("before"), (F.col("before") + F.col("change")).alias("n"))
        merged.where("n > 0 or before > 0").write.parquet(f"{target}/changes")
        now = self.spark.read.parquet(f"{target}/changes")
        now.where("n > 0").select("shard", "h1", "h2", "n").write.parquet(f"{target}/counts")
        crossed = now.where((F.col("n") >= self.min_docs) != (F.col("before") >= self.min_docs)).select(
            "shard", "h1", "h2", (F.col("n") >= self.min_docs).alias("enters"))
        old = self._table("filters") if self.version else self.spark.createDataFrame([], "shard int, data binary")

        def update(key: tuple, filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            keys = keys.sort_values(["h1", "h2"])
            enters = keys[keys.enters]
            held = CuckooFilter.read(filters.data.iloc[0]) if len(filters) else CuckooFilter.empty(2 * len(enters))
            for part, act in ((enters, held.insert), (keys[~keys.enters], held.delete)):
                for h1, mark in zip(part.h1.tolist(), _marks(part.h2.to_numpy(dtype=np.int64)).tolist(), strict=True):
                    act(h1, mark)
            return pd.DataFrame({"shard": [key[0]], "data": [held.data()]})

        (old.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, "shard int, data binary")
         .write.parquet(f"{target}/filters"))
        self.version += 1
        return self

    def _suspects(self, docs: DataFrame, key: Column, text: str) -> DataFrame:
        """Lines that a filter may hold: key, i (the line's place from 0), h1, h2."""
        keys = F.transform(_lines(F.col(text)), _line_key)
        h1 = F.transform(keys, lambda k: F.when(F.char_length(k) >= max(1, self.min_chars), F.xxhash64(k)))
        h2 = F.transform(keys, lambda k: F.xxhash64(F.lit(1), k))
        hashed = docs.select(key.alias("key"), h1.alias("h1"), h2.alias("h2"))
        filters = self._table("filters")
        if (filters.agg(F.sum(F.length("data"))).first()[0] or 0) > FILTER_BYTES:
            return hashed.select("key", F.posexplode_outer(F.arrays_zip("h1", "h2")).alias("i", "k")).select(
                "key", "i", "k.h1", "k.h2").where("h1 is not null")
        shards = self.shards
        shared = self.spark.sparkContext.broadcast({r.shard: bytes(r.data) for r in filters.collect()})

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {k: CuckooFilter.read(v) for k, v in shared.value.items()}
            for batch in batches:
                first = batch.column("h1")
                lengths = np.diff(first.offsets.to_numpy())
                row = np.repeat(np.arange(len(lengths)), lengths)
                place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                flat1, flat2 = first.flatten(), batch.column("h2").flatten()
                some = flat1.is_valid().to_numpy(zero_copy_only=False)
                a, b = flat1.fill_null(0).to_numpy(), flat2.to_numpy()
                shard, marks = a % shards, _marks(b)
                hit = np.zeros(len(a), dtype=bool)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order])) + 1
                for part in np.split(order, cuts):
                    if len(part) and (f := held.get(int(shard[part[0]]))):
                        hit[part] = f.may_hold(a[part], marks[part])
                at = np.flatnonzero(hit & some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(row[at])), pa.array(place[at], pa.int32()), pa.array(a[at], pa.int64()), pa.array(b[at], pa.int64())],
                    names=["key", "i", "h1", "h2"])

        return hashed.mapInArrow(probe, "key string, i int, h1 long, h2 long")

    def clean(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Adds n_lines, n_dropped (long) and kept_text to every row of docs, whose columns all stay.

        Lines whose key min_docs documents or more hold go, in every document; the others stay, joined by a line feed. A null or
        empty text is one empty line, which stays. Keys of fewer than min_chars code points, empty ones at least, stay.
        Rows that repeat get the same result each.
        """
        key = row_key(F.col(doc_id), F.col(text))
        hot = self._table("counts").where(F.col("n") >= self.min_docs).select("h1", "h2")
        drops = (self._suspects(docs, key, text).join(hot, ["h1", "h2"]).groupBy("key")
                 .agg(F.sort_array(F.collect_set("i")).alias("__drop")))
        lines = _lines(F.col(text))
        drop = F.coalesce("__drop", F.array().cast("array<int>"))
        kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), drop)
        return (docs.withColumn("__key", key).join(drops.withColumnRenamed("key", "__key"), "__key", "left")
                .withColumn("__lines", lines)
                .withColumn("n_lines", F.size("__lines").cast("long"))
                .withColumn("n_dropped", F.size(drop).cast("long"))
                .withColumn("kept_text", F.when(F.size(drop) == 0, F.coalesce(F.col(text), F.lit("")))
                            .otherwise(F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")))
                .drop("__key", "__drop", "__lines"))
