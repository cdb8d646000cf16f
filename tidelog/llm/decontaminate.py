"""Benchmark decontamination as a prefix-filtered set join.

Every window of an item (13 words in a row, or the whole item if it is shorter) is a set of shingles. An occurrence of the
window holds all of its shingles, so one necessary shingle is enough as the prefix: the rarest, by counts over all
documents. Documents are scanned once against the prefixes; a hit fixes where the window would have to start, the
positional bound (it starts at 0 or later) and the length bound (it ends within the document) are checked, and the words of
the document are compared with the window's. Nothing but verified occurrences is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.llm.common import item_words, positions, row_key, written

WINDOW, SHINGLE = 13, 3
#: Windows are broadcast in blocks of this many, so a broadcast has a fixed bound however large the benchmark is.
WINDOW_BLOCK = 100_000


def _shingles(words: Column, width: int) -> Column:
    return F.transform(positions(F.size(words) - (width - 1)), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """The distinct windows of all items: win (words), n (their number), items (ids that hold it)."""
    words = items.select(F.col(item_id).alias("item"), item_words(F.col(text)).alias("w")).where("size(w) > 0")
    each = words.select("item", F.explode_outer(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))), lambda i: F.slice("w", i + 1, window))).alias("win"))
    return each.groupBy("win").agg(F.collect_set("item").alias("items")).withColumn("n", F.size("win"))


def occurrences(docs: DataFrame, windows: DataFrame, key: Column, text: str) -> DataFrame:
    """Every place where a window occurs in a document: key, start, n, items.

    windows is a written table with the columns win, n, items.
    """
    words = docs.select(key.alias("key"), item_words(F.col(text)).alias("w"))
    found = None
    blocks = max(1, -(-windows.count() // WINDOW_BLOCK))
    widths = [r[0] for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().collect()]
    for width in sorted(widths):
        scanned = words.select("key", "w", F.posexplode_outer(_shingles(F.col("w"), width)).alias("p", "h"))
        for block in range(blocks):
            part = windows.where((F.least("n", F.lit(SHINGLE)) == width) & (F.pmod(F.xxhash64("win"), F.lit(blocks)) == block))
            shingles = part.select("win", "n", "items", F.posexplode_outer(_shingles(F.col("win"), width)).alias("off", "h"))
            wanted = written(scanned.select("h").join(F.broadcast(shingles.select("h").distinct()), "h").groupBy("h").agg(F.count("*").alias("df")))
            # A window with a shingle that no document holds occurs nowhere; the others are filed under their rarest one.
            rarest = (shingles.join(wanted, "h", "left").groupBy("win", "n", "items")
                      .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "off")).alias("best"))
                      .where("best.df > 0").select("win", "n", "items", "best.h", "best.off"))
            hits = scanned.join(F.broadcast(rarest), "h").where(
                "p >= off and p - off + n <= size(w) and slice(w, p - off + 1, n) = win").select(
                "key", (F.col("p") - F.col("off")).alias("start"), "n", "items")
            found = hits if found is None else found.unionByName(hits)
    return found if found is not None else docs.sparkSession.createDataFrame([], "key string, start int, n int, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of docs: its columns, and n_words, n_hit, n_items (long) and item_ids (as strings, sorted).

    A word of the document is hit if it is inside any occurrence of a window. Null and empty texts have no words and no
    hits; null and empty items have no windows; an item without an id hits words but is not listed. Items that share an
    id count once, rows that repeat get the same result each. Columns of docs with the names of results are replaced.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "item_ids")
    key = row_key(F.col(doc_id), F.col(text))
    windows = written(item_windows(items, item_id, item_text, window))
    windows = windows.withColumn("items", F.col("items").cast("array<string>"))
    places = occurrences(docs, windows, key, text).groupBy("key", "start").agg(F.max("n").alias("n"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    before = W.partitionBy("key").orderBy("start")
    spans = places.withColumn("end", F.col("start") + F.col("n")).withColumn(
        "seen", F.coalesce(F.max("end").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    hits = spans.groupBy("key").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "seen"))).cast("long").alias("__hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__items"))
    return (docs.withColumn("__key", key).withColumn("n_words", F.size(item_words(F.col(text))).cast("long"))
            .join(hits.withColumnRenamed("key", "__key"), "__key", "left")
            .withColumn("n_hit", F.coalesce("__hit", F.lit(0)).cast("long"))
            .withColumn("item_ids", F.coalesce("__items", F.array().cast("array<string>")))
            .withColumn("n_items", F.size("item_ids").cast("long"))
            .drop("__key", "__hit", "__items"))
