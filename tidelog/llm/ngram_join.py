"""N-gram Jaccard join through a MinHash LSH forest.

Texts are sets of five-word shingles; texts with equal sets are one class and go through the forest once. Each tree of the forest is
a trie of MinHash values. A class looks in tree after tree for others under its prefix there, until a link at the threshold is found
with the target recall. Prefixes are as short as they may be: one is shortened from DEPTH values level by level, down to SHORTEST, as long
as no more than CROWD classes are under it. Where texts are sparse, short prefixes reach the recall in few trees; where
they crowd, long ones part them better, and more trees are asked. Two texts under one prefix see the same crowd, so whichever of
them stops first has reached the recall for both.

Neighbours only say which texts may be linked. They are gathered into groups, and a group's texts are compared exactly, through an
inverted index of its shingles. A group is a component of neighbours while that is the least work. A component that would be cut into more
blocks than its texts have prefixes, as a long chain would, is taken prefix by prefix instead, and two texts are compared under the
first they share. Whatever is too large for one task is cut into blocks that are compared two by two. Links are counted and joined to
components where they are found; no row is made for a pair.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import UPPER, item_words, row_key, written
from tidelog.llm.graph import components

SHINGLE = 5
#: Linked: the shingles in common are at least NEAR[0] / NEAR[1] of those of either.
NEAR = (4, 5)
#: Prefixes have so many MinHash values, at least and at most; more classes than CROWD under one keep it from being shortened.
SHORTEST, DEPTH, TARGET, CROWD = 5, 8, 0.99999, 500
#: Shingles and sets of a block that is compared with another block in one task, and shingles that a task gets about.
BLOCK, BLOCK_SETS, TASK = 1_000_000, 500, 3_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(UPPER, UPPER.lower())


def trees_for(length: int) -> int:
    """Trees that find a pair at the threshold with the target recall, by prefixes of that length."""
    return math.ceil(math.log(1 - TARGET) / math.log(1 - (NEAR[0] / NEAR[1]) ** length))


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct codes of all runs of SHINGLE words; of fewer words, but not none, there is one run."""
    n = max(min(len(words), 1), len(words) - SHINGLE + 1)
    code = np.full(n, len(words) if n and len(words) < SHINGLE else SHINGLE, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        code = (code ^ words[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(32)
    return np.unique(code)


def _factors() -> np.ndarray:
    """One odd number for each level and tree: a MinHash is the least product with it."""
    return np.random.default_rng(2).integers(1, 1 << 63, (DEPTH, trees_for(DEPTH)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefixes(codes: np.ndarray, factors: np.ndarray, trees: int, lengths: range) -> np.ndarray:
    """For each tree the codes of its prefixes of these lengths. A code names its tree and length too."""
    prefix = np.arange(trees, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    out = np.zeros((trees, len(lengths)), np.uint64)
    for level in range(lengths[-1] if len(codes) else 0):
        least = np.full(trees, np.iinfo(np.uint64).max)
        for a in range(0, len(codes), 1000):
            least = np.minimum(least, (factors[level, :trees, None] * codes[a:a + 1000]).min(axis=1))
        prefix = (prefix ^ least) * np.uint64(0x9E3779B97F4A7C15)
        prefix ^= prefix >> np.uint64(31)
        if level + 1 in lengths:
            out[:, level + 1 - lengths[0]] = prefix
    return out


def _signed(rows: DataFrame, text: str, trees: int, lengths: range) -> DataFrame:
    """rows without their text, and cls, which names the shingle set (null if empty), n, its size, and prefixes, tree by tree."""
    kept = [c for c in rows.columns if c != text]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("cls", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("prefixes", T.ArrayType(T.LongType()))])

    factors = _factors()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = trees * len(lengths)
        for batch in batches:
            column = batch.column("__w")
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            names, sizes, found = [], [], np.zeros((batch.num_rows, width), np.uint64)
            for i in range(batch.num_rows):
                codes = shingles(flat[ends[i]:ends[i + 1]])
                sizes.append(len(codes))
                names.append(hashlib.blake2b(codes.tobytes(), digest_size=16).hexdigest() if len(codes) else None)
                found[i] = prefixes(codes, factors, trees, lengths).ravel()
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(names, pa.string()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found.ravel().view(np.int64)))], names=[f.name for f in schema])

    words = F.transform(item_words(F.col(text)), lambda w: F.xxhash64(w))
    return rows.select(*kept, words.alias("__w")).mapInArrow(sign, schema)


def _forest(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (node, tree, prefix): where each class looks for others.

    classes: node, key, and prefixes of the shortest length. Only classes that meet a crowd somewhere are signed to the full depth.
    """
    short = classes.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    crowds = written(short.groupBy("prefix").count().where(F.col("count") > CROWD).select("prefix"))
    crowded = written(short.join(crowds, "prefix", "left_semi").select("node").distinct())
    if crowded.isEmpty():
        return short.select("node", "tree", "prefix")
    lengths, trees = range(SHORTEST, DEPTH + 1), trees_for(DEPTH)
    again = texts.join(classes.join(crowded, "node", "left_semi").select("key", "node").hint("shuffle_hash"), "key").select("node", "text")
    whole = written(_signed(again, "text", trees, lengths).dropDuplicates(["node"]))
    per_tree = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.slice("prefixes", t * len(lengths) + 1, len(lengths)))
    deep = written(whole.select("node", F.posexplode(per_tree).alias("tree", "path"))
                   .select("node", "tree", *[F.col("path")[k].alias(f"p{length}") for k, length in enumerate(lengths)]))
    # From the full depth up: the shortest prefix without a crowd under it. A crowd under a prefix is one under all shorter ones.
    length = F.lit(SHORTEST)
    for k in lengths[:-1]:
        crowd = deep.groupBy(f"p{k}").count().where(F.col("count") > CROWD).select(f"p{k}", F.lit(True).alias(f"crowd{k}"))
        deep = deep.join(crowd, f"p{k}", "left")
        length = F.when(F.col(f"crowd{k}"), k + 1).otherwise(length)
    prefix = F.coalesce(*[F.when(F.col("length") == k, F.col(f"p{k}")) for k in lengths])
    # Trees are asked in order until what all before them miss together is small enough.
    missed = F.sum(F.log1p(-F.pow(F.lit(NEAR[0] / NEAR[1]), F.col("length")))).over(Window.partitionBy("node").orderBy("tree").rowsBetween(Window.unboundedPreceding, -1))
    asked = deep.withColumn("length", length).withColumn("missed", missed).where(F.col("missed").isNull() | (F.col("missed") > math.log(1 - TARGET)))
    return short.join(crowded, "node", "left_anti").select("node", "tree", "prefix").unionByName(asked.select("node", "tree", prefix.alias("prefix")))


def _meetings(classes: DataFrame, forest: DataFrame) -> DataFrame:
    """Which texts are compared where: rows (key, cls, size, n, comp, tree, earlier, b, i, j).

    comp is a component of neighbours (tree -1), or one prefix of a component that is cheaper by its prefixes; earlier then holds
    the class's prefixes by tree, 0 where it has none.
    """
    hubs = forest.groupBy("prefix").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top").drop("top")
    shared = written(forest.join(hubs, "prefix"))
    roots = components(shared.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    members = written(classes.select("key", "cls", "size", "n", "node").join(roots, "node"))
    blocks = F.ceil(F.greatest(F.sum("n") / BLOCK, F.count("*") / BLOCK_SETS)).cast("int").alias("blocks")
    large = members.groupBy("root").agg(blocks, F.count("*").alias("m")).where("blocks > 1")
    inside = written(shared.drop("hub").join(members.select("node", "root").join(large, "root"), "node"))
    # By its blocks a text is sent once for each of them, by its prefixes once for each of those.
    chains = inside.groupBy("root").agg((F.first("blocks") * F.first("m")).alias("sent"), F.count("*").alias("held")).where("held < sent").select("root")
    found = F.map_from_entries(F.collect_list(F.struct("tree", "prefix")))
    path = F.transform(F.sequence(F.lit(0), F.lit(trees_for(DEPTH) - 1)), lambda t: F.coalesce(F.col("found")[t], F.lit(0).cast("long")))
    linked = inside.join(chains, "root", "left_semi")
    paths = linked.groupBy("node").agg(found.alias("found")).select("node", path.alias("earlier"))
    by_prefix = linked.select("node", "tree", F.col("prefix").alias("comp")).join(paths, "node").join(members.drop("root"), "node").drop("node")
    whole = members.join(chains, "root", "left_anti").select(
        "key", "cls", "size", "n", F.col("root").alias("comp"), F.lit(-1).alias("tree"), F.lit(None).cast("array<bigint>").alias("earlier"))
    rows = written(whole.unionByName(by_prefix))
    return (rows.join(rows.groupBy("comp", "tree").agg(blocks), ["comp", "tree"])
            .withColumn("b", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("blocks")).cast("int"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .withColumns({"i": F.least("b", "other"), "j": F.greatest("b", "other")}).drop("other", "blocks"))


def _compare(sets: list[np.ndarray], sizes: np.ndarray, block: np.ndarray | None, earlier: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Per set: the total size of the sets linked to it, and the least set of its component here.

    Overlaps come from postings of each shingle. With block, only sets of different blocks are compared. Sets that share
    one of the earlier prefixes (0: none) are left to the group of that prefix.
    """
    m = len(sets)
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), lengths)
    _, run = np.unique(np.concatenate(sets), return_inverse=True)
    posting = owner[np.argsort(run, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(run))])
    runs = np.split(run, np.cumsum(lengths)[:-1])
    degree, label = np.zeros(m, np.int64), np.arange(m)
    for i in range(m):
        held = runs[i]
        many = starts[held + 1] - starts[held]
        held, many = held[many > 1], many[many > 1]
        if not len(held):
            continue
        total = int(many.sum())
        at = np.arange(total) + np.repeat(starts[held] - (np.cumsum(many) - many), many)
        common = np.bincount(posting[at], minlength=m)
        linked = NEAR[1] * common >= NEAR[0] * (lengths + lengths[i] - common)
        linked[i] = False
        if block is not None:
            linked &= block != block[i]
        at = np.flatnonzero(linked)
        if earlier is not None:
            at = at[~((earlier[at] == earlier[i]) & (earlier[i] != 0)).any(axis=1)]
        if len(at):
            degree[i] = sizes[at].sum()
            together = np.unique(label[np.append(at, i)])
            if len(together) > 1:
                label[np.isin(label, together)] = together[0]
    return degree, label


def _verified(groups: DataFrame) -> DataFrame:
    """groups: rows (bin, comp, tree, earlier, i, j, b, cls, size, text). Rows (cls, links, hub) for each class with links here."""
    schema, pair = pa.schema([("cls", pa.string()), ("links", pa.int64()), ("hub", pa.string())]), ["comp", "tree", "i", "j"]

    def compare(table: pa.Table) -> pa.Table:
        frame = table.drop_columns(["text"]).to_pandas().sort_values([*pair, "cls"]).drop_duplicates([*pair, "cls"])
        known: dict[str, np.ndarray] = {}
        for name, row in zip(frame.cls, frame.index, strict=True):
            if name not in known:
                words = _WORD.findall((table.column("text")[row].as_py() or "").translate(_LOWER))
                known[name] = shingles(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64))
        names, sizes, blocks, earlier = (frame[c].to_numpy() for c in ("cls", "size", "b", "earlier"))
        tree, i, j = (frame[c].to_numpy() for c in ("tree", "i", "j"))
        borders = np.flatnonzero((frame[pair] != frame[pair].shift()).any(axis=1).to_numpy())
        out: list[tuple] = []
        for a, b in zip(borders, [*borders[1:], len(frame)], strict=True):
            degree, label = _compare([known[c] for c in names[a:b]], sizes[a:b], blocks[a:b] if i[a] != j[a] else None,
                                     np.stack(earlier[a:b])[:, :tree[a]] if tree[a] > 0 else None)
            out += [(names[a + k], int(degree[k]), names[a + label[k]]) for k in np.flatnonzero(degree)]
        return pa.Table.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema) if out else schema.empty_table()

    return groups.groupBy("bin").applyInArrow(compare, "cls string, links long, hub string")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, key, class_key, class_id (the least doc_id that links lead to), n_links.

    n_links counts the other rows whose Jaccard similarity of shingle sets is NEAR or more, exact copies included. A text
    without words (null, empty, punctuation) has no links and its own doc_id as class. Rows that repeat are links of one
    another. A null doc_id takes part; its class is the least id there is, null if none. key names the row's content.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    signed = written(_signed(rows, "text", trees_for(SHORTEST), range(SHORTEST, SHORTEST + 1)))
    # Whatever the number of copies, a class is one row, combined before it is shuffled.
    classes = written(signed.where("cls is not null").groupBy("cls").agg(
        F.min("key").alias("key"), F.count("*").alias("size"), F.min("n").alias("n"), F.min("doc_id").alias("least"), F.first("prefixes").alias("prefixes"))
        .withColumn("node", F.xxhash64("cls")))
    texts = rows.select("key", "text")
    members = written(_meetings(classes, _forest(classes, texts)))
    bins = max(1, -(-(members.agg(F.sum("n")).first()[0] or 0) // TASK))
    groups = texts.join(members.hint("shuffle_hash"), "key").withColumn("bin", F.pmod(F.xxhash64("comp", "tree", "i", "j"), F.lit(max(24, bins))))
    links = written(_verified(groups.drop("key", "n")))
    roots = components(links.select(F.col("cls").alias("a"), F.col("hub").alias("b")))
    known = (classes.select("cls", "size", "least")
             .join(links.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
             .join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    ids = known.groupBy("root").agg(F.min("least").alias("class_id"))
    known = known.join(ids, "root").select("cls", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"))
    return signed.select("doc_id", "key", "cls").join(known, "cls", "left").select(
        "doc_id", "key", F.coalesce("root", "key").alias("class_key"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, of which one stays for each class: that with the least doc_id.

    Rows that repeat, or share id and text, are one. Texts without words all stay, once for each id.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    stays = near_duplicates(docs, doc_id, text).groupBy("class_key").agg(first.alias("first")).select(F.col("first.key").alias("__key"))
    keyed = docs.withColumn("__key", row_key(F.col(doc_id), F.col(text)))
    return keyed.join(stays.hint("shuffle_hash"), "__key").dropDuplicates(["__key"]).drop("__key")
