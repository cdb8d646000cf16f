"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes into tokens. All tokens of both are sorted by start; the running maximum of their ends
tells where a group ends: where the next start reaches it. Inside a group tokens that overlap are paired.

Neither tokenizer joins what stands before a space to that space where the character before it is no white space: there
both begin anew. Texts are cut at these places, and what a worker has once aligned of such a segment it remembers, in a
bounded cache. Whether a tokenizer's tokens spell the segment is compared byte by byte; a text with a segment that differs is
encoded and compared as a whole.

Counts over the whole corpus travel by batches of documents: each batch sends its distinct id pairs once, pairs are added
up over all batches, and each batch gets back what it sent.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import written

#: Tokens of A whose documents make a batch; a longer document makes one alone.
BATCH_TOKENS = 2_000_000
#: Segments, and characters of them, that a worker remembers.
CACHE_SEGMENTS, CACHE_CHARS = 400_000, 20_000_000
#: Segments that the tokenizers get at a time; what they return is much larger than the ids.
ENCODE_SEGMENTS = 10_000
#: A pair of ids is one number, the id of B in its upper half.
B_SHIFT = 32
#: Where a space has white space before it, or what some library takes for it, nothing is cut there.
_CUT = re.compile("(?<=[^\\s\u180e\u200b\u2060\ufeff]) ")
_UNCUT = re.compile("[\\s\u180e\u200b\u2060\ufeff] ")


def coalesce(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and overlaps of tokens with the byte lengths ``a`` and ``b``, which tile the same bytes.

    Returns the group of each A token, the group of each B token, the byte where each group ends, and the overlapping pairs
    as two arrays of token numbers, by A then B. A token of no bytes is in the group that goes on, or begins, where it stands.
    """
    ends = np.concatenate([np.cumsum(a), np.cumsum(b)])
    starts = ends - np.concatenate([a, b])
    order = np.lexsort((np.arange(len(starts)), ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    # A token without bytes that stands at a border begins no group of its own: what follows there begins one.
    if len(order) and (ends == starts).any():
        wide = (ends > starts)[order]
        breaks[1:] = breaks[1:] & wide[1:] & (np.cumsum(wide)[:-1] > 0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    group_ends = np.zeros(int(group.max()) + 1 if len(group) else 0, np.int64)
    np.maximum.at(group_ends, group, ends)
    start_a, end_a, start_b, end_b = starts[:len(a)], ends[:len(a)], starts[len(a):], ends[len(a):]
    first = np.searchsorted(end_b, start_a, "right")
    n = np.maximum(np.searchsorted(start_b, end_a, "left") - first, 0)
    left = np.repeat(np.arange(len(a)), n)
    right = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    return group[:len(a)], group[len(a):], group_ends, left, right


def byte_tokens(path: str) -> tuple[object, list[bytes]]:
    """The byte-level tokenizer of a file and the bytes of each of its ids."""
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in set(plain))}
    entries = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for entry, i in tokenizer.get_vocab().items():
        entries[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    return tokenizer, entries


def piece_tokens(path: str) -> tuple[object, list[bytes]]:
    """The piece tokenizer of a file and the bytes of each of its ids."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return pieces, entries


class _Numbers(dict):
    """Numbers segments in the order they first come, and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, segment: str) -> int:
        number = self[segment] = len(self)
        self.new.append(segment)
        return number


class Aligner:
    """Two tokenizers and what is remembered of segments: ids, groups, links."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.bytes_a = byte_tokens(path_a)
        self.b, self.bytes_b = piece_tokens(path_b)
        self.len_a, self.len_b = (np.array([len(x) for x in e], np.int64) for e in (self.bytes_a, self.bytes_b))
        #: Pieces that hold a space behind something else would reach over the places of the cuts.
        self.cuts = not any(b" " in x.lstrip(b" ") for x in self.bytes_b)
        self.forget()

    @classmethod
    def of_worker(cls, path_a: str, path_b: str) -> Aligner:
        """The one of this Python worker, which outlives a task."""
        holder = sys.modules.setdefault("_tokenizer_aligners", types.ModuleType("_tokenizer_aligners"))
        name = f"{path_a}\n{path_b}"
        if name not in vars(holder):
            setattr(holder, name, cls(path_a, path_b))
        return getattr(holder, name)

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.chars = 0
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, 3), np.int64)
        self.groups: list[str] = []
        self.starts = np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of space and text, by A, and of text by B, which puts the space itself."""
        a, b = [], []
        for at in range(0, len(texts), ENCODE_SEGMENTS):
            few = texts[at:at + ENCODE_SEGMENTS]
            a += [e.ids for e in self.a.encode_batch_fast([f" {t}" for t in few], add_special_tokens=False)]
            b += self.b.encode(few, num_threads=1)
        return a, b

    def segments(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        return _CUT.split(text) if _UNCUT.search(text) or text[:1] == " " else text.split(" ")

    def spelled(self, text: str, a: list[int], b: list[int]) -> bool:
        want = f" {text}".encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == want and b"".join(map(self.bytes_b.__getitem__, b)) == want

    def learn(self) -> None:
        """Aligns the segments that are new, all at once."""
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        self.chars += sum(map(len, new))
        a, b = self.encode(new)
        good = np.array([self.spelled(*x) for x in zip(new, a, b, strict=True)])
        a = [x if g else [] for x, g in zip(a, good, strict=True)]
        b = [x if g else [] for x, g in zip(b, good, strict=True)]
        flat_a, flat_b = (np.array([i for x in ids for i in x], np.int64) for ids in (a, b))
        group_a, group_b, _, left, right = coalesce(self.len_a[flat_a], self.len_b[flat_b])
        together = np.cumsum(self.len_a[flat_a])[left] == np.cumsum(self.len_b[flat_b])[right]
        left, right = left[together], right[together]
        na, nb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        owner = np.repeat(np.arange(len(new)), na)
        n_links = np.bincount(owner[left], minlength=len(new))
        last = np.append(group_a, -1)[np.cumsum(na) - 1]
        n_groups = np.where(na > 0, last - np.append(group_a, 0)[np.cumsum(na) - na] + 1, 0)
        self.good = np.concatenate([self.good, good])
        self.counts = np.concatenate([self.counts, np.stack([na, nb, n_groups], axis=1)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(n_links)])
        self.links = np.concatenate([self.links, flat_a[left] + (flat_b[right] << B_SHIFT)])
        self.groups += self._named(flat_a, group_a, flat_b, group_b, n_groups)

    @staticmethod
    def _named(flat_a: np.ndarray, group_a: np.ndarray, flat_b: np.ndarray, group_b: np.ndarray, n_groups: np.ndarray) -> list[str]:
        """Per segment its groups as text: ids of A, a bar, ids of B; semicolons between groups."""
        def joined(ids: np.ndarray, group: np.ndarray) -> list[str]:
            cuts = np.cumsum(np.bincount(group, minlength=int(n_groups.sum()))).tolist()
            names = list(map(str, ids.tolist()))
            return [",".join(names[i:j]) for i, j in zip([0, *cuts], cuts, strict=False)]
        both = [f"{x}|{y}" for x, y in zip(joined(flat_a, group_a), joined(flat_b, group_b), strict=True)]
        cuts = np.cumsum(n_groups).tolist()
        return [";".join(both[i:j]) for i, j in zip([0, *cuts], cuts, strict=False)]

    def number(self, texts: list[str | None]) -> list[np.ndarray]:
        """The segments of each text by number; a text that the tokenizers do not spell has none."""
        if len(self.numbers) > CACHE_SEGMENTS or self.chars > CACHE_CHARS:
            self.forget()
        get = self.numbers.__getitem__
        numbers = [np.fromiter(map(get, self.segments(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        self.learn()
        bad = [k for k, n in enumerate(numbers) if len(n) > 1 and not self.good[n].all()]
        for k in bad:
            numbers[k] = np.array([get(texts[k])])
        self.learn()
        return [n if self.good[n].all() else n[:0] for n in numbers]


def _take(starts: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of several rows of a ragged array side by side, and how many each has."""
    n = starts[rows + 1] - starts[rows]
    return values[np.repeat(starts[rows] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))], n


def _press(values: np.ndarray) -> bytes:
    return len(values).to_bytes(8, "little") + (pa.Codec("zstd").compress(values.astype(np.uint32).tobytes(), asbytes=True) if len(values) else b"")


def _open(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * 4, asbytes=True), np.uint32).astype(np.int64) if n else np.zeros(0, np.int64)


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, a_ids, b_ids, a_group, b_group (the group of each token, from 0), group_ends (bytes of
    space and text), overlaps (pairs of token numbers, from 0, whose bytes overlap).

    Texts null, empty, or not spelled by both tokenizers have empty lists. Each text is encoded whole, so one very long text is
    held by one worker. Rows that repeat give a row each; an empty table gives none. Other columns of docs, whatever their
    names, are not read.
    """
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *[T.StructField(n, ints) for n in ("a_ids", "b_ids", "a_group", "b_group")],
                           T.StructField("group_ends", longs), T.StructField("overlaps", T.ArrayType(ints))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(path_a, path_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for t in texts:
                (a,), (b,) = aligner.encode([t]) if t else ([[]], [[]])
                if not t or not aligner.spelled(t, a, b):
                    a = b = []
                ga, gb, ends, left, right = coalesce(aligner.len_a[np.array(a, np.int64)], aligner.len_b[np.array(b, np.int64)])
                out.append((a, b, ga.tolist(), gb.tolist(), ends.tolist(), np.stack([left, right], axis=1).tolist()))
            columns = [batch.column("doc_id"), *[pa.array(c) for c in (zip(*out, strict=True) if out else [[]] * 6)]]
            wanted = pa.schema([batch.schema.field("doc_id"), *[(n, pa.list_(pa.int32())) for n in ("a_ids", "b_ids", "a_group", "b_group")],
                                ("group_ends", pa.list_(pa.int64())), ("overlaps", pa.list_(pa.list_(pa.int32())))])
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _batches(docs: DataFrame, path_a: str, path_b: str, doc_id: str, text: str) -> DataFrame:
    """Batches of aligned documents: counts and hashes per document, the distinct pairs of the batch and which each link has."""
    kind = docs.schema[doc_id].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("batch", T.StringType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("n_a", longs), T.StructField("n_b", longs),
                           T.StructField("n_groups", longs), T.StructField("n_links", longs), T.StructField("hashes", T.ArrayType(T.StringType())),
                           T.StructField("pairs", longs), T.StructField("times", longs), T.StructField("links", T.BinaryType())])

    def build(ids: list[pa.Array], counts: list[np.ndarray], hashes: list[str], links: list[np.ndarray]) -> pa.RecordBatch:
        pairs, place, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        of = lambda values: pa.array([values], pa.list_(pa.int64()))
        all_ids, table = pa.concat_arrays(ids), np.concatenate(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([str(uuid.uuid4())]), pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), all_ids), *[of(table[:, k]) for k in range(4)],
             pa.array([hashes], pa.list_(pa.string())), of(pairs), of(times), pa.array([_press(place)])], names=[f.name for f in schema])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(path_a, path_b)
        held: tuple[list, list, list, list] = ([], [], [], [])
        size = 0
        for batch in rows:
            texts = batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                # No more texts at a time than a batch has room for, as their characters tell.
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars < BATCH_TOKENS):
                    chars += len(texts[upto] or "")
                    upto += 1
                numbers = aligner.number(texts[at:upto])
                lengths = np.array([len(n) for n in numbers], np.int64)
                flat = np.concatenate(numbers)
                owner = np.repeat(np.arange(len(numbers)), lengths)
                links, each = _take(aligner.starts, aligner.links, flat)
                sums = [np.bincount(owner, weights=w, minlength=len(numbers)).astype(np.int64) for w in (*aligner.counts[flat].T, each)]
                held[0].append(batch.column("doc_id").slice(at, upto - at))
                held[1].append(np.stack(sums, axis=1))
                held[2].extend(hashlib.sha256(";".join(map(aligner.groups.__getitem__, n.tolist())).encode()).hexdigest() if len(n) else "" for n in numbers)
                held[3].append(links)
                size += int(sums[0].sum()) + len(numbers)
                at = upto
                if size >= BATCH_TOKENS:
                    yield build(*held)
                    held, size = ([], [], [], []), 0
        if held[0]:
            yield build(*held)

    return written(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Counts of id pairs (code, n) over all rows of (code, times), and whether each is its B id's highest.

    A B id has no more partners than A has ids, so the second aggregate's groups are bounded by the vocabulary.
    """
    counts = pairs.groupBy("code").agg(F.sum("times").alias("n"))
    b = F.shiftright("code", B_SHIFT)
    best = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(best, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def summarize(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of overlapping tokens that end together. Its pair of ids counts once for every link of the corpus that
    has it; ``n_best`` counts links whose pair no other pair of their B id exceeds, ``count_sum`` adds their pairs' counts up.
    Texts null, empty, or not spelled by both tokenizers have zeros and an empty string. Rows that repeat count, and give a
    row, each; an empty table gives none; ties are all highest. Other columns of docs are not read.
    """
    batches = _batches(docs, path_a, path_b, doc_id, text)
    sent = written(batches.select("batch", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "code"}))
    given = sent.select("batch", "code").join(written(pair_counts(sent)), "code")

    def add(batch: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        row = batch.iloc[0]
        order = np.argsort(counts.code.to_numpy())
        n, best = counts.n.to_numpy()[order], counts.best.to_numpy()[order].astype(np.int64)
        place, lengths = _open(row.links), np.array(row.n_links, np.int64)
        ends = np.cumsum(lengths)
        total = lambda of: np.diff(np.concatenate([[0], np.cumsum(of[place])])[ends], prepend=0) if len(place) else 0 * lengths
        return pd.DataFrame({"doc_id": list(row.ids), "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": lengths,
                             "n_best": total(best), "count_sum": total(n), "groups_sha256": list(row.hashes)})

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *[T.StructField(c, T.LongType()) for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], T.StructField("groups_sha256", T.StringType())])
    return batches.drop("pairs", "times").groupBy("batch").cogroup(given.groupBy("batch")).applyInPandas(add, schema)
