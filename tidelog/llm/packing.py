"""Best-fit packing of tokenized documents into sequences, as hierarchical residual packing.

Documents are tokenized once and cut into pieces of at most the sequence's length. Pieces are dealt over bounded groups;
each group packs its own best-fit, longest first. Bins that are nearly full, or that no remaining bin is small enough to
join, are done; the underfull ones are the items of the next, wider round, until one group holds what is left or nothing
merges any more. A round writes where each item went; places add up along the rounds.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import written

#: Items that one task packs at a time.
GROUP_ITEMS = 50_000
#: A bin with no more free tokens than this is done.
NEARLY_FULL = 8
#: Word forms, and pieces of words, whose ids a Python worker remembers.
CACHE_WORDS = 1_000_000
#: Marks that may close a word.
MARKS = ".,;:!?"
#: White space that libraries read differently, and the start of special tokens: such texts are encoded as they are.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|<\\|")


class WordEncoder:
    """Ids of texts under a tokenizer that drops white space, through a bounded cache of word forms.

    New forms go through the tokenizer's own normalizer, pre-tokenizer and model, many at a time. Words of common
    letters, with or without closing marks, skip the first two: what these make of each letter is asked once, and whether
    they leave runs of such letters whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = self._common_letters()
        self.table = str.maketrans(self.letters)
        self.marks: dict[str, bytes] = {"": b""}

    def _steps(self, text: str) -> list[str]:
        text = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)] if self.tokenizer.pre_tokenizer else [text]

    def _common_letters(self) -> dict[str, str]:
        """Lower-case letters and the model's spelling of each; none if runs of them, or marks behind them, are not kept apart."""
        steps = {c: self._steps(c) for c in map(chr, range(0x41, 0x180)) if c.isalpha()}
        letters = {c: p[0] for c, p in steps.items() if len(p) == 1 and c == c.lower()}
        letters = {c: p for c, p in letters.items() if len(c.upper()) > 1 or c.upper().lower() != c or steps.get(c.upper(), [p]) == [p]}
        run = "".join(letters)
        whole = "".join(letters.values())
        apart = all(self._steps(f"{run}{m}") == [whole, *self._steps(m)] for m in MARKS)
        return letters if self._steps(run) == [whole] and apart else {}

    @classmethod
    def of_worker(cls, path: str) -> WordEncoder:
        """The one of this Python worker, which outlives a task."""
        holder = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
        if path not in vars(holder):
            setattr(holder, path, cls(path))
        return getattr(holder, path)

    def _learn(self, words: list[str]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        rest, known = [], self.letters.keys()
        for w in words:
            core = w.rstrip(MARKS)
            low = core.lower()
            if not core or not known >= set(low):
                rest.append(w)
                continue
            ids = self.pieces.get(low)
            if ids is None:
                ids = self.pieces[low] = self._ids(low.translate(self.table))
            if low == w:
                self.words[w] = ids
                continue
            end = w[len(core):]
            if end not in self.marks:
                self.marks[end] = self.whole(end)
            self.words[w] = ids + self.marks[end]
        if rest:
            self._learn_others(rest)

    def _ids(self, piece: str) -> bytes:
        return pack_ids([t.id for t in self.model.tokenize(piece)])

    def _learn_others(self, words: list[str]) -> None:
        joined = self.tokenizer.normalizer.normalize_str(" ".join(words)) if self.tokenizer.normalizer else " ".join(words)
        spans = [len(x) for x in joined.split(" ")]
        if len(spans) != len(words):
            for w in words:
                self.words[w] = self.whole(w)
            return
        out: list[list[bytes]] = [[] for _ in words]
        word, end = 0, spans[0]
        for piece, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(joined):
            while start >= end and word + 1 < len(words):
                word += 1
                end += 1 + spans[word]
            out[word].append(self._ids(piece))
        for w, parts in zip(words, out, strict=True):
            self.words[w] = b"".join(parts)

    def whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        split = [None if _is_odd(t) else t.split() for t in texts]
        new = list(set().union(*(x for x in split if x)).difference(self.words))
        for b in range(0, len(new), 20_000):
            self._learn(new[b:b + 20_000])
        return [self.whole(text) if words is None else self._joined(words) for words, text in zip(split, texts, strict=True)]

    def _joined(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:  # the cache was cleared on the way
            missing = list(set(words).difference(self.words))
            for b in range(0, len(missing), 20_000):
                self._learn(missing[b:b + 20_000])
            return b"".join([self.words[w] if w in self.words else self.whole(w) for w in words])


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _is_odd(text: str) -> bool:
    if text.isascii():
        return "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f")
    return _ODD.search(text) is not None


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int, doc_id: str = "doc_id", text: str = "text", drops_space: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each document's ids and an end id, cut at length."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()), *[
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]])
    end = np.array([end_id], np.uint32).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of_worker(tokenizer)
        for batch in batches:
            rows: list[int] = []
            out: list[tuple] = []
            for a in range(0, batch.num_rows, 200):
                texts = batch.column("text").slice(a, 200).to_pylist()
                for k, ids in enumerate(encoder.batch(texts) if drops_space else map(encoder.whole, texts)):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * length)):
                        rows.append(a + k)
                        out.append((n, at // 4, len(ids[at:at + 4 * length]) // 4, zlib.crc32(ids[at:at + 4 * length])))
            columns = [np.array(c, np.int64) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(columns[0].astype(np.int32)), *map(pa.array, columns[1:])], names=[f.name for f in schema])

    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit decreasing: per item its bin and its offset, and the filled size of each bin."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    free: dict[int, list[int]] = {}
    mask = 0  # bit f is set where a bin has f tokens free
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        above = mask >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            room, at = length, len(filled)
            filled.append(0)
        bins[i], offsets[i] = at, filled[at]
        filled[at] += size
        left = room - size
        if left:
            free.setdefault(left, []).append(at)
            mask |= 1 << left
    return bins, offsets, np.array(filled, np.int64)


def _round(items: DataFrame, number: int, groups: int, length: int) -> DataFrame:
    """Rows (node, parent, at, total): the bin that each item of a round went to, its place there, the bin's filled size."""
    dealt = items.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(groups)))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "node"])
        bins, offsets, filled = best_fit(rows.length.to_numpy(), length)
        return pd.DataFrame({"node": rows.node, "parent": -1 - ((number << 56) + (key[0] << 28) + bins), "at": offsets, "total": filled[bins]})

    return written(dealt.groupBy("part").applyInPandas(pack, "node long, parent long, at long, total long"))


def pack(cut: DataFrame, length: int) -> DataFrame:
    """Adds sequence_id and offset to rows that have a length of 1 to length. No row is dropped or cut; repeated rows each
    get a place. An empty table gives an empty one."""
    placed = written(cut.withColumn("__node", F.monotonically_increasing_id()))
    items = placed.where(F.col("length") < length).select(F.col("__node").alias("node"), "length")
    rounds: list[DataFrame] = []
    left, before = items.count(), None
    groups = max(1, -(-left // GROUP_ITEMS))
    while left:
        out = _round(items, len(rounds), groups, length)
        rounds.append(out)
        if groups == 1 or (before is not None and left * 10 > before * 9):
            break
        before = left
        bins = out.select(F.col("parent").alias("node"), F.col("total").alias("length")).distinct()
        least = bins.agg(F.min("length")).first()[0]
        items = bins.where((F.col("length") < length - NEARLY_FULL) & (F.col("length") + F.lit(least) <= length))
        left = items.count()
        groups = max(1, -(-left // GROUP_ITEMS))
    result = placed.withColumns({"sequence_id": F.col("__node"), "offset": F.lit(0).cast("long")})
    for out in rounds:
        out = out.select(F.col("node").alias("sequence_id"), "parent", "at")
        result = result.join(out, "sequence_id", "left").withColumns({
            "sequence_id": F.coalesce("parent", "sequence_id"), "offset": F.col("offset") + F.coalesce("at", F.lit(0))}).drop("parent", "at")
    return result.drop("__node").select(*cut.columns, "sequence_id", "offset")
