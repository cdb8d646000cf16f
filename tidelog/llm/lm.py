"""Language-model scores by deleted interpolation.

The probability of a token mixes its maximum-likelihood estimates after the one token before it, alone, and uniformly. The
mixture weights depend on how often the context was seen, in buckets of powers of two, and are learned by expectation-
maximisation on held-out counts: the tokens of a tuning fold, each with its own occurrence deleted from the counts.

Documents are put into batches of tokens, dictionary-coded and written once. A batch asks the count shards for its
distinct n-grams (sorted, as compressed differences); a shard adds up what all batches hold and answers each batch in the
order it asked, so an answer carries counts alone. Batches and shards are bounded, and the number of shards follows the
number of tokens.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import lower_ascii, space_words, written

BATCH_TOKENS = 2_000_000
SHARD_TOKENS = 2_000_000
#: Codes and tokens that are worked on at a time, so that the temporary arrays stay small beside what is held.
STEP = 250_000
BUCKETS, BINS, STEPS = 48, 96, 2
#: Codes of token pairs have so many bits more than the logarithm of the number of tokens.
SPARE_BITS = 24
#: No text holds a word with a space, so no word has this code but by chance.
END = " end"


def _press(values: np.ndarray) -> bytes:
    """Like bytes of all values side by side, compressed."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes()
    return raw.dtype.str.encode() + len(raw).to_bytes(8, "little") + (pa.Codec("zstd").compress(planes, asbytes=True) if planes else b"")


def _open(data: bytes) -> np.ndarray:
    dtype, n = np.dtype(data[:3].decode()), int.from_bytes(data[3:11], "little")
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[11:], n * dtype.itemsize, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).ravel()


def _press_sorted(codes: np.ndarray) -> bytes:
    return _press(np.diff(codes, prepend=np.uint64(0)).astype(np.uint64))


def _pairs(words: np.ndarray, index: np.ndarray, starts: np.ndarray, end: int, bits: int) -> np.ndarray:
    """A code for each token with the one before it; a document begins after an end."""
    code = words[index]
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[starts] = np.uint64(end)
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (code + np.uint64(0x7F4A7C15))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed >> np.uint64(64 - bits)


def _batches(docs: DataFrame, doc_id: str, text: str, held_out: Column, tuning: Column) -> DataFrame:
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("batch", T.StringType()), T.StructField("fold", T.IntegerType()), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("held_out", T.ArrayType(T.BooleanType())), T.StructField("n", T.LongType()),
        T.StructField("lengths", T.BinaryType()), T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType())])
    words = F.transform(space_words(lower_ascii(F.coalesce(F.col(text), F.lit("")))), lambda w: F.xxhash64(w))
    fold = F.when(held_out, 2).when(tuning, 1).otherwise(0)
    rows = docs.select(F.col(doc_id).alias("id"), fold.alias("fold"), F.concat(words, F.array(F.xxhash64(F.lit(END)))).alias("w"))

    def build(fold: int, parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids = pa.concat_arrays([p[0] for p in parts])
        lengths = np.concatenate([p[1] for p in parts])
        codes, index = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        values = [str(uuid.uuid4()), fold, None, [fold == 2] * len(ids), len(index), _press(lengths.astype(np.uint32)), _press_sorted(codes), _press(index.astype(np.uint32))]
        columns = [pa.array([v]) for v in values[:2]] + [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)] + [pa.array([v]) for v in values[3:]]
        columns[1] = columns[1].cast(pa.int32())
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [], 1: [], 2: []}
        size = {0: 0, 1: 0, 2: 0}
        for batch in batches:
            column = batch.column("w")
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy().view(np.uint64)
            folds = batch.column("fold").to_numpy()
            for fold in range(3):
                rows = np.flatnonzero(folds == fold)
                at = 0
                while at < len(rows):
                    total = np.cumsum(ends[rows[at:] + 1] - ends[rows[at:]]) + size[fold]
                    take = rows[at:at + max(1, int(np.searchsorted(total, BATCH_TOKENS)))]
                    held[fold].append((batch.column("id").take(pa.array(take)), ends[take + 1] - ends[take], np.concatenate([flat[ends[r]:ends[r + 1]] for r in take])))
                    size[fold] += len(held[fold][-1][2])
                    at += len(take)
                    if size[fold] >= BATCH_TOKENS or at < len(rows):
                        yield build(fold, held[fold])
                        held[fold], size[fold] = [], 0
        for fold, parts in held.items():
            if parts:
                yield build(fold, parts)

    return written(rows.mapInArrow(code, schema))


def _requests(batches: DataFrame, shards: int, bits: int, end: int) -> DataFrame:
    """Rows (kind, shard, batch, codes, counts): what a batch holds of a shard's n-grams, and how often where it trains."""
    schema = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("batch", pa.string()), ("codes", pa.binary()), ("counts", pa.binary())])

    def ask(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for row in table.to_pylist():
                words = np.cumsum(_open(row["words"]), dtype=np.uint64)
                index, lengths = _open(row["tokens"]), _open(row["lengths"]).astype(np.int64)
                rows = []
                pair = _pairs(words, index, np.cumsum(lengths) - lengths, end, bits)
                for kind, codes, counts, width in ((1, words, np.bincount(index, minlength=len(words)), 64), (2, *np.unique(pair, return_counts=True), bits)):
                    if row["fold"] == 2:
                        counts = np.zeros_like(counts)
                    edges = np.arange(1, shards, dtype=np.uint64) * np.uint64((1 << width) // shards)
                    cuts = [0, *np.searchsorted(codes, edges).tolist(), len(codes)]
                    for shard, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        if b > a:
                            rows.append((kind, shard, row["batch"], _press_sorted(codes[a:b]), _press(counts[a:b].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return batches.select("batch", "fold", "lengths", "words", "tokens").mapInArrow(ask, "kind int, shard int, batch string, codes binary, counts binary")


def _cuts(sorted_codes: list[np.ndarray]) -> list[list[int]]:
    """Places in each array, from its begin to its end, between which all arrays together hold about ``STEP`` codes."""
    pieces = max(1, -(-sum(map(len, sorted_codes)) // STEP))
    # Codes are hashes, so a sample of the largest array parts them all alike.
    longest = max(sorted_codes, key=len)
    edges = longest[np.arange(1, pieces) * len(longest) // pieces]
    inner = [np.searchsorted(x, edges).tolist() for x in sorted_codes]
    return [[0] * len(inner), *map(list, zip(*inner, strict=True)), [len(x) for x in sorted_codes]]


def _answers(requests: DataFrame) -> DataFrame:
    """Rows (kind, shard, batch, counts), and one per shard without a batch: its distinct trained n-grams and their total."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = [np.cumsum(_open(x), dtype=np.uint64) for x in rows.codes]
        held = [_open(x) for x in rows.counts]
        # Equal codes of all batches lie between the same cuts; what a batch held gives way to the answer.
        cuts = _cuts(asked)
        total = [np.empty(len(x), np.uint64) for x in asked]
        types = tokens = 0
        for at, upto in zip(cuts[:-1], cuts[1:], strict=True):
            codes, place = np.unique(np.concatenate([x[a:b] for x, a, b in zip(asked, at, upto, strict=True)]), return_inverse=True)
            counts = np.concatenate([x[a:b] for x, a, b in zip(held, at, upto, strict=True)]).astype(np.float64)
            sums = np.bincount(place, weights=counts, minlength=len(codes)).astype(np.uint64)
            types, tokens = types + int((sums > 0).sum()), tokens + int(sums.sum())
            begin = 0
            for x, a, b in zip(total, at, upto, strict=True):
                x[a:b] = sums[place[begin:begin + b - a]]
                begin += b - a
        del asked, held
        answers = []
        for i, x in enumerate(total):
            answers.append(_press(x))
            total[i] = None
        out = pd.DataFrame({"batch": rows.batch, "counts": answers, "types": 0, "tokens": 0})
        out.loc[len(out)] = [None, None, types, tokens]
        return out.assign(kind=key[0], shard=key[1])[["kind", "shard", "batch", "counts", "types", "tokens"]]

    return written(requests.groupBy("kind", "shard").applyInPandas(add, "kind int, shard int, batch string, counts binary, types long, tokens long"))


def _known(row: dict, answers: pd.DataFrame, end: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per token: count of the token, of the one before it, of the pair; and the lengths of the documents.

    Some whole documents at a time, in order: about ``STEP`` tokens, or one longer document.
    """
    words = np.cumsum(_open(row["words"]), dtype=np.uint64)
    index, lengths = _open(row["tokens"]), _open(row["lengths"]).astype(np.int64)
    ends = np.cumsum(lengths)
    answers = answers.sort_values(["kind", "shard"])
    counts = {k: np.concatenate([_open(x) for x in part.counts]) for k, part in answers.groupby("kind")}
    after_end = counts[1][np.searchsorted(words, np.uint64(end))]
    pairs = _pairs(words, index, ends - lengths, end, bits)
    distinct = np.unique(pairs)
    at = 0
    while at < len(lengths):
        begin = int(ends[at] - lengths[at])
        upto = max(at + 1, int(np.searchsorted(ends, begin + STEP, "right")))
        stop = int(ends[upto - 1])
        word = counts[1][index[begin:stop]].astype(np.float64)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[ends[at:upto] - lengths[at:upto] - begin] = after_end
        yield word, before, counts[2][np.searchsorted(distinct, pairs[begin:stop])].astype(np.float64), lengths[at:upto]
        at = upto


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.floor(np.log2(context + 1)).astype(np.int64))


def learn_weights(cells: np.ndarray, counts: np.ndarray, types: int, rounds: int = 40) -> np.ndarray:
    """Weights (pair, word, uniform) by bucket of the context, by expectation-maximisation over binned estimates."""
    weights = np.tile(np.array([0.4, 0.5, 0.1]), (BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    if not len(cells):
        return weights
    bucket, pair, word = cells // (BINS * BINS), cells // BINS % BINS, cells % BINS
    def size(b: np.ndarray) -> np.ndarray:
        return np.where(b == 0, 0.0, np.exp2(-(b - 0.5) / STEPS))
    parts = np.stack([size(pair), size(word), np.full(len(cells), 1 / (types + 1))], axis=1)
    for _ in range(rounds):
        share = weights[bucket] * parts
        share *= (counts / share.sum(axis=1))[:, None]
        total = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1) + np.array([0.0, 0.5, 0.5])
        weights = total / total.sum(axis=1, keepdims=True)
    pooled = total.sum(axis=0) / total.sum()
    seen = np.bincount(bucket, counts, BUCKETS) > 0
    weights[~seen & (np.arange(BUCKETS) > 0)] = pooled
    weights = np.maximum(weights, [0.0, 1e-6, 1e-6])
    return weights / weights.sum(axis=1, keepdims=True)


def _bins(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.floor(-np.log2(p) * STEPS).astype(np.float64), 0, BINS - 2) + 1, 0).astype(np.int64)


def score(docs: DataFrame, held_out: Column, tuning: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows that are not held out train; those of them where tuning is true give the held-out counts of the weights. Words are
    parted by white space, A-Z in lower case, and an end closes each document, so a null or empty text has one token. A null
    in held_out or tuning counts as false. Rows that repeat train and score each by themselves. Without training rows the
    model is uniform over nothing but unknown tokens.
    """
    spark = docs.sparkSession
    batches = _batches(docs, doc_id, text, held_out, tuning)
    total = batches.agg(F.sum("n")).first()[0] or 0
    shards = 64
    while shards * SHARD_TOKENS < total:
        shards *= 2
    bits = min(64, SPARE_BITS + max(1, total).bit_length())
    end = int(spark.range(1).select(F.xxhash64(F.lit(END))).first()[0]) & ((1 << 64) - 1)
    answers = _answers(_requests(batches, shards, bits, end))
    summary = {r.kind: r for r in answers.where("batch is null").groupBy("kind").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).collect()}
    types, tokens = (summary[1].types, summary[1].tokens) if summary else (0, 0)
    given = answers.where("batch is not null").select("kind", "shard", "batch", "counts")

    def joined(rows: DataFrame, answer: DataFrame, act, schema) -> DataFrame:
        return rows.groupBy("batch").cogroup(answer.groupBy("batch")).applyInPandas(act, schema)

    def held_out_counts(batch: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        found = []
        for word, before, pair, _ in _known(batch.iloc[0].to_dict(), answer, end, bits):
            context = before - 1
            with np.errstate(divide="ignore", invalid="ignore"):
                after = np.where(context > 0, (pair - 1) / context, 0)
            cells = (_bucket(context) * BINS + _bins(after)) * BINS + _bins((word - 1) / max(1, tokens - 1))
            found.append(pd.DataFrame(dict(zip(("cell", "n"), np.unique(cells, return_counts=True), strict=True))))
        return pd.concat(found).groupby("cell", as_index=False).n.sum()

    tune = batches.where("fold = 1").select("batch", "lengths", "words", "tokens")
    cells = joined(tune, given.join(tune.select("batch"), "batch", "left_semi"), held_out_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights(cells.cell.to_numpy(np.int64), cells.n.to_numpy(np.float64), types)

    def scores(batch: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row = batch.iloc[0]
        parts = []
        for word, before, pair, lengths in _known(row.to_dict(), answer, end, bits):
            starts = np.cumsum(lengths) - lengths
            mix = weights[_bucket(before)]
            p = mix[:, 0] * np.where(before > 0, pair / np.maximum(before, 1), 0) + mix[:, 1] * (word / max(1, tokens)) + mix[:, 2] / (types + 1)
            parts.append(pd.DataFrame({
                "n_tokens": lengths, "n_known": np.add.reduceat((word > 0).astype(np.int64), starts), "train_tokens": tokens,
                "base_score": np.add.reduceat(np.log10((word + 1) / (tokens + types + 1)), starts), "score": np.add.reduceat(np.log10(p), starts)}))
        out = pd.concat(parts, ignore_index=True)
        out.insert(0, "doc_id", list(row.ids))
        out.insert(1, "held_out", list(row.held_out))
        return out

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()), *[
        T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")], T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return joined(batches.select("batch", "ids", "held_out", "lengths", "words", "tokens"), given, scores, schema)
