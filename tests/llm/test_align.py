"""Token alignment against a plain version that walks each pair of tokenizations."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tidelog.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = " \n\t.,!?'abcde  éß漢😀　 ​\x1c\x85▁"


def texts():
    r = random.Random(3)
    yield from [None, "", " ", "a▁b", "  lead  two\n three \n four.\nNext <|endoftext|> <s> x", "naïve ​ zwj  nb 漢字かな 😀 é", "x" * 5000,
                "tab\t y", "hello world ", "hello world ", "ﬁ ligature 　 wide   sp", "a᠎ b﻿ c", "word " * 20_000]
    for _ in range(300):
        yield "".join(r.choice(LETTERS) for _ in range(r.randint(0, 60)))


def plain(rows):
    """Rows of the query, worked out one text at a time from the two whole token lists."""
    tokenizer, bytes_a = align.byte_tokens(A)
    pieces, bytes_b = align.piece_tokens(B)
    counts, each = collections.Counter(), []
    for i, text in rows:
        a = tokenizer.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if not text or any(b"".join(map(e.__getitem__, ids)) != f" {text}".encode() for e, ids in ((bytes_a, a), (bytes_b, b))):
            each.append((i, 0, 0, 0, [], ""))
            continue
        ends_a = np.cumsum([len(bytes_a[k]) for k in a]).tolist()
        ends_b = np.cumsum([len(bytes_b[k]) for k in b]).tolist()
        groups, links, left, right = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            upto_a, upto_b = ends_a.index(end, left) + 1, ends_b.index(end, right) + 1
            groups.append(",".join(map(str, a[left:upto_a])) + "|" + ",".join(map(str, b[right:upto_b])))
            links.append((a[upto_a - 1], b[upto_b - 1]))
            left, right = upto_a, upto_b
        counts.update(links)
        each.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(i, na, nb, ng, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), h) for i, na, nb, ng, links, h in each]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.fixture(scope="module")
def rows(spark, smallest):
    given = spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "text").collect()
    made = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts())]
    return made + [(10_000 + r.doc_id, r.text) for r in given]


def test_summary_equals_the_plain_version(docs_of, rows):
    got = [tuple(r) for r in align.summarize(docs_of(rows, extra="links").repartition(7), A, B).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_small_batches_and_a_full_cache_change_nothing(docs_of, rows, monkeypatch):
    monkeypatch.setattr(align, "BATCH_TOKENS", 900)
    monkeypatch.setattr(align, "CACHE_SEGMENTS", 50)
    got = [tuple(r) for r in align.summarize(docs_of(rows[:200], extra="batch").repartition(3), A, B).collect()]
    assert sorted(got, key=key) == sorted(plain(rows[:200]), key=key)


def test_groups_and_overlaps(docs_of):
    out = {r.doc_id: r for r in align.align(docs_of([(1, "strawberry jam"), (2, None), (3, "a▁b")], extra="a_ids"), A, B).collect()}
    assert out[2].a_ids == out[3].a_ids == out[2].overlaps == []
    one = out[1]
    assert one.group_ends[-1] == len(" strawberry jam") and one.a_group[-1] == one.b_group[-1] == len(one.group_ends) - 1
    assert all(one.a_group[a] == one.b_group[b] for a, b in one.overlaps)
    assert {a for a, _ in one.overlaps} == set(range(len(one.a_ids))) and {b for _, b in one.overlaps} == set(range(len(one.b_ids)))


def test_coalesce_by_hand():
    # Tokens of A: ab c de; of B: a bc de. They end together behind c and behind e.
    group_a, group_b, ends, left, right = align.coalesce(np.array([2, 1, 2]), np.array([1, 2, 2]))
    assert group_a.tolist() == [0, 0, 1] and group_b.tolist() == [0, 0, 1] and ends.tolist() == [3, 5]
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2)]
    assert all(len(x) == 0 for x in align.coalesce(np.zeros(0, np.int64), np.zeros(0, np.int64)))


def test_empty_table(docs_of):
    nothing = docs_of([(1, "a")]).limit(0)
    assert align.summarize(nothing, A, B).count() == 0 and align.align(nothing, A, B).count() == 0
