"""Winnowed fingerprints against a plain version that slides a window over each text."""

import base64
import hashlib
import random
import re
import zlib

import pytest

from tidelog.llm import fingerprint as fp

MASK = (1 << 60) - 1
R = random.Random(4)
VOCABULARY = ["".join(R.choice("abcdefgh") for _ in range(6)) for _ in range(2000)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def units(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return [u for w in words for u in (w if len(w) > 24 else [w])] or ([text] if text else [])


def rolled(hashes):
    out = 0
    for h in hashes:
        out = ((out << 1 | out >> 59) & MASK) ^ h
    return out


def plain(text):
    h = [zlib.crc32(u.encode()) << 28 | zlib.crc32(base64.b64encode(u.encode())) >> 4 for u in units(text or "")]
    grams = [rolled(h[i:i + 5]) for i in range(max(1, len(h) - 4))] if h else []
    kept = {}
    for i in range(max(1, len(grams) - 7) if grams else 0):
        window = range(i, min(i + 8, len(grams)))
        at = min(window, key=lambda j: (grams[j] >> 28, -j))
        kept[at] = grams[at]
    return sorted(kept.items())


def alike(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def edited_rows(rows):
    """(doc_id, n_chars, sha256 of the edit, fingerprint, edited fingerprint, near_edited, near_next) of rows whose order is plain."""
    rows = [(i, t or "") for i, t in rows]
    for (i, t), (_, follow) in zip(rows, rows[1:] + rows[:1], strict=True):
        edit = t[:len(t) - len(t) // 4] + follow[:len(t) // 4]
        prints, other = plain(t), plain(edit)
        text = [",".join(f"{p}:{h:x}" for p, h in x) for x in (prints, other)]
        sets = [{h for _, h in x} for x in (prints, other, plain(follow))]
        yield i, len(t), hashlib.sha256(edit.encode()).hexdigest(), *text, alike(sets[0], sets[1]), alike(sets[0], sets[2])


ODD = [None, "", " ", "?!", "one", "One two", "a b c d e", "a b c d e f", "same " * 300, "漢字" * 40 + " " + "かな" * 3, "x" * 30_000, "😀 é " * 50,
       "UPPER lower MiXed", prose(4, 1), prose(12, 2), prose(13, 3), prose(400, 4), prose(40_000, 5), "line\nline\r\nline\tend", "  sep\u0085x"]


def test_prints_equal_the_plain_version(docs_of):
    out = fp.fingerprints(docs_of([*enumerate(ODD), (None, "a b"), (3, "?!")], extra="prints"))
    assert out.columns == ["doc_id", "n_chars", "prints"]
    rows = out.collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = ODD[r.doc_id] if r.doc_id is not None else "a b"
        assert [(p.pos, p.hash) for p in r.prints] == plain(text) and r.n_chars == len(text or "")


def test_a_shared_passage_shares_a_hash(docs_of):
    """Any twelve units in a row: five of a hash and eight hashes of a window less one."""
    passage = prose(12, 77)
    rows = [(i, f"{prose(i % 9, i)} {passage} {prose(i % 7, 100 + i)}") for i in range(60)]
    kept = fp.passages(fp.fingerprints(docs_of(rows)))
    own = {(r.doc_id, r.hash) for r in kept.collect()}
    sets = [{h for d, h in own if d == i} for i in range(60)]
    assert all(a & b for a in sets for b in sets)


@pytest.mark.parametrize("ids", [range(len(ODD)), [10**12 * i - 5 for i in range(len(ODD))]])
def test_near_edits(docs_of, monkeypatch, ids):
    """Dense and sparse ids, in one chunk and in many; a null id comes first."""
    monkeypatch.setattr(fp, "ORDERED_ROWS", 3)
    rows = [(None, prose(50, 8)), *zip(ids, ODD, strict=True)]
    out = fp.near_edits(docs_of(rows, extra="edited"))
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(edited_rows(rows), key=key)


def test_repeated_rows_are_one_document(docs_of):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    got = [tuple(r) for r in fp.near_edits(docs_of([(1, a), (2, b), (1, a), (3, c)])).collect()]
    assert sorted(got) == sorted([r for r in edited_rows([(1, a), (2, b), (3, c)])] + [next(edited_rows([(1, a), (2, b), (3, c)]))])
    shared = [tuple(r) for r in fp.near_edits(docs_of([(1, a), (1, b)])).collect()]
    assert len(shared) == 2 and all(r[-1] == 0.0 and r[-2] > 0.3 for r in shared)


def test_lone_document_and_empty_table(docs_of):
    text = prose(100, 6)
    assert [tuple(r) for r in fp.near_edits(docs_of([(4, text)])).collect()] == list(edited_rows([(4, text)]))
    nothing = docs_of([(1, "a")]).limit(0)
    assert fp.near_edits(nothing).count() == 0 and fp.fingerprints(nothing).count() == 0
