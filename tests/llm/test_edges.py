"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for each operator."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidelog.llm import extract, langid, lm, ngram_join, packing, pii, quality, urls
from tidelog.llm.decontaminate import decontaminate
from tidelog.llm.linededup import CuckooFilter, LineDedup
from tidelog.llm.ngram_join import near_duplicates, one_of_each

random.seed(5)
WORDS = ["".join(random.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


PASSAGE = prose(40, 9999)
LONG = "\n".join(prose(50, k) for k in range(800))
ROWS = [(1, prose(80, 1)), (1, prose(80, 1)), (2, None), (3, ""), (None, prose(60, 3)), (4, " \n\t\n "), (5, LONG), (6, f"{prose(30, 6)} {PASSAGE.upper()} {prose(30, 7)}"),
        (7, "word"), (8, "word"), (2, "other"), (9, "x" * 200_000), (10, "1 " * 100_000)]


@pytest.fixture(scope="module")
def docs(docs_of):
    return docs_of(ROWS)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def test_decontaminate(spark, docs, nothing):
    items = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (None, "WORD"), (4, "word"), (5, "a b c")], "item_id long, text string")
    out = decontaminate(docs, items)
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in out.collect()]
    assert len(got) == len(ROWS) and set(docs.columns) <= set(out.columns)
    by = {i: (n, hit, ids) for i, n, hit, ids in got if i not in (None, 1, 2)}
    assert by[6] == (100, 40, ["1"]) and by[7] == by[8] == (1, 1, ["4"]) and by[3] == by[4] == (0, 0, [])
    assert by[5] == (40_000, 0, []) and by[10][:2] == (100_000, 0)
    assert [g for g in got if g[0] == 1] == [(1, 80, 0, [])] * 2
    assert decontaminate(nothing, items).count() == 0
    assert {r.n_hit for r in decontaminate(docs, items.limit(0)).collect()} == {0}


def test_near_duplicates(docs, nothing, docs_of):
    got = [(r.doc_id, r.class_id, r.n_links) for r in near_duplicates(docs).collect()]
    assert len(got) == len(ROWS)
    assert [g for g in got if g[0] == 1] == [(1, 1, 1)] * 2
    assert [g for g in got if g[0] in (7, 8)] == [(7, 7, 1), (8, 7, 1)] or [g for g in got if g[0] in (7, 8)] == [(8, 7, 1), (7, 7, 1)]
    assert {g for g in got if g[0] in (3, 4, 5)} == {(3, 3, 0), (4, 4, 0), (5, 5, 0)}
    kept = one_of_each(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted({(i or -1, t or "") for i, t in ROWS if i != 8})
    assert near_duplicates(nothing).count() == one_of_each(nothing).count() == 0


@pytest.mark.parametrize("crowd, sets", [(500, 500), (3, 500), (3, 4), (500, 2)])
def test_near_duplicates_against_all_pairs(docs_of, monkeypatch, crowd, sets):
    """Also with crowds and blocks so small that prefixes grow, more trees are asked and groups go by prefixes or by blocks."""
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    rows, r = [], random.Random(3)
    for k in range(12):
        base = prose(r.choice([30, 200]), 1000 + k).split()
        for c in range(r.choice([1, 4, 30])):
            copy = [w if r.random() > 0.02 else r.choice(WORDS) for w in base]
            rows.append((len(rows), " ".join(copy)))
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    links = {i: {j for j in sets if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    def least(i):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        return min(seen)
    got = {(r.doc_id, r.class_id, r.n_links) for r in near_duplicates(docs_of(rows)).collect()}
    assert got == {(i, least(i), len(links[i])) for i in sets}


def test_trees_reach_the_target():
    for length in range(ngram_join.SHORTEST, ngram_join.DEPTH + 1):
        trees = ngram_join.trees_for(length)
        assert 1 - (1 - 0.8 ** length) ** trees >= ngram_join.TARGET > 1 - (1 - 0.8 ** length) ** (trees - 1)


def test_prefixes_meet_as_often_as_sets_overlap():
    r = np.random.default_rng(5)
    same, pairs = np.zeros(4), 300
    for _ in range(pairs):
        codes = r.integers(0, 1 << 63, 110, dtype=np.uint64)
        a, b = (ngram_join.prefixes(codes[k:k + 100], ngram_join._factors(), 63, range(5, 9)) for k in (0, 10))
        same += (a == b).mean(axis=0)
    similarity = 90 / 110
    assert np.allclose(same / pairs, similarity ** np.arange(5, 9), atol=0.02)


def test_a_chain_goes_by_its_prefixes(spark, docs_of, monkeypatch):
    """20 000 texts, each linked to the next alone: a text is compared under its prefixes, not with every block of the chain."""
    n, sent = 20_000, []
    meetings = ngram_join._meetings
    monkeypatch.setattr(ngram_join, "_meetings", lambda *a: sent.append(meetings(*a)) or sent[-1])
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.col("id"), F.col("id") + 13), lambda k: F.concat(F.lit("w"), k.cast("string"))), " ").alias("text"))
    got = near_duplicates(docs).agg(F.min("class_id"), F.max("class_id"), F.min("n_links"), F.max("n_links"), F.sum("n_links")).first()
    assert tuple(got) == (0, 0, 1, 2, 2 * (n - 1))
    assert sent[0].where("tree >= 0").count() == sent[0].count() < 29 * n


def test_quality(docs, nothing):
    rules = quality.base_rules() + quality.default_rules(["shit"])
    kept = [(r.doc_id, r.keep) for r in quality.cascade(docs, rules, kept="keep").collect()]
    assert len(kept) == len(ROWS)
    assert [k for i, k in kept if i == 1] == [True, True] and not any(k for i, k in kept if i in (2, 3, 4, 7, 8, 9, 10)) and dict(kept)[5]
    assert {r.name for r in quality.order_rules(docs, rules)} == {r.name for r in rules}
    assert quality.cascade(nothing, quality.order_rules(nothing, rules)).count() == 0
    reverse = quality.cascade(docs, rules[::-1], kept="keep").collect()
    assert sorted(map(str, ((r.doc_id, r.keep) for r in reverse))) == sorted(map(str, kept))


def test_repeat_words_by_brute_force(docs_of):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(0, 25)))) for i in range(200)]
    got = {x.doc_id: x.n for x in docs_of(rows).select("doc_id", quality.n_repeat_words(quality.space_words(F.col("text"))).alias("n")).collect()}
    for i, t in rows:
        w = t.split()
        windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        assert got[i] == len({k + x for k, v in enumerate(windows) if windows.count(v) > 1 for x in range(3)})


def test_toxic_words(spark, docs_of):
    rows = [(i, prose(60, 5000 + i) + (" vilewordone, nastything" if i % 4 == 0 else "")) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)] + [(None, 1, 1), (3, 1, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.toxic_words(docs_of(rows), labels) == ["nastything", "vilewordone"]
    assert quality.toxic_words(docs_of(rows), labels.limit(0)) == []


def test_documents_that_share_a_word_teach_apart_and_copies_once(spark, docs_of):
    # "zomlplq" has a smaller MD5 sum than any other word here.
    rows = [(i, "zomlplq " + prose(60, 6000 + i) + (" vilewordone" if i % 4 == 0 else " copiedword" if i == 1 else "")) for i in range(80)]
    least = min((w for _, t in rows for w in t.split()), key=lambda w: hashlib.md5(w.encode()).hexdigest())
    assert least == "zomlplq"
    copies = [(100 + i, rows[1][1]) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0 or i >= 100 or i == 1)) for i, _ in rows + copies], "doc_id long, quality int, toxic int")
    assert quality.toxic_words(docs_of(rows + copies), labels) == ["vilewordone"]


def test_every_word_that_passes_is_learned(spark, docs_of):
    many = [f"z{a}{b}{c}vile" for a in "klmnopqrs" for b in "klmnopqrs" for c in "klmnopqrs"]
    rows = [(i, prose(60, 8000 + i) + (" " + " ".join(many) if i % 4 == 0 else "")) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    assert quality.toxic_words(docs_of(rows), labels) == sorted(many)


def test_toxic_stems_with_many_endings(spark, docs_of):
    # No single word is in five documents; the stem is in all toxic ones of a language with few documents.
    r = random.Random(11)
    def ending():
        return "".join(r.choice("klmnop") for _ in range(6))
    rows = [(i, prose(60, 7000 + i) + "".join(f" vilest{ending()}" for _ in range(8) if i % 20 == 0)) for i in range(800)]
    table = docs_of(rows)
    labels = spark.createDataFrame([(i, 1, int(i % 20 == 0)) for i in range(0, 800, 2)], "doc_id long, quality int, toxic int")
    words, weights = quality.learned(table, labels)
    assert words == [] and "vilest" in weights
    kept = {x.doc_id: x.kept for x in quality.cascade(table, quality.default_rules(words, weights)).collect()}
    assert not any(kept[i] for i in kept if i % 20 == 0) and sum(not kept[i] for i in kept if i % 20) <= 8
    held = docs_of([(1, prose(60, 1) + "".join(f" vilest{ending()}" for _ in range(8))), (2, prose(60, 2)), (3, None), (4, "")])
    assert {x.doc_id: x.kept for x in quality.cascade(held, quality.default_rules([], weights)).collect()}[1] is False
    assert quality.cascade(held, quality.default_rules([], weights)[-1:]).where("kept").count() == 3
    some = {"vile": 1.0, "vilest": 2.0, "vilest ": 3.0, "vileste": 1.5, "\u00e9t\u00e9": 2.5, "abc ": 4.0}
    texts = ["vilest Vilest vilestes vile evile, \u00c9T\u00c9s abc abcd", "abc", "vil", "x-vilely"]
    got = [x.s for x in docs_of(list(enumerate(texts))).orderBy("doc_id").select(quality.toxic_score(F.col("text"), some).alias("s")).collect()]
    assert got == [3.0 + 2.0 + 1.0 + 2.5 + 4.0, 4.0, 0.0, 1.0]
    assert quality.learned(table, labels.limit(0)) == ([], {}) and quality.learned(table, labels.where("toxic = 1")) == ([], {})


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><div id="cookie-notice">We use cookies. Accept all of them now please.</div>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li></ul></nav><article class=post><h1>A&amp;B   story</h1><p>It was a dark&nbsp;and stormy
night.<br>The rain fell in torrents.<p>Short one.</p><section class="comments"><p>Great post! I like this one very much, thanks for posting it.</p></section>
</article><aside>Other things</aside><form><label>Email</label></form><footer>&copy; 2020</footer>"""


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 1), (1, "u", PAGE, 1), (2, "u", None, 1), (None, None, "", 1), (3, "u", "no markup at all, just one plain sentence of text.", 1), (4, "u", "<p" * 50_000, 1),
                                   (5, "u", "<article>" + "<p>One sentence, and a second one.</p>" * 3000, 1), (6, "u", "<b" + '"' * 10_001, 1)], "page_id long, url string, html string, text int")
    got = [(r.page_id, r.text, r.n_chars) for r in extract.extract(pages).collect()]
    want = "A&B story\nIt was a dark and stormy night. The rain fell in torrents.\nShort one."
    assert got[:4] == [(1, want, len(want))] * 2 + [(2, "", 0), (None, "", 0)]
    assert got[4][1] == "no markup at all, just one plain sentence of text." and got[5][1] == "" and got[6][1].count("\n") == 2999
    assert extract.extract(pages.limit(0)).count() == 0


def test_minimum_cut_by_brute_force():
    r = random.Random(8)
    for _ in range(60):
        n = r.randrange(1, 8)
        scores = [r.uniform(-3, 3) for _ in range(n)]
        edges = {(a, b): r.uniform(0, 2) for a in range(n) for b in range(a + 1, n) if r.random() < 0.5}
        def cost(keep, scores=scores, edges=edges):
            return sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(scores, keep, strict=True)) + sum(w for (a, b), w in edges.items() if keep[a] != keep[b])
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(extract.minimum_cut(scores, edges)) == pytest.approx(best)


def test_packing(docs, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.WordEncoder(path)
    texts = [t or "" for _, t in ROWS] + ["It's ÀÉ e\u0301 \u00a0x 3²  <|endoftext|> end", "A-b_c!? DON'T\u2003we'll 12345", "\u0130stanbul \u03a3\u03a3"]
    assert encoder.batch(texts) == [encoder.whole(t) for t in texts]
    out = packing.pack(packing.pieces(docs, path, 512, 1, drops_space=True), 512).toPandas()
    want = []
    for i, t in ROWS:
        ids = np.append(np.frombuffer(encoder.whole(t or ""), np.uint32), np.uint32(1))
        want += [(str(i or ""), n, a, len(ids[a:a + 512]), zlib.crc32(ids[a:a + 512].astype(np.uint32).tobytes())) for n, a in enumerate(range(0, len(ids), 512))]
    got = [("" if r.doc_id != r.doc_id else str(int(r.doc_id)), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(got) == sorted(want)
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 512
    assert out.sequence_id.nunique() <= out.length.sum() / 512 * 1.05 + 1
    assert packing.pack(packing.pieces(nothing, path, 512, 1), 512).count() == 0


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 50)
    r = random.Random(2)
    rows = [(i, r.choice([10, 300, 700, 3000, 4095, 4096])) for i in range(1500)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, length long"), 4096).toPandas()
    assert sorted(zip(out.doc_id, out.length, strict=True)) == rows
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 4096


def test_language(docs, nothing, docs_of):
    rows = [(i, prose(40, i)) for i in range(60)]
    two = docs_of(rows).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.translate("text", "abcde", "äöüßé")).otherwise(F.col("text"))).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") != 1, "bb"))
    net = langid.train(langid.training_sample(two))
    got = langid.predict(two, net).collect()
    assert all(r.lang_pred == ("aa" if r.doc_id % 2 == 0 else "bb") and 0.5 < r.score <= 1 for r in got)
    odd = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, net).collect()]
    assert len(odd) == len(ROWS) and {(p, s) for i, p, s in odd if i in (3, 4, 10)} == {("und", 0.0)}
    assert langid.identify(nothing, F.lit(True)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}


def test_training_texts_are_chosen_once_and_by_language(docs_of, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_DOCS", 20)
    rows = [(i, prose(40, 9000 + i)) for i in range(200)]
    table = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") < 100, "aa").otherwise("bb"))
    copies = table.where("doc_id = 7").crossJoin(table.sparkSession.range(3000)).select(table.columns)
    sample = langid.training_sample(table.unionByName(copies))
    assert sorted(sample) == sorted(langid.training_sample(table))
    assert [sum(lang == x for _, lang in sample) for x in ("aa", "bb")] == [20 * langid.TRAIN_WINDOWS] * 2


def test_language_held_out(spark, smallest):
    from tidelog.llm.queries import op6_language_id

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in op6_language_id(spark, smallest).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 0
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(digits)))) % 10 == 0
            if not (kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "card" and not (13 <= len(digits) <= 19 and luhn) or kind == "phone" and not 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data_in_prose_and_in_hostile_texts(spark, docs_of):
    prose = ["We met at noon. Then we looked at home. Nobody was there.", "Look at example.com for more", "a cat (at) last. It sat at the dot. No"] * 40
    told = ["mail me: jane.doe (at) example (dot) org", "mail me: jane.doe at example dot org", "contact jane.doe[at]example.com"]
    marked = {r.doc_id: r.spans for r in pii.summarize(docs_of(list(enumerate(prose)))).collect()}
    assert set(marked.values()) == {""}
    found = pii.candidates(docs_of(list(enumerate(told))), F.col("doc_id"), "text").where("wide").collect()
    assert {r["key"]: r["m"] for r in found} == {0: "jane.doe (at) example (dot) org", 1: "jane.doe at example dot org", 2: "jane.doe[at]example.com"}
    hostile = [" at" * 340_000, " at a" * 200_000, "a (at) b" * 120_000, "x" * 1_000_000 + " at y dot", "a at b dot " * 90_000]
    began = time.monotonic()
    assert len(pii.candidates(docs_of(list(enumerate(hostile))), F.col("doc_id"), "text").groupBy("key").count().collect()) <= len(hostile)
    assert time.monotonic() - began < 30


def test_personal_data(spark, docs_of, docs, nothing, smallest):
    rows = [(1, "a@b.c_d@e.f x@y@z.w 1.2.3.4.5 001.2.3.256 0000001.2.3.4 é😀 a+b@c-d.co.uk."), (2, "4111 1111 1111 1111 4111-1111-1111-1112 1 - 2 4111  1111 +1 (269) 555-3296 +49 30 123456 7 +1 +123456789."),
            (3, "1 " * 200), (4, "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6"), (5, "999999999999999999999.1.1.1 255.255.255.255 256.1.1.1")]
    r = random.Random(6)
    rows += [(10 + k, "".join(r.choice("aB1234 .-+@()") for _ in range(120))) for k in range(300)]
    rows += [(x.doc_id + 1000, x.text) for x in spark.read.parquet(f"{smallest}/documents.parquet").collect()]
    for x in pii.summarize(docs_of(rows)).collect():
        want = plain_spans(dict(rows)[x.doc_id])
        assert x.base == ",".join(want)
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert set(want) <= set(x.spans.split(",") if x.spans else [])
    assert pii.summarize(docs).count() == len(ROWS) and pii.summarize(nothing).count() == 0
    hard = docs_of([(1, "9" * 300_000), (2, "a." * 100_000 + "@" + "b." * 100_000), (3, "1." * 50_000), (4, "+1" + " " * 100_000 + "2"), (5, "a" * 300_000)])
    assert {x.doc_id: x.n_ip for x in pii.summarize(hard).collect()} == {1: 0, 2: 0, 3: 12_500, 4: 0, 5: 0}


def test_classifier_adds_what_labelers_agree_on(docs_of):
    rows = [(i, f"{prose(20, i)} call me, phone +1 (269) 555-{1000 + i} or") for i in range(300)] + [(1000 + i, f"my phone 1 (269) 555-{1000 + i} is") for i in range(60)]
    rows += [(2000 + i, f"order no. 269-555-{1000 + i} shipped") for i in range(200)]
    got = {r.doc_id: r.spans for r in pii.summarize(docs_of(rows)).collect()}
    assert all(got[i].startswith("phone:") for i in range(300))
    assert sum(bool(got[1000 + i]) for i in range(60)) >= 50 and not any(got[2000 + i] for i in range(200))


def test_urls(spark):
    rows = [(1, "http://a.Example.NET/en/x?y#z", "r"), (1, "http://a.Example.NET/en/x?y#z", "r"), (2, "http://b.net/de/", "r"), (3, "http://net", "r"), (4, None, "r"), (None, "", "r"), (5, "no scheme", "r"),
            (6, "x://example.com/de/#", "r"), (7, "http://notexample.com/de/", "r"), (8, "http://x.org/fr/" + "a" * 100_000, "r"), (9, "http://example.net?/en/", "r"), (10, "a://b://net/", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = [(r.page_id, r.host, r.rule, r.verdict) for r in urls.filter_urls(pages, urls.CONTRACT_RULES).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        *[(1, "a.example.net", "example.net/en/", "allow")] * 2, (2, "b.net", "net/", "block"), (3, "net", None, "allow"), (4, "", None, "allow"), (None, "", None, "allow"), (5, "", None, "allow"),
        (6, "example.com", "example.com/de/", "block"), (7, "notexample.com", None, "allow"), (8, "x.org", "org/fr/", "allow"), (9, "example.net", None, "allow"), (10, "b:", None, "allow")]))
    assert urls.filter_urls(pages.limit(0), urls.CONTRACT_RULES).count() == 0
    tie = urls.filter_urls(pages, [("allow", "net", "/de/"), ("block", "net", "/de/")]).where("page_id = 2").first()
    assert (tie.rule, tie.verdict) == ("net/de/", "block")


def test_line_dedup(spark, docs, nothing, docs_of):
    common = [(100 + i, f"Same Line \n{prose(5, i)}\n\tsame line") for i in range(10)]
    nine = [(200 + i, f"nine times\nnine times\n{prose(5, 300 + i)}") for i in range(9)]
    table = docs_of([*ROWS, *common, *nine], extra="n_lines")
    state = LineDedup(spark, shards=8).insert(table)
    out = {r.doc_id: r for r in state.clean(table).collect()}
    assert (out[100].n_lines, out[100].n_dropped, out[100].kept_text) == (3, 2, prose(5, 0)) and out[200].n_dropped == 0
    assert (out[3].n_lines, out[3].kept_text) == (1, "") and out[4].kept_text == " \n\t\n " and out[5].kept_text == LONG
    assert state.clean(table).count() == len(ROWS) + 19
    # The tenth document brings a line to the threshold; its deletion takes it back.
    tenth = docs_of([(300, "NINE TIMES")])
    more = LineDedup(spark, state.folder, shards=8)
    more.version = state.version
    more.insert(tenth)
    assert {r.doc_id: r.n_dropped for r in more.clean(table).collect()}[200] == 2
    more.delete(tenth)
    assert {r.doc_id: r.n_dropped for r in more.clean(table).collect()}[200] == 0
    assert {tuple(r) for r in more._table("counts").collect()} == {tuple(r) for r in spark.read.parquet(f"{more.folder}/v1/counts").collect()}
    assert LineDedup(spark).insert(nothing).clean(nothing).count() == 0


def test_exact_table_decides_without_filters(spark, docs_of, monkeypatch):
    table = docs_of([(i, f"same\n{prose(5, i)}") for i in range(12)])
    state = LineDedup(spark).insert(table)
    monkeypatch.setattr("tidelog.llm.linededup.FILTER_BYTES", 0)
    assert {r.n_dropped for r in state.clean(table).collect()} == {1}


def test_cuckoo_filter():
    r = np.random.default_rng(1)
    keys = r.integers(-2 ** 62, 2 ** 62, (3000, 2))
    marks = (keys[:, 1].view(np.uint64) >> np.uint64(48) | np.uint64(1)).astype(np.int64)
    f = CuckooFilter.empty(100)
    for h, m in zip(keys[:2000, 0].tolist(), marks[:2000].tolist(), strict=True):
        f.insert(h, m)
    f = CuckooFilter.read(f.data())
    assert f.may_hold(keys[:2000, 0], marks[:2000]).all()
    for h, m in zip(keys[:2000, 0].tolist(), marks[:2000].tolist(), strict=True):
        f.delete(h, m)
    assert not f.rest and not f.buckets.any()


def plain_lm(rows, held):
    import math
    from collections import Counter

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [[w for w in re.split("[\x20\x09-\x0d]+", (t or "").translate(low)) if w] + [" end"] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, tokens, strict=True) if not held(i) for w in ws)
    total, types = sum(counts.values()), len(counts)
    return sorted((str(i), held(i), len(ws), sum(counts[w] > 0 for w in ws), total, round(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws), 6)) for (i, _), ws in zip(rows, tokens, strict=True))


def test_scores(docs, nothing, docs_of, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_TOKENS", 30_000)
    fold = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(7))
    got = lm.score(docs, fold == 2, fold == 3).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == plain_lm(ROWS, lambda i: (i or 0) % 7 == 2)
    assert all(r.score < 0 for r in got)
    assert lm.score(nothing, fold == 2, fold == 3).count() == 0
    assert {r.n_known for r in lm.score(docs, F.lit(True), F.lit(False)).collect()} == {0}


def test_model_beats_the_base_on_held_out_text(docs_of):
    r = random.Random(1)
    follow = {w: r.choice(WORDS) for w in WORDS}
    rows = []
    for i in range(300):
        w = [r.choice(WORDS)]
        while len(w) < 60:
            w.append(follow[w[-1]] if r.random() < 0.8 else r.choice(WORDS))
        rows.append((i, " ".join(w)))
    fold = F.pmod("doc_id", F.lit(7))
    held = [x for x in lm.score(docs_of(rows), fold == 2, fold == 3).collect() if x.held_out]
    assert sum(x.score for x in held) > 0.7 * sum(x.base_score for x in held)


def test_probabilities_sum_to_one():
    weights = lm.learn_weights(np.array([5 * lm.BINS ** 2 + 3 * lm.BINS + 20]), np.array([100.0]), 50)
    assert np.allclose(weights.sum(axis=1), 1) and (weights[:, 1:] > 0).all()
