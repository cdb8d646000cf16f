"""Quality rules as a short-circuit cascade.

Each rule says whether it rejects a document and which measures it needs. On a sample, every rule's cost (seconds for the
sample) and selectivity (share rejected) are estimated; rules then run in order of rejections per cost, and a document
that one rule rejects is spared the later ones. The order changes the time, never the verdict.

Two toxicity rules are learned: single words that labelled toxic documents hold far more often than the other labelled
documents do, and a score over words and beginnings of words, for stems with many endings. A feature's weight is the lower
bound of its smoothed log odds; no share of the documents is asked for, so that a language with few of them learns too.
Copies teach once: documents of a class with the same set of words count as one, all others for themselves. The labelled
sample is bounded by LABELLED_ROWS.
"""

from __future__ import annotations

import json
import os
import time
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bind, positions, space_words, written
from tidelog.plans.once import compute_once

#: At most so many labelled documents teach the toxicity rule: those whose ids have the smallest MD5 sums.
LABELLED_ROWS = 20_000
#: A word is toxic if it is in one of 100 toxic documents (and 5 at least), and 30 times as often there as elsewhere.
TOXIC_SHARE, TOXIC_LEAST, TOXIC_RATIO = 100, 5, 30
#: So many different toxic words make a document toxic: a single one also occurs in a clean document now and then.
TOXIC_WORDS = 2
#: Lengths of the beginnings that are features beside the words themselves.
STEMS = range(3, 9)
#: A feature counts if it is in so many toxic documents and its log odds are so many standard deviations above 0; its weight
#: is the log odds less BOUND deviations. Half of the labels of sf0.1 judged by the other half set DEVIATIONS and SCORE.
FEATURE_LEAST, DEVIATIONS, BOUND = 3, 3.3, 1.64
#: A document is toxic if the weights of its distinct words are above SCORE times the root of a tenth of its characters.
SCORE = 0.5
#: Places of the lookup table for each feature.
PLACES = 4
#: Rows from which the order of the rules is estimated.
ORDER_SAMPLE, ORDER_TIMES = 400, 4
_SYMBOL = "[#*$%&|<>]"
_WORD = r"\p{L}{3,}"


@dataclass(frozen=True)
class Measures:
    """What rules look at, each worked out once per document: columns of one row."""
    text: Column
    words: Column
    n_words: Column
    letters: Column


@dataclass(frozen=True)
class Rule:
    """rejects: from a document's measures (of a text that is never null) to a boolean that is true where it goes."""
    name: str
    rejects: Callable[[Measures], Column]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds __text (never null), __words, __n_words and __letters (the distinct lower-cased runs of letters)."""
    once = compute_once(docs, __text=F.coalesce(F.col(text), F.lit("")))
    once = compute_once(once, __words=space_words(F.col("__text")))
    return once.withColumn("__n_words", F.size("__words").cast("long"))


MEASURES = ["__text", "__words", "__n_words"]


def _measures() -> Measures:
    return Measures(F.col("__text"), F.col("__words"), F.col("__n_words"), letter_runs(F.col("__text")))


def letter_runs(text: Column) -> Column:
    """The distinct runs of letters of a text, in lower case."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+"))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.size(F.split(text, _SYMBOL)) - 1).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return bind(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column, width: int = 3) -> Column:
    """Words in windows of width words that the words of a text hold twice or more.

    Windows are compared by a 64-bit hash. Most texts have no equal neighbours among the sorted hashes and are done; for
    the rest the starts of repeated windows are sorted and the lengths of their union added up.
    """
    def windows(w: Column) -> Column:
        return F.transform(positions(F.size(w) - (width - 1)),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def repeated(h: Column) -> Column:
        return bind(F.sort_array(h), lambda s: F.array_distinct(
            F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))))

    def covered(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        starts = bind(F.array_sort(pairs), lambda p: F.sort_array(F.transform(
            F.filter(p, lambda x, i: ((i > 0) & (x.h == F.get(p, i - 1).h)) | (x.h == F.get(p, i + 1).h)
                     & (i < F.size(p) - 1)), lambda x: x.i)))
        return bind(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, i: F.when(i < F.size(s) - 1, F.least(F.get(s, i + 1) - x, F.lit(width))).otherwise(width)),
            F.lit(0).cast("long"), lambda total, x: total + x))

    def whole(w: Column) -> Column:
        return bind(windows(w), lambda h: F.when(F.size(repeated(h)) == 0, F.lit(0).cast("long")).otherwise(covered(h)))

    return whole(words)


def _caps(text: Column) -> Column:
    """More capitals than other letters of A-Z, and fifty letters at least. There are no fewer small letters than runs of them,
    so most texts are done once these are counted."""
    upper = F.size(F.split(text, "[A-Z]")) - 1
    runs = F.size(F.split(text, "[a-z]+")) - 1
    lower = F.char_length(F.regexp_replace(text, r"[^a-z]+", ""))
    return bind(upper, lambda n: (n >= 26 - 1) & (n > runs) & bind(lower, lambda m: (n > m) & (n + m >= 50)))


def default_rules(toxic: list[str], weights: dict[str, float] | None = None) -> list[Rule]:
    """Rules beside the contract's base rules: symbols, capitals, repeated lines, odd word lengths, several toxic words, toxic score."""
    known = F.array(*[F.lit(x) for x in toxic])
    rules = [
        Rule("symbols", lambda m: n_symbols(m.text) * 10 > m.n_words),
        Rule("capitals", lambda m: _caps(m.text)),
        Rule("repeated_lines", lambda m: bind(_lines(m.text), lambda x: (F.size(x) >= 5) & ((F.size(x) - F.size(F.array_distinct(x))) * 2 > F.size(x)))),
        Rule("word_length", lambda m: ~word_chars(m.words).between(2 * m.n_words, 20 * m.n_words)),
    ]
    if toxic:
        rules.append(Rule("toxic", lambda m: F.size(F.array_intersect(m.letters, known)) >= TOXIC_WORDS))
    if weights:
        rules.append(Rule("toxic_score", lambda m: toxic_score(m.text, weights) > SCORE * F.sqrt(F.char_length(m.text) / 10)))
    return rules


def base_rules() -> list[Rule]:
    return [Rule("few_words", lambda m: m.n_words < 50),
            Rule("repeats", lambda m: n_repeat_words(m.words) * 100 > m.n_words * 50)]


def _features(word: Column) -> Column:
    """The beginnings of a word, and the word with a blank behind it. Beginnings longer than the word are the word."""
    return F.array(*[F.substring(word, 1, k) for k in STEMS], F.concat(word, F.lit(" ")))


def _tree(features: set[str]) -> str:
    """A pattern of what begins like one of the features; those with a blank at the end have no letter behind them."""
    if "" in features:
        return ""
    same = os.path.commonprefix(list(features))
    if same:
        rest = {x[len(same):] for x in features}
        return same.replace(" ", r"(?!\p{L})") + (_tree(rest) if rest != {""} else "")
    heads = sorted({x[0] for x in features})
    return f"(?:{'|'.join(_tree({x for x in features if x[0] == a}) for a in heads)})"


def toxic_score(text: Column, weights: dict[str, float]) -> Column:
    """The sum over the distinct words of the text of the largest weight among a word's features.

    Only words that have a feature are taken from the text, by a tree of all features. A literal table, dealt by hash, holds
    all weights, however many: a lookup meets the few that share a place. A feature that weighs no more than a beginning of
    its own never is the largest and is left out.
    """
    best = {x: v for x, v in weights.items() if all(weights.get(x[:k], float("-inf")) < v for k in STEMS if k < len(x))}
    size = PLACES * len(best)
    # The place of a word in Python and in Spark: its CRC.
    table: list[dict[str, float]] = [{} for _ in range(size)]
    for word, value in best.items():
        table[zlib.crc32(word.encode()) % size][word] = value
    places = F.from_json(F.lit(json.dumps(table)), "array<map<string,double>>")
    found = F.regexp_extract_all(F.lower(text), F.lit(rf"(?<!\p{{L}})(?:{_tree(set(best))})\p{{L}}*"), F.lit(0))

    def weight(word: Column) -> Column:
        return F.array_max(F.transform(_features(word), lambda x: F.get(places, F.pmod(F.crc32(x), F.lit(size)).cast("int"))[x]))

    return F.aggregate(F.array_distinct(found), F.lit(0.0), lambda total, w: total + F.coalesce(weight(w), F.lit(0.0)))


def _known(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: str, words: Callable[[Column], Column]) -> DataFrame:
    """Rows (bad, words): the sorted distinct words of the labelled documents that have any, once for each class and set."""
    ids = (labels.select(F.col(key).alias("id"), F.col(toxic).alias("toxic")).where("id is not null and toxic is not null")
           .groupBy("id").agg(F.max("toxic").alias("toxic")))
    sample = ids.orderBy(F.md5(F.col("id").cast("string"))).limit(LABELLED_ROWS)
    known = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    taught = bind(F.array_sort(F.array_distinct(words(F.col("text")))), lambda w: F.struct(
        w.alias("words"), F.md5(F.array_join(w, " ")).alias("same")))
    once = compute_once(known.select((F.col("toxic") > 0).alias("bad"), "text"), taught=taught)
    return once.where(F.size("taught.words") > 0).groupBy("bad", "taught.same").agg(F.first("taught.words").alias("words")).drop("same")


def _counts(known: DataFrame, features: Column) -> DataFrame:
    """Rows (word, bad, n, all_bad, all_n): toxic and all documents with the feature, and without asking for it."""
    # The empty word of each document counts the documents of either class.
    held = known.select("bad", F.explode(F.concat(F.array(F.lit("")), features)).alias("word"))
    counts = held.groupBy("word").agg(F.count_if("bad").alias("bad"), F.count("*").alias("n")).where("bad >= 1 or word = ''")
    total = counts.where("word = ''").select(F.col("bad").alias("all_bad"), F.col("n").alias("all_n"))
    return counts.where("word <> ''").join(F.broadcast(total))


def toxic_words(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> list[str]:
    """The learned words (of four letters or more), sorted. No labels, or none of a class: none. Labels with a null id or
    class, and documents without such words, teach nothing.

    If an id is labelled more than once it is toxic if any label says so. At most LABELLED_ROWS ids are used, so what is
    broadcast and what is counted are bounded.
    """
    return learned(docs, labels, key, text, toxic)[0]


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> tuple[list[str], dict[str, float]]:
    """toxic_words, and the weights of toxic_score, from one count."""
    known = _known(docs, labels, key, text, toxic, lambda t: F.regexp_extract_all(F.lower(t), F.lit(_WORD), F.lit(0)))
    features = F.array_distinct(F.flatten(F.transform("words", _features)))
    counts = written(_counts(known, features))
    share = (F.col("bad") * (F.col("all_n") - F.col("all_bad") + 1)
             >= TOXIC_RATIO * (F.col("n") - F.col("bad") + 0.5) * (F.col("all_bad") + 1))
    found = (counts.where(F.col("word").endswith(" ") & (F.char_length("word") > 4))
             .where(share & (F.col("bad") >= TOXIC_LEAST) & (F.col("bad") * TOXIC_SHARE >= F.col("all_bad"))))
    a, b = F.col("bad") + 0.5, F.col("n") - F.col("bad") + 0.5
    odds = F.log(a / (F.col("all_bad") + 1)) - F.log(b / (F.col("all_n") - F.col("all_bad") + 1))
    deviation = F.sqrt(1 / a + 1 / b)
    weighted = (counts.where((F.col("bad") >= FEATURE_LEAST) & (F.col("all_n") > F.col("all_bad")))
                .where(odds > DEVIATIONS * deviation).select("word", (odds - BOUND * deviation).alias("weight")))
    return sorted(r.word[:-1] for r in found.select("word").collect()), {r.word: r.weight for r in weighted.collect()}


def order_rules(docs: DataFrame, rules: list[Rule], text: str = "text") -> list[Rule]:
    """The rules by rejections per second, as measured on a random sample of about ORDER_SAMPLE documents.

    Every rule runs twice over the sample, once and ORDER_TIMES over: the difference is the rule's own time, without that of
    planning and starting the job.
    """
    total = docs.count()
    sample = measured(docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).sample(min(1.0, ORDER_SAMPLE / max(1, total)), seed=7), "t").select(*MEASURES).persist()
    n = sample.count()
    more = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(ORDER_TIMES))))
    scored = []
    for rule in rules:
        times = []
        for rows in (sample, more):
            start = time.perf_counter()
            rejected = rows.where(rule.rejects(_measures())).count()
            times.append(time.perf_counter() - start)
        scored.append((rejected / max(1, n) / ORDER_TIMES / max(1e-4, times[1] - times[0]), rule))
    sample.unpersist()
    return [rule for _, rule in sorted(scored, key=lambda x: -x[0])]


def cascade(docs: DataFrame, rules: list[Rule], text: str = "text", kept: str = "kept") -> DataFrame:
    """Adds kept: true where no rule rejects. Rules run in the order given; the first that rejects ends a document's turn.

    A null text is judged as an empty one. A rule whose answer is null does not reject. Every row gets a verdict, repeated
    rows included; a column called like kept is replaced. With no rules every document is kept.
    """
    return judged(measured(docs, text), rules, kept).drop(*MEASURES)


def judged(rows: DataFrame, rules: list[Rule], kept: str = "kept", spare: Column | None = None) -> DataFrame:
    """``cascade`` over rows of ``measured``; rows where ``spare`` holds go without a look at any rule."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(_measures()), F.lit(False)).otherwise(verdict)
    return rows.withColumn(kept, verdict if spare is None else F.when(spare, F.lit(False)).otherwise(verdict))
