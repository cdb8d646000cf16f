"""Personal data by weak supervision.

Patterns propose candidate spans. Labelers of three sorts vote on each: format checks, gazetteers and context words; a vote is
for, against or none. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is for
each kind and how likely a span with given votes is personal. These likelihoods then teach a logistic span classifier, which
also sees the span's shape. Spans of the base patterns always stand; the classifier adds others that do not touch them.

Everything that grows with the data is DataFrame work. The counts of vote patterns (3 to the number of labelers, for each of
four kinds and twelve shapes) are all that comes to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.llm.common import bind, row_key, written

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
#: Base patterns, written so that no text makes them step back: runs are taken whole, and a run starts only at its first
#: character or where the last match ended.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DOT = r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)"
#: Wider patterns for what the base patterns miss. A plain word "at" is part of an address only where the dots are spelled out
#: too, and a dot as such has no space behind it: "we met at noon. Then" is no address.
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+(?:\x20?(?:\(at\)|\[at\]|\{{at\}})\x20?[A-Za-z0-9-]{{1,63}}+(?:(?:{_DOT}|\.)[A-Za-z]{{2,63}}+){{1,4}}+|\x20at\x20[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z]{{2,63}}+){{1,4}}+)",
    "card": r"(?<![0-9./_-])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+./-])(?:00[0-9]{1,3}[\x20.-]?|1[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Fixed gazetteers.
TOP_DOMAINS = "com org net edu gov mil int info biz io co de fr es it nl uk eu us ca au jp cn in br ru ch at be se no dk fi pl pt mx ar".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 353 358 380 420".split()
CARD_PREFIXES = "4 34 35 36 37 38 51 52 53 54 55 60 62 65".split()
#: Context words, in the text just before a span.
FOR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to|correo|courriel|kontakt)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|login|from|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|tél|teléfono|whatsapp)\b",
}
AGAINST = r"(?i)(?:\b(?:version|release|section|chapter|figure|table|isbn|issn|order|invoice|serial|article|paragraph|page|build)\b[^\n]{0,12}|[$€£]\s?|\bv\.?\s?)$"
LABELERS = 5
#: A span beyond the base is added from this probability.
ADD = 0.9


def _of(kind: Column, table: dict[str, Column], other: Column) -> Column:
    out = other
    for k, v in table.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def _matches(text: Column, pattern: str) -> Column:
    """An array of (gap, left, m, right): code points since the match before, the text around, the match."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.filter(F.arrays_zip(found.alias("m"), gaps.alias("gap"), F.slice(gaps, 2, 1_000_000_000).alias("after")), lambda x: x.m.isNotNull())
    return F.transform(zipped, lambda x: F.struct(
        F.char_length(x.gap).alias("gap"), F.right(x.gap, F.lit(40)).alias("left"), x.m.alias("m"), F.left(x.after, F.lit(8)).alias("right")))


def candidates(docs: DataFrame, key: Column, text: str) -> DataFrame:
    """Every match of a pattern: key, kind, wide, start, end (code points, end exclusive), m, left, right."""
    t = F.coalesce(F.col(text), F.lit(""))
    # A text without the characters that a pattern needs is not searched.
    digit = t.rlike("[0-9]")
    needs = {("email", False): t.contains("@"), ("ip", False): digit, ("card", False): digit, ("phone", False): t.contains("+"),
             ("email", True): t.rlike(r"[(\[{ ]at[)\]} ]") & t.rlike(r"\.|dot"), ("card", True): digit, ("phone", True): digit}
    none = F.array().cast("array<struct<gap:int,left:string,m:string,right:string>>")
    named = [F.struct(F.lit(k).alias("kind"), F.lit(wide).alias("wide"), F.when(needs[k, wide], _matches(t, p)).otherwise(none).alias("found"))
             for wide, patterns in ((False, BASE), (True, WIDE)) for k, p in patterns.items()]
    sets = docs.select(key.alias("key"), F.explode_outer(F.filter(F.array(*named), lambda s: F.size(s.found) > 0)).alias("s")).where("s is not null")
    each = sets.select("key", "s.kind", "s.wide", F.posexplode_outer("s.found").alias("at", "x")).select("key", "kind", "wide", "at", "x.*")
    # Rows that repeat share a key and hold the same matches: once is enough.
    each = each.groupBy("key", "kind", "wide", "at").agg(*[F.first(c).alias(c) for c in ("gap", "left", "m", "right")])
    before = W.partitionBy("key", "kind", "wide").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap") + F.char_length("m")).over(before)
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("m")).drop("gap", "at")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: bind(F.coalesce(c.try_cast("int"), F.lit(0)), lambda n: (
        F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n))))
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def passes(kind: Column, m: Column) -> Column:
    """What a match of a base pattern must also meet: parts, digits and the check digit."""
    n = F.length(_digits(m))
    parts = F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.right(F.ltrim(p, F.lit("0")), F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    card = F.when(n.between(13, 19), _luhn(_digits(m))).otherwise(False)
    return _of(kind, {"ip": parts, "card": card, "phone": n.between(9, 15)}, F.lit(True))


def votes(spans: DataFrame) -> DataFrame:
    """Adds the labelers' votes v1 to v5 (1 for, -1 against, 0 none) and the shape features length and parts."""
    kind, m = F.col("kind"), F.col("m")
    digits = _digits(m)
    format_ok = F.when(F.col("ok") & ~F.col("wide"), 1).when(kind == "email", 0).when(
        _of(kind, {"card": F.length(digits).between(13, 19) & _luhn(digits), "phone": F.length(digits).between(9, 15)}, F.lit(False)), 1).otherwise(-1)
    known = _of(kind, {
        "email": F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(TOP_DOMAINS),
        "ip": F.regexp_extract(m, r"^([0-9]{1,3})\.", 1).try_cast("int").between(1, 223) & ~m.rlike(r"^(?:0|10|127)\."),
        "card": F.left(digits, F.lit(1)).isin(CARD_PREFIXES) | F.left(digits, F.lit(2)).isin(CARD_PREFIXES),
        "phone": F.exists(F.array(*[F.left(digits, F.lit(k)) for k in (1, 2, 3)]), lambda d: d.isin(COUNTRY_CODES)) & m.rlike(r"^(?:\+|00|1[ .-])"),
    }, F.lit(False))
    near = _of(kind, {k: F.col("left").rlike(p) for k, p in FOR.items()}, F.lit(False))
    apart = ~F.col("left").rlike(r"[\p{L}\p{N}_/@-]$") & ~F.col("right").rlike(r"^(?:[\p{L}\p{N}_/@-]|\.[0-9])")
    return spans.withColumns({
        "v1": format_ok, "v2": F.when(known, 1).otherwise(F.when(kind == "phone", 0).otherwise(-1)), "v3": near.cast("int"),
        "v4": -F.col("left").rlike(AGAINST).cast("int"), "v5": F.when(apart, 1).otherwise(-1),
        "length": F.when(F.length("m") < 10, 0).when(F.length("m") < 15, 1).when(F.length("m") < 20, 2).otherwise(3),
        "parts": F.least(F.size(F.split(m, r"[ .()/-]")) / 3, F.lit(2)).cast("int")})


def reliabilities(rows: list[Row], rounds: int = 30) -> dict[tuple, float]:
    """From counts of vote patterns (kind, v1..., count): the probability that a span of a pattern is personal.

    Each labeler has, for each kind and class, a probability for each vote; classes start from the sum of votes.
    """
    out: dict[tuple, float] = {}
    for kind in {r["kind"] for r in rows}:
        counts: dict[tuple, int] = {}
        for r in rows:
            if r["kind"] == kind:
                v = tuple(r[f"v{k + 1}"] for k in range(LABELERS))
                counts[v] = counts.get(v, 0) + r["count"]
        belief = {v: 1 / (1 + math.exp(-1.5 * sum(v))) for v in counts}
        for _ in range(rounds):
            mass = sum(n * belief[v] for v, n in counts.items())
            total = sum(counts.values())
            tables = []
            for k in range(LABELERS):
                yes, no = {x: 1.0 for x in (-1, 0, 1)}, {x: 1.0 for x in (-1, 0, 1)}
                # A labeler is taken to be better than chance: two spans' worth of belief in its favour.
                yes[1] += 2
                no[-1] += 2
                for v, n in counts.items():
                    yes[v[k]] += n * belief[v]
                    no[v[k]] += n * (1 - belief[v])
                tables.append(({x: c / sum(yes.values()) for x, c in yes.items()}, {x: c / sum(no.values()) for x, c in no.items()}))
            prior = (mass + 1) / (total + 2)
            for v in counts:
                odds = math.log(prior / (1 - prior)) + sum(math.log(tables[k][0][x] / tables[k][1][x]) for k, x in enumerate(v))
                belief[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        out |= {(kind, *v): p for v, p in belief.items()}
    return out


def _features(r: Row | dict) -> list[str]:
    return ["bias", f"kind={r['kind']}", *[f"v{k}={r[f'v{k}']}" for k in range(1, LABELERS + 1)], f"length={r['length']}", f"parts={r['parts']}",
            f"kind={r['kind']},v1={r['v1']}", f"kind={r['kind']},length={r['length']}"]


def train_classifier(rows: list[Row], steps: int = 200) -> dict[str, float]:
    """Logistic regression on the counted span shapes, with the probabilities of their votes as soft labels."""
    truth = reliabilities(rows)
    data = [(_features(r), r["count"], truth[(r["kind"], *[r[f"v{k + 1}"] for k in range(LABELERS)])]) for r in rows]
    weights = {f: 0.0 for features, _, _ in data for f in features}
    seen = {f: 1e-9 for f in weights}
    total = sum(n for _, n, _ in data) or 1
    for _ in range(steps):
        slope = {f: 1e-4 * w for f, w in weights.items()}
        for features, n, p in data:
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[f] for f in features)))))
            for f in features:
                slope[f] += (q - p) * n / total
        for f, s in slope.items():
            seen[f] += s * s
            weights[f] -= 0.5 * s / math.sqrt(seen[f])
    return weights


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, kind, start, end, base): the base spans of every text and those that the classifier adds.

    key is the row key of (doc_id, text). Added spans touch no base span and no added span before them. Null and empty
    texts have none; texts are searched whole.
    """
    found = candidates(docs, row_key(F.col(doc_id), F.col(text)), text).withColumn("ok", passes(F.col("kind"), F.col("m")))
    voted = written(votes(found).drop("m", "left", "right"))
    shape = ["kind", *[f"v{k}" for k in range(1, LABELERS + 1)], "length", "parts"]
    weights = train_classifier(voted.groupBy(*shape).count().orderBy(*shape).collect())
    table = F.create_map(*[F.lit(x) for f, w in sorted(weights.items()) for x in (f, float(w))]) if weights else F.create_map(F.lit(""), F.lit(0.0))
    names = [F.lit("bias"), F.concat(F.lit("kind="), "kind"), *[F.concat(F.lit(f"v{k}="), F.col(f"v{k}").cast("string")) for k in range(1, LABELERS + 1)],
             F.concat(F.lit("length="), F.col("length").cast("string")), F.concat(F.lit("parts="), F.col("parts").cast("string")),
             F.concat(F.lit("kind="), "kind", F.lit(",v1="), F.col("v1").cast("string")), F.concat(F.lit("kind="), "kind", F.lit(",length="), F.col("length").cast("string"))]
    odds = sum((F.coalesce(F.try_element_at(table, n), F.lit(0.0)) for n in names), F.lit(0.0))
    judged = voted.select("key", "kind", "start", "end", (F.col("ok") & ~F.col("wide")).alias("base"), odds.alias("odds"))
    # An address with a part beyond 255 is none, whatever the votes.
    judged = judged.where(F.col("base") | ((F.col("kind") != "ip") & (F.col("odds") >= math.log(ADD / (1 - ADD)))))
    order = W.partitionBy("key").orderBy("start", F.desc("base"), F.desc("end"), "kind")
    past, ahead = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    clear = (F.coalesce(F.max("end").over(past), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(ahead), F.col("end")) >= F.col("end"))
    return judged.withColumn("clear", clear).where("base or clear").select("key", "kind", "start", "end", "base")


def summarize(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans), base and spans (kind:start:end, by kind
    and start, comma-joined). Rows that repeat get the same result each."""
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = find(docs, doc_id, text).withColumn("s", F.struct(number.alias("k"), "start", F.concat_ws(":", "kind", "start", "end").alias("t")))
    def joined(c: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda s: s.t), ",")
    grouped = spans.groupBy("key").agg(
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS],
        joined(F.when(F.col("base"), F.col("s"))).alias("base"), joined(F.col("s")).alias("spans"))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"))
    return keyed.join(grouped, "key", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
