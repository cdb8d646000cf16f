"""SQL for another engine that gives the rows of the registered queries."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _ascii(c: str) -> str:
    return f"translate(coalesce({c}, ''), '{UPPER}', '{UPPER.lower()}')"


def _item_words(c: str) -> str:
    return rf"list_filter(string_split_regex({_ascii(c)}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def hits(docs: str, where: str) -> str:
    """CTEs dw (doc_id, w), hit (doc_id, n_hit) and named (doc_id, ids) over the rows of docs."""
    return f"""
bw AS (SELECT item_id, {_item_words('text')} AS w FROM {where}),
win AS (SELECT item_id, list_slice(w, s + 1, least(s + 13, len(w))) AS win FROM
        (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS s FROM bw WHERE len(w) > 0)),
uw AS (SELECT win, len(win) AS n, list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL) AS ids FROM win GROUP BY win),
dw AS (SELECT doc_id, {_item_words('text')} AS w FROM {docs}),
pos AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM dw),
cut AS (SELECT doc_id, p, k.n, list_slice(w, p + 1, p + k.n) AS win FROM pos, (SELECT DISTINCT n FROM uw) k WHERE p + k.n <= len(w)),
occ AS (SELECT doc_id, p, cut.n, ids FROM cut JOIN uw ON cut.win = uw.win),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT i)) AS ids FROM (SELECT doc_id, unnest(ids) AS i FROM occ) GROUP BY doc_id)"""


def _words(c: str) -> str:
    return rf"list_filter(string_split_regex(coalesce({c}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def measures(docs: str) -> str:
    """CTEs m (doc_id, t, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) and judged (those, base_failed, verdict)."""
    return rf"""
d0 AS (SELECT doc_id, coalesce(text, '') AS t, {_words('text')} AS w,
              list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM {docs}),
tri AS (SELECT doc_id, i, w[i + 1:i + 3] AS x FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM d0 WHERE len(w) >= 3)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
cov AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS q FROM rep) GROUP BY doc_id),
m AS (SELECT d0.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM d0 LEFT JOIN cov USING (doc_id)),
lab AS (SELECT doc_id, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id
        ORDER BY md5(CAST(doc_id AS VARCHAR)) LIMIT 20000),
known AS (SELECT toxic > 0 AS bad, list_sort(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '\p{{L}}{{3,}}'))) AS s FROM documents JOIN lab USING (doc_id)),
taught AS (SELECT DISTINCT bad, s FROM known WHERE len(s) > 0),
part AS (SELECT row_number() OVER () AS id, bad, s FROM taught),
feat AS (SELECT DISTINCT id, bad, unnest(list_append([x[1:k] FOR k IN range(3, 9)], x || ' ')) AS f FROM (SELECT id, bad, unnest(s) AS x FROM part)),
tot AS (SELECT count(*) FILTER (bad) AS all_bad, count(*) AS all_n FROM part),
seen AS (SELECT f, count(*) FILTER (bad) AS bad, count(*) AS n, any_value(all_bad) AS all_bad, any_value(all_n) AS all_n FROM feat, tot GROUP BY f),
toxic AS (SELECT f[:-2] AS w FROM seen WHERE suffix(f, ' ') AND length(f) > 4 AND bad >= 5 AND bad * 100 >= all_bad
          AND bad * (all_n - all_bad + 1) >= 30 * (n - bad + 0.5) * (all_bad + 1)),
odds AS (SELECT f, ln((bad + 0.5) / (all_bad + 1)) - ln((n - bad + 0.5) / (all_n - all_bad + 1)) AS odds, sqrt(1 / (bad + 0.5) + 1 / (n - bad + 0.5)) AS dev
         FROM seen WHERE bad >= 3 AND all_n > all_bad),
weight AS (SELECT f, odds - 1.64 * dev AS v FROM odds WHERE odds > 3.3 * dev),
runs AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(t), '\p{{L}}+'))) AS w FROM m),
worth AS (SELECT w, max(v) AS v FROM (SELECT w, unnest(list_append([w[1:k] FOR k IN range(3, 9)], w || ' ')) AS f FROM (SELECT DISTINCT w FROM runs)) JOIN weight USING (f) GROUP BY w),
score AS (SELECT doc_id, count(*) FILTER (w IN (SELECT w FROM toxic)) AS n_toxic, coalesce(sum(v), 0) AS score FROM runs LEFT JOIN worth USING (w) GROUP BY doc_id),
judged AS (SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
             (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AS base_failed,
             NOT (n_symbols * 10 > n_words
                  OR (2 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AND length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) >= 50)
                  OR (n_lines >= 5 AND 2 * n_dup_lines > n_lines)
                  OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
                  OR coalesce(n_toxic, 0) >= 2 OR coalesce(score, 0) > 0.5 * sqrt(length(t) / 10)) AS verdict FROM m LEFT JOIN score USING (doc_id))"""


def lines(docs: str) -> str:
    """CTEs ln (doc_id, i, x, k) and hot (k) over the rows of docs."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
l0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {docs}),
ln AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS x FROM l0),
lk AS (SELECT doc_id, i, x, translate(trim(x, {space}), '{UPPER}', '{UPPER.lower()}') AS k FROM ln),
hot AS (SELECT k FROM lk WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
cleaned AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM hot)) AS n_dropped,
                   coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (k NOT IN (SELECT k FROM hot)), '') AS kept FROM lk GROUP BY doc_id)"""


def near(docs: str) -> str:
    """CTE near (doc_id, class_id, n_links): links of five-word shingles at 0.8, and the least id that links lead to."""
    return f"""
nw AS (SELECT doc_id, {_item_words('text')} AS w FROM {docs}),
sh AS (SELECT DISTINCT doc_id, list_slice(w, s + 1, least(s + 5, len(w))) AS x FROM
       (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM nw WHERE len(w) > 0)),
sn AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id
         JOIN sn p ON p.doc_id = a.doc_id JOIN sn q ON q.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, p.n, q.n
         HAVING 5 * count(*) >= 4 * (p.n + q.n - count(*))),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
near AS (SELECT d.doc_id, least(d.doc_id, coalesce(r.m, d.doc_id)) AS class_id, coalesce(l.n, 0) AS n_links FROM {docs} d
         LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = d.doc_id)"""


def _crc32(c: str) -> str:
    """Of UTF-8 text."""
    step = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), {step})"
    codes = f"list_transform(range(1, strlen({c}) + 1), lambda p: CAST('0x' || substr(hex(encode({c})), 2 * p - 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _ways() -> list[str]:
    """Ways over one row: role's letter or *, state before, letters, state after, cost, whether the row stays, inserted lines, role given.

    States: 1 nothing, 2 system, 3 user, 4 assistant.
    """
    then = {1: 3, 2: 3, 3: 4, 4: 3}
    said = {3: "user", 4: "assistant"}
    fits = {1: [("s", 2), ("u", 3)], 2: [("u", 3)], 3: [("a", 4)], 4: [("u", 3)]}
    out = []
    for f in then:
        at, lines = f, ""
        for inserted in range(3):
            own = [("*", "D", at, 2, False, ""), ("*", "R", then[at], 1, True, said[then[at]]), *[(k, "K", t, 0, True, "") for k, t in fits[at]]]
            out += [f"{{k: '{k}', f: {f}, x: '{'I' * inserted + x}', t: {t}, c: {5 * inserted + c}, stays: {stays}, pre: '{lines}', role: '{role}'}}" for k, x, t, c, stays, role in own]
            at = then[at]
            lines += f"~{said[at]}:"
    return out


def repaired() -> str:
    """CTEs j (rows after damage, judged) and ended (conv_id, c, a, r): cost, letters and lines of the first of the cheapest repairs."""
    best = ", ".join(f"list_min(list_transform(list_filter(w, lambda y: y.t = {t}), lambda y: y.v))" for t in (1, 2, 3, 4))
    return rf"""
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
kd AS (SELECT conv_id, turn, role, text, {_crc32('s')} % 20 AS d FROM k),
dm AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
       FROM kd, (VALUES (1), (2)) n(copy) WHERE d <> 0 AND (copy = 1 OR d = 3)),
nr AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text)) AS i,
              rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM dm),
nd AS (SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
              left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM nr),
j AS (SELECT *, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM nd),
ways AS (SELECT [{', '.join(_ways())}] AS ways),
dp(conv_id, i, st) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, [{{c: 0::BIGINT, a: '', r: ''}}, NULL, NULL, NULL] FROM dm
  UNION ALL
  SELECT conv_id, i, CASE WHEN gone THEN list_transform(st, lambda x: CASE WHEN x IS NULL THEN NULL ELSE {{c: x.c + 2, a: x.a || 'D', r: x.r}} END) ELSE [{best}] END FROM (
    SELECT dp.conv_id, j.i, st, blank OR duplicate AS gone, list_transform(
      list_filter(ways, lambda x: x.k IN ('*', letter) AND st[x.f] IS NOT NULL), lambda x: {{t: x.t, v: {{
        c: st[x.f].c + x.c + CASE WHEN truncated AND x.stays THEN 5 ELSE 0 END, a: st[x.f].a || x.x,
        r: st[x.f].r || replace(x.pre, '~', chr(10)) || CASE WHEN NOT x.stays THEN '' ELSE chr(10) || CASE WHEN x.role = '' THEN role ELSE x.role END || ':' || text END}}}}) AS w
    FROM dp JOIN j ON j.conv_id IS NOT DISTINCT FROM dp.conv_id AND j.i = dp.i + 1, ways)),
finished AS (SELECT conv_id, list_min(list_filter([st[1], st[4],
      CASE WHEN st[2] IS NULL THEN NULL ELSE {{c: st[2].c + 10, a: st[2].a || 'II', r: st[2].r || chr(10) || 'user:' || chr(10) || 'assistant:'}} END,
      CASE WHEN st[3] IS NULL THEN NULL ELSE {{c: st[3].c + 5, a: st[3].a || 'I', r: st[3].r || chr(10) || 'assistant:'}} END], lambda x: x IS NOT NULL)) AS v
    FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
ended AS (SELECT conv_id, v.c AS c, v.a AS a, v.r AS r FROM finished),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                count(*) FILTER (truncated) AS truncated, count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM j GROUP BY conv_id)"""


def _turned(x: str, by: int) -> str:
    return f"((({x}) & {(1 << (60 - by)) - 1}) << {by} | (({x}) >> {60 - by}))"


def winnowed() -> str:
    """CTEs e (doc_id, t, nx, ed) and fp (x, print, hashes) over documents; ids are unique."""
    turned = ", ".join(f"{_turned(f'h[i + {4 - by}]', by)}" for by in (4, 3, 2, 1))
    a, b, c, d = turned.split(", ")
    return rf"""
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nx FROM d),
e AS (SELECT doc_id, t, nx, left(t, length(t) - length(t) // 4) || left(nx, length(t) // 4) AS ed FROM n),
x AS (SELECT t AS x FROM e UNION SELECT ed FROM e),
w AS (SELECT x, {_item_words('x')} AS w FROM x),
u AS (SELECT x, CASE WHEN len(w) > 0 THEN flatten(list_transform(w, lambda y: CASE WHEN length(y) > 24 THEN regexp_extract_all(y, '(?s).') ELSE [y] END))
                     WHEN x = '' THEN [] ELSE [x] END AS u FROM w),
each AS (SELECT y, ({_crc32('y')} << 28) | ({_crc32('to_base64(encode(y))')} >> 4) AS v FROM (SELECT DISTINCT unnest(u) AS y FROM u)),
place AS (SELECT x, unnest(u) AS y, unnest(range(len(u))) AS i FROM u),
h AS (SELECT u.x, coalesce(list(v ORDER BY i) FILTER (v IS NOT NULL), []) AS h FROM u LEFT JOIN place ON place.x = u.x LEFT JOIN each ON each.y = place.y GROUP BY u.x),
g AS (SELECT x, CASE WHEN len(h) >= 5 THEN list_transform(range(1, len(h) - 3), lambda i: xor(xor(xor(xor({a}, {b}), {c}), {d}), h[i + 4]))
                     WHEN len(h) > 0 THEN [list_reduce(h, lambda p, q: xor({_turned('p', 1)}, q))] ELSE [] END AS g FROM h),
p AS (SELECT x, g, list_transform(range(1, len(g) + 1), lambda j: (g[j] >> 28) * 2147483648 + 2147483648 - j) AS p FROM g),
s AS (SELECT x, g, CASE WHEN len(g) = 0 THEN [] ELSE list_sort(list_transform(list_distinct(list_transform(range(1, greatest(len(g) - 7, 1) + 1), lambda i: list_min(p[i:i + 7]))),
             lambda k: 2147483647 - (k & 2147483647))) END AS s FROM p),
fp AS (SELECT x, array_to_string(list_transform(s, lambda q: q || ':' || format('{{:x}}', g[q + 1])), ',') AS print, list_distinct(list_transform(s, lambda q: g[q + 1])) AS hashes FROM s)"""


def _alike(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"


SQL = {
    "op1_decontaminate": f"""WITH {hits('documents', 'benchmark')}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op2_ngram_join": f"""WITH RECURSIVE {near('documents')}
SELECT doc_id, class_id, n_links FROM near""",
    "op3_quality_rules": f"""WITH {measures('documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND verdict AS kept FROM judged""",
    "op8_url_rules": """
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
b AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM b),
rules(action, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (SELECT page_id, max_by(struct_pack(rule := rh || rp, action := action), length(rh || rp)) AS best FROM c, rules
        WHERE (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT c.page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM c LEFT JOIN fit USING (page_id)""",
    "op9_line_dedup": f"""WITH {lines('documents')}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM cleaned""",
    "op12_repair_conversations": f"""WITH RECURSIVE {repaired()}
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(c, 0) AS cost, coalesce(a, '') AS audit, sha256(substr(coalesce(r, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM i.conv_id""",
    "op13_fingerprints": f"""WITH {winnowed()}
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(ed) AS edited_sha256, own.print AS fingerprint, edit.print AS edited_fingerprint,
       {_alike('own.hashes', 'edit.hashes')} AS near_edited, {_alike('own.hashes', 'follow.hashes')} AS near_next
FROM e JOIN fp own ON own.x = e.t JOIN fp edit ON edit.x = e.ed JOIN fp follow ON follow.x = e.nx""",
}
