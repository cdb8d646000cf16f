"""Conversation repair against a plain dynamic programme that holds whole audits, and against every possible repair of short ones."""

import hashlib
import random
import zlib

import pytest

from tidelog.llm import repair as rp


def closed(kinds):
    """The audit that divide and conquer gives."""
    letters, state = rp.hirschberg(bytes(kinds), rp.NOTHING, rp.CLOSE)
    return "".join(letters) + "I" * (rp.CLOSE[state] // rp.INSERT)


def fits(kind, state):
    return {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}}.get(kind % 4, {}).get(state)


def then(state):
    return 3 if state == 2 else 2


def every_repair(kinds):
    """Least (cost, audit) among all repairs that cost no more than deleting every row."""
    found, most = [], 2 * len(kinds)

    def go(i, state, cost, audit):
        if cost > most:
            return
        if i == len(kinds) and state in (0, 3):
            found.append((cost, audit))
        go(i, then(state), cost + 5, audit + "I")
        if i < len(kinds):
            more = 5 if kinds[i] >= 4 else 0
            go(i + 1, state, cost + 2, audit + "D")
            go(i + 1, then(state), cost + 1 + more, audit + "R")
            if fits(kinds[i], state) is not None:
                go(i + 1, fits(kinds[i], state), cost + more, audit + "K")

    go(0, 0, 0, "")
    return min(found)


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
    seen, best = set(), {0: (0, "", ())}
    blank = duplicate = truncated = 0

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for s, (c, a, lines) in list(best.items()):
                new = (c + 5, a + "I", (*lines, ("user:" if then(s) == 2 else "assistant:")))
                best[then(s)] = min(best.get(then(s), new), new)
        return best

    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        if not body or (role, text) in seen:
            blank, duplicate = blank + (not body), duplicate + bool(body)
            best = {s: (c + 2, a + "D", lines) for s, (c, a, lines) in best.items()}
            continue
        seen.add((role, text))
        cut = body[-1] not in ".!?"
        truncated += cut
        kind, more, new = "sua".find(role[:1]) % 4 if role[:1] else 3, 5 * cut, {}
        for s, (c, a, lines) in inserted(best).items():
            ways = [("D", s, 2, lines), ("R", then(s), 1 + more, (*lines, f"{'user' if then(s) == 2 else 'assistant'}:{text}"))]
            if fits(kind, s) is not None:
                ways.append(("K", fits(kind, s), more, (*lines, f"{role}:{text}")))
            for letter, t, cost, to in ways:
                option = (c + cost, a + letter, to)
                new[t] = min(new.get(t, option), option)
        best = new
    cost, audit, lines = min(v for s, v in inserted(best).items() if s in (0, 3))
    letters = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def made(seed, n, convs):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", "  ", "", None, "Why? \n", "long " * 50 + ".", "ünïcode 😀."]
    return [(r.choice(convs), r.choice([*range(n), None]), r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"text {r.randrange(n)}{r.choice('.!? ')}") for _ in range(n)]


@pytest.mark.parametrize("n", range(6))
def test_least_and_first_of_all_repairs(n):
    r = random.Random(n)
    for _ in range(80):
        kinds = [r.randrange(8) for _ in range(n)]
        assert closed(kinds) == every_repair(kinds)[1]


def test_crossings_of_long_conversations():
    r = random.Random(9)
    for n in (33, 200, 1000):
        kinds = [r.choice([0, 1, 1, 2, 2, 3, 5, 6]) for _ in range(n)]
        best = {0: (0, "")}
        for k in kinds:
            new = {}
            opened = dict(best)
            for _ in range(3):
                for s, (c, a) in list(opened.items()):
                    opened[then(s)] = min(opened.get(then(s), (c + 5, a + "I")), (c + 5, a + "I"))
            for s, (c, a) in opened.items():
                for letter, t, cost in rp._edits(k, s):
                    new[t] = min(new.get(t, (c + cost, a + letter)), (c + cost, a + letter))
            best = new
        assert closed(kinds) == min((c + rp.CLOSE[s], a + "I" * (rp.CLOSE[s] // 5)) for s, (c, a) in best.items())[1]


@pytest.mark.parametrize("chunk", [1000, 3])
def test_repair_equals_the_plain_version(spark, monkeypatch, chunk):
    """Null conversations, turns, roles and texts, rows that repeat, ties, one conversation with most rows; whole or in small chunks."""
    monkeypatch.setattr(rp, "CHUNK_ROWS", chunk)
    rows = made(1, 400, [1, 1, 1, 1, 2, 3, None]) + made(2, 40, list(range(10, 25))) + [(5, 1, "user", "x." * 200_000), (6, None, None, None)] + [(7, 0, "user", "Hi.")] * 50
    out = rp.repair(spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, key string"))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r.conv_id: tuple(r)[1:] for r in out.collect()}
    wanted = {c: plain([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == wanted
    lines = rp.repaired_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "place").collect()
    text = {}
    for r in lines:
        text.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(text.get(c, [])).encode()).hexdigest() for c in wanted} == {c: w[-1] for c, w in wanted.items()}


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(30), None) for t, r, x in ((0, "system", "Be. Kind!"), (1, None, None), (None, "assistant", "Why?"))]
    expected = []
    for c, t, r, x in rows:
        r, x = r or " ", x or " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 1:
            x = ""
        if kind == 2:
            x = x.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            r = "user"
        expected += [(c, t, r, x)] * {0: 0, 3: 2}.get(kind, 1)
    key = lambda r: tuple((x is None, x) for x in r)
    got = rp.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_conversations_without_rows_and_empty_tables(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    nothing = turns.limit(0)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in rp.repair(nothing, all_ids=turns).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", empty)]
    assert rp.repair(nothing).count() == 0 and rp.repaired_turns(nothing).count() == 0 and rp.damage(nothing).count() == 0
