"""Conversation repair by Hirschberg's divide and conquer.

A conversation should read system?, then user and assistant in turns. Its rows are kept, given another role, deleted, or
joined by inserted empty turns, at the least cost; of equally cheap repairs the one whose letters (D, I, K, R) come first.

Four states tell what a repaired conversation ends with: nothing, a system turn, a user turn, an assistant turn. A row is a
four by four matrix of costs under (min, +), and so is any stretch of rows. Rows are dealt by range over (conversation, turn),
so a conversation of any length is spread over tasks, and cut into chunks of bounded length. Each chunk leaves its matrix;
from the end of a conversation the matrices give the costs that follow each chunk. A chunk is then solved by itself: forward
costs of its first half and backward costs of its second meet in the middle, crossings that are not cheapest are closed, and
both halves are solved the same way. Only vectors of four costs are kept along the recursion. Which state a chunk begins with
is known once those before it are solved, so later chunks are solved for each of the four; a last pass along the
conversation picks one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import SPACES, written

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
#: What an inserted turn, or one given a role, makes of each state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Cost of the turns that a conversation ending in each state still lacks.
CLOSE = (0, 2 * INSERT, INSERT, 0)
OPEN_TO = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LETTERS = "sua"
LEGAL = frozenset(("su", "ua", "au"))
#: Rows, and characters of them, in a chunk.
CHUNK_ROWS, CHUNK_CHARS = 1000, 2_000_000

Vector = tuple[int, int, int, int]


def kind_of(role: str, unfinished: bool) -> int:
    """Of a row that may stay: the place of its role's first letter in LETTERS, 3 for others, and 4 more if it is unfinished."""
    return (LETTERS.find(role[:1]) if role[:1] else -1) % 4 + 4 * unfinished


def _edits(kind: int, state: int) -> list[tuple[str, int, int]]:
    """Ways to deal with a row itself in a state: letter, state after it, cost."""
    penalty = UNFINISHED if kind >= 4 else 0
    out = [("D", state, DELETE), ("R", NEXT[state], REROLE + penalty)]
    after = OPEN_TO.get(LETTERS[kind % 4:kind % 4 + 1], {}).get(state)
    return out if after is None else [*out, ("K", after, KEEP + penalty)]


def _matrix(kind: int) -> list[list[tuple[int, int]]]:
    """Per state before a row the states after it and their costs, with turns inserted before the row."""
    out = []
    for state in range(4):
        best = [FAR] * 4
        at, spent = state, 0
        for _ in range(3):
            for _, after, cost in _edits(kind, at):
                best[after] = min(best[after], spent + cost)
            at, spent = NEXT[at], spent + INSERT
        out.append([(t, c) for t, c in enumerate(best) if c < FAR])
    return out


MATRIX = [_matrix(k) for k in range(8)]
EDITS = [[sorted(_edits(k, s)) for s in range(4)] for k in range(8)]


def backward(kind: int, follow: Vector) -> Vector:
    """Costs from before a row, by state, given those from behind it."""
    return tuple([min([c + follow[t] for t, c in row]) for row in MATRIX[kind]])


def forward(kind: int, costs: Vector) -> Vector:
    """Costs of each state behind a row, given those before it."""
    out = [FAR] * 4
    for c0, row in zip(costs, MATRIX[kind], strict=True):
        for t, c in row:
            out[t] = min(out[t], c0 + c)
    return tuple(out)


def _one(kind: int, state: int, follow: Vector) -> tuple[str, int]:
    """The first letters, by ASCII, among the cheapest ways over one row, and the state they lead to."""
    letters = ""
    costs = backward(kind, follow)
    while True:
        # Letters in order: D, then an insertion, then K or R.
        (_, same, cost), *others = EDITS[kind][state]
        if cost + follow[same] == costs[state]:
            return letters + "D", same
        if INSERT + costs[NEXT[state]] == costs[state]:
            letters, state = letters + "I", NEXT[state]
            continue
        for letter, after, cost in others:
            if cost + follow[after] == costs[state]:
                return letters + letter, after
        raise AssertionError("no way over a row has the least cost")


def hirschberg(kinds: bytes, state: int, follow: Vector) -> tuple[list[str], int]:
    """Letters for each row, and the state behind them, from a state before them and the costs that follow them."""
    out: list[str] = []

    def solve(low: int, high: int, state: int, follow: Vector) -> int:
        if high - low == 1:
            letters, state = _one(kinds[low], state, follow)
            out.append(letters)
            return state
        middle = (low + high) // 2
        ahead = tuple(0 if s == state else FAR for s in range(4))
        for kind in kinds[low:middle]:
            ahead = forward(kind, ahead)
        behind = follow
        for kind in reversed(kinds[middle:high]):
            behind = backward(kind, behind)
        least = min(a + b for a, b in zip(ahead, behind, strict=True))
        # Of the crossings left open, the first half takes the one whose letters come first.
        crossings = tuple(b if a + b == least else FAR for a, b in zip(ahead, behind, strict=True))
        return solve(middle, high, solve(low, middle, state, crossings), follow)

    return out, solve(0, len(kinds), state, follow) if kinds else state


class Chunk(NamedTuple):
    """Consecutive rows of a conversation. ``marks`` has a row's kind, or minus the number of rows that have to go."""

    key: str
    dated: bool
    turn: int | None
    sign: str
    costs: list[int]
    marks: list[int]
    roles: list[str]
    texts: list[str]
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first_letter: str
    last_letter: str
    last_turn: int | None
    turns: int


PLACE = ["key", "dated", "turn", "sign"]
CHUNK_SCHEMA = ("key string, dated boolean, turn long, sign string, costs array<long>, marks array<long>, roles array<string>, texts array<string>, "
                "blank long, duplicate long, truncated long, illegal long, first_letter string, last_letter string, last_turn long, turns long")


def chunk_of(rows: list[dict]) -> Chunk:
    """Judges consecutive rows of one conversation (columns of ``_ordered``)."""
    marks: list[int] = []
    kept: list[dict] = []
    blank = duplicate = truncated = illegal = turns = 0
    letter, turn = None, None
    for r in rows:
        body = r["text"].rstrip(SPACES)
        copies = r["copies"]
        initial = r["role"][:1]
        illegal += copies - 1 + (letter is not None and letter + initial not in LEGAL)
        letter = initial
        turns += r["turn"] is not None and r["turn"] != turn
        turn = r["turn"]
        gone = copies
        if not body:
            blank += copies
        else:
            duplicate += copies - r["first"]
            if r["first"]:
                gone -= 1
                unfinished = body[-1] not in ".!?"
                truncated += unfinished
                marks.append(kind_of(r["role"], unfinished))
                kept.append(r)
        if gone:
            marks.append(-gone)
    costs = []
    kinds = bytes(m for m in marks if m >= 0)
    spent = -DELETE * sum(m for m in marks if m < 0)
    for state in range(4):
        vector = tuple(0 if s == state else FAR for s in range(4))
        for kind in kinds:
            vector = forward(kind, vector)
        costs += [min(c + spent, FAR) for c in vector]
    return Chunk(rows[0]["key"], rows[0]["dated"], rows[0]["turn"], rows[0]["sign"], costs, marks, [r["role"] for r in kept], [r["text"] for r in kept],
                 blank, duplicate, truncated, illegal, rows[0]["role"][:1], letter, turn, turns)


def _key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _ordered(turns: DataFrame) -> DataFrame:
    """Different rows of each conversation with the number of their copies, and whether role and text come first there."""
    rows = turns.select(_key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text")).groupBy("key", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    dated = F.col("turn").isNotNull()
    signed = rows.withColumn("dated", dated).withColumn("sign", F.md5(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text")))
    first = signed.groupBy("key", "sign").agg(F.min(F.struct("dated", "turn")).alias("least"))
    judged = signed.join(first, ["key", "sign"]).withColumn("first", F.struct("dated", "turn").eqNullSafe(F.col("least"))).drop("least")
    return judged.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)


def _record(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _stream(df: DataFrame, step: Callable[[Iterator[dict]], Iterator[tuple]], schema: str) -> DataFrame:
    """Runs a generator of tuples over the rows of each partition in order, a few at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(_parsed(df, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for out in step(row for batch in batches for small in _slices(batch) for row in small.to_pylist()):
            held.append(out)
            if len(held) == 500:
                yield _record(held, kind)
                held = []
        if held:
            yield _record(held, kind)

    return df.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _parsed(df: DataFrame, schema: str):
    return df.sparkSession.createDataFrame([], schema).schema


def _cut(rows: Iterator[dict]) -> Iterator[Chunk]:
    held: list[dict] = []
    chars = 0
    for row in rows:
        if held and (held[0]["key"] != row["key"] or len(held) >= CHUNK_ROWS or chars >= CHUNK_CHARS):
            yield chunk_of(held)
            held, chars = [], 0
        held.append(row)
        chars += len(row["text"])
    if held:
        yield chunk_of(held)


def _follow(chunks: Iterator[dict]) -> Iterator[tuple]:
    """Chunks from the last to the first: the costs that follow each, and whether it is the first of its conversation.

    The first one is known by what comes next, so rows are given out one late.
    """
    key, behind, late = None, CLOSE, None
    for c in chunks:
        if late is not None:
            yield (*late, c["key"] != key)
        if c["key"] != key:
            key, behind = c["key"], CLOSE
        late = (c["key"], c["dated"], c["turn"], c["sign"], list(behind))
        behind = tuple(min(c["costs"][4 * s + t] + behind[t] for t in range(4)) for s in range(4))
    if late is not None:
        yield (*late, True)


def _solve(chunks: Iterator[dict]) -> Iterator[tuple]:
    """Letters of a chunk, and the state behind it, for each state before it; a first chunk begins with nothing."""
    for c in chunks:
        kinds = bytes(m for m in c["marks"] if m >= 0)
        audits, after = [], []
        for state in range(1 if c["opening"] else 4):
            letters, end = hirschberg(kinds, state, tuple(c["follow"]))
            given = iter(letters)
            audits.append("".join(next(given) if m >= 0 else "D" * -m for m in c["marks"]))
            after.append(end)
        yield (*[c[n] for n in Chunk._fields if n != "costs"], audits, after)


SOLVED_SCHEMA = CHUNK_SCHEMA.replace("costs array<long>, ", "") + ", audits array<string>, after array<int>"


def solved(turns: DataFrame) -> DataFrame:
    """The chunks of all conversations with their letters for each state they may begin with; repartitioned and sorted along each."""
    chunks = written(_stream(_ordered(turns), _cut, CHUNK_SCHEMA))
    last_first = [F.col("key"), *[F.col(c).desc() for c in PLACE[1:]]]
    order = chunks.select(*PLACE, "costs").repartition("key").sortWithinPartitions(*last_first)
    follow = _stream(order, _follow, "key string, dated boolean, turn long, sign string, follow array<long>, opening boolean")
    follow = follow.withColumnsRenamed({c: f"f_{c}" for c in PLACE})
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in PLACE]
    joined = chunks.join(follow, same).drop(*[f"f_{c}" for c in PLACE])
    return _stream(joined, _solve, SOLVED_SCHEMA).repartition("key").sortWithinPartitions(*PLACE)


def _walk(chunk: dict, state: int) -> Iterator[tuple[str, str | None, str, int]]:
    """Letter, role and text (none for a deleted row) and cost of each edit."""
    letters, kept = iter(chunk["audits"][state]), iter(zip(chunk["roles"], chunk["texts"], strict=True))
    for mark in chunk["marks"]:
        if mark < 0:
            for _ in range(-mark):
                yield next(letters), None, "", DELETE
            continue
        role, text = next(kept)
        penalty = UNFINISHED if mark >= 4 else 0
        while (letter := next(letters)) == "I":
            state = NEXT[state]
            yield "I", ROLES[state], "", INSERT
        if letter == "D":
            yield "D", None, "", DELETE
        elif letter == "R":
            state = NEXT[state]
            yield "R", ROLES[state], text, REROLE + penalty
        else:
            state = OPEN_TO[role[0]][state]
            yield "K", role, text, KEEP + penalty


def _closing(state: int) -> Iterator[tuple[str, str, str, int]]:
    """The turns that a conversation still lacks at its end."""
    while CLOSE[state]:
        state = NEXT[state]
        yield "I", ROLES[state], "", INSERT


def _turns(chunks: Iterator[dict]) -> Iterator[tuple]:
    key, state, place = None, NOTHING, 0
    for c in chunks:
        if c["key"] != key:
            for letter, role, text, _ in _closing(state) if key is not None else ():
                yield key, place, role, text, letter
                place += 1
            key, state, place = c["key"], NOTHING, 0
        for letter, role, text, _ in _walk(c, state):
            if role is not None:
                yield key, place, role, text, letter
                place += 1
        state = c["after"][state]
    for letter, role, text, _ in _closing(state) if key is not None else ():
        yield key, place, role, text, letter
        place += 1


class _Digest:
    """What is told of one conversation, chunk by chunk."""

    def __init__(self, key: str):
        self.key, self.state, self.cost = key, NOTHING, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.turn: int | None = None
        self.letter: str | None = None
        self.audit: list[str] = []
        self.hash, self.begun = hashlib.sha256(), False

    def edit(self, letter: str, role: str | None, text: str, cost: int) -> None:
        self.cost += cost
        if role is not None:
            self.hash.update(("\n" * self.begun + f"{role}:{text}").encode())
            self.begun = True

    def add(self, c: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + c[name])
        self.illegal += self.letter is not None and self.letter + c["first_letter"] not in LEGAL
        self.letter = c["last_letter"]
        self.turns += c["turns"] - (c["turn"] is not None and c["turn"] == self.turn)
        self.turn = c["last_turn"]
        for e in _walk(c, self.state):
            self.edit(*e)
        self.audit.append(c["audits"][self.state])
        self.state = c["after"][self.state]

    def row(self) -> tuple:
        for e in _closing(self.state):
            self.edit(*e)
            self.audit.append("I")
        return (self.key, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _digests(chunks: Iterator[dict]) -> Iterator[tuple]:
    digest: _Digest | None = None
    for c in chunks:
        if digest is None or digest.key != c["key"]:
            if digest is not None:
                yield digest.row()
            digest = _Digest(c["key"])
        digest.add(c)
    if digest is not None:
        yield digest.row()


def _ids(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", _key(F.col("conv_id")).alias("key")).distinct()


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), role, text, edit (K kept, R given a role, I inserted).

    A conversation of which nothing stays has none. For the rest see ``repair``.
    """
    rows = _stream(solved(turns), _turns, "key string, place long, role string, text string, edit string")
    return rows.join(_ids(turns), "key").select("conv_id", "place", "role", "text", "edit")


def repair(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has conv_id, turn, role, text; rows are taken by turn, those without one first, and those that share one by an
    MD5 of role and text. A null role or text is one space; a null conv_id is a conversation like others. Rows that repeat
    count each, the later ones as duplicates. Conversations of ``all_ids`` (conv_id) without rows have zeros, an empty audit and
    the hash of an empty text. An empty table gives no rows. Other columns, whatever their names, are not read. A conversation
    may hold any share of the rows; its audit is one string and its hash one pass, the rest is done by chunks.
    """
    told = _stream(solved(turns), _digests, "key string, turns long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    span = turns.groupBy(_key(F.col("conv_id")).alias("key")).agg((F.max("turn") - F.min("turn") + 1).cast("long").alias("span"))
    ids = _ids(turns if all_ids is None else all_ids)
    zero = F.lit(0).cast("long")
    return ids.join(told, "key", "left").join(span, "key", "left").select(
        "conv_id", F.coalesce(F.col("span") - F.col("turns"), zero).alias("gaps"), *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damage(turns: DataFrame) -> DataFrame:
    """Turns broken on purpose, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes it a user's. Nulls of role and text become one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    role = F.when(kind == 4, "user").otherwise(part("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    twice = rows.where("kind = 3")
    return rows.unionByName(twice).drop("kind")
