"""Repair of conversation structure by a dynamic program over turns.

Role initials of a repaired conversation read ``(s?(ua)+)?``. Every row is kept,
given another role or deleted, and turns may be inserted. Conversations are
bucketed by length; in each bucket the rows of all conversations form a tensor
with time first, and one step updates the costs of every state of every
conversation at once. The costs to the end are stored, and the cheapest edits
are traced forward, all conversations together, taking the least letter first.

A conversation over ``LONG_ROWS`` rows or ``LONG_BYTES`` is cut into segments. A
segment is a map from the costs behind it to the costs before it, so segments
are mapped in parallel, their maps are chained per conversation, and each is
traced by itself from the state that the one before it leaves. What has to go in
order is the digest of the repaired text: one task reads a long conversation's
rows one by one and holds none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.operators.ranking import dense_row_number

from .frames import BROADCAST_ROWS, bound_batches, give_back, join_counted, need_columns, reliable, unpacked

BLANKS = " \t\n\v\f\r"
RETAG, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State that a new user or assistant turn leads to from each state.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Role classes by initial; class 3 is any other.
_CLASS = {"s": 0, "u": 1, "a": 2}
#: State after keeping a row of each class (columns) in each state; -1: not allowed.
_KEEP = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: Faults of a row, in the order in which they are looked for.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
_BIG = 1 << 40
_LETTERS = np.frombuffer(b"DIKR", np.uint8)
#: Beyond either a conversation is cut, into segments of so many rows.
LONG_ROWS, LONG_BYTES = 4096, 64 << 20
#: Conversations and text that a task gathers before it runs the program.
HELD_ROWS, HELD_BYTES = 50_000, 16 << 20
_ROLES = {USER: "user", ASSISTANT: "assistant", START: "", SYSTEM: ""}


# --- the program, on codes --------------------------------------------------
# A code is 4 * fault + role class. Costs at a row include what may be inserted
# before it.


def _inserted(base: np.ndarray) -> np.ndarray:
    """Costs ``[state, conversation]`` with turns inserted before going on."""
    out = base.copy()
    out[USER] = np.minimum(base[USER], base[ASSISTANT] + INSERT)
    out[ASSISTANT] = np.minimum(base[ASSISTANT], base[USER] + INSERT)
    for state in (START, SYSTEM):
        out[state] = np.minimum(base[state], out[USER] + INSERT)
    return out


def _at_end(n: int) -> np.ndarray:
    """Costs where conversations end: empty, or after an assistant's turn."""
    return np.repeat(np.array([0, _BIG, _BIG, 0], np.int64)[:, None], n, axis=1)


def _costs(codes: np.ndarray, lengths: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end, ``[time, state, conversation]``, from the codes
    ``[time, conversation]`` and the costs ``[state, conversation]`` behind them."""
    steps, n = codes.shape
    out = np.empty((steps + 1, 4, n), np.int64)
    out[steps] = after
    every = np.arange(n)
    for t in range(steps - 1, -1, -1):
        fault, kind, then = codes[t] >> 2, codes[t] & 3, out[t + 1]
        stays = (fault == SOUND) | (fault == CUT_OFF)
        extra = np.where(fault == CUT_OFF, TRUNCATED, 0)
        best = then + DELETE
        for state in range(4):
            to = _KEEP[state][kind]
            keep = np.where(stays & (to >= 0), then[to, every] + extra, _BIG)
            retag = np.where(stays, then[_NEXT[state]] + extra + RETAG, _BIG)
            best[state] = np.minimum(np.minimum(best[state], keep), retag)
        out[t] = np.where(t < lengths, _inserted(best), then)
    return out


def _trace(codes: np.ndarray, lengths: np.ndarray, costs: np.ndarray, state: np.ndarray, closing: bool) -> tuple[np.ndarray, np.ndarray]:
    """Letters ``[step, conversation]`` (0 where none) of the cheapest edits, the
    least in ASCII order, and the state that each conversation ends in.

    A letter decides where it leads, so the least letter on a cheapest way, taken
    again and again, gives the least string. Only the end of a conversation
    (``closing``) has insertions behind its last row.
    """
    steps, n = codes.shape
    every = np.arange(n)
    codes = np.vstack([codes, np.zeros((1, n), codes.dtype)])
    at, state, letters = np.zeros(n, np.int64), state.copy(), []
    unfinished = _at_end(1)[:, 0] > 0
    while True:
        here, ended = costs[at, state, every], at == lengths
        fault, kind = codes[at, every] >> 2, codes[at, every] & 3
        then = np.minimum(at + 1, steps)
        stays = ~ended & ((fault == SOUND) | (fault == CUT_OFF))
        extra = np.where(fault == CUT_OFF, TRUNCATED, 0)
        kept, new = _KEEP[state, kind], _NEXT[state]
        insert = (costs[at, new, every] + INSERT == here) & np.where(ended, closing & unfinished[state], True)
        options = (
            (~ended & (costs[then, state, every] + DELETE == here), state, 1),
            (insert, new, 0),
            (stays & (kept >= 0) & (costs[then, kept, every] + extra == here), kept, 1),
            (stays & (costs[then, new, every] + extra + RETAG == here), new, 1),
        )
        letter, to, moved = np.zeros(n, np.uint8), state, np.zeros(n, np.int64)
        for i in reversed(range(4)):
            able, where, step = options[i]
            letter, to, moved = np.where(able, _LETTERS[i], letter), np.where(able, where, to), np.where(able, step, moved)
        if not letter.any():
            return np.array(letters, np.uint8).reshape(len(letters), n), state
        letters.append(letter)
        state, at = to, at + moved


def edits(codes: list[np.ndarray], after: np.ndarray | None = None, state: np.ndarray | None = None) -> list[tuple[np.ndarray, str, int]]:
    """Per conversation: its costs to the end from each state, the letters of
    the cheapest edits from ``state``, and the state that these leave.

    With ``after`` the codes are segments, and these the costs behind them.
    """
    n, closing = len(codes), after is None
    after = _inserted(_at_end(n)) if closing else after
    state = np.full(n, START) if state is None else state
    out: list = [None] * n
    lengths = np.array([len(c) for c in codes], np.int64)
    size = np.ceil(np.log2(np.maximum(lengths, 1)))
    for s in np.unique(size):  # buckets: conversations of alike length
        which = np.flatnonzero(size == s)
        tensor = np.zeros((lengths[which].max(), len(which)), np.int64)
        for j, i in enumerate(which):
            tensor[: lengths[i], j] = codes[i]
        costs = _costs(tensor, lengths[which], after[:, which])
        letters, left = _trace(tensor, lengths[which], costs, state[which], closing)
        for j, i in enumerate(which):
            own = letters[:, j]
            out[i] = (costs[0, :, j], own[own > 0].tobytes().decode(), int(left[j]))
    return out


def _turn(letter: str, role: str, text: str, state: int) -> tuple[str, int]:
    """The repaired turn that K, R or I makes in a state, and the next state."""
    if letter == "K":
        return f"{role}:{text}", int(_KEEP[state, _CLASS[role[0]]])
    state = int(_NEXT[state])
    return f"{_ROLES[state]}:{text if letter == 'R' else ''}", state


def apply(audit: str, rows: list[tuple[str, str]], state: int = START) -> tuple[list[str], int]:
    """The turns that the letters of ``audit`` make of ``(role, text)`` rows."""
    out, at = [], 0
    for letter in audit:
        role, text = rows[at] if letter != "I" else ("", "")
        at += letter != "I"
        if letter != "D":
            turn, state = _turn(letter, role, text, state)
            out.append(turn)
    return out, state


# --- rows -------------------------------------------------------------------

_ORDER = ("turn", "role", "text")
_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: Initials that may follow each other.
_LEGAL = {"su", "ua", "au"}


def damage(turns: DataFrame, by: int = 20) -> DataFrame:
    """``(conv_id, turn, role, text, times)``: one row in ``by`` each is dropped
    (``times`` 0), emptied, robbed of its end marks, repeated (2) or given to the
    user, by the hash of conversation and turn. Null roles and texts become one
    space, as do nulls in the hashed name."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    lot = F.crc32(name.cast("binary")) % by
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    text = F.when(lot == 1, F.lit("")).when(lot == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(lot == 4, F.lit("user")).otherwise(role)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).alias("times"))


def _own_fault(text: Column) -> Column:
    """The fault that a row has whatever stands before it."""
    bare = F.rtrim(text, F.lit(BLANKS))
    return F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(SOUND)


class _Counts:
    """What is counted over a conversation's rows as they come by turn."""

    def __init__(self):
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.first, self.last, self.n_turns = None, None, 0

    def add(self, turn: int | None, role: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in _LEGAL
        self.before = role[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.n_turns = turn, self.n_turns + 1

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.n_turns if self.n_turns else 0
        return gaps, *self.faults[1:], self.illegal


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(cols, fields)], names=[name for name, _ in fields])


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def _short(rows: DataFrame) -> DataFrame:
    """The report of conversations that a task can hold whole."""

    def repaired(held):
        found = edits([np.array(codes, np.int64) for _, _, _, codes, _ in held])
        out = []
        for (conv_id, counts, turns, _, _), (costs, audit, _) in zip(held, found):
            text = "\n".join(apply(audit, turns)[0])
            out.append((conv_id, *counts.row(), int(costs[START]), audit, hashlib.sha256(_utf8(text)).hexdigest()))
        return _batch(_OUT, out)

    def run(batches):
        held, n_rows, n_bytes, key = [], 0, 0, None
        for batch in batches:
            for k, conv_id, turn, role, text, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if not held or k != key:
                    if n_rows >= HELD_ROWS or n_bytes >= HELD_BYTES:
                        yield repaired(held)
                        held, n_rows, n_bytes = [], 0, 0
                    key = k
                    held.append((conv_id, _Counts(), [], [], set()))
                _, counts, turns, codes, seen = held[-1]
                if fault != BLANK and (role, text) in seen:
                    fault = DUPLICATE
                seen.add((role, text))
                counts.add(turn, role, fault)
                turns.append((role, text))
                codes.append(4 * fault + _CLASS.get(role[:1], 3))
                n_rows, n_bytes = n_rows + 1, n_bytes + len(text)
        if held:
            yield repaired(held)
        give_back()

    dealt = rows.repartition("key").sortWithinPartitions("key", *_ORDER)
    return dealt.select("key", "conv_id", *_ORDER, _own_fault(F.col("text")).alias("fault")).mapInArrow(run, _OUT)


# --- conversations that no task should hold ---------------------------------


def _streamed(rows: DataFrame, order: list, columns: list[str], fn, schema: str, held: int = 256) -> DataFrame:
    """Send rows, dealt by ``key`` and ordered inside it, to ``fn``: a generator
    of results that is given one conversation's rows."""

    def run(batches):
        from itertools import groupby

        def each():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns])

        out = []
        for _, group in groupby(each(), key=lambda r: r[0]):
            for row in fn(group):
                out.append(row)
                if len(out) >= held:
                    yield _batch(schema, out)
                    out = []
        if out:
            yield _batch(schema, out)
        give_back()

    return rows.repartition("key").sortWithinPartitions("key", *order).select(*columns).mapInArrow(run, schema)


def _segments(rows: DataFrame, fn, schema: str, held: int = 64) -> DataFrame:
    """Send segments, some at a time, to ``fn(codes, rows)``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, held):
                piece = batch.slice(at, held)
                i = piece.schema.get_field_index("codes")
                codes = unpacked(piece.column(i), np.int64)
                yield _batch(schema, fn(codes, piece.drop_columns(["codes"]).to_pylist()))
        give_back()

    return rows.mapInArrow(run, schema)


def _maps(codes, rows):
    """Costs from each state before a segment to each state right behind it."""
    n = len(codes)
    ends = np.full((4, 4 * n), _BIG, np.int64)
    ends[np.tile(np.arange(4), n), np.arange(4 * n)] = 0
    found = edits([c for c in codes for _ in range(4)], ends)
    return [(r["key"], r["segment"], np.array([found[4 * i + j][0] for j in range(4)]).T.ravel().tolist()) for i, r in enumerate(rows)]


def _backward(group):
    """Costs behind each segment, from the last one to the first; the first also
    carries the conversation's own cost."""
    after = _inserted(_at_end(1))[:, 0]
    for key, segment, costs in group:
        before = (np.array(costs).reshape(4, 4) + after).min(axis=1)
        yield key, segment, after.tolist(), int(before[START])
        after = before


def _exits(codes, rows):
    after = np.array([r["after"] for r in rows], np.int64).T
    found = edits([c for c in codes for _ in range(4)], np.repeat(after, 4, axis=1), np.tile(np.arange(4), len(codes)))
    return [(r["key"], r["segment"], [found[4 * i + j][2] for j in range(4)]) for i, r in enumerate(rows)]


def _forward(group):
    state = START
    for key, segment, exits in group:
        yield key, segment, state
        state = exits[state]


def _by_row(codes, rows):
    """Each row's letter, after those of the insertions before it."""
    after, state = np.array([r["after"] for r in rows], np.int64).T, np.array([r["state"] for r in rows], np.int64)
    out = []
    for (_, audit, _), r in zip(edits(codes, after, state), rows):
        start, place = 0, r["first"]
        for i, letter in enumerate(audit):
            if letter != "I":
                out.append((place, audit[start : i + 1]))
                start, place = i + 1, place + 1
    return out


def _told(group):
    """The report of one conversation from its rows in order, one at a time."""
    counts, digest, audit, state, begun, cost, conv_id = _Counts(), hashlib.sha256(), [], START, False, 0, None

    def put(letter, role="", text=""):
        nonlocal state, begun
        turn, state = _turn(letter, role, text, state)
        digest.update(_utf8("\n" + turn if begun else turn))
        begun = True

    for _, conv_id, turn, role, text, fault, letters, cost in group:
        counts.add(turn, role, fault)
        audit.append(letters)
        for letter in letters:
            if letter != "D":
                put(letter, *((role, text) if letter != "I" else ()))
    while state in (SYSTEM, USER):
        audit.append("I")
        put("I")
    yield conv_id, *counts.row(), cost, "".join(audit), digest.hexdigest()


def _long(rows: DataFrame, segment_rows: int) -> DataFrame:
    """The report of conversations that are cut into segments.

    Rows are numbered by ranges of their order, so that a conversation lies over
    many tasks until the last step, which streams it.
    """
    rows = dense_row_number(rows.withColumn("fault", _own_fault(F.col("text"))), [F.col(c) for c in ("key", *_ORDER)], "place")
    name = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    facts = reliable(rows.select("key", "place", "fault", F.substring("role", 1, 1).alias("initial"), name.alias("name")))
    total = facts.count()
    firsts = facts.groupBy("key", "name").agg(F.count("*").alias("n"), F.min("place").alias("seen"))
    begins = facts.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("begin"))
    facts = join_counted(join_counted(facts, firsts, ["key", "name"], total).drop("n"), begins, "key", total)
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    fault = F.when((F.col("fault") != BLANK) & (F.col("place") > F.col("seen")), DUPLICATE).otherwise(F.col("fault"))
    facts = reliable(facts.select("key", "place", F.expr(f"(place - begin) div {segment_rows}").alias("segment"), fault.alias("fault"), kind.alias("kind")))
    listed = F.array_sort(F.collect_list(F.struct("place", (F.col("fault") * 4 + F.col("kind")).cast("long").alias("code"))))
    segments = reliable(facts.groupBy("key", "segment").agg(F.min("place").alias("first"), F.transform(listed, lambda x: x["code"]).alias("codes")))
    maps = _segments(segments.select("key", "segment", "codes"), _maps, "key string, segment long, costs array<long>")
    after = reliable(_streamed(maps, [F.desc("segment")], ["key", "segment", "costs"], _backward, "key string, segment long, after array<long>, cost long"))
    segments = segments.join(after, ["key", "segment"])
    exits = _segments(segments.select("key", "segment", "after", "codes"), _exits, "key string, segment long, exits array<long>")
    entries = _streamed(exits, ["segment"], ["key", "segment", "exits"], _forward, "key string, segment long, state long")
    letters = _segments(segments.join(entries, ["key", "segment"]).select("first", "after", "state", "codes"), _by_row, "place long, letters string")
    edited = rows.drop("fault").join(facts.select("place", "fault"), "place").join(letters, "place")
    costs = reliable(after.where("segment = 0").select("key", "cost").join(begins.select("key", "n"), "key"))
    edited = join_counted(edited, costs, "key", total)
    return _streamed(edited, ["place"], ["key", "conv_id", *_ORDER, "fault", "letters", "cost"], _told, _OUT, held=1)


def repair(turns: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """``(conv_id, turn, role, text[, times])`` rows, to one row a conversation:
    its faults, and the cheapest repair as letters and as a digest of its text.

    A row stands ``times`` times (once where there is no such column; a
    conversation that has only rows of 0 is reported empty). Rows of a
    conversation go by turn (nulls first), then role, then text, so the result
    does not depend on how equal turns come in. Null roles and texts are one
    space; a null ``conv_id`` names a conversation of its own. Roles count by
    their first character, whatever they are; an empty role has none. Texts of
    any length are taken whole. Other columns are ignored, whatever their names.
    An empty table gives no rows.
    """
    bound_batches(turns.sparkSession)
    times = {"times": "int"} if "times" in turns.columns else {}
    rows = need_columns(turns, conv_id="long", turn="long", role="string", text="string", **times)
    rows = rows.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" ")), "times": F.col("times") if times else F.lit(1)})
    rows = rows.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    sizes = rows.groupBy("key", "conv_id").agg(F.sum("times").alias("n"), F.sum(F.col("times") * (F.octet_length("role") + F.octet_length("text"))).alias("bytes"))
    odd = reliable(sizes.where((F.col("n") == 0) | (F.col("n") > long_rows) | (F.col("bytes") > long_bytes)))
    none = odd.where("n = 0").select("conv_id", *[F.lit(0).cast("long").alias(c.split()[0]) for c in _OUT.split(", ")[1:7]], F.lit("").alias("audit"), F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256"))
    rows = rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("copy", "times")
    far = odd.where("n > 0").select("key")
    n_far = far.count()
    if not n_far:
        return _short(rows).union(none)
    far = F.broadcast(far) if n_far <= BROADCAST_ROWS else far
    return _short(rows.join(far, "key", "left_anti")).union(_long(rows.join(far, "key", "left_semi"), long_rows)).union(none)


def oracle_sql() -> str:
    """DuckDB SQL for ``repair(damage(conversations))``: the program as a fold
    from the last row on, whose states are eight digits of cost and the letters."""
    steps = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    crc = f"xor(list_reduce(encode_bytes, lambda a, b: list_reduce(range(8), lambda c, k: {steps}, xor(a, b)), 4294967295::BIGINT), 4294967295)"
    name = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    bytes_ = f"list_transform(string_split({name}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    strip = " || ".join(f"chr({ord(c)})" for c in BLANKS)

    def plus(value, cost, letter):
        return f"printf('%08d', CAST(({value})[1:8] AS BIGINT) + ({cost})) || '{letter}' || ({value})[9:]"

    big = f"'{10**7}'"

    def row(state, kept):
        """One state's value before insertion, from those behind the row."""
        new = "ua"[state == "u"] if state in "ua" else "u"
        keep = " ".join(f"WHEN x.kind = '{k}' THEN {plus('v.' + to, 'x.extra', 'K')}" for k, to in kept)
        stay = f"CASE WHEN NOT x.stays THEN {big} ELSE least({plus('v.' + new, 'x.extra + 1', 'R')}, CASE {keep} ELSE {big} END) END"
        return f"least({plus('v.' + state, 2, 'D')}, {stay})"

    def inserted(of):
        u = f"least({of['u']}, {plus(of['a'], 5, 'I')})"
        return {"e": f"least({of['e']}, {plus(u, 5, 'I')})", "s": f"least({of['s']}, {plus(u, 5, 'I')})", "u": u, "a": f"least({of['a']}, {plus(of['u'], 5, 'I')})"}

    plain = {"e": row("e", [("s", "s"), ("u", "u")]), "s": row("s", [("u", "u")]), "u": row("u", [("a", "a")]), "a": row("a", [("u", "u")])}
    base = "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in plain.items()) + ")"
    closed = "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in inserted({k: f"w.{k}" for k in "esua"}).items()) + ")"
    end = "struct_pack(e := '00000000', s := '00000010II', u := '00000005I', a := '00000000')"
    fold = f"list_reduce(list_reverse(codes), lambda v, x: list_transform([{base}], lambda w: {closed})[1], {end})"
    return f"""
WITH n AS (SELECT *, {bytes_} AS encode_bytes FROM conversations),
l AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS lot FROM n),
d AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role, CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE lot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, {strip}) AS bare FROM d),
f AS (SELECT *, left(role, 1) AS kind, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
  CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before || kind NOT IN ('su', 'ua', 'au')) AS illegal,
  list(struct_pack(kind := kind, stays := fault IN ('', 'truncated'), extra := CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END) ORDER BY i) AS codes FROM f GROUP BY conv_id),
r AS (SELECT *, ({fold}).e AS best FROM c),
t AS (SELECT conv_id, best[9:] AS audit, unnest(string_split(best[9:], '')) AS letter, generate_subscripts(string_split(best[9:], ''), 1) AS k FROM r WHERE best[9:] <> ''),
u AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS place FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
p AS (SELECT u.conv_id, u.letter, u.place, role, text, max(CASE WHEN u.letter = 'K' AND u.place = 1 AND kind = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY u.conv_id) AS led
  FROM u LEFT JOIN f ON u.conv_id IS NOT DISTINCT FROM f.conv_id AND u.i = f.i WHERE u.letter <> 'D'),
s AS (SELECT conv_id, string_agg((CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || (CASE WHEN letter = 'I' THEN '' ELSE text END),
  chr(10) ORDER BY place) AS repaired FROM p GROUP BY conv_id)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(best[1:8] AS BIGINT), 0) AS cost, coalesce(best[9:], '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN r ON k.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN s ON k.conv_id IS NOT DISTINCT FROM s.conv_id"""
