"""Chat formatting: minimum-cost repair of the order of roles, then rendering.

Legal is an optional system turn, then user and assistant in turn, ending with the assistant. A turn may be relabelled, may
be merged into the one before it, and empty turns may be inserted; a shortest path through the legal-turn automaton
finds the cheapest repair of a conversation. Equal costs are settled by a fixed order, so reruns agree.

A conversation may hold a third of all turns, so no task gets one whole. Turns are sorted over all tasks by conversation
and place, and cut into chunks of at most ``CHUNK`` turns. Min-plus algebra does the rest: a chunk's table of the least cost
from each role before it to each role after it is all that the search over a conversation's chunks needs, and once each
chunk knows its two ends, it finds its own turns by itself.

The result has a row per turn, with the text fragment that it adds. A conversation's fragments, joined in order of
``position``, are its rendering; those of merged turns continue the turn before.

Defined results: turns are ordered by number (nulls last), then role and text; rows that repeat are turns that repeat. A null
conversation id is a conversation like any other. Null or unknown roles fit no role and cost ``UNKNOWN`` to relabel. A null
text is empty. Control marks within texts are broken up, so that no text can open a turn. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from posledger.llm.common import text_of
from posledger.sources.tables import stage

#: States of the automaton: nothing yet, and the role of the last turn.
STATES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: Other names of the roles.
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT,
           "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT}
#: The empty turns that lead legally from one state to a turn of a role.
PATHS = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,), (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,), (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,)}
ENDINGS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}

MERGE, INSERT, RELABEL, UNKNOWN = 1, 2, 3, 1
NEVER = 1 << 40
CHUNK = 1024
OUT = 2000
OPEN, CLOSE, JOINT = "<|{}|>\n", "<|end|>\n", "\n\n"

CHUNKED = ("conv_id long, turn long, role string, text string, chunk long, nr int, n_turns int, costs array<long>")
CHUNKED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("chunk", pa.int64()),
    ("nr", pa.int32()), ("n_turns", pa.int32()), ("costs", pa.list_(pa.int64()))])
ENDS = "chunk long, first long, entry int, exit int, last boolean"
ENDS_ARROW = pa.schema([("chunk", pa.int64()), ("first", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()),
                        ("last", pa.bool_())])
REPAIRED = ("conv_id long, position long, turn long, role string, new_role string, action string, "
            "inserted array<string>, appended array<string>, cost long, fragment string")
REPAIRED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("new_role", pa.string()), ("action", pa.string()), ("inserted", pa.list_(pa.string())),
    ("appended", pa.list_(pa.string())), ("cost", pa.int64()), ("fragment", pa.string())])


class Move(NamedTuple):
    cost: int
    before: int
    after: int
    merge: bool
    path: tuple[int, ...]


def role_of(name: str | None) -> int | None:
    return ALIASES.get((name or "").strip().lower())


def _moves(role: int | None) -> list[Move]:
    """All ways to take a turn of a role, the preferred of equal costs first."""
    moves = []
    for after in (role, *(r for r in (USER, ASSISTANT, SYSTEM) if r != role)):
        if after is None:
            continue
        label = 0 if after == role else UNKNOWN if role is None else RELABEL
        for before in range(4):
            if before == after:
                moves.append(Move(label + MERGE, before, after, True, ()))
            if (before, after) in PATHS:
                path = PATHS[before, after]
                moves.append(Move(label + INSERT * len(path), before, after, False, path))
    return sorted(moves, key=lambda m: m.cost)


MOVES = {role: _moves(role) for role in (None, SYSTEM, USER, ASSISTANT)}


def step(costs: list[int], role: int | None) -> tuple[list[int], list[Move | None]]:
    """Least costs after one more turn, and the move that each state is reached by."""
    best, by = [NEVER] * 4, [None] * 4
    for move in MOVES[role]:
        total = costs[move.before] + move.cost
        if total < best[move.after]:
            best[move.after], by[move.after] = total, move
    return best, by


def ending_cost(state: int) -> int:
    return INSERT * len(ENDINGS[state])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == OUT:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of sorted rows by chunk, and add a row with each chunk's cost table."""

    def numbered():
        task, made = TaskContext.get().partitionId() << 32, -1
        conv, nr, tables = object(), 0, []

        def table():
            return (conv, None, None, None, task | made, None, nr, [c for costs in tables for c in costs])

        for conv_id, turn, role, text in _rows(batches):
            if conv_id != conv or nr == CHUNK:
                if made >= 0:
                    yield table()
                conv, nr, made = conv_id, 0, made + 1
                tables = [[NEVER if i != s else 0 for i in range(4)] for s in range(4)]
            yield conv_id, turn, role, text, task | made, nr, None, None
            tables = [step(costs, role_of(role))[0] for costs in tables]
            nr += 1
        if made >= 0:
            yield table()

    return _batches(numbered(), CHUNKED_ARROW)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The roles before and after each chunk, from the cost tables of whole conversations in order."""

    def solved():
        conv, held = object(), []
        for conv_id, chunk, n_turns, costs in _rows(batches):
            if conv_id != conv:
                yield from path(held)
                conv, held = conv_id, []
            held.append((chunk, n_turns, costs))
        yield from path(held)

    def path(held):
        best, back = [0, NEVER, NEVER, NEVER], []
        for _, _, costs in held:
            ways = [[best[s] + costs[4 * s + q] for s in range(4)] for q in range(4)]
            back.append([w.index(min(w)) for w in ways])
            best = [min(w) for w in ways]
        if not held:
            return
        final = [c + ending_cost(s) for s, c in enumerate(best)]
        state, out, at = final.index(min(final)), [], sum(h[1] for h in held)
        for i in range(len(held) - 1, -1, -1):
            at -= held[i][1]
            out.append((held[i][0], at, back[i][state], state, i == len(held) - 1))
            state = back[i][state]
        yield from out

    return _batches(solved(), ENDS_ARROW)


def repair_chunk(roles: list[str | None], entry: int, exit_: int) -> list[Move]:
    """The cheapest moves from one end of a chunk to the other."""
    costs = [NEVER] * 4
    costs[entry] = 0
    trail = []
    for role in roles:
        costs, by = step(costs, role_of(role))
        trail.append(by)
    moves, state = [], exit_
    for by in reversed(trail):
        moves.append(by[state])
        state = by[state].before
    return moves[::-1]


def _turn(role: int, text: str = "") -> str:
    return OPEN.format(STATES[role]) + text.replace("<|", "<\\|")


def fragment(move: Move, text: str, appended: tuple[int, ...], last: bool) -> str:
    """What a turn adds to the rendering."""
    if move.merge:
        out = JOINT + text.replace("<|", "<\\|")
    else:
        out = CLOSE if move.before != START else ""
        out += "".join(_turn(r) + CLOSE for r in move.path) + _turn(move.after, text)
    return out + (CLOSE + "".join(_turn(r) + CLOSE for r in appended) if last else "")


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of rows sorted by chunk; holds one chunk."""

    def repaired():
        chunk, held = None, []
        for row in _rows(batches):
            if row[0] != chunk:
                yield from done(held)
                chunk, held = row[0], []
            held.append(row)
        yield from done(held)

    def done(held):
        if not held:
            return
        moves = repair_chunk([r[4] for r in held], held[0][7], held[0][8])
        for i, ((_, nr, conv_id, turn, role, text, first, _, exit_, last), move) in enumerate(zip(held, moves)):
            final = last and i == len(held) - 1
            appended = ENDINGS[exit_] if final else ()
            label = "keep" if role_of(role) == move.after else "relabel"
            action = ("merge" if label == "keep" else "relabel and merge") if move.merge else label
            yield (conv_id, first + nr, turn, role, STATES[move.after], action, [STATES[r] for r in move.path],
                   [STATES[r] for r in appended], move.cost + INSERT * len(appended),
                   fragment(move, text, appended, final))

    return _batches(repaired(), REPAIRED_ARROW)


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per turn: conv_id, position, turn, role, new_role, action, inserted, appended, cost, fragment."""
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).cast("string").alias("role"), text_of(text).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), "role", "text"]
    chunked = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, CHUNKED), "chat-chunks")
    tables = chunked.where("costs is not null").select("conv_id", "chunk", "n_turns", "costs")
    ends = tables.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(_ends, ENDS)
    known = chunked.where("costs is null").select("chunk", "nr", "conv_id", "turn", "role", "text").join(
        stage(ends, "chat-ends"), "chunk")
    return known.repartition("chunk").sortWithinPartitions("chunk", "nr").mapInArrow(_repair, REPAIRED)
