"""Chat formatting by minimum-cost repair of the roles.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, user first, assistant last. Each turn is kept, merged into the turn before,
relabelled, or preceded by an inserted empty turn; dynamic programming over the automaton's
four states finds the cheapest repair. Then the repaired turns are rendered.

Turns are dealt by a sort over (conversation, turn), so a conversation of any size spreads
over tasks, and numbered from 0 in their conversation: inside each sorted part, plus the turns
and bytes that earlier parts hold of the conversation that the part goes on with (a row per
part at most). A conversation is cut into segments where its turns reach a multiple of PIECE,
or its texts one of PIECE_BYTES; cuts follow these numbers alone, so the result does not depend
on how rows are dealt. What a segment does to the states is a 4 x 4 matrix of costs; matrices
of a conversation's segments are chained (min-plus), which fixes each one's first and last
state, and every segment is then repaired on its own. The result has a row per segment, whose
texts follow one another; a conversation within both bounds is one row.

A text cannot pass for a marker: ``<`` and ``|`` with backslashes or nothing between them get
one more backslash. ``parse`` reads the turns back.

Turns go by ``turn`` (nulls last), then role and text, so ties have an order; repeated rows
are turns of their own. Unknown and null roles cost less to relabel. Null text is empty.
Rows without a conversation id are conversations of one turn each, with a null id. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep, parts_of

PIECE = 4096
PIECE_BYTES = 8 << 20
ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "ai": "assistant"}
UNKNOWN = 3
START = 3  # states: a role's number once its turn is open, or START
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    relabel: int = 2
    label: int = 1  # an unknown role
    insert: int = 3


@dataclass(frozen=True)
class Step:
    cost: int
    state: int
    op: str  # keep, merge, relabel
    inserted: int | None


def steps(costs: Costs) -> dict[tuple[int, int], list[Step]]:
    """All moves from a state with a turn of a role, cheapest first, one per new state."""
    out = {}
    for state, role in product((0, 1, 2, START), (0, 1, 2, UNKNOWN)):
        named = lambda x, role=role: 0 if x == role else costs.label if role == UNKNOWN else costs.relabel
        moves = [Step(named(x), x, "keep" if x == role else "relabel", None) for x in NEXT[state]]
        if state != START:
            moves.append(Step(costs.merge + named(state), state, "merge", None))
        moves += [
            Step(costs.insert + named(x), x, "keep" if x == role else "relabel", y) for y in NEXT[state] for x in NEXT[y]
        ]
        rank = {"keep": 0, "merge": 1, "relabel": 2}
        best: dict[int, Step] = {}
        for m in sorted(moves, key=lambda m: (m.cost, m.inserted is not None, rank[m.op])):
            best.setdefault(m.state, m)
        out[state, role] = list(best.values())
    return out


def ending(state: int) -> tuple[int, ...]:
    """Turns to insert after the last one."""
    return {2: (), 1: (2,), 0: (1, 2), START: ()}[state]


def _forward(roles: list[int], start: int, table) -> list[dict[int, tuple[int, int, Step | None]]]:
    """Per turn: state -> (cost, state before, step)."""
    layers = [{start: (0, start, None)}]
    for role in roles:
        layer: dict[int, tuple[int, int, Step | None]] = {}
        for state in sorted(layers[-1]):
            cost = layers[-1][state][0]
            for step in table[state, role]:
                if step.state not in layer or cost + step.cost < layer[step.state][0]:
                    layer[step.state] = (cost + step.cost, state, step)
        layers.append(layer)
    return layers


def matrix(roles: list[int], table) -> list[int]:
    """Costs from each state to each state (-1: cannot be), row by row."""
    out = []
    for start in (0, 1, 2, START):
        last = {start: (0, start, None)}
        last = _forward(roles, start, table)[-1] if roles else last
        out += [last[q][0] if q in last else -1 for q in (0, 1, 2, START)]
    return out


def chain(matrices: list[list[int]], costs: Costs) -> tuple[int, list[int]]:
    """(least cost of all pieces, states before each and after the last)."""
    layers = [{START: (0, START)}]
    for m in matrices:
        layer: dict[int, tuple[int, int]] = {}
        for p in sorted(layers[-1]):
            for q in range(4):
                if m[p * 4 + q] >= 0:
                    cost = layers[-1][p][0] + m[p * 4 + q]
                    if q not in layer or cost < layer[q][0]:
                        layer[q] = (cost, p)
        layers.append(layer)
    state = min(layers[-1], key=lambda q: (layers[-1][q][0] + costs.insert * len(ending(q)), q))
    total = layers[-1][state][0] + costs.insert * len(ending(state))
    states = [state]
    for layer in reversed(layers[1:]):
        states.append(layer[states[-1]][1])
    return total, states[::-1]


def repair(roles: list[int], table, start: int = START, end: int | None = None, costs: Costs | None = None) -> list[Step]:
    """The cheapest steps from ``start`` to ``end`` (any state that is cheapest to end in)."""
    layers = _forward(roles, start, table)
    if end is None:
        each = (costs or Costs()).insert
        end = min(layers[-1], key=lambda q: (layers[-1][q][0] + each * len(ending(q)), q))
    out = []
    for layer in reversed(layers[1:]):
        _, before, step = layer[end]
        out.append(step)
        end = before
    return out[::-1]


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def parse(rendered: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation; merged texts are joined by a line break."""
    turns = re.findall(r"<\|(\w+)\|>\n(.*?)<\|end\|>\n", rendered, re.DOTALL)
    return [(role, re.sub(r"<\\(\\*)\|", r"<\1|", text)) for role, text in turns]


def render(steps: list[Step], texts: list[str], start: int, last: bool) -> tuple[str, int]:
    """(text of a piece, turns opened in it). Pieces of a conversation follow one another."""
    out, opened, state = [], 0, start

    def open_(role: int):
        nonlocal opened, state
        if state != START:
            out.append("<|end|>\n")
        out.append(f"<|{ROLES[role]}|>\n")
        opened, state = opened + 1, role

    for step, text in zip(steps, texts):
        if step.inserted is not None:
            open_(step.inserted)
        if step.op == "merge":
            out.append("\n")
        else:
            open_(step.state)
        out.append(escaped(text))
    if last and state != START:
        for role in ending(state):
            open_(role)
        out.append("<|end|>\n")
    return "".join(out), opened


def _runs(batches, keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Rows of equal first ``keys`` columns that follow one another, as columns of values."""
    now, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != now:
                if held is not None:
                    yield now, held
                now, held = row[:keys], [[] for _ in columns]
            for c, value in zip(held, row):
                c.append(value)
    if held is not None:
        yield now, held


def _numbered(rows: DataFrame, parts: int, piece: int, piece_bytes: int) -> DataFrame:
    """``rows`` (conv, turn, role, text) with ``alone, segment, place``, written.

    ``alone`` numbers rows without an id, and is -1 for others; ``place`` is the turn's number
    in its conversation.
    """
    order = ["conv", F.col("turn").asc_nulls_last(), "role", F.xxhash64("text")]

    def number(batches):
        """A turn's place, and the bytes before it, in its conversation's turns of this part."""
        part = TaskContext.get().partitionId()
        row, now, place, size = 0, None, 0, 0
        for batch in batches:
            n, at = batch.num_rows, np.arange(row, row + batch.num_rows)
            row += n
            conv = batch.column(0)
            none = conv.is_null().to_numpy(zero_copy_only=False)
            ids = conv.fill_null(0).to_numpy(zero_copy_only=False)
            places, before = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            length = pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.r_[True, (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])] if n else np.zeros(0, dtype=bool)
            for a, b in zip(np.flatnonzero(new), [*np.flatnonzero(new)[1:], n]):
                if none[a]:
                    continue
                if now != ids[a]:
                    now, place, size = ids[a], 0, 0
                places[a:b] = place + np.arange(b - a)
                before[a:b] = size + np.cumsum(length[a:b]) - length[a:b]
                place, size = place + int(b - a), size + int(length[a:b].sum())
            alone = np.where(none, (part << 40) + at, -1)
            more = {"part": np.full(n, part, dtype=np.int32), "alone": alone, "inside": places, "before": before}
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more.values())], [*batch.schema.names, *more])

    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    kinds = "conv long, turn long, role int, text string, part int, alone long, inside long, before long"
    placed = keep(ordered.mapInArrow(number, kinds), "turns")
    held = placed.where("conv is not null").groupBy("conv", "part").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")
    )
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        F.col("conv").alias("_conv"), F.col("part").alias("_part"), F.sum("n").over(earlier).alias("_n"),
        F.sum("bytes").over(earlier).alias("_bytes"),
    ).where("_n is not null")
    # a part goes on with one conversation at most
    offsets = keep(offsets, "offsets")
    start = lambda c: F.coalesce(F.col(c), F.lit(0))
    place, before = F.col("inside") + start("_n"), F.col("before") + start("_bytes")
    whole = lambda c, size: F.floor(c / F.lit(size))
    # both parts only grow along a conversation, so the sum changes where either does
    segment = whole(place, piece) + whole(before, piece_bytes)
    joined = placed.join(offsets, (placed["conv"] == offsets["_conv"]) & (placed["part"] == offsets["_part"]), "left")
    return keep(
        joined.select("conv", "alone", segment.cast("long").alias("segment"), place.alias("place"), "role", "text"), "segments"
    )


def formatted(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    costs: Costs = Costs(), aliases: dict[str, str] = ALIASES, piece: int = PIECE, piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``conv_id, segment, n_segments, cost, n_turns, n_merged, n_relabelled, n_inserted, rendered``.

    Counts are of the segment (``n_turns``: turns it opens); ``cost`` is the conversation's.
    """
    name = F.lower(F.trim(F.col(role)))
    for alias, known in aliases.items():
        name = F.when(name == alias, known).otherwise(name)
    code = F.lit(UNKNOWN)
    for k, known in enumerate(ROLES):
        code = F.when(name == known, k).otherwise(code)
    rows = turns.select(
        F.col(conversation).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), code.alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    placed = _numbered(rows, parts_of(turns), piece, piece_bytes)
    table = steps(costs)
    key = ["conv", "alone", "segment"]

    def matrices(batches):
        for key, (_, _, _, _, roles) in _runs(batches, 3):
            yield pa.RecordBatch.from_pylist(
                [{"conv": key[0], "alone": key[1], "segment": key[2], "m": matrix(roles, table)}],
                schema=pa.schema([("conv", pa.int64()), ("alone", pa.int64()), ("segment", pa.int64()), ("m", pa.list_(pa.int32()))]),
            )

    made = placed.select(*key, "place", "role").repartition(*key).sortWithinPartitions(*key, "place").mapInArrow(
        matrices, "conv long, alone long, segment long, m array<int>"
    )

    def chains(batches):
        for (conv, alone), (_, _, segment, ms) in _runs(batches, 2):
            total, states = chain(ms, costs)
            yield pa.RecordBatch.from_pylist(
                [
                    {"c": conv, "a": alone, "s": s, "start": a, "end": b, "number": k, "n_segments": len(ms), "cost": total}
                    for k, (s, a, b) in enumerate(zip(segment, states, states[1:]))
                ],
                schema=pa.schema([("c", pa.int64()), ("a", pa.int64()), ("s", pa.int64()), ("start", pa.int32()),
                                  ("end", pa.int32()), ("number", pa.int32()), ("n_segments", pa.int32()), ("cost", pa.int64())]),
            )

    ends = keep(
        made.repartition("conv", "alone").sortWithinPartitions(*key).mapInArrow(
            chains, "c long, a long, s long, start int, end int, number int, n_segments int, cost long"
        ), "chains",
    )

    def finish(batches):
        for (conv, _, _), columns in _runs(batches, 3):
            _, _, _, _, roles, texts, start, end, number, total, cost = columns
            plan = repair(roles, table, start[0], end[0])
            last = number[0] == total[0] - 1
            rendered, opened = render(plan, texts, start[0], last)
            closing = len(ending(end[0])) if last else 0
            yield pa.RecordBatch.from_pylist([{
                "conv_id": conv, "segment": number[0], "n_segments": total[0], "cost": cost[0], "n_turns": opened,
                "n_merged": sum(s.op == "merge" for s in plan),
                "n_relabelled": sum(s.op == "relabel" for s in plan),
                "n_inserted": sum(s.inserted is not None for s in plan) + closing, "rendered": rendered,
            }], schema=pa.schema([
                ("conv_id", pa.int64()), ("segment", pa.int32()), ("n_segments", pa.int32()), ("cost", pa.int64()),
                ("n_turns", pa.int64()), ("n_merged", pa.int64()), ("n_relabelled", pa.int64()),
                ("n_inserted", pa.int64()), ("rendered", pa.string()),
            ]))

    same = placed["conv"].eqNullSafe(ends["c"]) & (placed["alone"] == ends["a"]) & (placed["segment"] == ends["s"])
    joined = placed.join(ends, same).select(*key, "place", "role", "text", "start", "end", "number", "n_segments", "cost")
    return joined.repartition(*key).sortWithinPartitions(*key, "place").mapInArrow(
        finish, "conv_id long, segment int, n_segments int, cost long, n_turns long, n_merged long, n_relabelled long, "
        "n_inserted long, rendered string",
    )
