"""Conversation structure repair by square-root checkpointed dynamic programming.

A conversation is legal if its turns' role initials read ``(s?(ua)+)?``. Each turn is kept
(0), reroled to user or assistant (1) or deleted (2; blank and repeated turns must be), and
empty turns of either role are inserted anywhere (5); a truncated turn that stays adds 5.
The repair is the cheapest list of edits, of equal ones that with the ASCII-least initials
(D, I, K, R). Where the automaton stands (start, after s, u, a) fixes the role that an
insertion or a rerole gives, so the initials tell the whole repair.

- **Order.** Turns are sorted over (conversation, turn) in ranges, so a conversation of any
  size is dealt to many tasks; each gets its number in the conversation from the ranges'
  counts. Equal turns go by role, then by the text's SHA-256.
- **Blocks** are cut at fixed numbers, never where tasks end: the square root of the
  conversation's length, 32 at least and 1024 at most, so most conversations are one.
- **Checkpoints.** A block is a 4 x 4 matrix of least costs between states. Chained from the
  end (min-plus), the matrices leave the backward state costs at block borders only.
- **Walk.** Each block's inner state costs are computed again from its checkpoint, and the
  walk forward takes the least initial whose cost is tight. It is done for each state the
  block may begin in; chaining the states that it ends in picks the true one.

Blocks of a batch are worked on side by side, as arrays. Only codes of a byte a turn pass
through this; texts are joined by row afterwards. What one task holds of a conversation is
its list of checkpoints (some 100 bytes per block). ``fingerprints`` feeds a conversation's
repaired text to one hash, which is sequential by nature: it streams through one task.

Faults (a turn's first counts): blank: no visible character; duplicate: role and text seen
earlier; truncated: the last visible character is none of ``.!?``. Repetition is told by
SHA-256 of role and text. A null role or text is one space; null turns come first; rows
with a null conversation are one conversation. Repeated rows are turns of their own. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep, parts_of

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
LEAST_BLOCK, MOST_BLOCK = 32, 1024
START, SYSTEM, USER, ASSISTANT = range(4)  # states: the last turn's role
_INF = 1 << 40
_GIVEN = np.array([USER, USER, ASSISTANT, USER])  # state after an insertion or a rerole
# state after keeping a turn with initial s, u, a or another, by the state before; 4: not legal
_KEPT = np.array([[SYSTEM, 4, 4, 4], [USER, USER, 4, USER], [4, 4, ASSISTANT, 4], [4, 4, 4, 4]])
_FINAL = np.array([0, 2 * INSERT, INSERT, 0])  # cost from a state after the last turn
MUST_DELETE, IS_TRUNCATED = 1, 2  # a turn's code: its initial (0 to 3) + 4 * one of these


def _with_insertions(cost: np.ndarray) -> np.ndarray:
    once = cost[..., _GIVEN]
    return np.minimum(cost, np.minimum(once + INSERT, once[..., _GIVEN] + 2 * INSERT))


def _choices(code: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and reroling a turn, by state before, given those after it."""
    shape = (-1,) + (1,) * (after.ndim - 1)
    code = code.reshape(shape)
    kept = np.concatenate([after, np.full((*after.shape[:-1], 1), _INF)], axis=-1)
    to = np.broadcast_to(_KEPT[code[..., 0] & 3], after.shape)
    more = np.where(code >> 2 == MUST_DELETE, _INF, np.where(code >> 2 == IS_TRUNCATED, TRUNCATED, 0))
    return after + DELETE, np.take_along_axis(kept, to, -1) + more, after[..., _GIVEN] + REROLE + more


def _before(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """State costs before a turn from those after it."""
    return _with_insertions(np.minimum.reduce(_choices(code, after)))


class Blocks:
    """Codes of several blocks side by side, the longest first."""

    def __init__(self, codes: list[np.ndarray]):
        self.sizes = np.array([len(c) for c in codes], dtype=np.int64)
        self.longest = int(self.sizes.max(initial=0))
        self.codes = np.zeros((len(codes), self.longest), dtype=np.int64)
        for row, c in zip(self.codes, codes):
            row[: len(c)] = c

    def active(self, t: int) -> int:
        """How many blocks have a turn ``t``."""
        return int(np.searchsorted(-self.sizes, -t, "left"))

    def matrices(self) -> np.ndarray:
        """(block, state before, state after) -> least cost."""
        unit = np.where(np.eye(4, dtype=bool), 0, _INF)
        cost = np.tile(unit, (len(self.sizes), 1, 1))  # block, state after, state before
        for t in range(self.longest - 1, -1, -1):
            n = self.active(t)
            cost[:n] = np.minimum(_before(self.codes[:n, t], cost[:n]), _INF)
        return cost.transpose(0, 2, 1)

    def walks(self, end: np.ndarray, last: np.ndarray):
        """From each state the cheapest edits: (costs before, states after, initials).

        ``end``: state costs after each block; ``last``: whether its conversation ends there.
        """
        costs = [None] * self.longest + [end]
        for t in range(self.longest - 1, -1, -1):
            n = self.active(t)
            costs[t] = costs[t + 1].copy()
            costs[t][:n] = _before(self.codes[:n, t], costs[t + 1][:n])
        state = np.tile(np.arange(4), (len(end), 1))
        out = np.zeros((len(end), 4, 3 * self.longest + 2), dtype=np.uint8)
        take = lambda cost, s: np.take_along_axis(cost, s, 1)
        for t in range(self.longest):
            n = self.active(t)
            code, here = self.codes[:n, t], costs[t][:n]
            delete, kept, rerole = _choices(code, costs[t + 1][:n])
            waiting = np.ones((n, 4), dtype=bool)
            for k in range(3):  # two insertions and the turn itself at most
                s = state[:n]
                best = take(here, s)
                pick = np.select(
                    [take(delete, s) == best, take(here, _GIVEN[s]) + INSERT == best, take(kept, s) == best,
                     take(rerole, s) == best], [ord(x) for x in "DIKR"], 0,
                )
                pick[~waiting] = 0
                out[:n, :, 3 * t + k] = pick
                moved = np.where(pick == ord("K"), np.take_along_axis(_KEPT[code & 3], s, 1), s)
                state[:n] = np.where((pick == ord("I")) | (pick == ord("R")), _GIVEN[s], moved)
                waiting &= pick == ord("I")
                if not waiting.any():
                    break
        for k in (-2, -1):
            more = last[:, None] & ((state == SYSTEM) | (state == USER))
            out[:, :, k][more] = ord("I")
            state = np.where(more, _GIVEN[state], state)
        return costs[0], state, out


def _groups(sizes: np.ndarray):
    """Indexes of blocks of like size, the longest first, so that padding stays below half."""
    order = np.argsort(-sizes, kind="stable")
    level = np.ceil(np.log2(np.maximum(sizes[order], 1))).astype(int)
    for part in np.split(order, np.flatnonzero(np.diff(level)) + 1):
        if len(part):
            yield part


def _lists(column: pa.Array) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1]) if len(column) else []


def chain_back(matrices: np.ndarray) -> np.ndarray:
    """State costs after each block of one conversation."""
    out = np.empty((len(matrices), 4), dtype=np.int64)
    now = _FINAL
    for k in range(len(matrices) - 1, -1, -1):
        out[k] = now
        now = (matrices[k] + now[None, :]).min(1)
    return out


def _texts(chars: np.ndarray) -> pa.Array:
    """Strings of the bytes that are not zero in each row."""
    n = (chars > 0).sum(1)
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(chars[chars > 0]))


class Repair(NamedTuple):
    """``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``turns``: conv_id, position (from 0), edit, role, text of the repaired conversations.
    """

    report: DataFrame
    turns: DataFrame


def repaired(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> Repair:
    spaced = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    rows = turns.select(
        spaced(conversation).alias("c"), turns[conversation].alias("conv_id"), turns[turn].cast("long").alias("turn"),
        spaced(role).alias("role"), spaced(text).alias("text"),
    )
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    kind = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"
    )
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    rows = rows.select(
        "*", digest.alias("digest"), kind.alias("kind"),
        F.when((initial == 0) | (F.length("role") == 0), 3).otherwise(initial - 1).alias("initial"),
    )
    order = ["c", F.col("turn").asc_nulls_first(), "role", "digest"]
    ordered = rows.repartitionByRange(parts_of(turns), *order).sortWithinPartitions(*order)
    ordered = keep(ordered.withColumn("place", F.monotonically_increasing_id()), "turns")
    coded = _coded(ordered)
    blocks = keep(_blocks(coded), "blocks")
    walked = keep(_walked(blocks), "walked")
    chosen = keep(_chosen(walked), "edits")
    gaps = ordered.where("turn is not null").groupBy("c", "turn").agg(F.lit(1).alias("one")).groupBy("c").agg(
        F.expr("try_subtract(try_add(try_subtract(max(turn), min(turn)), 1L), count(*))").alias("gaps")
    )
    names = ordered.groupBy("c").agg(F.any_value("conv_id").alias("conv_id"))
    report = names.join(_summed(chosen), "c").join(gaps, "c", "left").select(
        "conv_id", F.when(F.col("turns") == 0, 0).otherwise(F.coalesce("gaps", F.lit(0))).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    )
    return Repair(report, _repaired_turns(chosen, ordered))


def _coded(ordered: DataFrame) -> DataFrame:
    """``c, n, pos, place, initial, fault`` of each turn: its number in its conversation of n turns."""
    part = F.shiftright("place", 33)
    narrow = ordered.select("c", part.alias("part"), "place", "digest", "kind", "initial")
    parts = narrow.groupBy("c", "part").agg(F.min("place").alias("low"), F.count("*").alias("size"))
    every = Window.partitionBy("c")
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "c", "part", "low", F.sum("size").over(every).alias("n"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
    )
    numbered = narrow.join(parts, ["c", "part"]).withColumn("pos", F.col("place") - F.col("low") + F.col("offset"))
    numbered = keep(numbered.drop("part", "low", "offset"), "numbers")
    # the least number of each role and text that comes again; blank turns are that already
    visible = F.coalesce(F.col("kind") != "blank", F.lit(True))
    again = numbered.where(visible).groupBy("c", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("m"))
    found = numbered.join(again.where("m > 1").drop("m"), ["c", "digest"], "left")
    repeated = visible & (F.col("pos") > F.col("first"))
    return found.select("c", "n", "pos", "place", "initial", F.when(repeated, "duplicate").otherwise(F.col("kind")).alias("fault"))


def _blocks(coded: DataFrame) -> DataFrame:
    """Blocks with the codes and places of their turns, in order."""
    size = F.least(F.greatest(F.ceil(F.sqrt("n")), F.lit(LEAST_BLOCK)), F.lit(MOST_BLOCK)).cast("long")
    fault = F.col("fault")
    code = F.col("initial") + 4 * F.when(fault == "truncated", IS_TRUNCATED).when(fault.isNotNull(), MUST_DELETE).otherwise(0)
    rows = coded.select(
        "c", "n", F.floor(F.col("pos") / size).alias("block"), fault.alias("fault"),
        F.struct("pos", code.cast("int").alias("code"), "place").alias("t"), size.alias("size"),
    )
    grouped = rows.groupBy("c", "n", "block", "size").agg(
        F.sort_array(F.collect_list("t")).alias("t"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    return grouped.select(
        "c", "block", F.ceil(F.col("n") / F.col("size")).cast("long").alias("blocks"),
        F.col("t.code").alias("codes"), F.col("t.place").alias("places"), "blank", "duplicate", "truncated",
    )


def _walked(blocks: DataFrame) -> DataFrame:
    """Blocks with the cheapest edits from each state they may begin in."""

    def matrices(batches):
        for batch in batches:
            codes = _lists(batch.column(2))
            found = np.zeros((len(codes), 16), dtype=np.int64)
            for part in _groups(np.array([len(c) for c in codes])):
                found[part] = Blocks([codes[i] for i in part]).matrices().reshape(-1, 16)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * 16, pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat], ["c", "block", "m"])

    def ends(batches):
        for batch in batches:
            for c, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made = np.array([r["m"] for r in row], dtype=np.int64).reshape(-1, 4, 4)
                yield pa.RecordBatch.from_pydict(
                    {"c": [c] * len(row), "block": [r["block"] for r in row], "end": chain_back(made).tolist()},
                    schema=pa.schema([("c", pa.string()), ("block", pa.int64()), ("end", pa.list_(pa.int64()))]),
                )

    several = blocks.where("blocks > 1").select("c", "block", "codes")
    made = several.mapInArrow(matrices, "c string, block long, m array<long>")
    chained = made.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("block", "m"))).alias("m"))
    checkpoints = keep(chained.mapInArrow(ends, "c string, block long, end array<long>"), "checkpoints")
    ready = blocks.join(checkpoints, ["c", "block"], "left").withColumn(
        "end", F.coalesce("end", F.array(*(F.lit(int(x)).cast("long") for x in _FINAL)))
    )
    more = ["c", "block", "blocks", "codes", "places", "blank", "duplicate", "truncated"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.select(more).schema)

    def walk(batches):
        legal = np.zeros((4, 4), dtype=bool)
        legal[0, 1] = legal[1, 2] = legal[2, 1] = True
        for batch in batches:
            codes = _lists(batch.column(3))
            end = np.array(batch.column(8).to_pylist(), dtype=np.int64).reshape(-1, 4)
            last = batch.column(1).to_numpy() + 1 == batch.column(2).to_numpy()
            sizes = np.array([len(c) for c in codes])
            for part in _groups(sizes):
                held = Blocks([codes[i] for i in part])
                costs, states, chars = held.walks(end[part], last[part])
                who = held.codes & 3
                pair = np.arange(1, held.longest)[None, :] < held.sizes[:, None]
                wrong = (~legal[who[:, :-1], who[:, 1:]] & pair).sum(1)
                fours = pa.array(np.arange(len(part) + 1) * 4, pa.int32())
                own = batch.take(pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:8], pa.array(costs[:, 0]), pa.array(wrong),
                     pa.ListArray.from_arrays(fours, pa.array(states.ravel().astype(np.int32))),
                     pa.ListArray.from_arrays(fours, _texts(chars.reshape(len(part) * 4, -1)))],
                    [*more, "cost", "wrong", "states", "audits"],
                )

    return ready.select(*more, "end").mapInArrow(
        walk, f"{kinds}, cost long, wrong long, states array<int>, audits array<string>"
    )


def _kept(audit: Column) -> Column:
    """How many turns edits leave."""
    return F.length(F.replace(audit, F.lit("D"), F.lit("")))


def _chosen(walked: DataFrame) -> DataFrame:
    """Blocks with the state they begin in, the repaired turns before them, and their edits."""

    def starts(batches):
        for batch in batches:
            for c, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                state, base, out = START, 0, []
                for r in row:
                    out.append((state, base))
                    state, base = r["states"][state], base + r["kept"][state]
                yield pa.RecordBatch.from_pydict(
                    {"c": [c] * len(row), "block": [r["block"] for r in row], "state": [s for s, _ in out], "base": [b for _, b in out]},
                    schema=pa.schema([("c", pa.string()), ("block", pa.int64()), ("state", pa.int32()), ("base", pa.int64())]),
                )

    several = walked.where("blocks > 1").select("c", "block", "states", F.transform("audits", _kept).alias("kept"))
    chained = several.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("block", "states", "kept"))).alias("b"))
    begun = keep(chained.mapInArrow(starts, "c string, block long, state int, base long"), "starts")
    found = walked.join(begun, ["c", "block"], "left").withColumns(
        {"state": F.coalesce("state", F.lit(START)), "base": F.coalesce("base", F.lit(0))}
    )
    return found.withColumn("audit", F.get("audits", F.col("state"))).drop("audits", "states")


def _summed(chosen: DataFrame) -> DataFrame:
    """One row per conversation."""
    initial = lambda k: F.get("codes", k).bitwiseAND(F.lit(3))
    ends = F.struct("block", "audit", initial(F.lit(0)).alias("first"), initial(F.size("codes") - 1).alias("last"))
    grouped = chosen.groupBy("c").agg(
        F.sort_array(F.collect_list(ends)).alias("b"), F.sum(F.size("codes")).alias("turns"),
        *(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "wrong")),
        F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"),
    )
    pairs = F.arrays_zip(
        F.slice("b.last", 1, F.size("b") - 1).alias("x"), F.slice("b.first", 2, F.size("b") - 1).alias("y")
    )
    bad = F.size(F.filter(pairs, lambda p: ~((p.x == 0) & (p.y == 1) | (p.x == 1) & (p.y == 2) | (p.x == 2) & (p.y == 1))))
    return grouped.select(
        "c", "turns", "blank", "duplicate", "truncated", (F.col("wrong") + bad).alias("illegal"), "cost",
        F.array_join("b.audit", "").alias("audit"),
    )


def _repaired_turns(chosen: DataFrame, ordered: DataFrame) -> DataFrame:
    """Edits turn by turn, with roles and texts."""

    def task(batches):
        for batch in batches:
            c, codes, places, state, base, audit = (batch.column(k) for k in range(6))
            for k, edits in enumerate(audit.to_pylist()):
                edits = np.frombuffer(edits.encode(), dtype=np.uint8)
                turn = np.cumsum(edits != ord("I")) - 1  # of the block
                left = edits != ord("D")
                nth = np.cumsum(left) - 1
                own = codes[k].values.to_numpy(), places[k].values.to_numpy()
                of_turn = edits != ord("I")
                place = np.where(of_turn, own[1][np.maximum(turn, 0)], -1) if len(own[1]) else np.full(len(edits), -1)
                before = state[k].as_py()
                opening = np.flatnonzero(left)[:1]
                system = before == START and len(opening) and edits[opening[0]] == ord("K") and own[0][turn[opening[0]]] & 3 == 0
                user = (nth + (before == USER) + bool(system)) % 2 == 0
                given = np.where(edits == ord("K"), "", np.where(user, "user", "assistant"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[k].as_py()] * int(left.sum()), pa.string()), pa.array(nth[left] + base[k].as_py()),
                     pa.array([chr(x) for x in edits[left]], pa.string()), pa.array(place[left], pa.int64()),
                     pa.array(given[left].tolist(), pa.string())],
                    ["c", "position", "edit", "place", "given"],
                )

    edits = chosen.select("c", "codes", "places", "state", "base", "audit").mapInArrow(
        task, "c string, position long, edit string, place long, given string"
    )
    edits = keep(edits, "edits")
    texts = ordered.select("place", "conv_id", "role", "text")
    of_turn = edits.where("place >= 0").join(texts, "place").select(
        "c", "conv_id", "position", "edit", F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("given")).alias("role"), "text"
    )
    names = ordered.groupBy("c").agg(F.any_value("conv_id").alias("conv_id"))
    inserted = edits.where("place < 0").join(names, "c").select(
        "c", "conv_id", "position", "edit", F.col("given").alias("role"), F.lit("").alias("text")
    )
    return of_turn.unionByName(inserted).drop("c")


def fingerprints(turns: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of each conversation's ``role:text`` lines, streamed in order."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    rows = turns.select(key.alias("c"), "position", F.concat("role", F.lit(":"), "text").alias("line"), "conv_id")
    ordered = rows.repartition("c").sortWithinPartitions("c", "position")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def task(batches):
        now, id, total = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([id, pa.array([total.hexdigest()], pa.string())], ["conv_id", "sha256"])

        for batch in batches:
            for k, (c, line) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                if c != now:
                    if total is not None:
                        yield done()
                    now, id, total = c, batch.column(3).slice(k, 1), hashlib.sha256()
                else:
                    total.update(b"\n")
                total.update(line.as_buffer())
        if total is not None:
            yield done()

    return ordered.mapInArrow(task, f"conv_id {kind}, sha256 string")
