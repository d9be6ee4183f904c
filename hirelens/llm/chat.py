"""Chat formatting: minimum-cost repair of roles, then rendering.

A legal conversation is an optional system turn, then user and assistant turns in turn, from user to assistant.
Each input turn may be kept, merged into the turn before it, or relabelled; empty turns may be inserted, also at the end. A dynamic program over
the automaton of legal turns finds the cheapest repair. Of equally cheap ones the first in this order is taken, at every turn from the last
to the first: keep, merge, relabel; then without an inserted turn; then system, user, assistant.

The program is a product of small (min, +) matrices, one per turn, so a conversation can be cut
anywhere. Turns are sorted across the cluster and written in blocks. Every block yields one matrix for
its first conversation and one for its last; the driver chains these (two a block) to the costs with which each block
is entered. With them a block says from which state it is entered for each state it may be left in, and the driver
follows that backwards. So a conversation of any length spreads over many tasks.

Turns are ordered by number (null last), then role, then text (null first). Roles other than system, user and
assistant, and null, must be relabelled. A null text is empty. Equal rows are turns of their own. A null conv_id is
one conversation. The result has one row per input turn: rendering a conversation is reading its fragments in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch

ROLES = ("system", "user", "assistant")
#: What may follow a turn; 3 is the beginning.
NEXT = {3: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
BEGIN, END = 3, 2


@dataclass(frozen=True)
class Costs:
    """Price of each change, `foreign` that of naming a role that is none of the three, and the frame of a turn."""

    merge: float = 1.0
    relabel: float = 2.0
    foreign: float = 1.0
    insert: float = 1.5
    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"


@dataclass(frozen=True)
class Move:
    """From state to state with a turn: the action, and the roles of empty turns before it."""

    state: int
    cost: float
    rank: tuple
    action: str
    inserted: tuple[int, ...]


def bridges(state: int, role: int) -> Iterator[tuple[int, ...]]:
    """Shortest ways of empty turns from a state to one that a turn of the role may follow."""
    if role in NEXT[state]:
        yield ()
        return
    for a in NEXT[state]:
        if role in NEXT[a]:
            yield (a,)
    for a in NEXT[state]:
        for b in NEXT[a]:
            if role in NEXT[b] and role not in NEXT[a]:
                yield (a, b)


def moves(state: int, role: int | None, costs: Costs) -> list[Move]:
    """All moves with a turn of a role (None: a foreign one), the cheapest for each target first."""
    out = []
    if state != BEGIN and role == state:
        out.append(Move(state, costs.merge, (1, 0, state), "merge", ()))
    for target in range(len(ROLES)):
        price, action = (0.0, "keep") if role == target else (costs.foreign if role is None else costs.relabel, "relabel")
        for way in bridges(state, target):
            rank = (0 if action == "keep" else 2, len(way), target)
            out.append(Move(target, price + costs.insert * len(way), rank, action, way))
    if state != BEGIN and role != state:  # relabel and merge
        price = costs.merge + (costs.foreign if role is None else costs.relabel)
        out.append(Move(state, price, (2, 0, state), "relabel and merge", ()))
    return sorted(out, key=lambda m: (m.cost, m.rank))


def table(costs: Costs) -> dict[int | None, list[list[Move]]]:
    """For each role and state the best move to every target."""
    out: dict[int | None, list[list[Move]]] = {}
    for role in (0, 1, 2, None):
        out[role] = []
        for state in range(4):
            best: dict[int, Move] = {}
            for m in moves(state, role, costs):
                best.setdefault(m.state, m)
            out[role].append(list(best.values()))
    return out


def closing_cost(state: int, costs: Costs) -> tuple[float, tuple[int, ...]]:
    """Price and empty turns to end legally after a state."""
    way: tuple[int, ...] = ()
    while state != END:
        state = NEXT[state][-1]
        way += (state,)
    return costs.insert * len(way), way


def matrix(role: int | None, moved: dict) -> np.ndarray:
    m = np.full((4, 4), np.inf)
    for state in range(4):
        for move in moved[role][state]:
            m[state, move.state] = move.cost
    return m


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def number(role: str | None) -> int | None:
    return ROLES.index(role) if role in ROLES else None


def backtrace(roles: list[int | None], entry: np.ndarray, leave: int, moved: dict) -> list[tuple[int, Move]]:
    """State before and move of every turn, given the cost of each state before the first and the state after the last."""
    costs = [entry]
    for role in roles:
        before, after = costs[-1], np.full(4, np.inf)
        for state in range(4):
            for m in moved[role][state]:
                after[m.state] = min(after[m.state], before[state] + m.cost)
        costs.append(after)
    out, state = [], leave
    for k in range(len(roles) - 1, -1, -1):
        options = [(costs[k][s] + m.cost, m.rank, s, m) for s in range(4) for m in moved[roles[k]][s] if m.state == state]
        _, _, state, move = min(options, key=lambda o: o[:3])
        out.append((state, move))
    return out[::-1]


def best_exit(costs: np.ndarray, price: Costs) -> int:
    return min(range(4), key=lambda s: (costs[s] + (closing_cost(s, price)[0] if s != BEGIN else np.inf), s))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows of one conversation in one block, as (block, conv_id) and rows."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (now := (row["block"], row["conv_id"])) != key:
                if rows:
                    yield key, rows
                key, rows = now, []
            rows.append(row)
    if rows:
        yield key, rows


def row_order() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]


def in_blocks(blocks: DataFrame, *columns: str) -> DataFrame:
    """Whole blocks, sorted, with the columns asked for."""
    order = [o for o, name in zip(row_order(), ("turn", "role", "text")) if name in columns]
    return blocks.select("block", *columns).repartition("block").sortWithinPartitions(
        "block", F.col("conv_id").asc_nulls_first(), *order)


def edges(batches: Iterator[pa.RecordBatch], about: Callable[[int, bool, list], list[float]]) -> Iterator[pa.RecordBatch]:
    """For the first and the last conversation of each block its number of turns and what `about` says of its roles.

    A conversation that is both comes once as the first, with `only` set. conv_id is given as text, null stays null.
    """

    def row(key: tuple, rows: list[dict], first: bool, only: bool) -> dict:
        roles = [number(r["role"]) for r in rows]
        conv = None if key[1] is None else str(key[1])
        return {"block": key[0], "conv": conv, "first": first, "only": only, "n": len(rows), "told": about(key[0], first, roles)}

    held: list[tuple[tuple, list[dict]]] = []
    out: list[dict] = []

    def finish() -> None:
        if held:
            out.append(row(*held[0], True, len(held) == 1))
            if len(held) > 1:
                out.append(row(*held[-1], False, False))
            held.clear()

    for key, rows in blocks_of(batches):
        if held and held[0][0][0] != key[0]:
            finish()
        del held[1:]
        held.append((key, rows))
    finish()
    if out:
        yield pa.RecordBatch.from_pylist(out, EDGE)


EDGE = pa.schema([("block", pa.int32()), ("conv", pa.string()), ("first", pa.bool_()), ("only", pa.bool_()),
                  ("n", pa.int64()), ("told", pa.list_(pa.float64()))])
EDGES = "block int, conv string, first boolean, only boolean, n long, told array<double>"
START = np.array([np.inf, np.inf, np.inf, 0.0])


@dataclass(frozen=True)
class Joint:
    """How a block's first conversation is entered and its last one left."""

    entry: np.ndarray  # cost of each state before the first turn
    place: int  # turns before it
    going_on: bool  # the last conversation goes on in the next block
    leave: int = -1  # the state it is left in, if it goes on


def entered(rows: list) -> dict[int, Joint]:
    """Joints from the matrices of all blocks, in order; leaving states are not known yet."""
    out, before, conv, place, last = {}, START, None, 0, None
    for i, r in enumerate(rows):
        if r["first"]:
            goes_on = last is not None and last == (r["conv"],)
            before, place = (before, place) if goes_on else (START, 0)
            out[r["block"]] = Joint(before, place, False)
            if goes_on:
                previous = rows[i - 1]["block"]
                out[previous] = replace(out[previous], going_on=True)
        else:
            before, place = START, 0
        before = (before[:, None] + np.array(r["told"]).reshape(4, 4)).min(axis=0)
        place, last = place + r["n"], (r["conv"],)
    return out


def left(joints: dict[int, Joint], rows: list) -> dict[int, Joint]:
    """Joints with leaving states, from what each block says of its first conversation.

    `told` has, for each state after its last turn in the block, the state before its first one; then the best state to end in.
    """
    out, before, firsts = dict(joints), -1, {r["block"]: r for r in rows if r["first"]}
    for block in sorted(joints, reverse=True):
        first = firsts[block]
        if out[block].going_on:
            out[block] = replace(out[block], leave=before)
        ends_in = out[block].leave if first["only"] and out[block].going_on else int(first["told"][4])
        before = int(first["told"][ends_in])
    return out


def repaired(key: tuple, rows: list[dict], entry: np.ndarray, place: int, leave: int, ends: bool, moved: dict, costs: Costs) -> Iterator[dict]:
    """One row per turn of a conversation's part."""
    path = backtrace([number(r["role"]) for r in rows], entry, leave, moved)
    turn = lambda role: costs.opening.format(role=ROLES[role])
    for k, (row, (state, move)) in enumerate(zip(rows, path)):
        text = row["text"] or ""
        if "merge" in move.action:
            fragment = "\n" + text
        else:
            fragment = ("" if state == BEGIN else costs.closing) + "".join(
                turn(r) + costs.closing for r in move.inserted) + turn(move.state) + text
        inserted, price = [ROLES[r] for r in move.inserted], move.cost
        if ends and k == len(rows) - 1:
            more, way = closing_cost(move.state, costs)
            price += more
            fragment += costs.closing + "".join(turn(r) + costs.closing for r in way)
            inserted += [f"after:{ROLES[r]}" for r in way]
        yield {"conv_id": key[1], "turn": row["turn"], "place": place + k, "old_role": row["role"], "role": ROLES[move.state],
               "action": move.action, "inserted": ",".join(inserted), "cost": price, "fragment": fragment}


def repair(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per input turn: conv_id, turn, `place` in the conversation (from 0), old and new role, the action, roles of
    empty turns inserted before it (or after it, at the end), the cost, and the rendered fragment."""
    scratch, moved = Scratch(turns.sparkSession, "chat"), table(costs)
    conv = F.col("conv_id").asc_nulls_first()
    blocks = scratch.keep(
        turns.select("conv_id", "turn", "role", "text").repartitionByRange(conv, *row_order()).withColumn(
            "block", F.spark_partition_id()), "blocks")

    def matrices(block: int, first: bool, roles: list) -> list[float]:
        total = np.full((4, 4), np.inf)
        np.fill_diagonal(total, 0.0)
        for role in roles:
            total = chain(total, matrix(role, moved))
        return total.ravel().tolist()

    def told(about: Callable) -> list:
        source = in_blocks(blocks, "conv_id", "turn", "role")
        found = source.mapInArrow(lambda batches: edges(batches, about), EDGES)
        return sorted((r.asDict() for r in found.collect()), key=lambda r: (r["block"], not r["first"]))  # two a block

    joints = entered(told(matrices))

    def states(block: int, first: bool, roles: list) -> list[float]:
        if not first:
            return []
        entry = joints[block].entry
        after = entry
        for role in roles:
            after = (after[:, None] + matrix(role, moved)).min(axis=0)
        before = [float(backtrace(roles, entry, s, moved)[0][0]) if np.isfinite(after[s]) else -1.0 for s in range(4)]
        return [*before, float(best_exit(after, costs))]

    joints = left(joints, told(states))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, out, seen = None, None, [], set()

        def done(key: tuple, rows: list[dict], last: bool) -> None:
            joint, first = joints[key[0]], key[0] not in seen
            seen.add(key[0])
            entry, place = (joint.entry, joint.place) if first else (START, 0)
            ends = not (last and joint.going_on)
            leave = joint.leave
            if ends:
                after = entry
                for r in rows:
                    after = (after[:, None] + matrix(number(r["role"]), moved)).min(axis=0)
                leave = best_exit(after, costs)
            out.extend(repaired(key, rows, entry, place, leave, ends, moved, costs))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema)
            out.clear()
            return made

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for b in batches:
                schema = schema or pa.schema([
                    ("conv_id", b.schema.field("conv_id").type), ("turn", b.schema.field("turn").type), ("place", pa.int64()),
                    *[(n, pa.string()) for n in ("old_role", "role", "action", "inserted")], ("cost", pa.float64()), ("fragment", pa.string())])
                yield b

        for key, rows in blocks_of(watched()):
            if held:
                done(*held, held[0][0] != key[0])
            held = key, rows
            if len(out) >= 5000:
                yield batch()
        if held:
            done(*held, True)
        if out:
            yield batch()

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema.fields}
    return in_blocks(blocks, "conv_id", "turn", "role", "text").mapInArrow(
        render, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, place long, old_role string, role string, action string, "
                "inserted string, cost double, fragment string")
