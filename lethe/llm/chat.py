"""Repair of role sequences at minimum cost, and their rendering.

Legal conversations are those an automaton accepts: at most one system turn first, then
user and assistant in turn, the assistant last.  A turn may keep its role, be merged
into the turn before it, or be given another role; empty turns may be inserted.  Every
choice has a cost and dynamic programming over the automaton's states takes the
cheapest sequence (on a tie the one with fewer turns, then the earlier choice).

A turn's effect is a matrix of costs between states, and matrices compose.  Turns are
sorted over the cluster, so a very long conversation spreads over many partitions:
first every partition sums up its first and last conversation in one small matrix,
then the states at the partition bounds are chosen from these, then every partition
repairs its turns by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.operators.sizing import durable, shuffle_partitions

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Names under which the three roles are met.
_ALIASES = {
    "system": SYSTEM, "developer": SYSTEM,
    "user": USER, "human": USER, "prompter": USER,
    "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT,
}
_TURN = "conv_id long, turn long, seq long, role string, action string, text string, rendered string"
Cost = tuple[float, int]  # cost, turns of the repaired sequence


@dataclass(frozen=True)
class RepairCosts:
    merge: float = 1.0
    relabel: float = 2.0
    name: float = 0.5  # giving a role to a turn whose role is unknown
    insert: float = 2.5
    opening: str = "<|{role}|>\n"
    closing: str = "\n<|end|>\n"
    joint: str = "\n"


@lru_cache(maxsize=4)
def _inserts(c: RepairCosts) -> dict[tuple[int, int], tuple[int, ...]]:
    """The empty turns that lead from a state to another, fewest first."""
    ways: dict[tuple[int, int], tuple[int, ...]] = {}
    for start in range(4):
        edge = [(start, ())]
        while edge:
            reached = []
            for state, way in edge:
                if (start, state) not in ways:
                    ways[start, state] = way
                    reached += [(to, (*way, to)) for to in _NEXT[state]]
            edge = reached
    return ways


@lru_cache(maxsize=4)
def _steps(c: RepairCosts) -> dict[int, list[tuple[int, int, Cost, tuple[int, ...], str]]]:
    """Per role (0: unknown) the cheapest (from, to, cost, inserted roles, action)."""
    table = {}
    for role in range(4):
        best: dict[tuple[int, int], tuple] = {}
        for (start, middle), way in _inserts(c).items():
            for to in (SYSTEM, USER, ASSISTANT):
                legal, merges = to in _NEXT[middle], to == middle
                if not (legal or merges):
                    continue
                cost = len(way) * c.insert + (c.merge if merges else 0)
                cost += 0 if to == role else c.relabel if role else c.name
                turns = len(way) + (0 if merges else 1)
                action = "+".join(
                    [*(["merge"] if merges else []), *(["relabel"] if to != role else [])]
                )
                found = (cost, turns, len(way), action or "keep", way)
                if (start, to) not in best or found < best[start, to]:
                    best[start, to] = found
        table[role] = [(s, t, b[:2], b[4], b[3]) for (s, t), b in sorted(best.items())]
    return table


def _role(name: str | None) -> int:
    return _ALIASES.get((name or "").strip().lower(), 0)


def _costs(turns: list[int], entry: int, c: RepairCosts) -> list[dict[int, tuple]]:
    """Forward costs from one state: per turn, state -> (cost, turns, state before, step)."""
    table = [{entry: ((0.0, 0), None, None)}]
    for role in turns:
        row: dict[int, tuple] = {}
        for step in _steps(c)[role]:
            start, to, (cost, n), _, _ = step
            if start in table[-1]:
                (old, m), _, _ = table[-1][start]
                found = (round(old + cost, 6), m + n)
                if to not in row or found < row[to][0]:
                    row[to] = (found, start, step)
        table.append(row)
    return table


def _closing_turns(state: int, c: RepairCosts) -> tuple[int, ...]:
    return _inserts(c)[state, ASSISTANT]


def _final(row: dict[int, tuple], c: RepairCosts) -> int:
    """The last state from which closing the conversation is cheapest."""
    def whole(state):
        (cost, n), extra = row[state][0], len(_closing_turns(state, c))
        return (cost + extra * c.insert, n + extra, state)

    return min(row, key=whole)


def repaired_roles(roles: list[str | None], costs: RepairCosts = RepairCosts()) -> tuple[float, list[tuple]]:
    """(cost, [(role, action)]) of one whole conversation; for small inputs and tests."""
    table = _costs([_role(r) for r in roles], START, costs)
    last = _final(table[-1], costs)
    total = table[-1][last][0][0] + len(_closing_turns(last, costs)) * costs.insert
    out = [(ROLES[t], a) for ways, t, a in _walk(table, last) for t, a in [*((w, "insert") for w in ways), (t, a)]]
    return total, out + [(ROLES[t], "insert") for t in _closing_turns(last, costs)]


def _walk(table: list[dict[int, tuple]], last: int) -> list[tuple]:
    """(inserted roles, role, action) of every turn on the way to the state ``last``."""
    steps, state = [], last
    for row in reversed(table[1:]):
        _, before, step = row[state]
        steps.append((step[3], step[1], step[4]))
        state = before
    return steps[::-1]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    rows = (
        row
        for batch in batches
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)
    )
    for key, own in groupby(rows, key=lambda r: r[0]):
        yield key, list(own)


def _summaries(batches: Iterator[pa.RecordBatch], c: RepairCosts) -> Iterator[pa.RecordBatch]:
    """The cost matrices of a partition's first and last conversation."""
    ends = []
    for n, (key, rows) in enumerate(_runs(batches)):
        ends = ends[:1] + [(n, key, [_role(r[2]) for r in rows])]
    part = TaskContext.get().partitionId()
    for n, key, roles in ends:
        cells = [
            {"entry": s, "exit": t, "cost": cell[0][0], "turns": cell[0][1]}
            for s in range(4)
            for t, cell in _costs(roles, s, c)[-1].items()
        ]
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "run": n, "conv_id": key, "cells": cells}],
            schema=pa.schema([("part", pa.int64()), ("run", pa.int64()), ("conv_id", pa.int64()),
                              ("cells", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()),
                                                            ("cost", pa.float64()), ("turns", pa.int64())])))]),
        )


def _bounds(summaries: list, c: RepairCosts) -> dict[tuple[int, int], tuple[int, int, int, bool]]:
    """(part, run) -> (entry, exit, turns before, whether the conversation ends there)."""
    out = {}
    ordered = sorted(summaries, key=lambda s: (s["part"], s["run"]))
    for _, runs in groupby(ordered, key=lambda s: (s["conv_id"] is None, s["conv_id"])):
        runs = list(runs)
        table: list[dict[int, tuple]] = [{START: ((0.0, 0), None, None)}]
        for run in runs:
            row: dict[int, tuple] = {}
            for cell in run["cells"]:
                if cell["entry"] in table[-1]:
                    (old, m), _, _ = table[-1][cell["entry"]]
                    found = (round(old + cell["cost"], 6), m + cell["turns"])
                    if cell["exit"] not in row or found < row[cell["exit"]][0]:
                        row[cell["exit"]] = (found, cell["entry"], None)
            table.append(row)
        state = _final(table[-1], c)
        for k in range(len(runs) - 1, -1, -1):
            entry = table[k + 1][state][1]
            out[runs[k]["part"], runs[k]["run"]] = (entry, state, table[k][entry][0][1], k == len(runs) - 1)
            state = entry
    return out


def _repair(batches: Iterator[pa.RecordBatch], bounds, c: RepairCosts) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    for n, (key, rows) in enumerate(_runs(batches)):
        entry, last, seq, ends = bounds.value.get((part, n), (START, None, 0, True))
        table = _costs([_role(r[2]) for r in rows], entry, c)
        last = _final(table[-1], c) if last is None else last
        seq -= 1
        for (_, turn, _, text), (ways, role, action) in zip(rows, _walk(table, last), strict=True):
            text = text or ""
            for way in ways:
                seq += 1
                out.append(_line(key, turn, seq, way, "insert", "", c))
            if action.startswith("merge"):
                out.append((key, turn, max(seq, 0), ROLES[role], action, text, c.joint + text))
            else:
                seq += 1
                out.append(_line(key, turn, seq, role, action, text, c))
        if ends:
            for way in _closing_turns(last, c):
                seq += 1
                out.append(_line(key, rows[-1][1], seq, way, "insert", "", c))
            out[-1] = (*out[-1][:-1], out[-1][-1] + c.closing)
        if len(out) > 5000:
            yield _turn_batch(out)
            out = []
    if out:
        yield _turn_batch(out)


def _line(key, turn, seq, role, action, text, c: RepairCosts) -> tuple:
    rendered = (c.closing if seq else "") + c.opening.format(role=ROLES[role]) + text
    return (key, turn, seq, ROLES[role], action, text, rendered)


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in _TURN.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.string()] * 4
    columns = zip(zip(*rows, strict=True), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns], names)


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         costs: RepairCosts = RepairCosts()) -> DataFrame:
    """Repaired conversations: one row per turn kept or merged and per turn inserted.

    Columns: conv_id, turn (the source turn; of an inserted one the turn it stands
    before, at the end the last), seq (the repaired turn, from 0), role, action (keep,
    merge, relabel, merge+relabel, insert), text and rendered.  The ``rendered`` parts of a
    conversation in order of seq and turn are its whole text.  Turns are ordered by turn,
    role and text, nulls first; repeated rows are turns of their own.  A null or unknown
    role is one that has to be given; null texts are empty.  Turns without conversation
    id are one conversation with a null id.  Other columns are not read.
    """
    columns = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    parts = shuffle_partitions(turns.sparkSession)
    ordered = durable(columns.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    found = ordered.mapInArrow(
        partial(_summaries, c=costs),
        "part long, run long, conv_id long, cells array<struct<entry int, exit int, cost double, turns long>>",
    ).collect()  # two rows per partition
    bounds = turns.sparkSession.sparkContext.broadcast(_bounds(found, costs))
    return ordered.mapInArrow(partial(_repair, bounds=bounds, c=costs), _TURN)
