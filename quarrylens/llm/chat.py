"""Minimum-cost role repair of conversations.

Legal sequences: at most one system turn, first; then user and assistant in turn, beginning with user and ending with
assistant. A dynamic programme over this automaton chooses for each turn, at least cost, to keep it, to merge it into the
turn before, to put an empty turn before it or to relabel it; an empty assistant turn may be added at the end. Costs are
parameters; ties go to fewer turns and then to the order just given. The repaired turns are rendered one after the other.

A conversation may be longer than a task should hold: turns are sorted by range over tasks, and a stretch of a conversation
in one task is a min-plus matrix from the state before to the state after it. Only the first and last stretch of each task
can go beyond it; their matrices, two for a task, are put together on the driver, and each stretch is then solved between
its own two states.

Result, a row for each turn and added turn: conv_id, out_turn (from 0), piece (number within the out_turn), action, role,
text, rendered; the rendered pieces of a conversation joined by out_turn and piece are its chat text.

Cases: roles are compared in lower case without space around them, and other names of the roles are known; an unknown or
null role fits no state and is relabelled at a lower cost; a null text is empty; turns are ordered by turn, null first, then
a digest of role and text, so repeated rows and ties have a fixed order; rows without conv_id are one conversation; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shared_folder, small_batches, tasks_of

ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "chatbot": "assistant", "developer": "system", "instruction": "system"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn of a role, from the state before it; what isn't there is illegal.
STEP = {(START, "system"): SYSTEM, (START, "user"): USER, (SYSTEM, "user"): USER, (ASSISTANT, "user"): USER, (USER, "assistant"): ASSISTANT}
_ROLE_OF = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
_NEVER = (float("inf"), 0)


@dataclass(frozen=True)
class ChatParams:
    merge: int = 1
    insert: int = 3
    relabel: int = 4
    relabel_unknown: int = 2
    task_rows: int = 100_000  # turns of a task, about; a worker holds the roles and texts of one stretch of it


def known_role(role: str | None) -> str | None:
    role = (role or "").strip().lower()
    role = ALIASES.get(role, role)
    return role if role in ROLES else None


class Automaton:
    """For each role the moves (from, to, cost, turns added, action, inserted role, new role)."""

    def __init__(self, p: ChatParams = ChatParams()):
        self.p = p
        self.moves = {role: [m for s in range(4) for m in self._from(s, role)] for role in (*ROLES, None)}
        self.ends = {s: (0, 0) for s in (START, SYSTEM, ASSISTANT)} | {USER: (p.insert, 1)}

    def _from(self, s: int, role: str | None):
        p = self.p
        if (s, role) in STEP:
            yield s, STEP[s, role], 0, 1, "keep", None, role
        if role and _ROLE_OF.get(s) == role:
            yield s, s, p.merge, 0, "merge", None, role
        for extra in ROLES:
            if (s, extra) in STEP and (STEP[s, extra], role) in STEP:
                yield s, STEP[STEP[s, extra], role], p.insert, 2, "insert", extra, role
        for new in ROLES:
            if new != role and (s, new) in STEP:
                yield s, STEP[s, new], p.relabel if role else p.relabel_unknown, 1, "relabel", None, new

    def matrix(self, roles) -> list[list[tuple]]:
        """Least (cost, turns) from each state to each over some roles."""
        rows = [[(0, 0) if a == b else _NEVER for b in range(4)] for a in range(4)]
        for role in roles:
            new = [[_NEVER] * 4 for _ in range(4)]
            for a, b, cost, turns, *_ in self.moves[role]:
                for was, row in zip(rows, new, strict=True):
                    if was[a] is not _NEVER and (v := (was[a][0] + cost, was[a][1] + turns)) < row[b]:
                        row[b] = v
            rows = new
        return rows

    def path(self, roles, entry: int, leave: int) -> list[tuple]:
        """The moves of a least path from entry to leave."""
        best = [(0, 0) if s == entry else _NEVER for s in range(4)]
        back = []
        for role in roles:
            new, via = [_NEVER] * 4, [None] * 4
            for m in self.moves[role]:
                if best[m[0]] is not _NEVER and (v := (best[m[0]][0] + m[2], best[m[0]][1] + m[3])) < new[m[1]]:
                    new[m[1]], via[m[1]] = v, m
            back.append(via)
            best = new
        out, s = [], leave
        for via in reversed(back):
            out.append(via[s])
            s = via[s][0]
        return out[::-1]

    def through(self, matrices) -> list[tuple[int, int, int]]:
        """Entry, exit and number of turns before, for each stretch of one conversation."""
        best = [(0, 0) if s == START else _NEVER for s in range(4)]
        trail = []
        for m in matrices:
            new, via = [_NEVER] * 4, [0] * 4
            for a in range(4):
                if best[a] is _NEVER:
                    continue
                for b in range(4):
                    if m[a][b] is not _NEVER and (v := (best[a][0] + m[a][b][0], best[a][1] + m[a][b][1])) < new[b]:
                        new[b], via[b] = v, a
            trail.append(via)
            best = new
        s = min((x for x in range(4) if best[x] is not _NEVER), key=lambda x: (best[x][0] + self.ends[x][0], best[x][1] + self.ends[x][1], -x))
        states = [s]
        for via in reversed(trail):
            states.append(via[states[-1]])
        states.reverse()
        out, turns = [], 0
        for m, a, b in zip(matrices, states[:-1], states[1:], strict=True):
            out.append((a, b, turns))
            turns += m[a][b][1]
        return out


def _stretches(batches):
    """(conv_id, rows) of each stretch of rows with one conv_id, rows as (role, text)."""
    now, rows = None, []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            if rows and conv != now:
                yield now, rows
                rows = []
            now = conv
            rows.append((known_role(role), text or ""))
    if rows:
        yield now, rows


def _render(piece: int, role: str, text: str) -> str:
    return f"<|{role}|>\n{text}" if piece == 0 else f"\n{text}"


def repair_roles(turns: DataFrame, params: ChatParams = ChatParams()) -> DataFrame:
    spark = turns.sparkSession
    small_batches(spark)
    shared_folder(spark)
    a = Automaton(params)
    n = max(tasks_of(spark), -(-turns.count() // params.task_rows))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    # Written once, so that both passes see the same tasks.
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    rows = rows.repartitionByRange(n, "conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie", "role", "text").drop("tie").checkpoint()

    def edges(batches):
        """The first and the last stretch of a task: place, conv_id and matrix; one that is both comes once, as place 2."""
        from pyspark import TaskContext

        first = last = None
        for conv, stretch in _stretches(batches):
            last = (conv, [role for role, _ in stretch])
            first = first or last
        if first is None:
            return
        ends = [(2, *first)] if first is last else [(0, *first), (1, *last)]
        flat = [[x for row in a.matrix(roles) for cell in row for x in cell] for *_, roles in ends]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task] * len(ends), pa.int64()), pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64()), pa.array(flat, pa.list_(pa.float64()))], names=["task", "place", "conv_id", "m"])

    found = rows.mapInArrow(edges, "task long, place long, conv_id long, m array<double>").collect()  # at most two for each task
    chains: list[list] = []
    for r in sorted(found, key=lambda r: (r.task, r.place)):
        if chains and r.place != 1 and chains[-1][-1].conv_id == r.conv_id:
            chains[-1].append(r)
        else:
            chains.append([r])
    cell = lambda c, t: _NEVER if c == float("inf") else (int(c), int(t))
    solved: dict[tuple[int, int], tuple[int, int, int, bool]] = {}
    for chain in chains:
        if len(chain) > 1:
            ms = [[[cell(r.m[8 * i + 2 * j], r.m[8 * i + 2 * j + 1]) for j in range(4)] for i in range(4)] for r in chain]
            for k, (r, x) in enumerate(zip(chain, a.through(ms), strict=True)):
                for place in (0, 1) if r.place == 2 else (r.place,):
                    solved[r.task, place] = (*x, k == len(chain) - 1)
    held = spark.sparkContext.broadcast(solved)  # a few numbers for each task

    def repair(batches):
        from pyspark import TaskContext

        task, known = TaskContext.get().partitionId(), held.value
        columns: list[list] = [[] for _ in range(7)]
        stretches, number = _stretches(batches), 0
        current = next(stretches, None)
        while current is not None:
            following = next(stretches, None)
            conv, stretch = current
            roles = [role for role, _ in stretch]
            place = 0 if number == 0 else 1 if following is None else -1
            if (task, place) in known:
                entry, leave, turn, closes = known[task, place]
            else:
                ((entry, leave, turn),), closes = a.through([a.matrix(roles)]), True
            turn, piece = turn - 1, 0
            emit = lambda *x: [c.append(v) for c, v in zip(columns, x, strict=True)]
            # A stretch that begins with merges goes on with the turn before it: its pieces are numbered after any of that.
            base = 0 if entry == START and turn < 0 else 1
            for (_, text), (_, _, _, _, action, extra, role) in zip(stretch, a.path(roles, entry, leave), strict=True):
                if action == "merge":
                    piece += 1
                else:
                    if action == "insert":
                        turn += 1
                        emit(conv, turn, 0, "insert", extra, "", _render(0, extra, ""))
                    turn, piece, base = turn + 1, 0, 0
                emit(conv, turn, piece + (base and number == 0 and (task + 1 << 32)), "keep" if action == "insert" else action, role, text, _render(1 if action == "merge" else 0, role, text))
            if closes and leave == USER:
                turn += 1
                emit(conv, turn, 0, "insert", "assistant", "", _render(0, "assistant", ""))
            number += 1
            current = following
            if len(columns[0]) >= 1000 or current is None:
                kinds = (pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "out_turn", "piece", "action", "role", "text", "rendered"])
                columns = [[] for _ in range(7)]

    return rows.mapInArrow(repair, "conv_id long, out_turn long, piece long, action string, role string, text string, rendered string")
