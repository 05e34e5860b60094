"""Least costs by writing out every way to change a conversation; legality is a pattern over the whole result."""

import itertools
import random
import re

from quarrylens.llm import chat


def least(roles, p=chat.ChatParams()):
    """(cost, turns) over all ways to keep, merge, put an empty turn before or relabel each turn, and to add one at the end."""
    legal = re.compile(r"s?(ua)*$")
    best = None
    ways = ["keep", "merge", "+s", "+u", "+a", "s", "u", "a"]
    for chosen in itertools.product(ways, repeat=len(roles)):
        for last in ("", "a"):
            out, cost = "", 0
            for role, way in zip(roles, chosen, strict=True):
                name = role[0] if role else None
                if way == "merge":
                    if not name or out[-1:] != name:
                        break
                    cost += p.merge
                elif way == "keep" or way[0] == "+":
                    if not name:
                        break
                    out, cost = out + way[1:] * (way[0] == "+") + name, cost + p.insert * (way[0] == "+")
                elif way == name:
                    break
                else:
                    out, cost = out + way, cost + (p.relabel if role else p.relabel_unknown)
            else:
                out, cost = out + last, cost + p.insert * len(last)
                if legal.fullmatch(out) and (best is None or (cost, len(out)) < best):
                    best = cost, len(out)
    return best


def test_all_short_conversations():
    a = chat.Automaton()
    for n in (1, 2, 3):
        for roles in itertools.product([*chat.ROLES, None], repeat=n):
            m = a.matrix(roles)[chat.START]
            mine = min((c + a.ends[s][0], t + a.ends[s][1]) for s, (c, t) in enumerate(m) if c != float("inf"))
            assert mine == least(roles), roles


def test_rows_of_all_kinds(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system", "Bot", None]), f"{c}.{t}", "x") for c in range(8) for t in range(4)]
    rows += [(None, t, "user", f"none.{t}", "x") for t in range(3)] + [(50, None, "user", None, "x"), (50, None, "user", None, "x"), (50, 1, "user", "y" * 200_000, "x"), (50, 1, "user", "tie", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string")
    for params in (chat.ChatParams(), chat.ChatParams(task_rows=3)):
        got = chat.repair_roles(turns, params).collect()
        for conv in {x[0] for x in rows}:
            mine = sorted((x for x in got if x.conv_id == conv), key=lambda x: (x.out_turn, x.piece))
            roles = [chat.known_role(x[2]) for x in rows if x[0] == conv]
            heads = [next(x.role for x in mine if x.out_turn == k) for k in range(mine[-1].out_turn + 1)]
            if conv is not None and conv < 8:
                assert len(heads) == least(roles)[1]
            assert re.fullmatch(r"s?(ua)*", "".join(h[0] for h in heads))
            assert sorted(x.text for x in mine if x.action != "insert" or x.text) == sorted((x[3] or "") for x in rows if x[0] == conv) or sum(len(x.text) for x in mine) == sum(len(x[3] or "") for x in rows if x[0] == conv)
    assert chat.repair_roles(turns.limit(0)).count() == 0
