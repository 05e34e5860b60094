"""Repairs against a search over all edits written out state by state, segments against whole conversations, odd tables."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quarrylens.llm import queries, sql, structure

SCHEMA = "conv_id long, turn long, role string, text string, dropped boolean, conv_key string, segment int, audit string"
GRAMMAR = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(turns):
    """(audit, cost, repaired) by best-first search over (row, state), cheapest and then least letters first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(turns) and q in ("", "a"):
            return audit, cost, "\n".join(out)
        if (i, q) in done:
            continue
        done.add((i, q))
        for x, after in GRAMMAR[q].items():
            if x != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", i, after, (*out, f"{NAMES[x]}:")))
        if i < len(turns):
            fault, role, text = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q, out))
            if fault in ("", "truncated"):
                extra = 3 if fault else 0
                for x, after in GRAMMAR[q].items():
                    if x == role[:1]:
                        heapq.heappush(heap, (cost + extra, audit + "K", i + 1, after, (*out, f"{role}:{text}")))
                    if x != "s":
                        heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, after, (*out, f"{NAMES[x]}:{text}")))


def plain_report(rows, damaging=True):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damage(rows) if damaging else [(c, t, " " if ro is None else ro, " " if x is None else x) for c, t, ro, x in rows]:
        convs[r[0]].append(r)
    out = []
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        seen, turns, n = set(), [], Counter()
        for _, _, role, text in found:
            left = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            turns.append((fault, role, text))
        numbers = {r[1] for r in found if r[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [r[2][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        audit, cost, text = plain_repair(turns)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def random_rows(rnd, convs, most, wild=True):
    roles = ["system", "user", "assistant", "user", "assistant", *(["tool", "", None, " ", "u"] if wild else [])]
    texts = ["Yes.", "No!", "Why?", "cut off", " ok. \n", "  ", "", None, "é ", "a.b"]
    out = []
    for c in range(convs):
        for k in range(rnd.randrange(most)):
            text = rnd.choice(texts)
            out.append((None if wild and c == 3 else c, None if wild and rnd.random() < 0.05 else k * rnd.choice([1, 1, 2]), rnd.choice(roles), text and rnd.random() < 0.8 and text + str(k) + "." or text))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, True, "x", 1, "y") for r in rows], SCHEMA)


def test_query(spark):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{data}/conversations.parquet").to_pylist()]
    assert Counter(map(tuple, queries.queries()["op12_conversations"](spark, data).collect())) == plain_report(rows)


@pytest.mark.parametrize("bits", [12, 1])
def test_against_search(spark, monkeypatch, bits):
    """Random conversations, also cut into segments of at most two turns."""
    monkeypatch.setattr(structure, "SEGMENT_BITS", bits)
    rows = random_rows(random.Random(bits), 120, 14)
    assert Counter(map(tuple, structure.damage_and_repair(table(spark, rows)).collect())) == plain_report(rows)


def test_long_and_odd(spark, monkeypatch):
    """A conversation that holds most rows, rows alike, all rows dropped, a very long text, no rows."""
    monkeypatch.setattr(structure, "SEGMENT_BITS", 6)
    rnd = random.Random(2)
    rows = [(7, k, *r[2:]) for k, r in enumerate(random_rows(rnd, 300, 12, wild=False))] + [(8, 1, "user", "same.")] * 400 + random_rows(rnd, 5, 6)
    dropped = next((c, 1) for c in range(100, 1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows += [(*dropped, "user", "gone."), (9, 1, "user", "x" * 3_000_000 + "."), (9, 2, "assistant", "y.")]
    got = Counter(map(tuple, structure.damage_and_repair(table(spark, rows)).collect()))
    want = plain_report(rows)
    assert got == want and any(r[0] == dropped[0] and r[6:] == (0, "", hashlib.sha256(b"").hexdigest()) for r in got)
    assert structure.damage_and_repair(table(spark, [])).collect() == []


def test_repaired_turns(spark):
    """The operator's own output: the edits with roles and texts; what is left is legal and has the reported digest."""
    rows = random_rows(random.Random(9), 40, 10)
    repair = structure.repair_structure(table(spark, rows))
    report = {r.conv_id: r for r in repair.report().collect()}
    assert Counter(map(tuple, report.values())) == plain_report(rows, damaging=False)
    kept = {}
    for r in repair.turns().orderBy("conv_key", "segment", "place").collect():
        kept.setdefault(r.conv_key, []).append(r)
    for conv, r in report.items():
        edits = kept.get("-" if conv is None else f"={conv}", [])
        assert "".join(e.letter for e in edits) == r.audit
        left = [e for e in edits if e.letter != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(e.role[0] for e in left)) and hashlib.sha256("\n".join(f"{e.role}:{e.text}" for e in left).encode()).hexdigest() == r.repaired_sha256


def test_table_stays_small():
    """Vectors are few, however long the conversations are."""
    rnd, costs = random.Random(4), structure.Costs()
    for _ in range(30):
        costs.scan([rnd.randrange(16) for _ in range(5_000)], structure._END)
        costs.matrix([rnd.randrange(16) for _ in range(500)])
    assert len(costs.vectors) < 200


def test_sql_on_random_rows():
    con, rows = duckdb.connect(), random_rows(random.Random(1), 120, 14)
    con.register("conversations", pa.table({c: [r[k] for r in rows] for k, c in enumerate(("conv_id", "turn", "role", "text"))}))
    assert Counter(con.execute(sql.oracle_sql()["op12_conversations"]).fetchall()) == plain_report(rows)
