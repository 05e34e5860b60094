"""Repair of conversations whose turns are blank, repeated, cut short or out of order, with an audit of the edits.

Legal sequences of role initials are `(s?(ua)+)?`. Edits keep, relabel, delete or insert turns at a cost; blank and repeated turns must go.
The least costs from a turn to the end, one for each of the automaton's four states, are a vector. Taken less their minimum, vectors are
the states of a deterministic automaton that reads turns from the last to the first: its transitions (next vector, cost added) are made when first needed and
kept in a table, so a conversation is a scan of table look-ups. The differences in a vector are bounded, as every state can be
left for any later one by a few edits, so the table stays small however long the conversations are. The scan leaves the cost; a trace
against its direction, from the first turn, follows arcs that are tight, which is a second table, and of tight edits takes the least letter: the audit is the
least of the cheapest ones.

Conversations may be longer than a task should hold. Turns are sorted by conversation and place into range parts; a part's stretches of at
most 4,096 turns are segments, each a short text of symbols (fault and initial). For conversations of more segments, a segment's costs
are a min-plus matrix, got by scans from the four unit vectors; matrices are put together by conversation, then each segment is
traced from every state it may be entered in, and the traces' ends are chained. Only these small tables are grouped by conversation. Texts
move once to be sorted and once to meet their segment's edits. The digest of a whole conversation is a chain by its nature: its pieces,
one or a few for a segment, stream through one task in order and are held one at a time.

Cases: a null role or text is one space (a text of white space is blank); roles other than those beginning with s, u or a fit nowhere; turns in order, null
ones first, those of one turn by role and then by digest of the text, rows alike in any order; rows without conv_id are one conversation; repeated rows are
duplicates; texts and conversations of any length; an empty table gives no rows. Other columns, clashing names included, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, hot_keys, in_order, small_batches, split_join

ROLES = ("system", "user", "assistant")
SPACES = " \t\n\x0b\f\r"
KEEP, RELABEL, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SEGMENT_BITS = 12
PIECE_CHARS = 4_000_000
#: States of the automaton: nothing yet, after system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = (USER, USER, ASSISTANT, USER)  # the state after an inserted or relabelled turn
_KEPT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})  # the state after a kept turn, by its initial
_END = (0.0, 6.0, 3.0, 0.0)  # costs of ending in a state
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: A turn's symbol: A to P, four initials (s, u, a, another) for each fault (none, truncated, duplicate, blank).
SYMBOLS = "ABCDEFGHIJKLMNOP"


class Costs:
    """The automaton of cost vectors, made as it is needed."""

    def __init__(self):
        self.vectors: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.table: list[list] = []  # by vector and symbol: (vector before the turn, cost added)
        self.moves: dict[tuple, tuple] = {}  # by vector after, symbol and state: (letters, state after, cost)

    def number(self, vector) -> int:
        found = self.numbers.get(vector)
        if found is None:
            found = self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.table.append([None] * 16)
        return found

    @staticmethod
    def before(after, symbol: int) -> tuple:
        """Costs before a turn, from those after it."""
        fault, initial = divmod(symbol, 4)
        extra = TRUNCATED if fault == 1 else 0
        least = [DELETE + after[q] for q in range(4)]
        if fault < 2:
            for q in range(4):
                least[q] = min(least[q], RELABEL + extra + after[_AFTER[q]])
                if initial in _KEPT[q]:
                    least[q] = min(least[q], KEEP + extra + after[_KEPT[q][initial]])
        user, assistant = min(least[USER], INSERT + least[ASSISTANT]), min(least[ASSISTANT], INSERT + least[USER])
        return min(least[START], INSERT + user), min(least[SYSTEM], INSERT + user), user, assistant

    def step(self, after: int, symbol: int) -> tuple[int, float]:
        costs = self.before(self.vectors[after], symbol)
        low = min(costs)
        out = self.table[after][symbol] = (self.number(tuple(c - low for c in costs)), low)
        return out

    def scan(self, symbols: list[int], vector) -> tuple[list[int], tuple]:
        """The numbers of the vectors after each turn, and the costs before the first, from the costs after the last."""
        low = min(vector)
        at, cost, seen, table = self.number(tuple(c - low for c in vector)), low, [], self.table
        for symbol in reversed(symbols):
            seen.append(at)
            at, more = table[at][symbol] or self.step(at, symbol)
            cost += more
        return seen[::-1], tuple(c + cost for c in self.vectors[at])

    def move(self, after: int, symbol: int, state: int) -> tuple[str, int, int]:
        """The least letters on tight arcs from a state up to and over a turn, the state after them and their cost."""
        vector, (fault, initial) = self.vectors[after], divmod(symbol, 4)
        costs, extra, letters, spent, q = self.before(vector, symbol), TRUNCATED if fault == 1 else 0, "", 0, state
        while True:
            kept = _KEPT[q].get(initial) if fault < 2 else None
            if DELETE + vector[q] == costs[q]:
                out = letters + "D", q, spent + DELETE
            elif INSERT + costs[_AFTER[q]] == costs[q]:
                letters, q, spent = letters + "I", _AFTER[q], spent + INSERT
                continue
            elif kept is not None and KEEP + extra + vector[kept] == costs[q]:
                out = letters + "K", kept, spent + KEEP + extra
            else:
                out = letters + "R", _AFTER[q], spent + RELABEL + extra
            self.moves[after, symbol, state] = out
            return out

    def trace(self, symbols: list[int], seen: list[int], state: int, ends: bool) -> tuple[str, int, int]:
        """The audit of a stretch from a state, the state after it and its cost."""
        letters, spent, moves = [], 0, self.moves
        for symbol, after in zip(symbols, seen, strict=True):
            more, state, cost = moves.get((after, symbol, state)) or self.move(after, symbol, state)
            letters.append(more)
            spent += cost
        while ends and _END[state]:
            letters.append("I")
            state, spent = _AFTER[state], spent + INSERT
        return "".join(letters), state, spent

    def matrix(self, symbols: list[int]) -> list[float]:
        """Least costs from each state before a stretch to each after it, row by row."""
        columns = [self.scan(symbols, tuple(0.0 if q == t else math.inf for q in range(4)))[1] for t in range(4)]
        return [columns[t][q] for q in range(4) for t in range(4)]


def _mapped(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str, most: int = 2_000) -> DataFrame:
    """Rows of df through a generator, in the order and the tasks they have; its state outlives batches."""

    def run(batches):
        out = []
        for row in rows(r for batch in batches for r in batch.to_pylist()):
            out.append(row)
            if len(out) >= most or isinstance(row[-1], str) and len(row[-1]) > PIECE_CHARS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), fields.values(), strict=True)], names=list(fields))
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), fields.values(), strict=True)], names=list(fields))

    plain = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    nested = {f"array<{k}>": pa.list_(v) for k, v in plain.items()} | {"array<double>": pa.list_(pa.float64())}
    fields = {c.split()[0]: (plain | nested)[c.split()[1]] for c in schema.split(", ")}
    return df.mapInArrow(run, schema)


def _codes(symbols: str) -> list[int]:
    return [ord(c) - 65 for c in symbols]


def _matrices(rows: Iterator[dict]) -> Iterator[tuple]:
    costs = Costs()
    for r in rows:
        yield r["conv_key"], r["segment"], costs.matrix(_codes(r["symbols"]))


def _costs_after(rows: Iterator[dict]) -> Iterator[tuple]:
    """From a conversation's matrices in order, the costs after each segment."""
    for r in rows:
        vector, last = _END, True
        for part in reversed(r["parts"]):
            yield r["conv_key"], part["segment"], list(vector), last
            m, last = part["matrix"], False
            vector = [min(m[4 * q + t] + vector[t] for t in range(4)) for q in range(4)]


def _tries(rows: Iterator[dict]) -> Iterator[tuple]:
    """A segment's edits from each state it may be entered in; the only segment of a conversation is entered at the start."""
    costs = Costs()
    for r in rows:
        symbols, many = _codes(r["symbols"]), r["after"] is not None
        seen, _ = costs.scan(symbols, tuple(r["after"]) if many else _END)
        tries = [costs.trace(symbols, seen, q, r["last"] if many else True) for q in (range(4) if many else (START,))]
        initials = [s % 4 for s in symbols]
        illegal = sum(pair not in _LEGAL for pair in zip(initials, initials[1:], strict=False))
        yield r["conv_key"], r["segment"], many, illegal, [t[0] for t in tries], [t[1] for t in tries], [t[2] for t in tries]


def _entries(rows: Iterator[dict]) -> Iterator[tuple]:
    for r in rows:
        state = START
        for part in r["parts"]:
            yield r["conv_key"], part["segment"], state
            state = part["ends"][state]


def _edits(rows: Iterator[dict]) -> Iterator[tuple]:
    """(conv_key, segment, many, letter, role, text) for each letter of a segment's audit, its turns following it; letter is null at its end."""
    key, many, audit, at, state = None, False, "", 0, START

    def inserts():
        nonlocal at, state
        while audit[at : at + 1] == "I":
            at, state = at + 1, _AFTER[state]
            yield *key, many, "I", ROLES[state - 1], ""

    for r in rows:
        if r["audit"] is not None:
            if key is not None:
                yield from inserts()
                yield *key, many, None, None, None
            key, many, audit, at, state = (r["conv_key"], r["segment"]), r["many"], r["audit"], 0, r["entry"]
            continue
        yield from inserts()
        letter, role, at = audit[at], r["role"], at + 1
        if letter == "K":
            state = _KEPT[state]["sua".index(role[0])]
        elif letter == "R":
            state = _AFTER[state]
            role = ROLES[state - 1]
        yield *key, many, letter, role, r["text"]
    if key is not None:
        yield from inserts()
        yield *key, many, None, None, None


def _pieces(rows: Iterator[dict]) -> Iterator[tuple]:
    """Digests of conversations of one segment; pieces of the others, to be joined by new lines."""
    hashed, lines, size, number = hashlib.sha256(), [], 0, 0
    first = True
    for key, segment, many, letter, role, text in _edits(rows):
        if letter is None:
            if many:
                if lines:
                    yield key, segment, number, None, "\n".join(lines)
            else:
                yield key, segment, 0, hashed.hexdigest(), None
            hashed, lines, size, number, first = hashlib.sha256(), [], 0, 0, True
        elif letter != "D":
            line = f"{role}:{text}"
            if many:
                lines.append(line)
                size += len(line)
                if size > PIECE_CHARS:
                    yield key, segment, number, None, "\n".join(lines)
                    lines, size, number = [], 0, number + 1
            else:
                hashed.update((line if first else "\n" + line).encode("utf-8", "surrogatepass"))
                first = False


def _chained(rows: Iterator[dict]) -> Iterator[tuple]:
    key, hashed = None, None
    for r in rows:
        if r["conv_key"] != key:
            if key is not None:
                yield key, hashed.hexdigest()
            key, hashed = r["conv_key"], hashlib.sha256()
        else:
            hashed.update(b"\n")
        hashed.update(r["piece"].encode("utf-8", "surrogatepass"))
    if key is not None:
        yield key, hashed.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """The audit's damage, by crc32 of `conv_id:turn`: a row may be dropped (marked so), emptied, stripped of `.!?`, repeated or given to the user."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), copies.alias("_copy")).drop("_copy")


class Repair:
    """A table's conversations, scanned and traced: `tried` has a row for each segment, `rows` the turns in order; both are written tables."""

    def __init__(self, turns: DataFrame):
        """turns: conv_id, turn, role, text, dropped."""
        spark = turns.sparkSession
        small_batches(spark)
        self.scratch, space = Scratch(spark), F.lit(" ")
        key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
        rows = turns.select("conv_id", key.alias("conv_key"), "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), "dropped")
        rows = rows.withColumn("digest", F.md5("text"))
        order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
        self.rows = in_order(self.scratch, rows, order, "rows").withColumn("segment", F.shiftright("at", SEGMENT_BITS))
        self.segments = self.scratch.table(self._segments(), "segments")
        many = self.segments.groupBy("conv_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv_key")
        self.many = self.scratch.table(many, "many")
        self.tried = self._tried()

    def _segments(self) -> DataFrame:
        """(conv_id, conv_key, segment, symbols, low, high, turns): a segment's symbols in order, its least and greatest turn and the number of its turns' values."""
        keys, left = ["conv_key", "role", "digest"], F.col("dropped") == F.lit(False)
        repeated = self.rows.filter(left).groupBy(keys).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        repeated = self.scratch.table(repeated, "repeated")
        hot = hot_keys(repeated, keys, "n", self.rows.count())
        stripped = F.rtrim("text", F.lit(SPACES))
        narrow = self.rows.select("conv_id", *keys, "segment", "at", "turn", "dropped", (stripped == "").alias("blank"), (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"))
        marked = split_join(narrow, repeated.select(*keys, "first"), keys, "left", hot, F.col("at"))
        fault = F.when(F.col("blank"), 3).when(F.col("at") > F.col("first"), 2).when(F.col("cut"), 1).otherwise(0)
        initial = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.left("role", F.lit(1))), F.lit(0)) - 1, F.lit(3))
        initial = F.when(F.col("role") == "", 3).otherwise(initial)
        symbol = F.substring(F.lit(SYMBOLS), fault * 4 + initial + 1, F.lit(1))
        # A segment is part of one part's 4,096 rows.
        found = F.transform(F.sort_array(F.collect_list(F.when(left, F.struct("at", symbol.alias("symbol"))))), lambda x: x["symbol"])
        turn = F.when(left, F.col("turn"))
        return marked.groupBy("conv_key", "segment").agg(F.first("conv_id").alias("conv_id"), F.array_join(found, "").alias("symbols"), F.min(turn).alias("low"), F.max(turn).alias("high"), F.size(F.collect_set(turn)).alias("turns"))

    def _tried(self) -> DataFrame:
        """(conv_key, segment, many, illegal, audit, entry, cost)."""
        narrow = self.segments.select("conv_key", "segment", "symbols")
        schema = "conv_key string, segment bigint, many boolean, illegal int, audits array<string>, ends array<int>, costs array<int>"
        pick = [F.element_at(c, F.col("entry") + 1).alias(n) for c, n in (("audits", "audit"), ("costs", "cost"))]
        parts = lambda df, col: df.groupBy("conv_key").agg(F.sort_array(F.collect_list(F.struct("segment", col))).alias("parts"))
        alone = narrow.join(self.many, "conv_key", "left_anti").select("*", F.lit(None).cast("array<double>").alias("after"), F.lit(True).alias("last"))
        if not self.many.limit(1).count():
            alone = narrow.select("*", F.lit(None).cast("array<double>").alias("after"), F.lit(True).alias("last"))
        tried = _mapped(alone, _tries, schema).withColumn("entry", F.lit(START))
        out = tried.select("conv_key", "segment", "many", "illegal", "entry", *pick)
        if self.many.limit(1).count():
            split = narrow.join(self.many, "conv_key")
            matrices = _mapped(split, _matrices, "conv_key string, segment bigint, matrix array<double>")
            after = _mapped(parts(matrices, "matrix"), _costs_after, "conv_key string, segment bigint, after array<double>, last boolean", 200)
            tried = self.scratch.table(_mapped(split.join(after, ["conv_key", "segment"]), _tries, schema), "tries")
            entries = _mapped(parts(tried, "ends"), _entries, "conv_key string, segment bigint, entry int")
            out = out.unionByName(tried.join(entries, ["conv_key", "segment"]).select("conv_key", "segment", "many", "illegal", "entry", *pick))
        return self.scratch.table(out, "tried")

    def _followed(self) -> DataFrame:
        """Each segment's edits, then its turns in order, in one task; segments are dealt over tasks."""
        edits = self.tried.select("conv_key", "segment", F.lit(-1).cast("bigint").alias("at"), "many", "entry", "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        null = lambda t: F.lit(None).cast(t)
        turns = self.rows.filter("not dropped").select("conv_key", "segment", "at", null("boolean").alias("many"), null("int").alias("entry"), null("string").alias("audit"), "role", "text")
        return edits.unionByName(turns).repartition("conv_key", "segment").sortWithinPartitions("conv_key", "segment", "at")

    def turns(self) -> DataFrame:
        """(conv_key, segment, letter, role, text): the edits in order; a repaired conversation is what its K, R and I letters have."""

        def rows(found):
            for n, (key, segment, _, letter, role, text) in enumerate(_edits(found)):
                if letter is not None:
                    yield key, segment, n, letter, role, text

        return _mapped(self._followed(), rows, "conv_key string, segment bigint, place bigint, letter string, role string, text string")

    def digests(self) -> DataFrame:
        """(conv_key, repaired_sha256)."""
        pieces = self.scratch.table(_mapped(self._followed(), _pieces, "conv_key string, segment bigint, number int, digest string, piece string"), "pieces")
        alone = pieces.filter("digest is not null").select("conv_key", F.col("digest").alias("repaired_sha256"))
        if not self.many.limit(1).count():
            return alone
        split = pieces.filter("digest is null").repartition("conv_key").sortWithinPartitions("conv_key", "segment", "number")
        return alone.unionByName(_mapped(split.select("conv_key", "piece"), _chained, "conv_key string, repaired_sha256 string"))

    def report(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each conversation."""
        count = lambda faults: F.regexp_count("symbols", F.lit(f"[{faults}]")).cast("bigint")
        initial = lambda symbol: F.pmod(F.ascii(symbol) - 65, F.lit(4))
        part = F.struct("segment", "audit", initial(F.left("symbols", F.lit(1))).alias("head"), initial(F.right("symbols", F.lit(1))).alias("tail"), "low", "high", (F.col("symbols") != "").alias("some"))
        both = self.segments.join(self.tried, ["conv_key", "segment"]).withColumn("part", part)
        total = lambda c, n: F.sum(c).cast("bigint").alias(n)
        found = both.groupBy("conv_key").agg(
            F.first("conv_id").alias("conv_id"), F.min("low").alias("low"), F.max("high").alias("high"), total("turns", "turns"), total(count("M-P"), "blank"), total(count("I-L"), "duplicate"),
            total(count("E-H"), "truncated"), total("illegal", "inside"), total("cost", "cost"), F.sort_array(F.collect_list("part")).alias("parts"),
        )
        # Where segments meet: a pair of initials, and a turn that both have.
        some = F.filter("parts", lambda x: x["some"])
        met = lambda test: F.size(F.filter(F.transform("some", lambda x, i: F.coalesce((i > 0) & test(F.get("some", i - 1), x), F.lit(False))), lambda x: x)).cast("bigint")
        legal = lambda a, b: (a["tail"] * 4 + b["head"]).isin(*[4 * a + b for a, b in _LEGAL])
        found = found.withColumn("some", some).withColumn("shared", met(lambda a, b: a["high"] == b["low"])).withColumn("between", met(lambda a, b: ~legal(a, b)))
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - F.col("shared")), F.lit(0)).cast("bigint")
        audit = F.array_join(F.transform("parts", lambda x: x["audit"]), "")
        out = found.join(self.digests(), "conv_key", "left")
        return out.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", (F.col("inside") + F.col("between")).alias("illegal"), "cost", audit.alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_structure(conversations: DataFrame) -> Repair:
    """The repair of a table of turns (conv_id, turn, role, text)."""
    return Repair(conversations.select("conv_id", "turn", "role", "text", F.lit(False).alias("dropped")))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    return Repair(damaged(conversations)).report()
