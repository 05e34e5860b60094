"""Benchmark decontamination with one Aho-Corasick automaton.

Items and documents are normalised alike: A-Z become a-z and a text is its words, the runs of ASCII digits, a-z and
non-ASCII characters. The automaton's letters are words: it holds every window of ten consecutive item words (an item of fewer
words is one window). Its nodes are numbered level by level and, within a level, by parent and word, so that goto is one binary
search in a sorted array and node k + 1 is the end of edge k; failure and output links are arrays beside it. A text is scanned
once; as no node is deeper than a window, its state depends on the last ten words only, and a long text is cut into stretches
that begin nine words early and go through the automaton side by side. A match is confirmed on the words themselves, mapped
back to word numbers and, for `contaminated_spans`, to offsets of the original.

The automaton is built once, in a task, and mapped by the workers from a file (`mapped`). Items over `shard_chars` characters
in all make several automata, each built once; a worker then runs a text through each of them, all of them being mapped.

Cases: a null text has no words; an item without words has no window; an empty benchmark hits nothing; the same window in
several items counts for each; all items without an id are one item that `items_sha256` leaves out; repeated rows are judged
alike; texts may be of any length; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import mapped
from .common import LOWER, Words, row_chunks, small_batches, utf8_parts

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_FOLD = (LOWER - np.uint64(1)).astype(np.uint8)
_STRETCH = 64


@dataclass(frozen=True)
class DecontamParams:
    window: int = 10
    shard_chars: int = 4_000_000  # of benchmark text in one automaton


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def build_automaton(item: pa.Array, text: pa.Array, size: int) -> dict[str, np.ndarray]:
    """The arrays of the automaton of some items' windows."""
    data, off = utf8_parts(text)
    words = Words(data, off)
    letters, letter = np.unique(words.hash, return_inverse=True)
    letter = letter.astype(np.int64) + 1
    begin = np.concatenate(([0], np.cumsum(words.count)))[:-1]
    each = np.where(words.count > 0, np.maximum(1, words.count - size + 1), 0)
    owner = np.repeat(np.arange(len(each)), each)
    first = np.repeat(begin, each) + np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    length = np.minimum(words.count[owner], size)

    node, edges, base = np.zeros(len(first), np.uint64), [], 0
    for depth in range(size):
        goes = np.flatnonzero(length > depth)
        if not len(goes):
            break
        keys, end = np.unique((node[goes] << np.uint64(32)) | letter[first[goes] + depth].astype(np.uint64), return_inverse=True)
        edges.append(keys)
        node[goes] = (base + 1 + end).astype(np.uint64)
        base += len(keys)
    ends = np.zeros(base + 1, np.int64)  # 1 + number of the window that ends at a node
    last, one, window = np.unique(node, return_index=True, return_inverse=True)
    ends[last.astype(np.int64)] = np.arange(1, len(last) + 1)
    a = {"edges": np.concatenate([*edges, np.zeros(0, np.uint64)]), "fail": np.zeros(base + 1, np.uint32), "ends": ends.astype(np.uint32), "also": np.zeros(base + 1, np.uint32)}
    lo = 0
    for level in edges:
        child = np.arange(lo + 1, lo + 1 + len(level))
        if lo:
            a["fail"][child] = _goto(a, a["fail"][(level >> np.uint64(32)).astype(np.int64)].astype(np.int64), level & np.uint64(0xFFFFFFFF))
        up = a["fail"][child]
        a["also"][child] = np.where(ends[up] > 0, up, a["also"][up])  # the next shorter window that ends here too
        lo += len(level)

    # Windows: their words in the items' own bytes, and the items that hold them.
    inner = first[one]
    pairs = np.unique(np.stack((window.ravel(), owner)), axis=1)
    ids = item.cast(pa.int64())
    return a | {
        "letters": letters, "lengths": length[one].astype(np.uint8),
        "text": _FOLD[data], "word_start": words.start.astype(np.uint32), "word_end": words.end.astype(np.uint32), "window_word": inner.astype(np.uint32),
        "owners_end": np.cumsum(np.bincount(pairs[0], minlength=len(last))).astype(np.uint64), "owners": pairs[1].astype(np.uint32),
        "item": ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), "item_null": ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
    }


_KINDS = {"edges": np.uint64, "fail": np.uint32, "ends": np.uint32, "also": np.uint32, "letters": np.uint64, "lengths": np.uint8, "text": np.uint8, "word_start": np.uint32, "word_end": np.uint32, "window_word": np.uint32, "owners_end": np.uint64, "owners": np.uint32, "item": np.int64, "item_null": np.uint8}


def _goto(a: dict[str, np.ndarray], state: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """The states after one letter each: along an edge, else from the failure state; the root goes to itself."""
    edges, out = a["edges"], np.zeros(len(state), np.int64)
    todo = np.arange(len(state))
    while len(todo):
        key = (state.astype(np.uint64) << np.uint64(32)) | letter
        at = np.searchsorted(edges, key)
        found = edges[np.minimum(at, len(edges) - 1)] == key
        out[todo[found]] = at[found] + 1
        on = ~found & (state > 0)
        todo, state, letter = todo[on], a["fail"][state[on]].astype(np.int64), letter[on]
    return out


def _found(a: dict[str, np.ndarray], words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The last word of each match and the number of its window, not yet confirmed."""
    nothing = np.zeros(0, np.int64)
    if not len(words.hash) or not len(a["edges"]):
        return nothing, nothing
    at = np.minimum(np.searchsorted(a["letters"], words.hash), len(a["letters"]) - 1)
    letter = np.where(a["letters"][at] == words.hash, at + 1, 0).astype(np.uint64)
    # Runs of known words in one text; the state before a run is the root.
    known = letter > 0
    same = np.zeros(len(known), bool)
    same[1:] = known[:-1] & (words.row[1:] == words.row[:-1])
    start = np.flatnonzero(known & ~same)
    stop = np.append(start[1:], len(known))
    gaps = np.flatnonzero(~known)
    if len(gaps):
        g = np.searchsorted(gaps, start)
        stop = np.where(g < len(gaps), np.minimum(stop, gaps[np.minimum(g, len(gaps) - 1)]), stop)
    long = stop - start >= int(a["lengths"].min())
    start, stop = start[long], stop[long]
    pieces = -(-(stop - start) // _STRETCH)
    run = np.repeat(np.arange(len(start)), pieces)
    own = start[run] + (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _STRETCH
    stop = np.minimum(own + _STRETCH, stop[run])
    at = np.maximum(own - (size - 1), start[run])
    order = np.argsort(at - stop, kind="stable")
    at, own, stop = at[order], own[order], stop[order]
    state, ends, windows, step = np.zeros(len(at), np.int64), [nothing], [nothing], 0
    sizes = stop - at
    live = len(at)
    while live:
        state = _goto(a, state[:live], letter[at[:live] + step])
        node = np.where(a["ends"][state] > 0, state, a["also"][state])
        hit = np.flatnonzero((node > 0) & (at[:live] + step >= own[:live]))
        node = node[hit]
        while len(hit):
            ends.append(at[hit] + step)
            windows.append(a["ends"][node].astype(np.int64) - 1)
            node = a["also"][node].astype(np.int64)
            hit, node = hit[node > 0], node[node > 0]
        step += 1
        live = int(np.searchsorted(-sizes, -step, side="left"))
    return np.concatenate(ends), np.concatenate(windows)


class Scanner:
    """Runs texts through the published automata."""

    def __init__(self, benchmark: DataFrame, p: DecontamParams):
        self.size = p.window
        items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").dropDuplicates()
        chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
        shards = max(1, -(-chars // p.shard_chars))
        size = p.window

        def build(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            arrays = build_automaton(group.column("item_id").combine_chunks(), group.column("text").combine_chunks(), size)
            return mapped.packed(group.column("shard")[0].as_py(), arrays)

        # A shard is a bounded share of the items; each is built in a task of its own.
        dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
        self.names = mapped.publish(dealt.groupBy("shard").applyInArrow(build, mapped.SCHEMA))

    def automata(self) -> list[dict[str, np.ndarray]]:
        return [{k: v.view(_KINDS[k]) for k, v in shard.items()} for shard in mapped.opened(self.names)]

    def hits(self, data: np.ndarray, off: np.ndarray):
        """The words of some texts, which of them are hit, and for each text that is hit (row, id) of the occurring items."""
        words = Words(data, off)
        mark, items = np.zeros(len(words.hash) + 1, np.int64), set()
        for a in self.automata():
            for end, window in zip(*_found(a, words, self.size), strict=True):
                n = int(a["lengths"][window])
                at, inner = end - n + 1, int(a["window_word"][window])
                mine = b" ".join(_FOLD[data[words.start[i] : words.end[i]]].tobytes() for i in range(at, end + 1))
                if mine != b" ".join(a["text"][a["word_start"][i] : a["word_end"][i]].tobytes() for i in range(inner, inner + n)):
                    continue
                mark[at] += 1
                mark[end + 1] -= 1
                lo = int(a["owners_end"][window - 1]) if window else 0
                for k in a["owners"][lo : int(a["owners_end"][window])]:
                    items.add((int(words.row[end]), None if a["item_null"][k] else int(a["item"][k])))
        return words, np.cumsum(mark[:-1]) > 0, items


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), a row for each row of docs."""
    small_batches(docs.sparkSession)
    scanner = Scanner(benchmark, params)
    none = sha256(b"").hexdigest()

    def run(batches):
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            for lo, hi in row_chunks(off):
                words, hit, items = scanner.hits(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                found: dict[int, list] = {}
                for row, item in items:
                    found.setdefault(row, []).append(item)
                n_hit = np.bincount(words.row[hit], minlength=hi - lo)
                sums = [sha256(",".join(sorted(str(i) for i in found[r] if i is not None)).encode()).hexdigest() if r in found else none for r in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(words.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(found.get(r, ())) for r in range(hi - lo)], pa.int64()), pa.array(sums, pa.string()), pa.array(n_hit > 0)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """(doc_id, start, stop): the stretches of hit words of each text, as code point offsets of the original."""
    small_batches(docs.sparkSession)
    scanner = Scanner(benchmark, params)

    def run(batches):
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            for lo, hi in row_chunks(off):
                part, ends = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                words, hit, _ = scanner.hits(part, ends)
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
                runs = np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(words.row[at]) > 0)) + 1)
                row = np.array([words.row[r[0]] for r in runs])
                begin, end = (points[np.array(x)] - points[ends[row]] for x in ([words.start[r[0]] for r in runs], [words.end[r[-1]] for r in runs]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=["doc_id", "start", "stop"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, start long, stop long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """The rows of docs in which no window of an item occurs, with all their columns."""
    small_batches(docs.sparkSession)
    scanner, at = Scanner(benchmark, params), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            data, off = utf8_parts(batch.column(at))
            clean = np.ones(batch.num_rows, bool)
            for lo, hi in row_chunks(off):
                words, hit, _ = scanner.hits(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                clean[lo + np.unique(words.row[hit])] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
