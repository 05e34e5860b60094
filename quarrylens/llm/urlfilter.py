"""URL filter over a sorted digest array.

Rules are (host, path, verdict): a short list or a table of any size. Spark sorts them by the 64-bit xxhash of host and path
into range parts; each part packs its keys in order and, beside them, offsets into the rules' full strings. The parts are
written into the shared folder, shipped to every executor once and memory-mapped there (`mapped`). A url asks for each host
suffix on a label boundary with each path prefix whose length some rule has; all keys of a batch are hashed, the part and the
place are found by vectorised binary searches, and every match is confirmed by the stored string. The longest rule that fits
wins, by characters of host and path, then the longer host, then block.

Cases: a null url or one without "://" has an empty host and path and no rule fits it; without a rule the verdict is
`default`. Of two equal rules the block stands; rules with a null host or path are none. Repeated rows are judged alike. Urls
may be of any length. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import mapped
from .common import small_batches

_AZ = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, pattern, 1), *_AZ), F.regexp_extract(text, pattern, 2)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")


def publish(rules: DataFrame) -> tuple[list[str], list[int], int]:
    """Ships the sorted parts; their files, the path lengths that occur (bounded by `MOST_LENGTHS`) and the most labels of a host."""
    known = rules.select(F.col("host").cast("string").alias("host"), F.col("path").cast("string").alias("path"), (F.col("verdict") == "block").alias("block")).filter("host is not null and path is not null")
    known = known.groupBy("host", "path").agg(F.max("block").alias("block"))

    def keyed(batches):
        for batch in batches:
            keys = [xxhash.xxh64_intdigest(f"{h}\0{p}".encode()) for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64) ^ np.int64(-(2**63))), *batch.columns], names=["key", "host", "path", "block"])

    def pack(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if tables:
            t = pa.concat_tables(tables)
            text = [(("b" if block else "a") + f"{h}\0{p}").encode() for h, p, block in zip(t["host"].to_pylist(), t["path"].to_pylist(), t["block"].to_pylist(), strict=True)]
            keys = t["key"].to_numpy().astype(np.int64) ^ np.int64(-(2**63))
            ends = np.cumsum([0, *map(len, text)]).astype(np.uint64)
            yield from mapped.packed(t["part"][0].as_py(), {"keys": keys.view(np.uint64), "ends": ends, "text": np.frombuffer(b"".join(text), np.uint8)}).to_batches()

    # Keys are signed here with the top bit turned over, so that Spark sorts them as unsigned numbers.
    parts = known.mapInArrow(keyed, "key long, host string, path string, block boolean")
    parts = parts.repartitionByRange(F.col("key")).sortWithinPartitions("key", "host", "path").withColumn("part", F.spark_partition_id())
    lengths = [r.n for r in known.select(F.char_length("path").alias("n")).distinct().limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"rules' paths have more than {MOST_LENGTHS} lengths")
    depth = known.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first().n or 0
    return mapped.publish(parts.mapInArrow(pack, mapped.SCHEMA)), sorted(lengths, reverse=True), depth


#: Lengths of paths, each of which is asked for at every url.
MOST_LENGTHS = 2000


class DigestStore:
    """The parts of the digest array, mapped where they lie, in the order of their keys."""

    def __init__(self, shards: list[dict[str, np.ndarray]]):
        self.parts = [(s["keys"].view(np.uint64), s["ends"].view(np.uint64), s["text"]) for s in shards]
        self.first = np.array([keys[0] for keys, _, _ in self.parts], np.uint64)

    def find(self, texts: list[str]) -> list[str | None]:
        """The payload letter of each text, None if it isn't stored."""
        out: list[str | None] = [None] * len(texts)
        if not self.parts or not texts:
            return out
        keys = np.fromiter((xxhash.xxh64_intdigest(t.encode()) for t in texts), dtype=np.uint64, count=len(texts))
        part = np.maximum(np.searchsorted(self.first, keys, "right") - 1, 0)
        for k in np.unique(part):
            at = np.flatnonzero(part == k)
            stored, ends, text = self.parts[k]
            lo, hi = np.searchsorted(stored, keys[at], "left"), np.searchsorted(stored, keys[at], "right")
            for i in np.flatnonzero(hi > lo):
                for j in range(lo[i], hi[i]):
                    full = text[int(ends[j]) : int(ends[j + 1])].tobytes().decode()
                    if full[1:] == texts[at[i]]:
                        out[at[i]] = full[0]
        return out


def filter_urls(pages: DataFrame, rules: list[Rule] | DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict), a row for each row of pages. rule is host + path of the winner, else null."""
    small_batches(pages.sparkSession)
    names, lengths, depths = publish(rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules))

    def run(batches):
        store = DigestStore(mapped.opened(names))
        for batch in batches:
            asked, owner = [], []
            for i, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                labels = host.rsplit(".", depths) if host else []
                for d in range(1, min(depths, host.count(".") + 1 if host else 0) + 1):
                    suffix = ".".join(labels[-d:])
                    for n in lengths:
                        if n <= len(path):
                            asked.append((suffix, path[:n]))
                            owner.append(i)
            rule: list[str | None] = [None] * batch.num_rows
            verdict, rank = [default] * batch.num_rows, [(-1, -1)] * batch.num_rows
            for i, (h, p), found in zip(owner, asked, store.find([f"{h}\0{p}" for h, p in asked]), strict=True):
                if found and (len(h) + len(p), len(h)) > rank[i]:
                    rank[i], rule[i], verdict[i] = (len(h) + len(p), len(h)), h + p, "block" if found == "b" else "allow"
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    host, path = host_and_path(F.col("url"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
