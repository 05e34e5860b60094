"""Shared pieces: scratch tables in the shared folder, Arrow text access, vectorised word and shingle hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: White space, as one contract's word rule names it: words are runs of anything else.
SPACE = "\\x20\\x09-\\x0D"
#: Word bytes of the other rule: ASCII digits and letters and every byte of a non-ASCII character.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z become a-z, other bytes stay; 1 is added so that no byte hashes as nothing.
LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
LOWER[0x41:0x5B] += np.uint64(32)

SHINGLE = 5
BATCH_ROWS = 512
CHUNK_BYTES = 2_000_000


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only in a local session may it be unset: then it is a folder of this machine; elsewhere that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = getattr(spark, "_quarrylens_scratch", None)
        if found is None:
            found = spark._quarrylens_scratch = "file://" + tempfile.mkdtemp(prefix="quarrylens-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Written tables in the shared folder: they cut lineage and survive the loss of an executor."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.names = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}", set()

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            self.names.discard(name)

    def drop_all_but(self, *names: str) -> None:
        self.drop(*(self.names - set(names)))


def small_batches(spark: SparkSession) -> None:
    """Texts can be long: at most BATCH_ROWS rows go to a Python worker at once. The setting is the session's and only lowered."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def tasks_of(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def hot_keys(counts: DataFrame, keys: list[str], n: str, total: int) -> DataFrame | None:
    """Keys that hold more than a quarter of an average task's rows, with `slices`, the number of parts to cut each into.

    counts has one row for each key. Of `total` rows in P tasks there are fewer than 4 P such keys, so they may be broadcast. None without any.
    """
    spark = counts.sparkSession
    most = max(100, total // (4 * tasks_of(spark)))
    found = counts.filter(F.col(n) > most).select(*keys, F.ceil(F.col(n) / most).cast("int").alias("slices"))
    rows = found.toArrow()  # read back as a local table, without a job of Python tasks
    return spark.createDataFrame(rows) if rows.num_rows else None


def hot_in(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """hot_keys of a written table's rows."""
    return hot_keys(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key")), keys, "rows_of_key", df.count())


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: DataFrame | None, by: Column) -> DataFrame:
    """left joined with right, which has one row for each key; left's rows of a hot key are dealt over its slices by `by`.

    The right row of a hot key is repeated for each slice: in all fewer than 8 P rows more.
    """
    if hot is None:
        return left.join(right, keys, how)
    hot = F.broadcast(hot)  # fewer than 4 P rows
    dealt = left.join(hot, keys, "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64(by), F.col("slices")), F.lit(0))).drop("slices")
    repeated = right.join(hot, keys, "left").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("slices", F.lit(1)).cast("bigint") - 1))).drop("slices")
    return dealt.join(repeated, [*keys, "slice"], how).drop("slice")


def in_order(scratch: Scratch, df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df written in sorted range parts, with `at`: a whole number that ascends along the order, the part above its lower 33 bits and the row in the part in them.

    Rows alike in the order's keys are dealt over parts by their place of reading, so copies don't land in one task.
    """
    dealt = df.withColumn("_read", F.monotonically_increasing_id())
    parts = dealt.repartitionByRange(tasks_of(df.sparkSession), *order, "_read").sortWithinPartitions(*order, "_read")
    return scratch.table(parts.drop("_read").withColumn("at", F.monotonically_increasing_id()), name)


def places(ordered: DataFrame) -> DataFrame:
    """in_order's table with `place`, 0, 1, 2 ... along the order."""
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row for each part
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return ordered.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("place", F.col("_before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def space_words(text: Column) -> Column:
    """The words of the white-space rule, in order; null has none."""
    cleaned = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]{{2,}}|[\\x09-\\x0D]", " "))
    return let(cleaned, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, " ")))


def utf8_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and offsets (one more than rows); nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def row_chunks(off: np.ndarray, most: int = CHUNK_BYTES):
    """Ranges of rows of about `most` bytes; a longer text is a range of its own."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_P = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("p", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", _P), ("q", pow(_P, -1, 1 << 64))):
            out = np.empty(size, dtype=np.uint64)
            out[0], filled = 1, 1
            step = base
            while filled < size:
                take = min(filled, size - filled)
                out[filled : filled + take] = out[:take] * np.uint64(step)
                step = step * step % (1 << 64)
                filled += take
            _POWERS[key] = out
    return _POWERS["p"], _POWERS["q"]


#: Odd factors for the places of a shingle.
PLACES = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


class Words:
    """The lower-cased words of rows lo..hi of a text column: row, byte range and 64-bit hash of each."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(data)
        word = WORD_BYTE[data]
        begin, end = word.copy(), word.copy()
        if n:
            begin[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            first = off[:-1][off[:-1] < off[1:]]
            begin[first] = word[first]
            last = off[1:][off[:-1] < off[1:]] - 1
            end[last] = word[last]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.rows = len(off) - 1
        self.row = np.searchsorted(off[1:], self.start, side="right")
        self.count = np.bincount(self.row, minlength=self.rows)
        p, q = _powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(LOWER[data] * p[:n], out=total[1:])
        self.hash = mix64((total[self.end] - total[self.start]) * q[self.start] + (self.end - self.start).astype(np.uint64))

    def shingles(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, hash and first word of each window of `size` words; a text of fewer words, but not none, is one window."""
        n, h = len(self.hash), self.hash
        first = np.concatenate(([0], np.cumsum(self.count)))[:-1]
        if n >= size:
            code = h[: n - size + 1] * PLACES[0]
            for k in range(1, size):
                code = code + h[k : n - size + 1 + k] * PLACES[k]
            at = np.flatnonzero(self.row[: n - size + 1] == self.row[size - 1 :])
            row, code = self.row[at], mix64(code[at])
        else:
            row, code, at = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((self.count > 0) & (self.count < size))
        if len(short):
            left, width = first[short], self.count[short]
            sums = np.zeros(len(short), dtype=np.uint64)
            for k in range(size - 1):
                has = width > k
                sums[has] += h[left[has] + k] * PLACES[k]
            row, code, at = np.concatenate((row, short)), np.concatenate((code, mix64(sums ^ PLACES[9]))), np.concatenate((at, left))
            order = np.argsort(row, kind="stable")
            row, code, at = row[order], code[order], at[order]
        return row, code, at
