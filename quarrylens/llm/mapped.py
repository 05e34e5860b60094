"""Packed arrays that a job writes once and every worker maps into memory.

A job's rows (shard, name, seq, data) are the pieces of named byte arrays. They are written as Parquet into the shared folder
and shipped to each executor once with addFile. The first worker of an executor unpacks a shipped file beside it, the others
map what it left; a lost executor's successor gets the files again. Mapped pages are shared by all workers of a machine.
"""

from __future__ import annotations

import os
import shutil
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import shared_folder

SCHEMA = "shard int, name string, seq int, data binary"
_PIECE = 64_000_000


def packed(shard: int, arrays: dict[str, np.ndarray]) -> pa.Table:
    """The rows of one shard's arrays, none over _PIECE bytes."""
    rows = []
    for name, values in arrays.items():
        raw = np.ascontiguousarray(values).view(np.uint8).ravel()
        rows += [(name, k, raw[lo : lo + _PIECE].tobytes()) for k, lo in enumerate(range(0, max(1, len(raw)), _PIECE))]
    return pa.table({"shard": pa.array([shard] * len(rows), pa.int32()), "name": pa.array([r[0] for r in rows], pa.string()), "seq": pa.array([r[1] for r in rows], pa.int32()), "data": pa.array([r[2] for r in rows], pa.binary())})


def publish(pieces: DataFrame) -> list[str]:
    """Writes the pieces (all of a shard in one task) and ships them; the names of the shipped files."""
    spark = pieces.sparkSession
    sc = spark.sparkContext
    path = f"{shared_folder(spark)}/mapped-{uuid.uuid4().hex}"
    pieces.write.parquet(path)
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    names = []
    for f in folder.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(folder):
        if f.getPath().getName().startswith("part-"):
            sc.addFile(f.getPath().toString())
            names.append(f.getPath().getName())
    return sorted(names)


_OPENED: dict[tuple, list[dict[str, np.ndarray]]] = {}


def opened(names: list[str]) -> list[dict[str, np.ndarray]]:
    """The arrays (bytes) of each shard of some shipped files, by shard number."""
    key = tuple(names)
    if key not in _OPENED:
        _OPENED.clear()
        shards: dict[int, dict[str, np.ndarray]] = {}
        for name in names:
            folder = _unpacked(SparkFiles.get(name))
            for f in os.listdir(folder):
                shard, array = f.split("-", 1)
                path = os.path.join(folder, f)
                shards.setdefault(int(shard), {})[array] = np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.zeros(0, np.uint8)
        _OPENED[key] = [shards[k] for k in sorted(shards)]
    return _OPENED[key]


def _unpacked(path: str) -> str:
    folder = f"{path}.arrays"
    if not os.path.isdir(folder):
        own = f"{path}.{uuid.uuid4().hex}"
        os.mkdir(own)
        for batch in pq.ParquetFile(path).iter_batches(batch_size=1):
            for shard, name, data in zip(*(batch.column(c) for c in ("shard", "name", "data")), strict=True):
                with open(os.path.join(own, f"{shard.as_py()}-{name.as_py()}"), "ab") as out:
                    out.write(data.as_buffer())
        try:
            os.rename(own, folder)
        except OSError:  # another worker was first
            shutil.rmtree(own)
    return folder
