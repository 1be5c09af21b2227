"""Helpers shared by the corpus operators: the shared folder, written tables, safe document ids and packed arrays."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import json
import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside an operator, so that joins and groups keep such rows; results show null again.
NULL_ID = -(2**63)

_live: list[Workspace] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Where it is unset, a local session gets a new local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not jvm_dir.isDefined() and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        found = jvm_dir.get() if jvm_dir.isDefined() else f"file://{tempfile.mkdtemp(prefix='quire-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Workspace:
    """Tables that one operator run writes into the shared folder, so that losing executors does not lose them.

    Results are lazy and read these tables, so they stay until drop() or the end of the driver.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _live.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def forget(self, name: str) -> None:
        """Deletes one table that nothing reads any more."""
        self._delete(self.path(name))

    def _delete(self, path: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is None:
            return
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

    def drop(self) -> None:
        if self in _live:
            _live.remove(self)
        self._delete(self.root)


def live_workspaces() -> list[Workspace]:
    return list(_live)


@atexit.register
def _drop_all() -> None:
    for workspace in live_workspaces():
        try:
            workspace.drop()
        except Exception:  # noqa: BLE001  the JVM may be gone by now
            pass


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def safe_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID)).alias(name)


def shown_id(name: str = "doc_id") -> Column:
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)


def compress(value: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(value)


def expand(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value)


def pack(*arrays: np.ndarray) -> bytes:
    """One compressed value that holds several one-dimensional arrays."""
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    return compress(struct.pack("<I", len(head)) + head + b"".join(a.tobytes() for a in arrays))


def unpack(value: bytes) -> list[np.ndarray]:
    raw = expand(value)
    (size,) = struct.unpack_from("<I", raw)
    at, out = 4 + size, []
    for kind, count in json.loads(raw[4:at]):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    return out


def planes(numbers: np.ndarray) -> list[np.ndarray]:
    """The four bytes of each number as four arrays, which pack well."""
    return [(numbers >> np.uint32(8 * k)).astype(np.uint8) for k in range(4)]


def whole(parts: list[np.ndarray]) -> np.ndarray:
    return sum(part.astype(np.int64) << (8 * k) for k, part in enumerate(parts))


def portions(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose texts (column 1) have at most so many bytes, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, upto - at)
        at = upto


#: What Python workers keep from task to task.
caches: dict[str, object] = {}


def give_back() -> None:
    """Gives free memory back to the system, as a worker is used again by other operators and stages, which would otherwise hold the sum of all peaks."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(function):
    """A mapInArrow function that drops the worker's caches first and afterwards gives free memory back."""

    @functools.wraps(function)
    def run(batches):
        caches.clear()
        yield from function(batches)
        give_back()

    return run


def trimmed_group(function):
    """An applyInArrow function that gives free memory back after each group."""

    @functools.wraps(function)
    def run(table):
        out = function(table)
        del table
        give_back()
        return out

    return run


class Interner(dict):
    """Numbers its keys in the order in which they are first looked up."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number
