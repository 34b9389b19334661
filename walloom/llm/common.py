"""What several corpus operators share: table access, checkpoints, hashing, lookups."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_folder, stored

__all__ = ["Lookup", "broadcast_if_small", "checkpoint_folder", "checkpointed", "frugal", "mix", "slices", "stored", "string_bytes", "table", "worker_cache"]

MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, so that columns with other names never clash."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, in the folder that the session names."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


_caches: dict[str, dict] = {}


def worker_cache(operator: str) -> dict:
    """What a Python worker keeps for an operator from task to task. Workers outlive their stage, so what they kept for others is dropped."""
    for other in [name for name in _caches if name != operator]:
        del _caches[other]
    return _caches.setdefault(operator, {})


def frugal(run, operator: str):
    """A task's function that hands the memory of past batches back, which Arrow's pool would keep as long as the worker lives."""

    def task(batches):
        worker_cache(operator)
        for out in run(batches):
            yield out
            pa.default_memory_pool().release_unused()
        gc.collect()
        pa.default_memory_pool().release_unused()

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (uint64 in and out)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a whole string column and its offsets; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]] if len(offsets) else flat[:0], offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def slices(batches, most_bytes: int = 8 << 20, column: str = "text"):
    """Record batches cut into runs of rows of bounded text size (one row at least), so that memory stays flat."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        run = (np.cumsum(sizes) - sizes) // most_bytes
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


class Lookup:
    """A read-only map from uint64 keys to small ints, for whole arrays of keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int, bits: int = 20):
        keys, values = np.asarray(keys, np.uint64), np.asarray(values, np.int32)
        while len(keys) > (1 << bits) // 8:
            bits += 1
        self.missing, self.shift = np.int32(missing), np.uint64(64 - bits)
        self.keys = np.concatenate([keys, np.zeros(1, np.uint64)])
        self.values = np.concatenate([values, np.full(1, missing, np.int32)])
        none = len(keys)
        for salt in range(1, 100):
            self.salts = (np.uint64(0x9E3779B97F4A7C15 * (2 * salt + 1) % 2**64), np.uint64(0xC2B2AE3D27D4EB4F * (2 * salt + 1) % 2**64))
            first, second = self._slots(keys)
            self.first, self.second = np.full(1 << bits, none, np.int32), np.full(1 << bits, none, np.int32)
            self.first[first] = np.arange(none, dtype=np.int32)
            rest = np.flatnonzero(self.first[first] != np.arange(none))
            self.second[second[rest]] = rest.astype(np.int32)
            if (self.second[second[rest]] == rest).all():
                return
        raise ValueError("keys repeat")

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (keys * self.salts[0]) >> self.shift, (keys * self.salts[1]) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        first, second = self._slots(keys)
        a, b = self.first[first], self.second[second]
        found = self.keys[a] == keys
        out = np.where(found, self.values[a], np.where(self.keys[b] == keys, self.values[b], self.missing))
        return np.where((keys == 0) & ~found, self.missing, out) if (keys == 0).any() else out


def broadcast_if_small(df: DataFrame, rows: int, most: int = 1_000_000) -> DataFrame:
    """Broadcast a narrow table of a counted size if that is within the bound; beyond it Spark shuffles both sides."""
    return F.broadcast(df) if rows <= most else df
