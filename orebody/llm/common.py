"""Shared helpers: Arrow text buffers as numpy arrays, vectorised hashing, checkpoints."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.sources.shared import checkpoint, ensure_checkpoint_dir  # noqa: F401  shared with the operators

#: Bytes of text that a numpy kernel works on at once; bounds a Python worker's memory.
KERNEL_BYTES = 1 << 20

#: Fixed constants: splitmix64 increments and multipliers.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_2
    return x ^ (x >> np.uint64(31))


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, int64 offsets of n + 1) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_slices(offs: np.ndarray, limit: int = KERNEL_BYTES):
    """Ranges of rows whose texts hold at most ``limit`` bytes (or one row, however long)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def in_slices(batches, column: int, limit: int = 4 * KERNEL_BYTES):
    """The batches, cut so that the texts of a column hold at most ``limit`` bytes each (or one row); what a batch
    took is given back when the next is asked for."""
    for batch in batches:
        _, offs = text_buffers(batch.column(column))
        for i, j in row_slices(offs, limit):
            yield batch.slice(i, j - i)
    pa.default_memory_pool().release_unused()


class Poly:
    """Polynomial hash modulo 2**64 of any span of a byte buffer, from one prefix sum.

    The hash of a span depends on its bytes alone, so equal spans anywhere hash alike.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1, 2**62)) * 4 + 3
        self._pow = self._powers(self.base, 1)
        self._inv = self._powers(pow(self.base, -1, 2**64), 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(max(n, 1), np.uint64)
        out[0] = 1
        have = 1
        while have < n:
            take = min(have, n - have)
            out[have : have + take] = out[:take] * np.uint64(pow(base, have, 2**64))
            have += take
        return out

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._pow) < n:
            n = max(n, KERNEL_BYTES + 1024)
            self._pow, self._inv = self._powers(self.base, n), self._powers(pow(self.base, -1, 2**64), n)
        return self._pow, self._inv

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums; ``values`` are bytes, or uint64 symbols used as they are."""
        up, _ = self.powers(len(values) + 1)
        v = self.table[values] if values.dtype == np.uint8 else values
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(v * up[: len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts, ends) -> np.ndarray:
        _, down = self.powers(len(prefix))
        return mix64((prefix[ends] - prefix[starts]) * down[starts])


@functools.lru_cache(maxsize=8)
def poly(seed: int) -> Poly:
    """One hash family a seed and worker process."""
    return Poly(seed)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, true inside the inclusive ranges."""
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


#: Bytes that part words of the class [^\x20\x09-\x0D]+.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of the class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
WORD_BYTES = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(buf: np.ndarray, offs: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row, n + 1 long) of maximal runs of member bytes inside each row."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = members[buf]
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offs[:-1][offs[:-1] < len(buf)]] = False
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learnt from: crc32(doc_id as text) mod 3 is 1 (a null id is held out of neither)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
