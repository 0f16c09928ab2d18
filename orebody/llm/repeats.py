"""What the two exact-substring operators share: buckets of documents, and finding keys that recur across buckets.

Documents are dealt once, by a hash of id and text, to buckets of bounded bytes; a bucket is read by three
steps of one plan that reuse that one exchange.  A bucket sends each of its distinct keys (64-bit content
hashes) once, as sorted binary blocks, to the reducers of the key's range, and gets one bit a key back:
whether another bucket has it too.  So a key held by a third of all documents costs one entry a bucket,
and key ranges are even whatever the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm.common import text_buffers

#: Most shuffle partitions that buckets are dealt to; beyond, a partition holds several buckets, one at a time in memory.
MOST_PARTITIONS = 20_000
#: Rows of a bucket, for texts so short that bytes bound nothing.
BUCKET_ROWS = 100_000


def buckets(docs: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int, int]:
    """((doc_id, text as binary, p) dealt by p, one bucket a partition; total bytes; number of partitions)."""
    text = F.col("text").cast("binary")
    total, rows = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    n = max(1, math.ceil(total / bucket_bytes), math.ceil(rows / BUCKET_ROWS))
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("p")
    )
    n_parts = min(n, MOST_PARTITIONS)
    return dealt.repartitionById(n_parts, F.col("p")), total, n_parts


def in_order(table: pa.Table) -> pa.Table:
    """The bucket's rows in an order that does not depend on how they arrived (equal rows are alike)."""
    return table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])) if len(table) else table


def bucket_of(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    table = in_order(table)
    return table, *text_buffers(table["text"])


def ranges(sorted_keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(those of n equal key ranges that sorted uint64 keys fall in, their edges, one longer); the cost does not grow with n."""
    r = ((sorted_keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, r[1:] != r[:-1])[: len(r)])
    return r[first].astype(np.int32), np.append(first, len(r))


def blocks(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """The values of each range."""
    return [values[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def key_blocks(p: int, keys: np.ndarray, n: int) -> pa.Table:
    """(r, p, keys): the bucket's distinct sorted keys, cut by range."""
    full, edges = ranges(keys, n)
    return pa.table({"r": pa.array(full), "p": pa.array(np.full(len(full), p, np.int32)), "keys": pa.array(blocks(keys, edges), pa.binary())})


KEY_SCHEMA = "r int, p int, keys binary"
FLAG_SCHEMA = "p int, r int, flags binary"


def by_range(df: DataFrame, n: int):
    """``df`` grouped by r, one of n ranges, each in a partition of its own."""
    return df.repartitionById(min(n, MOST_PARTITIONS), F.col("r")).groupBy("r")


def recurring(table):
    """For each bucket's block of one key range, a bit a key: does another bucket have it?"""
    blocks = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
    sizes = np.array([len(b) for b in blocks])
    keys = np.concatenate(blocks)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    twin = np.zeros(len(s), bool)
    same = s[1:] == s[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    flags = np.empty(len(s), bool)
    flags[order] = twin
    parts = np.split(flags, np.cumsum(sizes)[:-1])
    return pa.table({"p": table["p"].cast(pa.int32()), "r": table["r"].cast(pa.int32()), "flags": pa.array([np.packbits(f).tobytes() for f in parts], pa.binary())})


def flagged(keys: np.ndarray, n: int, table: pa.Table) -> np.ndarray:
    """The bits that came back, in the order of the bucket's distinct sorted keys."""
    full, edges = ranges(keys, n)
    out = np.zeros(len(keys), bool)
    for k, flags in zip(np.searchsorted(full, table["r"].to_numpy()).tolist(), table["flags"].to_pylist()):
        a, b = edges[k : k + 2].tolist()
        out[a:b] = np.unpackbits(np.frombuffer(flags, np.uint8), count=b - a).astype(bool)
    return out


def window_blocks(h: np.ndarray, c: np.ndarray, at: np.ndarray, size: int, n: int) -> tuple[dict[int, tuple[bytes, bytes, bytes]], np.ndarray]:
    """What a bucket of ``size`` tokens sends of its windows, which start at ``at`` and have the hashes (h, c).

    Returns, for each of n ranges of h that has any, (h, c, start) of the distinct windows, and the runs
    [from, to) of the starts of windows that the bucket itself has twice; those windows are sent without a start.
    """
    order = np.lexsort((c, h))
    h, c, at = h[order], c[order], at[order]
    new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))[: len(h)]
    group = np.cumsum(new) - 1
    several = np.bincount(group, minlength=1)[group] > 1
    here = np.zeros(size, bool)
    here[at[several]] = True
    place = np.where(several, -1, at).astype(np.int32)[new]
    h, c = h[new], c[new]
    full, edges = ranges(h, n)
    return dict(zip(full.tolist(), zip(blocks(h, edges), blocks(c, edges), blocks(place, edges)))), np.stack(runs_of(here), axis=1)


def match_windows(table: pa.Table) -> list[np.ndarray]:
    """For each row of one range (keys, checks, at): the starts of windows that another bucket has too."""
    load = lambda name, kind: [np.frombuffer(b, kind) for b in table[name].to_pylist()]
    keys, checks, at = load("keys", np.uint64), load("checks", np.uint32), load("at", np.int32)
    h, c = np.concatenate(keys), np.concatenate(checks)
    order = np.lexsort((c, h))
    h, c = h[order], c[order]
    same = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    twin = np.zeros(len(h), bool)
    twin[1:] |= same
    twin[:-1] |= same
    hit = np.empty(len(h), bool)
    hit[order] = twin
    parts = np.split(hit, np.cumsum([len(k) for k in keys])[:-1])
    return [a[x & (a >= 0)] for a, x in zip(at, parts)]


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def marked(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions 0..n-1 inside any [start, end)."""
    steps = np.bincount(np.clip(starts, 0, n), minlength=n + 1) - np.bincount(np.clip(ends, 0, n), minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def whole_windows(bounds: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a window of ``size`` fits inside its row."""
    fits = np.diff(bounds) >= size
    return marked(int(bounds[-1]), bounds[:-1][fits], bounds[1:][fits] - size + 1)
