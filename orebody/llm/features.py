"""Text features as sparse numpy rows: hashed words and structure statistics, from whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm.common import LOWER, WORD_BYTES, byte_class, held_out, mix64, poly, row_slices, text_buffers, word_spans

#: Hashed words are numbered 0 .. 2**WORD_BITS - 1; slots of binned statistics follow.
WORD_BITS = 18
BINS = 16

#: Byte classes whose shares describe a text.
CLASSES = (
    byte_class((0x41, 0x5A)),
    byte_class((0x61, 0x7A), (0x80, 0xFF)),
    byte_class((0x30, 0x39)),
    byte_class((0x21, 0x21)),
    byte_class((0x23, 0x26), (0x2A, 0x2A)),
    byte_class((0x2C, 0x2C), (0x2E, 0x2E), (0x3B, 0x3B)),
    byte_class((0x3C, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
    byte_class((0x0A, 0x0A)),
    byte_class((0x20, 0x20)),
)
#: Shares of the classes, then log length, word length, distinct words, most frequent word.
N_STATS = len(CLASSES) + 4
N_SLOTS = (1 << WORD_BITS) + N_STATS * BINS


def rows_of(texts, prefixes: tuple[int, ...] = ()):
    """For each buffer of rows: (first id of each row, n + 1 long; distinct word ids; their counts; statistics in 0..1)."""
    buf, offs = text_buffers(texts)
    for i, j in row_slices(offs):
        yield sparse_rows(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], prefixes)


def sparse_rows(buf: np.ndarray, offs: np.ndarray, prefixes: tuple[int, ...] = ()):
    """``prefixes``: lengths in bytes of word beginnings that count as features besides the words."""
    n = len(offs) - 1
    low = LOWER[buf]
    starts, ends, first = word_spans(low, offs, WORD_BYTES)
    family = poly(11)
    prefix = family.prefix(low)
    words = family.spans(prefix, starts, ends)
    row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    spread = [(row << np.uint64(WORD_BITS)) | (words >> np.uint64(64 - WORD_BITS))]
    for size in prefixes:
        long = starts + size < ends
        begin = mix64(family.spans(prefix, starts[long], starts[long] + size) + np.uint64(size))
        spread.append((row[long] << np.uint64(WORD_BITS)) | (begin >> np.uint64(64 - WORD_BITS)))
    keys, counts = np.unique(np.concatenate(spread), return_counts=True)
    ids = (keys & np.uint64((1 << WORD_BITS) - 1)).astype(np.int32)
    bounds = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) << np.uint64(WORD_BITS))
    size = np.diff(offs).astype(float)
    stats = np.zeros((n, N_STATS))
    for k, members in enumerate(CLASSES):
        total = np.concatenate([[0], np.cumsum(members[buf], dtype=np.int64)])
        stats[:, k] = np.diff(total[offs]) / np.maximum(size, 1)
    n_words, distinct = np.diff(first), np.diff(bounds)
    k = len(CLASSES)
    stats[:, k] = np.minimum(np.log2(size + 1) / 24, 1)
    total = np.concatenate([[0], np.cumsum(ends - starts)])
    stats[:, k + 1] = np.minimum(np.diff(total[first]) / np.maximum(n_words, 1) / 32, 1)
    stats[:, k + 2] = distinct / np.maximum(n_words, 1) / (1 + len(prefixes))
    if len(counts):
        filled = distinct > 0
        stats[filled, k + 3] = np.maximum.reduceat(counts, bounds[:-1][filled]) / n_words[filled]
    return bounds, ids, counts, stats


def stat_slots(stats: np.ndarray) -> np.ndarray:
    """Slot of each statistic's bin (bins are finer towards 0, where shares lie)."""
    bins = np.minimum((np.sqrt(stats) * BINS).astype(np.int32), BINS - 1)
    return (1 << WORD_BITS) + np.arange(stats.shape[1], dtype=np.int32) * BINS + bins


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]], zero for empty rows; values of one or two dimensions."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), values.dtype)
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(values, bounds[:-1][filled], axis=0)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, column: str, most: int, values: tuple[int, ...], prefixes: tuple[int, ...] = ()):
    """Features of a bounded sample of labelled rows that are not held out.

    Returns (list of (ids, statistics), labels).  For each value at most ``most`` rows are taken, in
    the order of a hash of the id, so that reruns agree; several labels of a document count as their maximum.
    """
    usable = labels.filter(~held_out() & F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("__y"))
    return sampled_rows(docs, [usable.filter(F.col("__y") == v) for v in values], most, prefixes)


def drawn(rows: DataFrame, n_rows: int, most: int, times: int = 3) -> DataFrame:
    """Distinct rows (doc_id and others) whose id's hash falls in a share of about ``times * most`` of ``n_rows``
    rows; what is then ordered and limited to ``most`` stays small in every task, however many rows there are."""
    share = max(1, n_rows // (times * most))
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).distinct()


def sampled_rows(docs: DataFrame, choices: list[DataFrame], most: int, prefixes: tuple[int, ...] = (), only_ids: bool = False):
    """Features of at most ``most`` documents of each choice (tables of doc_id and __y); ``only_ids`` leaves the
    statistics out.  Returns (list of (ids, statistics), labels); the rows are views of two flat arrays.
    """
    parts = [c.select("doc_id", "__y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in choices]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    width = 0 if only_ids else N_STATS

    def extract(batches):
        for batch in batches:
            at = 0
            for bounds, ids, _, stats in rows_of(batch.column(2), prefixes):
                n = len(stats)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        batch.column(1).slice(at, n),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(stats[:, :width].reshape(-1))),
                    ],
                    names=["doc_id", "__y", "ids", "stats"],
                )
                at += n

    # at most choices * most ids are broadcast, a bound that does not grow with the data
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "__y", "text")
    table = joined.mapInArrow(extract, "doc_id bigint, __y int, ids array<int>, stats array<double>").toArrow()
    ids, stats = table["ids"].combine_chunks(), table["stats"].combine_chunks()
    y, doc_id = table["__y"].to_numpy().astype(np.int8), table["doc_id"].to_numpy()
    order = np.lexsort((doc_id, y))
    bounds, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    stats = stats.values.to_numpy().reshape(len(table), width)
    return [(flat[bounds[i] : bounds[i + 1]], stats[i]) for i in order.tolist()], y[order]
