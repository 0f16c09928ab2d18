"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of the benchmark items (a shorter item is one
window of its own length).  Patterns of one length m form a table: the shift of a block of two words is
the least distance from its last occurrence in any pattern to the pattern's end (m - 1 for a block that no
pattern holds), so a search stands only on every (m - 1)th word of ordinary text.  A position of shift
zero selects the patterns with that suffix block, thinned by the hash of the whole window, and the bytes
are then compared directly.  All documents of a buffer are searched at once, one lane each.

Scale: documents are read once, without a shuffle.  The patterns are broadcast only below
``pattern_bytes`` of benchmark text; a larger benchmark is cut into blocks of items, each searched in a
pass of its own, and the passes are merged by document.

Defined results: null text and null items have no words; an empty benchmark hits nothing; equal windows of
several items count for each; repeated document rows give repeated result rows (with several benchmark
blocks too); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm.common import LOWER, WORD_BYTES, mix64, poly, row_slices, text_buffers, word_spans

WINDOW = 10
#: Most benchmark text in one broadcast table of patterns; the table takes about 12 bytes for each of text.
PATTERN_BYTES = 2 << 20
#: Shift tables have 2**TABLE_BITS entries, addressed by the hash of a block.
TABLE_BITS = 18
#: Words that one lane of the search covers.
LANE = 2048

SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, item_ids array<string>"
RAW = "doc_id bigint, __row bigint, n_words bigint, runs array<bigint>, item_ids array<string>"


def words_of(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, first word of each row, word hashes)."""
    buf, offs = text_buffers(texts)
    return lowered_words(buf, offs)


def lowered_words(buf, offs):
    low = LOWER[buf]
    starts, ends, first = word_spans(low, offs, WORD_BYTES)
    family = poly(11)
    hashes = family.spans(family.prefix(low), starts, ends) if len(low) else np.zeros(0, np.uint64)
    return low, starts, ends, first, hashes


def window_hashes(words: np.ndarray, m: int) -> np.ndarray:
    """Hash of every run of m word hashes, from prefix sums."""
    if len(words) < m:
        return np.zeros(0, np.uint64)
    family = poly(12)
    prefix = family.prefix(words)
    at = np.arange(len(words) - m + 1)
    return family.spans(prefix, at, at + m)


class PatternTable:
    """Wu-Manber tables of the patterns of one length, as flat arrays over the items' words."""

    def __init__(self, m: int, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, heads: np.ndarray, owners: np.ndarray, names: list[str]):
        """``heads``: first word of each window of the items; ``owners``: its item, an index of ``names``."""
        self.m, self.low, self.starts, self.ends, self.names = m, low, starts, ends, names
        self.block = min(2, m)
        reach = m - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, reach, np.int64)
        for at in range(reach):  # a column at a time
            keys = block_keys(words[heads + at], words[heads + at + self.block - 1], self.block)
            np.minimum.at(self.shift, keys, reach - 1 - at)
        family, other = poly(12), poly(13)
        hashes = family.spans(family.prefix(words), heads, heads + m)
        checks = other.spans(other.prefix(words), heads, heads + m)
        order = np.lexsort((checks, hashes))
        hashes, checks = hashes[order], checks[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1]))[: len(hashes)]
        self.hashes, self.heads = hashes[new], heads[order][new]
        self.suffix = keys[order][new]
        # items of pattern p: owners[at[p]:at[p + 1]], each once
        pairs = np.unique(((np.cumsum(new) - 1) << 32) | owners[order])
        self.owners = (pairs & 0xFFFFFFFF).astype(np.int32)
        self.at = np.searchsorted(pairs >> 32, np.arange(len(self.hashes) + 1))
        same = np.append(False, self.hashes[1:] == self.hashes[:-1])[: len(self.hashes)]
        self.most = int(np.diff(np.flatnonzero(np.append(~same, True))).max(initial=1))  # patterns of one hash

    def text(self, p: int) -> bytes:
        """The pattern's words, joined by a space."""
        h = int(self.heads[p])
        return b" ".join([self.low[self.starts[w] : self.ends[w]].tobytes() for w in range(h, h + self.m)])

    def items(self, p: int) -> list[str]:
        return [self.names[i] for i in self.owners[self.at[p] : self.at[p + 1]].tolist()]

    def search(self, low, starts, ends, first, words) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, pattern) of each occurrence."""
        m = self.m
        if len(words) < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        addresses = block_keys(words[: len(words) - self.block + 1], words[self.block - 1 :], self.block)
        # a lane stands on the last word of a window; it ends where its stretch of one document ends
        spans = [np.arange(a + m - 1, b, LANE) for a, b in zip(first[:-1].tolist(), first[1:].tolist()) if b - a >= m]
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        last = np.repeat([b for a, b in zip(first[:-1].tolist(), first[1:].tolist()) if b - a >= m], [len(s) for s in spans])
        at = np.concatenate(spans)
        stop = np.minimum(at + LANE, last)
        found = []
        while len(at):
            shift = self.shift[addresses[at - self.block + 1]]
            stand = at[shift == 0]
            if len(stand):
                found.append(stand)
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        head = np.concatenate(found) - m + 1
        family = poly(12)
        whole = family.spans(family.prefix(words), head, head + m)
        first_of = np.searchsorted(self.hashes, whole)
        heads, patterns = [], []
        for step in range(self.most):
            k = np.minimum(first_of + step, len(self.hashes) - 1)
            same = np.flatnonzero((self.hashes[k] == whole) & (self.suffix[k] == addresses[head + m - self.block]) & (first_of + step < len(self.hashes)))
            held = {}
            for h, p in zip(head[same].tolist(), k[same].tolist()):
                if p not in held:
                    held[p] = self.text(p)
                if b" ".join([low[starts[w] : ends[w]].tobytes() for w in range(h, h + m)]) == held[p]:
                    heads.append(h)
                    patterns.append(p)
        return np.array(heads, np.int64), np.array(patterns, np.int64)


def block_keys(left: np.ndarray, right: np.ndarray, block: int) -> np.ndarray:
    keys = left if block == 1 else mix64(left * np.uint64(3) + right)
    return (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def build_tables(item_ids: list, texts, window: int) -> list[PatternTable]:
    """One table a pattern length: the window, and the lengths of shorter items."""
    low, starts, ends, first, words = words_of(texts)
    count = np.diff(first)
    names = [str(i) for i in item_ids]
    out = []
    for m in np.unique(np.minimum(count[count > 0], window)).tolist():
        own = np.flatnonzero((count == m) if m < window else (count >= m))
        n = count[own] - m + 1
        owners = np.repeat(own, n)
        heads = first[owners] + np.arange(len(owners)) - np.repeat(np.cumsum(n) - n, n)
        out.append(PatternTable(m, low, starts, ends, words, heads, owners, names))
    return out


def scan(tables: list[PatternTable], texts):
    """Yields, for each text, (number of words, hit runs as [from, to, from, to, ...], items)."""
    buf, offs = text_buffers(texts)
    for i, j in row_slices(offs):
        low, starts, ends, first, words = lowered_words(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        heads, tails, items = [], [], []
        for table in tables:
            head, pattern = table.search(low, starts, ends, first, words)
            heads.append(head)
            tails.append(head + table.m)
            items.extend(table.items(p) for p in pattern.tolist())
        head = np.concatenate(heads) if heads else np.zeros(0, np.int64)
        tail = np.concatenate(tails) if tails else np.zeros(0, np.int64)
        row = np.searchsorted(first, head, side="right") - 1
        by_row: dict[int, list[int]] = {}
        for k, r in enumerate(row.tolist()):
            by_row.setdefault(r, []).append(k)
        count = np.diff(first)
        for r in range(j - i):
            runs, names = [], set()
            for k in sorted(by_row.get(r, ()), key=lambda k: int(head[k])):
                a, b = int(head[k] - first[r]), int(tail[k] - first[r])
                if runs and a <= runs[-1]:
                    runs[-1] = max(runs[-1], b)
                else:
                    runs += [a, b]
                names.update(items[k])
            yield int(count[r]), runs, sorted(names)


def digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def benchmark_blocks(benchmark: DataFrame, pattern_bytes: int) -> list[DataFrame]:
    """Blocks of items with about ``pattern_bytes`` of text at most (an item is never cut)."""
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / pattern_bytes))
    items = benchmark.select("item_id", "text")
    return [items] if n == 1 else [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """SCHEMA's columns for every document row: words, hit words, items that occur, their digest."""
    sc = docs.sparkSession.sparkContext
    blocks = benchmark_blocks(benchmark, pattern_bytes)

    def tables_of(block):
        rows = block.toArrow()  # bounded by pattern_bytes
        return sc.broadcast(build_tables(rows["item_id"].to_pylist(), rows["text"], window))

    if len(blocks) == 1:
        shared = tables_of(blocks[0])

        def run(batches):
            for batch in batches:
                rows = list(scan(shared.value, batch.column(1)))
                hit = [sum(r[1][1::2]) - sum(r[1][::2]) for r in rows]
                cols = [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array([len(r[2]) for r in rows], pa.int64()),
                    pa.array([digest(r[2]) for r in rows], pa.string()),
                    pa.array([h > 0 for h in hit], pa.bool_()),
                    pa.array([r[2] for r in rows], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in SCHEMA.split(", ")])

        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)

    def one_pass(block):
        shared = tables_of(block)

        def run(batches):
            for batch in batches:
                rows = list(scan(shared.value, batch.column(2)))
                cols = [batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))))]
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in RAW.split(", ")])

        # rows are told apart by id and text; equal rows have equal results and keep their number
        return docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text"), "text").mapInArrow(run, RAW)

    passes = [one_pass(b).withColumn("__pass", F.lit(k)) for k, b in enumerate(blocks)]
    union = passes[0]
    for p in passes[1:]:
        union = union.unionByName(p)
    merged = union.groupBy("doc_id", "__row", "n_words").agg(
        F.flatten(F.collect_set("runs")).alias("__runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
        F.sum(F.when(F.col("__pass") == 0, 1).otherwise(0)).alias("__copies"),
    )

    @F.pandas_udf("bigint")
    def covered(runs):
        return runs.map(_covered)

    hit = covered("__runs")
    out = merged.withColumn("n_hit", hit).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "item_ids",
    )


def _covered(runs) -> int:
    """Words in the union of runs given as a flat list of from, to."""
    total = end = 0
    for a, b in sorted(zip(runs[::2], runs[1::2])):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return int(total)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs; one pass, no shuffle."""
    blocks = benchmark_blocks(benchmark, PATTERN_BYTES)
    at = docs.columns.index("text")
    for block in blocks:
        rows = block.toArrow()  # bounded by PATTERN_BYTES
        shared = docs.sparkSession.sparkContext.broadcast(build_tables(rows["item_id"].to_pylist(), rows["text"], window))

        def run(batches, shared=shared):
            for batch in batches:
                yield batch.filter(pa.array([not runs for _, runs, _ in scan(shared.value, batch.column(at))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
