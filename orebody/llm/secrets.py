"""Secret scan: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Two first-order Markov models over bytes are trained from labelled samples (random-looking strings, label 1;
ordinary identifiers and words, label 0).  A run of token characters is a secret when its log-likelihood
ratio is at least ``MEAN_RATIO`` a character and ``TOTAL_RATIO`` in all.  Spans of the models are
added where they touch no span of the fixed patterns, which all stay.

Scale: one pass over the documents without a shuffle; the models are one table of 256 x 256 ratios.  Training
takes at most ``SAMPLE_DOCS`` distinct texts, found by a filter on their hash, and of each label at most
``MOST_RUNS`` distinct runs in the order of their hash; a run counts by its first ``RUN_BYTES`` bytes there.

Defined results: null text counts as empty and has no spans; repeated rows are scanned alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm.common import byte_class, checkpoint, row_slices, text_buffers, word_spans

#: The base patterns, their least lengths, and the order of kinds at one start.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "markov")

HEX = byte_class((0x30, 0x39), (0x61, 0x66))
TOKEN = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x2B, 0x2B), (0x2F, 0x2F), (0x5F, 0x5F), (0x3D, 0x3D), (0x2D, 0x2D))
#: Token characters that a model run needs at least.
LEAST_RUN = 20
MEAN_RATIO, TOTAL_RATIO = 0.8, 24.0
SAMPLE_DOCS = 2000
#: Texts drawn for each one wanted: copies among them fall together.
DRAWN = 4
#: Distinct token runs of each label that the models learn from, and bytes of a run.
MOST_RUNS, RUN_BYTES = 200_000, 200
#: Random strings of each alphabet that are added to the labelled samples.
RANDOM_STRINGS = 2000
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-")

SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_markov bigint"


def transitions(samples: list[bytes], prior: float = 0.05) -> np.ndarray:
    """Log-probabilities of each byte after each byte, smoothed."""
    counts = np.full((256, 256), prior)
    for s in samples:
        a = np.frombuffer(s, np.uint8)
        if len(a) > 1:
            np.add.at(counts, (a[:-1], a[1:]), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def train(samples: list[tuple[bytes, int]]) -> np.ndarray:
    """Table of log-likelihood ratios (random over ordinary) from samples labelled 1 (random) and 0 (ordinary)."""
    return transitions([s for s, y in samples if y == 1]) - transitions([s for s, y in samples if y == 0])


def labelled_samples(docs: DataFrame, most: int = SAMPLE_DOCS, seed: int = 0) -> list[tuple[bytes, int]]:
    """Random strings of fixed alphabets and values of base spans (1); other token runs of at most ``most`` documents (0).

    Texts are drawn by a hash of the text that lies under a share of its range, set by the number of distinct
    texts, so that few more than are wanted leave their partition, however many rows there are; copies count once.
    """
    rng = np.random.default_rng(seed)
    out = [(bytes(rng.choice(list(alphabet.encode()), int(rng.integers(20, 65))).astype(np.uint8)), 1) for alphabet in ALPHABETS for _ in range(RANDOM_STRINGS)]

    def runs(batches):
        for batch in batches:
            found: dict[tuple[bytes, int], None] = {}
            for text in batch.column(0):
                data = (text.as_py() or "").encode()
                touched = Taken(base_spans(data))
                for m in re.finditer(rb"[A-Za-z0-9+/_=-]{4,}", data):
                    inside = touched(m.start(), m.end())
                    if not inside or m.end() - m.start() >= LEAST_RUN:
                        found[m[0][:RUN_BYTES], int(inside)] = None
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.binary()), pa.array([k[1] for k in found], pa.int32())], names=["s", "y"])

    texts = docs.select("text", F.xxhash64("text").alias("at")).filter(F.col("text").isNotNull())
    share = max(1, texts.agg(F.approx_count_distinct("at")).first()[0] // (DRAWN * most))
    sample = texts.filter(F.pmod("at", F.lit(share)) == 0).dropDuplicates(["text"]).orderBy("at", "text").limit(most).select("text")
    found = checkpoint(sample.mapInArrow(runs, "s binary, y int").distinct())
    for label in (0, 1):
        part = found.filter(F.col("y") == label).orderBy(F.xxhash64("s"), "s").limit(MOST_RUNS).toArrow()
        out += [(s, label) for s in part["s"].to_pylist()]
    return out


class Taken:
    """Whether a stretch touches any of some spans (start, kind, end)."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, _, b in spans:  # in order of start
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def __call__(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b) - 1
        return k >= 0 and self.ends[k] > a


def hex_runs(data: bytes) -> list[tuple[int, int]]:
    starts, ends, _ = word_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]), HEX)
    long = ends - starts >= LEAST_HEX
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns' matches, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= LEAST_ASSIGN] if b"=" in data or b":" in data else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(a, 2, b) for a, b in hex_runs(data)]
    return sorted(out)


def scan_rows(texts, ratios: np.ndarray):
    """For each text, spans (start, kind, end) in code points, in order."""
    buf, offs = text_buffers(texts)
    for i, j in row_slices(offs):
        part, at = buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        starts, ends, first = word_spans(part, at, TOKEN)
        long = np.flatnonzero(ends - starts >= LEAST_RUN)
        # hexadecimal runs are token runs or lie in one, so rows without a long token run have none
        marked = np.zeros(j - i, bool)
        marked[np.searchsorted(at, starts[long], side="right") - 1] = True
        seps = np.concatenate([[0], np.cumsum((part == 0x3D) | (part == 0x3A))])
        marked |= np.diff(seps[at]) > 0
        by_row: dict[int, list[int]] = {}
        if len(long):
            pairs = ratios[part[:-1], part[1:]] if len(long) * 64 > len(part) else None
            for k in long.tolist():
                a, b = int(starts[k]), int(ends[k])
                score = pairs[a : b - 1].sum() if pairs is not None else ratios[part[a : b - 1], part[a + 1 : b]].sum()
                if score >= TOTAL_RATIO and score >= MEAN_RATIO * (b - a - 1):
                    by_row.setdefault(int(np.searchsorted(at, a, side="right")) - 1, []).append(k)
        for r in range(j - i):
            data = part[at[r] : at[r + 1]].tobytes() if marked[r] else b""
            spans = base_spans(data) if marked[r] else []
            if r in by_row:
                touched = Taken(spans)
                runs = [(int(starts[k] - at[r]), 3, int(ends[k] - at[r])) for k in by_row[r]]
                spans += [(a, kind, b) for a, kind, b in runs if not touched(a, b)]
            if spans and not data.isascii():
                points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                spans = [(int(points[a]), kind, int(points[b])) for a, kind, b in spans]
            yield sorted(spans)


def joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def scan(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """SCHEMA's columns for every document row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            rows = list(scan_rows(batch.column(1), shared.value))
            counts = [[sum(kind == k for _, kind, _ in spans) for spans in rows] for k in range(4)]
            base = [hashlib.sha256(joined([x for x in spans if x[1] != 3]).encode()).hexdigest() for spans in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(base, pa.string()), pa.array([joined(s) for s in rows], pa.string()), pa.array(counts[3], pa.int64())],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
