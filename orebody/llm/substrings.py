"""Exact substring deduplication over words: symbols of a recompression reveal what can repeat, windows verify it.

Every word that lies in a window of ``window`` words whose sequence also starts anywhere else is removed.

1. Each bucket of documents names runs of words and pairs, round by round, and asks about its distinct symbols;
   the ranges of names, over all buckets, number those that occur more than once.  A symbol that occurs once
   rules out all windows around its reach.
2. Under these numbers each bucket goes on naming runs and pairs, where no symbol is known to occur once, and
   asks about the higher symbols in the same way: those that are shared reveal the long repeats.
3. The windows that are left (the repeated ones, and about a seventh more) send 96-bit content hashes; those that
   start at two places, in one bucket or in two, are repeats.
4. Each bucket removes the words that its repeated windows cover.

The steps read the same exchange of the documents, a bucket a partition.  What moves besides the text is about
two bytes a word for the symbols and 16 bytes for each distinct candidate window of a bucket.

Defined results: null text has no words; documents shorter than a window keep everything; repeated rows
are copies of each other like any other; null ids are allowed; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm import recompression, repeats
from orebody.llm.common import NOT_BLANK, poly, row_slices, word_spans

WINDOW = 35
#: Rounds of pairs before and after all buckets' names meet: symbols of about six words, whose reach nearly always fits in a window.
ROUNDS = (3, 3)
BUCKET_BYTES = 6 << 20
#: Keys of one range that a reducer holds at once, about.
REDUCER_BYTES_OF_TEXT = 64 << 20

SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, removed array<bigint>, kept string"
_ASKED_SCHEMA = "r int, p int, keys binary, several binary"
_NAMED_SCHEMA = "p int, r int, flags binary, numbers binary"
_WINDOW_SCHEMA = "r int, p int, keys binary, checks binary, at binary, runs binary"
_FOUND_SCHEMA = "p int, at binary, runs binary"


def bucket_words(table: pa.Table):
    """(rows in order, bytes, offsets, word hashes, first word of each row)."""
    table, buf, offs = repeats.bucket_of(table)
    hashes, firsts, n = [], [np.zeros(1, np.int64)], 0
    family = poly(21)
    for i, j in row_slices(offs):
        part = buf[offs[i] : offs[j]]
        starts, ends, first = word_spans(part, offs[i : j + 1] - offs[i], NOT_BLANK)
        hashes.append(family.spans(family.prefix(part), starts, ends))
        firsts.append(first[1:] + n)
        n += len(starts)
    return table, buf, offs, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def bits(mask: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """The mask's stretches, packed."""
    return [np.packbits(mask[a:b]).tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def asked(p: int, names: np.ndarray, n: int) -> pa.Table:
    """What a bucket asks of the ranges about its symbols: each distinct name once, and whether the bucket has it twice."""
    keys, counts = np.unique(names, return_counts=True)
    full, edges = repeats.ranges(keys, n)
    blocks = {"keys": repeats.blocks(keys, edges), "several": bits(counts > 1, edges)}
    return pa.table({"r": pa.array(full), "p": pa.array(np.full(len(full), p, np.int32)), **{k: pa.array(v, pa.binary()) for k, v in blocks.items()}})


def named(table: pa.Table) -> pa.Table:
    """A range's answer to every bucket: which of its names occur more than once anywhere, and their numbers."""
    blocks = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
    several = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(b)).astype(bool) for m, b in zip(table["several"].to_pylist(), blocks)]
    keys, back, counts = np.unique(np.concatenate(blocks), return_inverse=True, return_counts=True)
    often = counts > 1
    np.logical_or.at(often, back, np.concatenate(several))
    number = np.cumsum(often).astype(np.uint32)  # from 1; the same in every run, since names are in order
    parts = np.split(back, np.cumsum([len(b) for b in blocks])[:-1])
    flags = [np.packbits(often[k]).tobytes() for k in parts]
    numbers = [number[k][often[k]].tobytes() for k in parts]
    return pa.table({"p": table["p"].cast(pa.int32()), "r": table["r"].cast(pa.int32()), "flags": pa.array(flags, pa.binary()), "numbers": pa.array(numbers, pa.binary())})


def answered(names: np.ndarray, n: int, table: pa.Table) -> np.ndarray:
    """For every symbol its number over all ranges, 0 if it occurs once."""
    keys, back = np.unique(names, return_inverse=True)
    full, edges = repeats.ranges(keys, n)
    out = np.zeros(len(keys), np.uint64)
    for k, r, flags, numbers in zip(np.searchsorted(full, table["r"].to_numpy()).tolist(), table["r"].to_pylist(), table["flags"].to_pylist(), table["numbers"].to_pylist()):
        a, b = edges[k : k + 2].tolist()
        often = np.unpackbits(np.frombuffer(flags, np.uint8), count=b - a).astype(bool)
        out[a:b][often] = np.frombuffer(numbers, np.uint32) + (np.uint64(r) << np.uint64(32))
    return out[back]


def ruled_out(symbols: recompression.Symbols, single: np.ndarray, window: int, n: int) -> np.ndarray:
    """Starts of windows in which a symbol that occurs once has all its reach."""
    safe = single & (symbols.hi - symbols.lo <= window)
    return repeats.marked(n, np.maximum(symbols.hi[safe] - window, 0), symbols.lo[safe] + 1)


def windows_at(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows that start at ``at``."""
    out = []
    for seed in (31, 32):
        family = poly(seed)
        out.append(family.spans(family.prefix(words), at, at + window))
    return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


def deduplicate(docs: DataFrame, window: int = WINDOW, rounds: tuple[int, int] = ROUNDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, removed (word runs as from, to, ...) and kept (words joined by a space)."""
    dealt, total, n_buckets = repeats.buckets(docs, bucket_bytes)
    n_ranges = max(1, math.ceil(total / REDUCER_BYTES_OF_TEXT))

    def first_symbols(words, first):
        return recompression.advance(recompression.tokens_as_symbols(words, first), 0, rounds[0])

    def second_symbols(symbols, answers):
        numbered = recompression.renamed(symbols, answered(symbols.name, n_ranges, answers))
        return numbered.single, recompression.advance(numbered, rounds[0], rounds[1])

    def send_first(key, table):
        _, _, _, words, first = bucket_words(table)
        return asked(key[0].as_py(), first_symbols(words, first).name, n_ranges)

    def send_second(key, table, answers):
        _, _, _, words, first = bucket_words(table)
        _, higher = second_symbols(first_symbols(words, first), answers)
        return asked(key[0].as_py(), higher.name[~higher.single], n_ranges)  # of single symbols nothing need be asked

    def send_windows(key, table, answers):
        _, _, _, words, first = bucket_words(table)
        lower = first_symbols(words, first)
        of_step = answers["step"].to_numpy()
        single, higher = second_symbols(lower, answers.filter(pa.array(of_step == 1)))
        can = repeats.whole_windows(first, window) & ~ruled_out(lower, single, window, len(words))
        open_ = np.flatnonzero(~higher.single)
        once = higher.single.copy()
        once[open_] = answered(higher.name[open_], n_ranges, answers.filter(pa.array(of_step == 2))) == 0
        at = np.flatnonzero(can & ~ruled_out(higher, once, window, len(words)))
        windows, local = repeats.window_blocks(*windows_at(words, at, window), at, len(words), n_ranges)
        p = key[0].as_py()
        runs = [b""] * len(windows)
        if windows:
            runs[p % len(windows)] = local.astype(np.int32).tobytes()
        keys, checks, at = zip(*windows.values()) if windows else ((), (), ())
        return pa.table(
            {
                "r": pa.array(list(windows), pa.int32()),
                "p": pa.array([p] * len(windows), pa.int32()),
                "keys": pa.array(keys, pa.binary()),
                "checks": pa.array(checks, pa.binary()),
                "at": pa.array(at, pa.binary()),
                "runs": pa.array(runs, pa.binary()),
            }
        )

    def match_windows(table):
        found = [x.tobytes() for x in repeats.match_windows(table)]
        return pa.table({"p": table["p"].cast(pa.int32()), "at": pa.array(found, pa.binary()), "runs": table["runs"].cast(pa.binary())})

    def remove(table, found):
        table, buf, offs = repeats.bucket_of(table)
        texts = [buf[a:b].tobytes().split() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        at = [np.frombuffer(b, np.int32) for b in found["at"].to_pylist()]
        runs = [np.frombuffer(b, np.int32).reshape(-1, 2) for b in found["runs"].to_pylist()]
        starts = np.concatenate([np.zeros(0, np.int32), *at, *(r[:, 0] for r in runs)]).astype(np.int64)
        ends = np.concatenate([np.zeros(0, np.int32), *(a + 1 for a in at), *(r[:, 1] for r in runs)]).astype(np.int64)
        gone = repeats.marked(int(first[-1]), starts, ends + window - 1)
        total = np.concatenate([[0], np.cumsum(gone)])
        n_removed = np.diff(total[first])
        kept, removed = [], []
        for r, words in enumerate(texts):
            own = gone[first[r] : first[r + 1]]
            if n_removed[r]:
                kept.append(b" ".join(compress(words, (~own).tolist())))
                removed.append(np.stack(repeats.runs_of(own), axis=1).reshape(-1).tolist())
            else:
                kept.append(b" ".join(words))
                removed.append([])
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "removed": pa.array(removed, pa.list_(pa.int64())),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    to_buckets = lambda rows: rows.repartitionById(n_buckets, F.col("p")).groupBy("p")
    answers = repeats.by_range(dealt.groupBy("p").applyInArrow(send_first, _ASKED_SCHEMA), n_ranges).applyInArrow(named, _NAMED_SCHEMA).withColumn("step", F.lit(1))
    higher = dealt.groupBy("p").cogroup(to_buckets(answers)).applyInArrow(send_second, _ASKED_SCHEMA)
    more = repeats.by_range(higher, n_ranges).applyInArrow(named, _NAMED_SCHEMA).withColumn("step", F.lit(2))
    candidates = dealt.groupBy("p").cogroup(to_buckets(answers.unionByName(more))).applyInArrow(send_windows, _WINDOW_SCHEMA)
    found = repeats.by_range(candidates, n_ranges).applyInArrow(match_windows, _FOUND_SCHEMA)
    return dealt.groupBy("p").cogroup(to_buckets(found)).applyInArrow(remove, SCHEMA)
