"""Exact substring deduplication over bytes by a distributed, sampled suffix array with deep-shallow sorting.

Every byte that lies in a string of ``length`` bytes which also starts anywhere else is removed.

1. Each bucket of documents samples positions whose next ``GRAM`` bytes hash to 0 mod ``SPARSE`` and sends
   content hashes of the ``PROBE`` bytes there; a probe that no other place has rules out all strings around it.
2. Strings that are left are grouped by their anchor, the GRAM of least hash in them.  Neighbours with one
   anchor travel as one slice of text, dealt by the anchor; a bucket sends equal slices once.
3. A reducer collapses equal slices, sorts the suffixes that start at the anchors (multikey quicksort, then
   blind tries) and, walking their common prefixes from long to short, joins groups of suffixes while keeping
   each group ordered by what stands before the anchors.  Two slices share the strings that fit between their
   common part before and after; each suffix need only be held against its neighbours in that order, so no
   group's pairs are listed, yet every shared string is found and compared in full.
   An anchor that very many slices have (a line in a third of all texts, in ever other surroundings) would be
   one reducer's group.  Such anchors are found beforehand in a sample of the documents; their strings go one
   by one, dealt by their own content hashes of 96 bits, of which a bucket sends equal ones once.  Which anchors
   these are does not change the result.
4. Each bucket removes the bytes that its repeated strings cover.

Steps 1, 2 and 4 read the same exchange of the documents.

Defined results: null text is empty; documents shorter than ``length`` keep everything; matches do not cross
documents; repeated rows are copies of each other like any other; null ids are allowed; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm import repeats
from orebody.llm.common import checkpoint, mix64, poly, row_slices, text_buffers
from orebody.llm.suffix_sort import common, sort_suffixes

LENGTH = 400
GRAM = 32
SPARSE = 64
BUCKET_BYTES = 4 << 20
#: Text whose probes, and whose slices, make one key range of the reducers.
PROBE_RANGE_BYTES = 64 << 20
SLICE_RANGE_BYTES = 6 << 20
#: One document of so many, by a hash of id and text, is looked at for frequent anchors.
SAMPLE_SHARE = 64
#: Slices of the sample from which an anchor is frequent, and the most such anchors; beyond, the limit doubles.
FREQUENT_SLICES = 256
MOST_FREQUENT = 500_000

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, removed array<bigint>, kept binary"
_SLICE_SCHEMA = "r int, p int, anchors binary, heads binary, places binary, copies binary, data binary, runs binary, keys binary, checks binary, at binary"
_FOUND_SCHEMA = "p int, runs binary"


def grams(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums, hash of the ``size`` bytes at each position; the largest word where they do not fit)."""
    family = poly(41)
    prefix = family.prefix(buf)
    out = np.full(len(buf), ~np.uint64(0))
    fits = repeats.whole_windows(offs, size)
    n = len(buf) - size + 1
    if n > 0:
        at = np.flatnonzero(fits)
        out[at] = family.spans(prefix, at, at + size)
    return prefix, out


def probes(buf, offs, length):
    """(prefix sums, gram hashes, sampled positions, probe hashes, probe length)."""
    gram = min(GRAM, length)
    probe = max(gram, length // 2)
    prefix, hashes = grams(buf, offs, gram)
    at = np.flatnonzero(((hashes & np.uint64(SPARSE - 1)) == 0) & repeats.whole_windows(offs, probe))
    return prefix, hashes, at, poly(41).spans(prefix, at, at + probe), probe


def anchors(hashes: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Position of the least gram of the string at each position, the first of equal ones."""
    n = len(hashes)
    if n < length:
        return np.arange(n)
    key = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(n, dtype=np.uint64)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        key[: n - size] = np.minimum(key[: n - size], key[size:])
        size *= 2
    rest = width - size
    if rest:
        key[: n - rest] = np.minimum(key[: n - rest], key[rest:])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def frequent_anchors(docs: DataFrame, length: int, share: int = SAMPLE_SHARE, least: int = FREQUENT_SLICES) -> np.ndarray:
    """Sorted names of the anchors that at least ``least`` slices of one document in ``share`` have."""
    gram = min(GRAM, length)

    def run(batches):
        for batch in batches:
            raw, bounds = text_buffers(batch.column(0))
            for i, j in row_slices(bounds):
                buf, offs = raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                hashes = grams(buf, offs, gram)[1]
                place = np.unique(anchors(hashes, length, gram)[repeats.whole_windows(offs, length)])
                yield pa.RecordBatch.from_arrays([pa.array(mix64(hashes[place]).view(np.int64))], names=["name"])

    text = F.col("text").cast("binary")
    chosen = docs.select(text.alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)).alias("k")).filter("k = 0").select("text")
    counted = checkpoint(chosen.mapInArrow(run, "name bigint").groupBy("name").count().filter(F.col("count") >= least))
    while counted.filter(F.col("count") >= least).count() > MOST_FREQUENT:
        least *= 2
    names = counted.filter(F.col("count") >= least).select("name").toArrow()["name"].to_numpy()  # at most MOST_FREQUENT
    return np.sort(names.astype(np.int64).view(np.uint64))


def shared_strings(right: list[bytes], left: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For slices given by what follows their anchor and by what precedes it (reversed): intervals [from, to]
    of offsets before the anchor at which a string of ``length`` bytes starts that another slice has too."""
    out: list[list[tuple[int, int]]] = [[] for _ in right]
    order, prefixes = sort_suffixes(right)
    by_left = sorted(range(len(left)), key=left.__getitem__)
    rank = [0] * len(left)
    for k, i in enumerate(by_left):
        rank[i] = k
    # groups are runs of the suffix order; each is named by its first and last place
    group = {k: [rank[i]] for k, i in enumerate(order)}
    edge = list(range(len(order)))  # the other end of the group that starts or ends here
    longest = [len(x) for x in left]
    reach = {k: longest[i] for k, i in enumerate(order)}
    for k in sorted(range(1, len(order)), key=lambda k: -prefixes[k]):
        rho = prefixes[k]
        a, b = edge[k - 1], k  # first places of the two groups
        end = edge[b]
        one, two = group.pop(a), group.pop(b)
        small, big = (one, two) if len(one) <= len(two) else (two, one)
        least = length - rho
        if least <= min(reach[a], reach[b]):
            for x in small:
                at = bisect_left(big, x)
                for y in big[max(0, at - 1) : at + 1]:
                    i, j = by_left[x], by_left[y]
                    far = common(left[i], left[j])
                    if far >= least:
                        out[i].append((max(least, 0), far))
                        out[j].append((max(least, 0), far))
        if len(small) < 8:
            for x in small:
                insort(big, x)
        else:
            big.extend(small)
            big.sort()
        group[a] = big
        reach[a] = max(reach[a], reach[b])
        edge[a], edge[end] = end, a
    return out


def _windows(buf, prefix, at, length):
    """(two hashes of the strings at ``at``, at, bytes of the bucket)."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), at, len(buf)
    other = poly(42)
    checks = other.spans(other.prefix(buf), at, at + length) >> np.uint64(32)
    return poly(41).spans(prefix, at, at + length), checks.astype(np.uint32), at, len(buf)


def deduplicate(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES, share: int = SAMPLE_SHARE, least: int = FREQUENT_SLICES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, removed (byte runs as from, to, ...) and kept (the bytes that stay)."""
    frequent = frequent_anchors(docs, length, share, least)
    dealt, total, n_buckets = repeats.buckets(docs, bucket_bytes)
    probe_ranges = max(1, math.ceil(total / PROBE_RANGE_BYTES))
    slice_ranges = max(1, math.ceil(total / SLICE_RANGE_BYTES))
    gram = min(GRAM, length)

    def send_probes(key, table):
        _, buf, offs = repeats.bucket_of(table)
        return repeats.key_blocks(key[0].as_py(), np.unique(probes(buf, offs, length)[3]), probe_ranges)

    def send_slices(key, table, flags):
        _, buf, offs = repeats.bucket_of(table)
        prefix, hashes, at, names, probe = probes(buf, offs, length)
        keys, back, counts = np.unique(names, return_inverse=True, return_counts=True)
        once = at[~(repeats.flagged(keys, probe_ranges, flags) | (counts > 1))[back]]
        can = repeats.whole_windows(offs, length)
        can &= ~repeats.marked(len(buf), np.maximum(once + probe - length, 0), once + 1)
        start = np.flatnonzero(can)
        anchor = anchors(hashes, length, gram)[start]
        alone = np.isin(mix64(hashes[anchor]), frequent)
        windows, alone_runs = repeats.window_blocks(*_windows(buf, prefix, start[alone], length), slice_ranges)
        start, anchor = start[~alone], anchor[~alone]
        # strings in a row with one anchor make a slice
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1])
        first = start[new]
        last = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else start
        place = anchor[new]
        content = poly(41).spans(prefix, first, last + length) + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, lead, twin, copies = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
        several = copies[twin] > 1
        gone = repeats.marked(len(buf), first[several], last[several] + 1)
        runs = np.concatenate([np.stack(repeats.runs_of(gone), axis=1), alone_runs]).astype(np.int64).tobytes()
        first, last, place, copies = first[lead], last[lead], place[lead], copies
        name = mix64(hashes[place])  # least hashes lie near zero; mixed, they fill all ranges alike
        order = np.argsort(name, kind="stable")
        first, last, place, copies, name = first[order], last[order], place[order], copies[order], name[order]
        own_ranges, own_edges = repeats.ranges(name, slice_ranges)
        full = np.union1d(own_ranges, np.array(list(windows), np.int32)).astype(np.int32)
        edges = np.append(own_edges[np.searchsorted(own_ranges, full)], len(name))  # of a range without slices: none
        p = key[0].as_py()
        rows = {k: [] for k in ("anchors", "heads", "places", "copies", "data", "runs", "keys", "checks", "at")}
        for k, r in enumerate(full.tolist()):
            own = slice(edges[k], edges[k + 1])
            rows["anchors"].append(name[own].tobytes())
            rows["heads"].append(np.stack([place[own] - first[own], last[own] + length - place[own]], axis=1).astype(np.int32).tobytes())
            rows["places"].append(place[own].tobytes())
            rows["copies"].append(np.minimum(copies[own], 2).astype(np.uint8).tobytes())
            rows["data"].append(b"".join([buf[a:b].tobytes() for a, b in zip(first[own].tolist(), (last[own] + length).tolist())]))
            rows["runs"].append(runs if k == p % len(full) else b"")
            for column, block in zip(("keys", "checks", "at"), windows.get(r, (b"", b"", b""))):
                rows[column].append(block)
        return pa.table(
            {"r": pa.array(full), "p": pa.array(np.full(len(full), p, np.int32)), **{k: pa.array(v, pa.binary()) for k, v in rows.items()}}
        )

    def sort_slices(table):
        owners: dict[tuple[int, bytes], list[tuple[int, int]]] = {}  # (bytes before the anchor, slice) -> (block, place)
        whole: set[tuple[int, bytes]] = set()
        named: dict[tuple[int, bytes], int] = {}
        columns = [table[c].to_pylist() for c in ("anchors", "heads", "places", "copies", "data")]
        for block, (names, heads, places, copies, data) in enumerate(zip(*columns)):
            at = 0
            view = np.frombuffer(heads, np.int32).reshape(-1, 2)
            for name, (a, b), place, n in zip(
                np.frombuffer(names, np.uint64).tolist(), view.tolist(), np.frombuffer(places, np.int64).tolist(), np.frombuffer(copies, np.uint8).tolist()
            ):
                item = (a, data[at : at + a + b])
                at += a + b
                owners.setdefault(item, []).append((block, place))
                named[item] = name
                if n > 1:
                    whole.add(item)
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for item, name in named.items():
            groups.setdefault(name, []).append(item)
        found: list[list[tuple[int, int]]] = [[] for _ in columns[0]]
        for items in groups.values():
            shared = shared_strings([s[a:] for a, s in items], [s[:a][::-1] for a, s in items], length) if len(items) > 1 else [[]]
            for (a, s), spans in zip(items, shared):
                own = owners[a, s]
                if len(own) > 1 or (a, s) in whole:
                    spans = [(length - (len(s) - a), a)]
                for block, place in own:
                    found[block].extend((place - hi, place - lo + 1) for lo, hi in spans)
        alone = [np.stack([at, at + 1], axis=1).astype(np.int64).tobytes() for at in repeats.match_windows(table)]
        runs = [np.array(f, np.int64).reshape(-1, 2).tobytes() + a + r for f, a, r in zip(found, alone, table["runs"].to_pylist())]
        return pa.table({"p": table["p"].cast(pa.int32()), "runs": pa.array(runs, pa.binary())})

    def remove(table, found):
        table, buf, offs = repeats.bucket_of(table)
        runs = np.concatenate([np.zeros((0, 2), np.int64), *(np.frombuffer(b, np.int64).reshape(-1, 2) for b in found["runs"].to_pylist())])
        gone = repeats.marked(len(buf), runs[:, 0], runs[:, 1] + length - 1)
        total = np.concatenate([[0], np.cumsum(gone)])
        n_removed = np.diff(total[offs])
        kept, removed = [], []
        for r, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
            if n_removed[r]:
                kept.append(buf[a:b][~gone[a:b]].tobytes())
                removed.append(np.stack(repeats.runs_of(gone[a:b]), axis=1).reshape(-1).tolist())
            else:
                kept.append(buf[a:b].tobytes())
                removed.append([])
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n_bytes": pa.array(np.diff(offs), pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array([len(x) // 2 for x in removed], pa.int64()),
                "removed": pa.array(removed, pa.list_(pa.int64())),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    to_buckets = lambda rows: rows.repartitionById(n_buckets, F.col("p")).groupBy("p")
    names = dealt.groupBy("p").applyInArrow(send_probes, repeats.KEY_SCHEMA)
    flags = repeats.by_range(names, probe_ranges).applyInArrow(repeats.recurring, repeats.FLAG_SCHEMA)
    slices = dealt.groupBy("p").cogroup(to_buckets(flags)).applyInArrow(send_slices, _SLICE_SCHEMA)
    found = repeats.by_range(slices, slice_ranges).applyInArrow(sort_slices, _FOUND_SCHEMA)
    return dealt.groupBy("p").cogroup(to_buckets(found)).applyInArrow(remove, SCHEMA)
