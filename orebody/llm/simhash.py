"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: 64 bits, each the majority of that bit over the XXH64 hashes of the text's word shingles.
Two fingerprints link when at most ``radius`` bits differ; a document's component is what links reach.

Distinct fingerprints are dealt to partitions by the pigeonhole rule: of ``blocks`` bit blocks, linked
fingerprints agree on at least blocks - radius, so each goes once to every choice of that many blocks, and
every link meets in some group.  Inside a group the fingerprints are sorted by Gray rank; nodes of 8 and
of 64 neighbours factor out the bits that all of them share (mask and pattern), and two nodes are compared
by those bits first: differences add up from the upper node to the lower ones to the fingerprints, and a
pair of nodes is dropped as soon as they exceed the radius.  Pairs of nodes that already lie in one
component are dropped too, so a large group of copies costs its spanning links, not all its pairs.  A
group gives a star of links a component, never all pairs.

Scale: exact copies collapse to one fingerprint before any dealing; more blocks (longer keys) are used as
the number of fingerprints grows, with the same result; components are found by rounds of label spreading
with pointer jumping over checkpointed tables.

Defined results: null and wordless texts have fingerprint zero; a text of fewer words than a shingle is
one shingle; repeated rows give repeated rows; null ids are never a component's name unless it has no other
(then the name is null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orebody.llm.common import checkpoint, in_slices, mix64, partitions_for

RADIUS = 4
SHINGLE_WORDS = 4
SEED = 42
#: Near-duplicate stages: words of a shingle, and the Jaccard similarity of the sets of shingles from which texts are near copies.
STAGE_SHINGLE_WORDS = 5
STAGE_SIMILARITY = 0.8
#: SimHashes of a stage's sets; together the sketch of a text.
STAGE_WORDS = 16
#: Largest share of bits in which sketches of sets of that similarity differ on average: their cosine is 0.889 at least.
STAGE_DIFFERS = 0.152
#: Of pairs at that similarity, the share that may meet in no table of keys.
STAGE_MISS = 1e-5
#: Bits of a key: so many at least, and so many that a key has no more than STAGE_GROUP texts on average.
STAGE_KEY_BITS, STAGE_GROUP = 8, 4096
#: A table's rows carry two words: a pair that meets is a candidate if at most so many bits differ in the first and in
#: both. Of pairs at 0.8, a share of STAGE_PASS at least has no more.
STAGE_RADIUS, STAGE_MOST_BITS, STAGE_PASS = 17, 26, 0.95
#: A text with more candidates than these in a table is crowded there.
STAGE_PARTNERS = 8
#: Best partners of other components that a crowded text asks for in each table; as other texts meet in each, it gets
#: many more of them in all.
STAGE_ASKED = 2
#: Bits of whole sketches in which such partners may differ: of pairs at 0.8, one in 20,000 has more.
STAGE_MOST_SKETCH_BITS = 202
#: Rows of a group whose sketches are compared with a text's at once; bounds memory.
STAGE_CHUNK = 1024
#: Rows of a key beyond which no single task holds them; more, if more than 1 / LARGE_LABELS of all rows.
STAGE_HOT = 16_384
#: Rows (keys of texts) in a partition of a stage.
STAGE_ROWS = 1_000_000
#: (fingerprints up to, bit blocks): longer keys once groups would grow large; all give the same links.
BLOCKS_BY_COUNT = ((40_000_000, 5), (4_000_000_000, 6), (1 << 63, 8))
#: Components of more than a share of 1 / LARGE_LABELS of the fingerprints, and of LEAST_LARGE, are named by a broadcast.
LARGE_LABELS, LEAST_LARGE = 10_000, 100
#: Pairs of nodes that are compared at once; bounds memory.
PAIR_CHUNK = 1 << 20

#: Every byte's bits, least significant first, as eight byte lanes of one word.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
#: One for each of the two votes on each word of a stage's sketches.
_SALTS = mix64(np.arange(1, 2 * STAGE_WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(text: bytes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every k-word shingle of the lower-cased text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([hashed(b" ".join(words), SEED)], np.uint64)
    line = b" ".join(words)
    ends = [x - 1 for x in accumulate([len(w) + 1 for w in words])]
    starts = [0, *(x + 1 for x in ends[: len(ends) - k])]
    return np.fromiter((hashed(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])), np.uint64, len(words) - k + 1)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    raw = hashes.view(np.uint8).reshape(n, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 255):  # a byte lane holds up to 255
        counts += _LANES[raw[i : i + 255]].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; where the documents are read, without a shuffle."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter((majority(shingle_hashes(t.as_py() or b"", shingle_words)) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each word in the sequence of Gray codes."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def block_masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def group_keys(fps: np.ndarray, blocks: int, radius: int) -> list[np.ndarray]:
    """For each choice of blocks - radius blocks, a hash of the choice and its bits."""
    masks = block_masks(blocks)
    out = []
    for k, chosen in enumerate(itertools.combinations(masks, blocks - radius)):
        out.append(mix64((fps & np.uint64(sum(chosen))) + mix64(np.full(1, k + 1, np.uint64))))
    return out


class Level:
    """Nodes over runs of neighbours: where they start, the bits all members share, and those bits' values."""

    def __init__(self, values: np.ndarray, masks: np.ndarray, starts: np.ndarray):
        self.starts = starts
        odd = np.bitwise_or.reduceat(values ^ np.repeat(values[starts], np.diff(np.append(starts, len(values)))), starts)
        self.mask = ~odd & np.bitwise_and.reduceat(masks, starts)
        self.value = values[starts] & self.mask


def node_starts(bounds: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of nodes of at most ``fan`` children inside each group [bounds[i], bounds[i + 1]), and the groups' bounds in nodes."""
    sizes = np.diff(bounds)
    per = -(-sizes // fan)
    out = np.concatenate([[0], np.cumsum(per)])
    group = np.repeat(np.arange(len(sizes)), per)
    return bounds[group] + (np.arange(out[-1]) - out[group]) * fan, out


def local_roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of the component of each of n nodes, by hooking and pointer jumping."""
    root = np.arange(n) if root is None else root
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root != (up := root[root])).any():
            root = up


def triangle(bounds: np.ndarray, lo: int, hi: int):
    """All pairs i <= j inside groups, for the nodes i in [lo, hi)."""
    i = np.arange(lo, hi)
    end = bounds[np.searchsorted(bounds, i, side="right")]
    n = end - i
    left = np.repeat(i, n)
    return left, left + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)


def children(left, right, starts, total):
    """Pairs of children of each pair of nodes; of a node with itself, i <= j only. Returns (parent pair, i, j)."""
    ends = np.append(starts[1:], total)
    na, nb = ends[left] - starts[left], ends[right] - starts[right]
    n = na * nb
    pair = np.repeat(np.arange(len(left)), n)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    i, j = starts[left[pair]] + k // nb[pair], starts[right[pair]] + k % nb[pair]
    keep = (left[pair] != right[pair]) | (i <= j)
    return pair[keep], i[keep], j[keep]


def linked_roots(fps: np.ndarray, bounds: np.ndarray, radius: int, sigs: np.ndarray | None = None, most_bits: int = 0) -> np.ndarray:
    """Component root (an index) of each fingerprint, linking only inside groups.

    ``fps`` is sorted by group and Gray rank; ``bounds`` are the groups' edges.  Given ``sigs`` (rows of
    fingerprints), a link's rows must differ in at most ``most_bits`` bits besides.
    """

    def alike(x, y):
        ok = np.bitwise_count(fps[x] ^ fps[y]) <= radius
        if sigs is not None:
            at = np.flatnonzero(ok)
            ok[at] = np.bitwise_count(sigs[x[at]] ^ sigs[y[at]]).sum(axis=1, dtype=np.int64) <= most_bits
        return ok

    n = len(fps)
    root = np.arange(n)
    if n < 2:
        return root
    # neighbours in Gray order first: it joins most of a large group before the tree is walked
    near = np.flatnonzero(alike(np.arange(1, n), np.arange(n - 1)))
    near = near[~np.isin(near + 1, bounds)]
    root = local_roots(n, near, near + 1, root)
    low_at, low_bounds = node_starts(bounds, 8)
    low = Level(fps, np.full(n, ~np.uint64(0)), low_at)
    up_at, up_bounds = node_starts(low_bounds, 8)
    up = Level(low.value, low.mask, up_at)

    def one_root(level_starts, total):
        """Root of a node all of whose fingerprints share it, else -1 - node."""
        first, ends = root[level_starts], np.append(level_starts[1:], total)
        same = np.minimum.reduceat(root, level_starts) == np.maximum.reduceat(root, level_starts)
        return np.where(same, first, -1 - np.arange(len(ends)))

    low_nodes, fp_of_up = len(low_at), low_at[up_at]
    at, groups_end = 0, len(up_at)
    reach = up_bounds[np.searchsorted(up_bounds, np.arange(groups_end), side="right")] - np.arange(groups_end)
    work = np.cumsum(reach)
    while at < groups_end:
        to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + PAIR_CHUNK, side="right")))
        left, right = triangle(up_bounds, at, min(to, groups_end))
        at = min(to, groups_end)
        whole = one_root(fp_of_up, n)
        shared = up.mask[left] & up.mask[right]
        apart = np.bitwise_count((up.value[left] ^ up.value[right]) & shared)
        keep = (apart <= radius) & (whole[left] != whole[right])
        keep |= (apart <= radius) & (left == right) & (whole[left] < 0)
        left, right, shared, apart = left[keep], right[keep], shared[keep], apart[keep]
        for s in range(0, len(left), PAIR_CHUNK // 64):
            e = s + PAIR_CHUNK // 64
            pair, i, j = children(left[s:e], right[s:e], up_at, low_nodes)
            # bits tested above are not tested again: only those that the lower nodes share besides
            more = low.mask[i] & low.mask[j] & ~shared[s:e][pair]
            far = apart[s:e][pair] + np.bitwise_count((low.value[i] ^ low.value[j]) & more)
            whole = one_root(low_at, n)
            keep = (far <= radius) & ((whole[i] != whole[j]) | (i == j) & (whole[i] < 0))
            i, j = i[keep], j[keep]
            for q in range(0, len(i), PAIR_CHUNK // 64):
                _, x, y = children(i[q : q + PAIR_CHUNK // 64], j[q : q + PAIR_CHUNK // 64], low_at, n)
                open_ = root[x] != root[y]
                x, y = x[open_], y[open_]
                link = alike(x, y)
                root = local_roots(n, x[link], y[link], root)
    return root


def stars(key: np.ndarray, node: np.ndarray, fp: np.ndarray, radius: int, sigs: np.ndarray | None = None, most_bits: int = 0) -> pa.RecordBatch:
    """Links of rows that share a key, as one star a component."""
    order = np.lexsort((gray_rank(fp), key))
    key, fp, node, sigs = key[order], fp[order], node[order], None if sigs is None else sigs[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    root = linked_roots(fp, np.append(first, len(key)), radius, sigs, most_bits)
    # every member points to its component's least node: groups that share it give the same links, which collapse
    least = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(least, root, node)
    a, b = node, least[root]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])


def links(marks: DataFrame, n_marks: int, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between nodes whose components are those of all pairs with fingerprints within ``radius``.

    ``marks`` has node and fp.
    """
    blocks = blocks or next(b for most, b in BLOCKS_BY_COUNT if n_marks <= most)
    blocks = max(blocks, radius + 1)

    def deal(batches):
        for batch in batches:
            for key in group_keys(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64), blocks, radius):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(1), batch.column(0)], names=["key", "fp", "node"])

    def join(batches):
        parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
        if not parts:
            return
        key, fp, node = (np.concatenate(c) for c in zip(*parts))
        fp = fp.view(np.uint64)
        yield stars(key, node, fp, radius)

    dealt = marks.select("node", "fp").mapInArrow(deal, "key bigint, fp bigint, node bigint")
    n_parts = max(partitions_for(marks), n_marks * len(list(itertools.combinations(range(blocks), radius))) // 2_000_000)
    return dealt.repartition(n_parts, "key").mapInArrow(join, "a bigint, b bigint").distinct()


def sketch(hashes: np.ndarray) -> np.ndarray:
    """STAGE_WORDS SimHashes of a set of shingles, each of other hashes.

    A shingle votes twice on each bit, by two hashes, so that sets of odd and of even sizes tie alike: else sets of
    four and of five shingles at a similarity of 0.8 would differ in 0.19 of the bits.
    """
    counts = np.zeros(64 * STAGE_WORDS, np.int64)
    for i in range(0, len(hashes), 127):  # a byte lane holds up to 255
        votes = mix64(hashes[i : i + 127, None] ^ _SALTS).view(np.uint8).reshape(-1, 8 * STAGE_WORDS)
        counts += _LANES[votes].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return np.packbits(counts > len(hashes), bitorder="little").view(np.uint64)


def stage_keys(n_nodes: int) -> tuple[int, int]:
    """(bits of a key, tables of keys): more bits as texts become more, and then more tables, with the same share of
    pairs missed."""
    bits = STAGE_KEY_BITS
    while n_nodes > STAGE_GROUP << bits:
        bits += 1
    return bits, math.ceil(math.log(STAGE_MISS) / math.log1p(-STAGE_PASS * (1 - STAGE_DIFFERS) ** bits))


def table_keys(sketches: np.ndarray, key_bits: int, tables: int):
    """For each table, its number and a hash of that and of its own choice of the sketches' bits."""
    bits = np.unpackbits(sketches.view(np.uint8), axis=1, bitorder="little")
    weights = np.uint64(1) << np.arange(key_bits, dtype=np.uint64)
    order, at = np.arange(bits.shape[1]), 0
    for k in range(tables):
        if at + key_bits > len(order):  # all bits are used: go on in another order
            order, at = np.random.default_rng(k).permutation(bits.shape[1]), 0
        chosen = (bits[:, order[at : at + key_bits]] * weights).sum(axis=1, dtype=np.uint64)
        at += key_bits
        yield k, mix64(chosen + mix64(np.full(1, k + 1, np.uint64)))


def carried(table: int) -> tuple[int, int]:
    """The two words of the sketch that a table's rows carry; 240 tables have other ones."""
    return table % STAGE_WORDS, (table + 1 + table // STAGE_WORDS % (STAGE_WORDS - 1)) % STAGE_WORDS


def near_pairs(fps: np.ndarray, more: np.ndarray, bounds: np.ndarray, radius: int, most_bits: int):
    """Blocks of (i, j, bits): all pairs i < j inside groups whose fingerprints differ in at most ``radius`` bits, and
    with those of ``more`` in at most ``most_bits``.

    ``fps`` is sorted by group and Gray rank; ``bounds`` are the groups' edges.  The same index as in ``linked_roots``:
    nodes of 64 and of 8 neighbours are compared by the bits that all of them share.
    """
    n = len(fps)
    low_at, low_bounds = node_starts(bounds, 8)
    low = Level(fps, np.full(n, ~np.uint64(0)), low_at)
    up_at, up_bounds = node_starts(low_bounds, 8)
    up = Level(low.value, low.mask, up_at)
    low_end, padded, lanes = np.append(low_at[1:], n), np.append(fps, np.zeros(8, np.uint64)), np.arange(8)
    at, groups_end = 0, len(up_at)
    work = np.cumsum(up_bounds[np.searchsorted(up_bounds, np.arange(groups_end), side="right")] - np.arange(groups_end))
    while at < groups_end:
        to = min(max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + PAIR_CHUNK // 64, side="right"))), groups_end)
        left, right = triangle(up_bounds, at, to)
        at = to
        shared = up.mask[left] & up.mask[right]
        apart = np.bitwise_count((up.value[left] ^ up.value[right]) & shared)
        keep = apart <= radius
        left, right, shared, apart = left[keep], right[keep], shared[keep], apart[keep]
        for s in range(0, len(left), PAIR_CHUNK // 4096):
            e = s + PAIR_CHUNK // 4096
            pair, i, j = children(left[s:e], right[s:e], up_at, len(low_at))
            # bits tested above are not tested again: only those that the lower nodes share besides
            besides = low.mask[i] & low.mask[j] & ~shared[s:e][pair]
            keep = apart[s:e][pair] + np.bitwise_count((low.value[i] ^ low.value[j]) & besides) <= radius
            i, j = i[keep], j[keep]
            x, y = low_at[i][:, None] + lanes, low_at[j][:, None] + lanes
            bits = np.bitwise_count(padded[x][:, :, None] ^ padded[y][:, None, :])
            at_pair, a, b = np.nonzero(bits <= radius)
            bits, ends_x, ends_y = bits[at_pair, a, b], low_end[i][at_pair], low_end[j][at_pair]
            x, y = x[at_pair, a], y[at_pair, b]
            keep = (x < y) & (x < ends_x) & (y < ends_y)
            x, y = x[keep], y[keep]
            bits = bits[keep] + np.bitwise_count(more[x] ^ more[y])
            keep = bits <= most_bits
            if keep.any():
                yield x[keep], y[keep], bits[keep]


def likely_pairs(fps: np.ndarray, more: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates among rows sorted by group and Gray rank.

    All pairs of which one row has at most STAGE_PARTNERS; of rows with more, the best partner, and a pair (i, i) that
    tells so.  So their number grows with the rows and not with all pairs.
    """
    n = len(fps)
    partners, best = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    held, fresh = [np.zeros((2, 0), np.int64)], 0

    def open_pairs():
        pairs = np.concatenate(held, axis=1)
        return pairs[:, (partners[pairs] <= STAGE_PARTNERS).any(axis=0)]

    for i, j, bits in near_pairs(fps, more, bounds, STAGE_RADIUS, STAGE_MOST_BITS):
        far = bits.astype(np.int64) << 40
        for a, b in ((i, j), (j, i)):
            np.add.at(partners, a, 1)
            np.minimum.at(best, a, far | b)
        held.append(np.stack([i, j]))
        fresh += len(i)
        if fresh > PAIR_CHUNK:
            held, fresh = [open_pairs()], 0
    pairs = open_pairs()
    crowded = np.flatnonzero(partners > STAGE_PARTNERS)
    return np.concatenate([pairs[0], crowded, crowded]), np.concatenate([pairs[1], best[crowded] & ((1 << 40) - 1), crowded])


def pairs_across(sketches: np.ndarray, labels: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The STAGE_ASKED best partners, among the rows with another label, of each row that asks."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if (labels != labels[0]).any():
        for at in np.flatnonzero(asks).tolist():
            parts = (sketches[s : s + STAGE_CHUNK] for s in range(0, len(sketches), STAGE_CHUNK))
            bits = np.concatenate([np.bitwise_count(p ^ sketches[at]).sum(axis=1, dtype=np.int64) for p in parts])
            near = np.flatnonzero((labels != labels[at]) & (bits <= STAGE_MOST_SKETCH_BITS))
            near = near[np.argsort(bits[near], kind="stable")[:STAGE_ASKED]]
            left.append(np.full(len(near), at))
            right.append(near)
    return np.concatenate(left), np.concatenate(right)


def pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Pairs, each once, the lesser node first."""
    found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, 0])), pa.array(np.ascontiguousarray(found[:, 1]))], names=["a", "b"])


def sketches_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, STAGE_WORDS)


def dealt_by_key(dealt: DataFrame, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """``dealt`` (key, node, ...) in partitions by the key.

    The rows of a key that a task should not hold are cut into parts, by the node's hash, and every two parts meet
    under a key of their own: so each pair still meets.
    """
    n_rows = n_nodes * stage_keys(n_nodes)[1]
    n_parts = max(partitions_for(nodes), n_rows // STAGE_ROWS)
    limit = max(STAGE_HOT, n_rows // LARGE_LABELS)  # so that at most LARGE_LABELS keys are broadcast
    if n_nodes <= limit:  # a key has each node once
        return dealt.repartition(n_parts, "key")
    hot = dealt.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    hot = checkpoint(hot.select("key", F.ceil(2 * F.col("n") / limit).cast("int").alias("__parts")))
    if not hot.isEmpty():
        own, other = F.pmod(F.xxhash64("node"), F.col("__parts")).cast("int"), F.col("__other")
        marked = dealt.join(F.broadcast(hot), "key", "left")
        met = marked.filter("__parts IS NOT NULL").withColumn("__own", own).withColumn("__other", F.explode(F.expr("sequence(0, __parts - 1)"))).filter("__own <> __other")
        met = met.withColumn("key", F.xxhash64("key", F.least("__own", other), F.greatest("__own", other)))
        dealt = marked.filter("__parts IS NULL").select(*dealt.columns).unionByName(met.select(*dealt.columns))
    return dealt.repartition(n_parts, "key")


def candidates(nodes: DataFrame, n_nodes: int) -> DataFrame:
    """Pairs (a < b) of ``nodes`` (node, sketch) that may be near copies; they meet where all bits of a table's key agree.

    Pairs of which a text has few are all given; texts with many are given as pairs (a, a) besides.
    """
    key_bits, tables = stage_keys(n_nodes)

    def deal(batches):
        for batch in batches:
            sketches = sketches_of(batch.column(1))
            for k, key in table_keys(sketches, key_bits, tables):
                one, two = (pa.array(np.ascontiguousarray(sketches[:, w]).view(np.int64)) for w in carried(k))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), one, two], names=["key", "node", "one", "two"])

    def join(batches):
        parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
        if not parts:
            return
        key, node, one, two = (np.concatenate(c) for c in zip(*parts))
        del parts
        one = one.view(np.uint64)
        order = np.lexsort((node, gray_rank(one), key))
        key, node, one, two = key[order], node[order], one[order], two[order].view(np.uint64)
        bounds = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))
        a, b = likely_pairs(one, two, bounds)
        yield pair_batch(node[a], node[b])

    dealt = nodes.select("node", "sketch").mapInArrow(deal, "key bigint, node bigint, one bigint, two bigint")
    return dealt_by_key(dealt, nodes, n_nodes).mapInArrow(join, "a bigint, b bigint").distinct()


def partners(nodes: DataFrame, n_nodes: int) -> DataFrame:
    """Pairs (a < b) of ``nodes`` (node, sketch, label, asks): the best partners of another label, by whole sketches,
    of texts that ask, in every table of keys."""
    key_bits, tables = stage_keys(n_nodes)

    def deal(batches):
        for batch in batches:
            for _, key in table_keys(sketches_of(batch.column(1)), key_bits, tables):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], names=["key", "node", "sketch", "label", "asks"])

    def join(batches):
        parts = [(*(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3, 4)), sketches_of(batch.column(2))) for batch in batches]
        if not parts:
            return
        key, node, label, asks, sketches = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.lexsort((node, key))
        key = key[order]
        bounds = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key)).tolist()
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(bounds, bounds[1:]):
            own = order[s:e]
            a, b = pairs_across(sketches[own], label[own], asks[own])
            left.append(node[own[a]])
            right.append(node[own[b]])
        yield pair_batch(np.concatenate(left), np.concatenate(right))

    nodes = nodes.select("node", "sketch", "label", "asks")
    dealt = nodes.mapInArrow(deal, "key bigint, node bigint, sketch binary, label bigint, asks boolean")
    return dealt_by_key(dealt, nodes, n_nodes).mapInArrow(join, "a bigint, b bigint").distinct()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets without repeats."""
    both = len(np.unique(np.concatenate([a, b])))
    return (len(a) + len(b) - both) / both if both else 1.0


def sets_of(docs: DataFrame, pairs: DataFrame, shingle_words: int) -> DataFrame:
    """(node, hashes): the sets of shingles that ``pairs`` (a, b) ask for."""

    def collect(batches):
        for batch in in_slices(batches, 0):
            sets = [shingle_set(t, shingle_words) for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([node_of(h) for h in sets], np.int64)), pa.array([h.tobytes() for h in sets], pa.binary())], names=["node", "hashes"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = docs.select("text").mapInArrow(collect, "node bigint, hashes binary").groupBy("node").agg(F.first("hashes").alias("hashes"))
    return checkpoint(sets.join(wanted, "node", "left_semi"))


def settled_links(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets of shingles have that Jaccard similarity or more, by the sets themselves."""

    def settle(batches):
        for batch in in_slices(batches, 2):
            x, y = ([np.frombuffer(h, np.uint64) for h in batch.column(k).to_pylist()] for k in (2, 3))
            alike = np.fromiter((jaccard(p, q) >= similarity for p, q in zip(x, y)), bool, len(x))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(alike)) for k in (0, 1)], names=["a", "b"])

    left, right = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return checkpoint(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(settle, "a bigint, b bigint"))


def near_copy_labels(docs: DataFrame, nodes: DataFrame, n_nodes: int, shingle_words: int, similarity: float) -> DataFrame:
    """(node, label) of the components of ``nodes`` (node, sketch) that links of that similarity make.

    Crowded texts, of which not all pairs were taken, ask again for their best partners of other components by whole
    sketches, until a round finds no further link.
    """
    found = checkpoint(candidates(nodes, n_nodes))
    tested = found.filter("a < b")
    crowded = found.filter("a = b").select(F.col("a").alias("node"))
    sets = sets_of(docs, tested, shingle_words)
    links = drawn_in(settled_links(sets, tested, similarity))
    labels = components(links).withColumnRenamed("fp", "node")
    if crowded.isEmpty():
        return labels
    rows = nodes.select("node", "sketch").join(crowded, "node", "left_semi").join(labels, "node", "left")
    open_ = checkpoint(rows.select("node", "sketch", F.coalesce("label", "node").alias("label"), F.lit(True).alias("asks")))
    n_open = open_.count()
    while True:
        more = checkpoint(partners(open_, n_open).join(tested, ["a", "b"], "left_anti"))
        further = settled_links(sets, more, similarity)
        if further.isEmpty():
            return labels
        tested, links = tested.unionByName(more), drawn_in(links.unionByName(further))
        labels = components(links).withColumnRenamed("fp", "node")
        # what joined a larger component has other partners than before, and asks again
        was = open_.select("node", "sketch", F.col("label").alias("was")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        parts = was.groupBy("label", "was").agg(F.count("*").alias("__n"))
        joined = parts.groupBy("label").agg(F.max_by("was", F.struct("__n", "was")).alias("largest")).select(F.col("label").alias("__label"), "largest")
        again = parts.join(joined, F.col("label") == F.col("__label")).filter("was <> largest").select("was", F.lit(True).alias("asks"))
        open_ = checkpoint(was.join(again, "was", "left").select("node", "sketch", "label", F.coalesce("asks", F.lit(False)).alias("asks")))


def drawn_in(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """Fewer links (a < b) with the same components: a round ties all lesser neighbours of a node, and the node, to
    the least of them.  A node that many groups tie to different heads so keeps one link, and heads' links coincide.
    """
    for _ in range(rounds):
        tied = checkpoint(edges.withColumn("least", F.min("a").over(Window.partitionBy("b"))))
        heads = tied.filter("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
        edges = checkpoint(tied.select(F.col("least").alias("a"), "b").unionByName(heads).distinct())
    return edges


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(fp, label): label is the least fp (signed order) that links reach, for every fp with a link.

    A round gives each node the least label among its neighbours and then that label's own label.
    """
    both = checkpoint(edges.select(F.col("a").alias("fp"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("fp"), F.col("a").alias("to"))))
    labels = checkpoint(both.groupBy("fp").agg(F.least(F.col("fp"), F.min("to")).alias("label")))
    for _ in range(most_rounds):
        spread = both.join(labels.select(F.col("fp").alias("to"), "label"), "to").groupBy("fp").agg(F.min("label").alias("near"))
        low = labels.join(spread, "fp").select("fp", F.least("label", "near").alias("low"), F.col("label").alias("was"))
        jump = labels.select(F.col("fp").alias("low"), F.col("label").alias("further"))
        step = checkpoint(low.join(jump, "low", "left").select("fp", F.least("low", F.coalesce("further", "low")).alias("label"), "was"))
        labels = step.select("fp", "label")
        if step.filter("label < was").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def groups(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS, blocks: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    fps = checkpoint(fingerprints(docs, shingle_words))
    distinct = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    n = distinct.count()
    labels = components(links(distinct.select(F.col("fp").alias("node"), "fp"), n, radius, blocks))
    named = checkpoint(distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    by_fp = with_least(named, n).select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def with_least(named: DataFrame, n: int) -> DataFrame:
    """Adds component_id, the least ``least`` of the rows with a label, of which there are ``n``.

    Labels of more than n / LARGE_LABELS rows are fewer than LARGE_LABELS: these are broadcast, so that no task
    gathers a large component; the other labels' groups are small.
    """
    large = max(LEAST_LARGE, n // LARGE_LABELS)
    sizes = checkpoint(named.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("__n")))
    wide = named.join(F.broadcast(sizes.filter(F.col("__n") > large).select("label", F.col("component_id").alias("__id"), F.lit(True).alias("__large"))), "label", "left")
    of_large = wide.filter("__large").select("fp", F.col("__id").alias("component_id"))
    of_small = wide.filter("__large IS NULL").select("fp", "label").join(sizes.filter(F.col("__n") <= large).select("label", "component_id"), "label").select("fp", "component_id")
    return of_large.unionByName(of_small)


def shingle_set(text, shingle_words: int) -> np.ndarray:
    """Hashes of a text's shingles in order, each once."""
    return np.unique(shingle_hashes(text.as_py() or b"", shingle_words))


def node_of(hashes: np.ndarray) -> int:
    """Name of a set of shingles, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, node, sketch): the name of the text's set of shingles, and the set's SimHashes."""

    def run(batches):
        for batch in in_slices(batches, 1):
            sets = [shingle_set(t, shingle_words) for t in batch.column(1).cast(pa.binary())]
            sketches = pa.array([sketch(h).tobytes() for h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array([node_of(h) for h in sets], np.int64)), sketches], names=["doc_id", "node", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, node bigint, sketch binary")


def first_of_groups(docs: DataFrame, shingle_words: int = STAGE_SHINGLE_WORDS, similarity: float = STAGE_SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, less all but the least id of every group of near copies.

    Two texts link when the Jaccard similarity of their sets of shingles is ``similarity`` or more: SimHashes and the
    Gray-order index find the candidates (see ``candidates``; made for 0.8 and above), and the sets settle them.
    """
    marks = checkpoint(signatures(docs, shingle_words))
    nodes = checkpoint(marks.groupBy("node").agg(F.first("sketch").alias("sketch"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("least")))
    labels = near_copy_labels(docs, nodes, nodes.count(), shingle_words, similarity)
    kept = nodes.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(F.min(F.struct("least", "node")).alias("first"))
    kept = checkpoint(kept.select(F.col("first.least.doc_id").alias("__id"), F.col("first.node").alias("__node")))
    names, numbers = docs.columns, [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*numbers)  # no name of the input's can clash with those below
    at, doc_id = names.index("text"), F.col(f"c{names.index('doc_id')}").cast("long")
    if marks.count() == marks.select("doc_id").distinct().count():
        return plain.join(kept, doc_id.eqNullSafe(F.col("__id")), "left_semi").toDF(*names)

    # an id that several rows have does not tell them apart: rows are found by their signatures, one of equals stays
    def sign(batches):
        for batch in batches:
            nodes_of = pa.array(np.array([node_of(shingle_set(t, shingle_words)) for t in batch.column(at).cast(pa.binary())], np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes_of], names=[*numbers, "__sig"])

    signed = plain.mapInArrow(sign, StructType([*plain.schema.fields, StructField("__sig", LongType())]))
    match = doc_id.eqNullSafe(F.col("__id")) & (F.col("__sig") == F.col("__node"))
    return signed.join(kept, match, "left_semi").dropDuplicates([f"c{names.index('doc_id')}", "__sig"]).drop("__sig").toDF(*names)
