"""Approximate nearest neighbours by an inverted multi-index, nearness being the inner product.

Both halves of the vectors are quantised on their own, each with about 2 sqrt(rows) centroids, so a cell is
a pair of centroids and every row is indexed in one; what the pair leaves of the vector is coded by sixteen
small codebooks (one byte each).  A query sorts the centroids of each half by their inner products and walks
tiles of neighbouring pairs by falling sum with a heap until they hold a share of the rows; every cell whose
sum reaches the bound so found is visited.  Visited entries are scored by table look-up of their codes; those
that may be among the k best, given how far each entry lies from its code, are scored again by exact inner
products of the originals in double precision.  So many near-equal vectors that one code stands for are all
scored exactly.

The share is measured, not set: on a bounded sample, the least share whose cells hold ``CELL_RECALL`` of the
true neighbours.  Clustered vectors so need few cells, vectors without structure many.

Scale: entries are dealt by cell to parts of at most ``PART_ROWS`` rows, once; a cell larger than a part is cut
by a hash of the id, and no entry is left out.  A query goes to those parts that hold a visited cell, and a task
streams them past the part's entries, so it holds one part however many queries come.  Broadcast are the
codebooks and one count a cell (at most 2**20).  Each part returns at most k rows a query.

Defined results: vectors null, all zero, of a length other than the most usual, or holding null or non-finite
components, and rows with a null id, take no part; equal scores go to the smaller id; repeated rows are
candidates as often as they occur, and a repeated id asks once (with its first vector in order); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orebody.llm.common import mix64, partitions_for

K = 20
#: Every id divisible by this asks.
QUERY_EVERY = 20
#: Centroids of a half are a power of two, at most 2**MOST_BITS.
MOST_BITS = 10
#: Tiles along a side of the square of sorted centroid pairs.
TILES = 16
#: Codebooks of the rest that the centroids leave, and entries of each.
CODEBOOKS, CODES = 16, 256
#: Rows that centroids and codes are fitted on, and rows of them that ask when the share is measured.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 200
#: Part of the true neighbours that the visited cells must hold on the sample.
CELL_RECALL = 0.95
#: Standard deviations of a coded score's error that an entry may lie off and still be scored exactly.
DOUBT = 1.0
#: Rows of a part: as many as give each shuffle partition one, between these bounds.
LEAST_PART_ROWS, PART_ROWS = 512, 131_072
#: Queries that meet a part's entries at once; bounds memory.
QUERY_CHUNK = 64

_MOVED = "part int, asks boolean, vec_id bigint, v array<double>, cell int, codes binary, number double"


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v as doubles) of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(finite & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (usual["n"] if usual else 0))


def matrix(column) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    values = flat.to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Index of the nearest centroid of each row, some rows at a time."""
    size = (c * c).sum(axis=1)[None, :]
    parts = [np.argmin(size - 2 * x[i : i + 1024] @ c.T, axis=1) for i in range(0, len(x), 1024)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """At most k centroids; a centroid that no row is nearest to stays where it is."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        order = np.argsort(near, kind="stable")
        held, first, n = np.unique(near[order], return_index=True, return_counts=True)
        c[held] = np.add.reduceat(x[order], first, axis=0) / n[:, None]
    return c


def in_line(c: np.ndarray) -> np.ndarray:
    """Centroids in the order of their main direction, so that neighbours in number are near each other."""
    if c.shape[1] == 0:
        return c
    away = c - c.mean(axis=0)
    return c[np.argsort(away @ np.linalg.svd(away, full_matrices=False)[2][0], kind="stable")]


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, and of the rest in stretches of dimensions."""

    first: np.ndarray
    second: np.ndarray
    rest: list[np.ndarray]
    edges: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, : self.half], self.first) * len(self.second) + nearest(x[:, self.half :], self.second)

    def codes(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes of rows, standard deviation of their error in the score of a query of length 1)."""
        rest = x - np.concatenate([self.first[cell // len(self.second)], self.second[cell % len(self.second)]], axis=1)
        out = []
        for a, b, c in zip(self.edges[:-1], self.edges[1:], self.rest):
            out.append(nearest(rest[:, a:b], c))
            rest[:, a:b] -= c[out[-1]]
        return np.stack(out, axis=1).astype(np.uint8), np.sqrt((rest * rest).mean(axis=1))

    def sums(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of queries with the centroids of both halves."""
        return q[:, : self.half] @ self.first.T, q[:, self.half :] @ self.second.T

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Inner products of queries with every code of the rest."""
        return [q[:, a:b] @ c.T for a, b, c in zip(self.edges[:-1], self.edges[1:], self.rest)]


def fit(rows: DataFrame, n: int, sample: int = SAMPLE_ROWS, k: int = K) -> tuple[Index, float]:
    """(index, share of the rows that a query's cells must hold), from at most ``sample`` rows by a hash of the id."""
    share = max(1, n // (2 * sample))
    drawn = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(share)) == 0)
    x = matrix(drawn.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").toArrow()["v"]).astype(np.float32)
    bits = min(MOST_BITS, max(4, round(np.log2(2 * np.sqrt(n)))))
    half = x.shape[1] // 2
    first, second = (in_line(k_means(part, 1 << bits)) for part in (x[:, :half], x[:, half:]))
    edges = np.linspace(0, x.shape[1], min(CODEBOOKS, x.shape[1]) + 1).astype(int)
    halves = Index(first, second, [], edges)
    cell = halves.cells(x)
    rest = x - np.concatenate([first[cell // len(second)], second[cell % len(second)]], axis=1)
    index = Index(first, second, [k_means(rest[:, a:b], CODES) for a, b in zip(edges[:-1], edges[1:])], edges)
    return index, needed_share(index, x, cell, k)


def needed_share(index: Index, x: np.ndarray, cell: np.ndarray, k: int, recall: float = CELL_RECALL, queries: int = SAMPLE_QUERIES) -> float:
    """Least share of the sample's rows, by falling cell sum, that holds ``recall`` of the sample's true neighbours."""
    places = []
    for at in np.array_split(np.arange(min(queries, len(x))), 10):
        scores, (one, two) = x[at] @ x.T, index.sums(x[at])
        scores[np.arange(len(at)), at] = -np.inf
        best = np.argsort(-scores, axis=1)[:, : min(k, len(x) - 1)]
        sums = one[:, cell // len(index.second)] + two[:, cell % len(index.second)]
        ordered = np.sort(-sums, axis=1)
        for r, own in enumerate(best):  # rows whose cells come before or with the neighbour's own
            places.append(np.searchsorted(ordered[r], -sums[r, own], side="right"))
    places = np.concatenate(places) if places else np.zeros(0)
    return float(np.quantile(places, recall)) / len(x) if len(places) else 1.0


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, least: int) -> float:
    """The sum that cells must reach, so that they hold ``least`` rows at least; counts: rows of each cell, a square.

    A heap gives tiles of sorted centroid pairs by falling best sum until these hold enough; the bound is then
    read from the cells of those tiles.
    """
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[a].astype(float), second[b].astype(float)
    i_at, j_at = (np.unique(np.linspace(0, len(v), min(TILES, len(v)) + 1).astype(int)) for v in (x, y))
    held_by = counts[a][:, b]
    tiles = np.add.reduceat(np.add.reduceat(held_by, i_at[:-1], axis=0), j_at[:-1], axis=1).tolist()
    tops, lefts = x[i_at[:-1]].tolist(), y[j_at[:-1]].tolist()
    heap, seen, held, taken = [(-(tops[0] + lefts[0]), 0, 0)], {(0, 0)}, 0, []
    while heap and held < least:
        _, i, j = heapq.heappop(heap)
        taken.append((i, j))
        held += tiles[i][j]
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(tops) and q < len(lefts) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (-(tops[p] + lefts[q]), p, q))
    if held < least:
        return -np.inf
    sums = np.concatenate([(x[i_at[i] : i_at[i + 1], None] + y[None, j_at[j] : j_at[j + 1]]).reshape(-1) for i, j in taken])
    rows = np.concatenate([held_by[i_at[i] : i_at[i + 1], j_at[j] : j_at[j + 1]].reshape(-1) for i, j in taken])
    low, high = float(sums.min()), float(sums.max())
    if low == high:
        return low
    steps = np.minimum(((high - sums) * (1024 / (high - low))).astype(np.int64), 1023)
    enough = int(np.searchsorted(np.cumsum(np.bincount(steps, weights=rows, minlength=1024)), least))
    return high - (enough + 1) * (high - low) / 1024 - 1e-9


def layout(counts: np.ndarray, part_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First part and number of parts of each cell: small cells share a part, large ones are cut; and the number of parts."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at = held = 0
    for cell in np.flatnonzero(counts).tolist():
        n = int(counts[cell])
        if held and held + n > part_rows:
            at, held = at + 1, 0
        first[cell] = at
        if n > part_rows:
            parts[cell] = -(-n // part_rows)
            at += int(parts[cell])
        else:
            held += n
    return first, parts, at + (held > 0)


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k largest scores, equal ones by smaller id."""
    on = np.arange(len(scores))
    if len(on) > k:
        on = np.flatnonzero(scores >= np.partition(scores, len(on) - k)[len(on) - k])
    return on[np.lexsort((ids[on], -scores[on]))[:k]]


def answer(index: Index, entries, q: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray, k: int, doubt: float):
    """For each query, (ids, exact scores, rows scored exactly) of its best entries of one part."""
    ids, x, cell, codes, error = entries
    one, two = index.sums(q)
    sums = one[:, cell // len(index.second)] + two[:, cell % len(index.second)]
    tables = index.tables(q)
    for r in range(len(q)):
        on = np.flatnonzero((sums[r] >= bounds[r]) & (ids != query_ids[r]))
        if len(on) > k:
            about = sums[r, on].astype(float)
            for m, table in enumerate(tables):
                about += table[r][codes[m][on]]
            reach = doubt * np.linalg.norm(q[r]) * error[on]
            on = on[about + reach >= np.partition(about - reach, len(on) - k)[len(on) - k]]
        scores = np.array([float(np.dot(q[r], v)) for v in x[on]]) if len(on) else np.zeros(0)
        best = top(scores, ids[on], k)
        yield ids[on][best], scores[best], len(on)


def search(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, part_rows: int | None = None, sample: int = SAMPLE_ROWS, doubt: float = DOUBT) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for every query, and n_scored: rows scored exactly for it."""
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double, n_scored bigint"
    rows = valid(vectors)
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % query_every == 0, 1))).first()
    if not n_queries:
        return spark.createDataFrame([], schema)
    index, share = fit(rows, n, sample, k)
    shared_index = spark.sparkContext.broadcast(index)

    def to_cells(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            cell = shared_index.value.cells(x) if len(x) else np.zeros(0, np.int64)
            codes, error = shared_index.value.codes(x, cell) if len(x) else (np.zeros((0, 1), np.uint8), np.zeros(0))
            coded = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), coded, pa.array(error)], names=["vec_id", "v", "cell", "codes", "number"])

    coded = rows.mapInArrow(to_cells, "vec_id bigint, v array<double>, cell int, codes binary, number double")
    held = coded.groupBy("cell").count().toArrow()  # at most 2**20 rows
    counts = np.zeros(len(index.first) * len(index.second), np.int32)
    counts[held["cell"].to_numpy()] = held["count"].to_numpy()
    wide = part_rows or min(PART_ROWS, max(LEAST_PART_ROWS, -(-n // partitions_for(vectors))))
    first, parts, n_parts = layout(counts, wide)
    least = int(np.ceil(share * n))
    shared = spark.sparkContext.broadcast((counts, first.astype(np.int32), parts.astype(np.int32)))

    def to_parts(batches):
        _, first, parts = shared.value
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            salt = (mix64(ids.view(np.uint64)) >> np.uint64(33)).astype(np.int64) % parts[cell]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array((first[cell] + salt).astype(np.int32)), pa.array(np.zeros(n, bool)), *batch.columns],
                names=["part", "asks", "vec_id", "v", "cell", "codes", "number"],
            )

    def ask(batches):
        counts, first, parts = shared.value
        index = shared_index.value
        full = np.flatnonzero(counts)
        # a part's cells: those that begin in it; a cut cell fills parts of its own
        begins = np.flatnonzero(np.append(True, first[full][1:] != first[full][:-1]))
        square = counts.reshape(len(index.first), -1)
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            one, two = index.sums(x) if len(x) else ((), ())
            part, row, bound = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0)]
            for r in range(len(x)):
                least_sum = walk(one[r], two[r], square, least)
                best = np.maximum.reduceat(one[r][full // len(two[r])] + two[r][full % len(two[r])], begins)
                for g in np.flatnonzero(best >= least_sum).tolist():
                    cell = full[begins[g]]
                    at = np.arange(first[cell], first[cell] + parts[cell], dtype=np.int32)
                    part.append(at)
                    row.append(np.full(len(at), r))
                    bound.append(np.full(len(at), least_sum))
            row = np.concatenate(row)
            n = len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(part)), pa.array(np.ones(n, bool)), pa.array(ids[row], pa.int64()), batch.column(1).take(pa.array(row)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(np.concatenate(bound))],
                names=["part", "asks", "vec_id", "v", "cell", "codes", "number"],
            )

    def rank(batches):
        """Rows come by part, entries before queries: a part's entries are held while its queries pass."""
        now, entries, building = None, None, []

        def load():
            ids, x, cell, codes, error = (np.concatenate(c) for c in zip(*building))
            return ids, x, cell, np.ascontiguousarray(codes.T), error

        for batch in batches:
            part, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (asks[1:] != asks[:-1])))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
                rows = batch.slice(a, b - a)
                if part[a] != now:
                    now, entries, building = part[a], None, []
                ids, x = rows.column(2).to_numpy(), matrix(rows.column(3))
                if not asks[a]:
                    codes = np.frombuffer(b"".join(rows.column(5).to_pylist()), np.uint8).reshape(len(ids), -1)
                    building.append((ids, x, rows.column(4).to_numpy().astype(np.int64), codes, rows.column(6).to_numpy()))
                    continue
                if entries is None:
                    if not building:
                        continue
                    entries = load()
                bounds = rows.column(6).to_numpy()
                for s in range(0, len(ids), QUERY_CHUNK):
                    found = list(answer(shared_index.value, entries, x[s : s + QUERY_CHUNK], ids[s : s + QUERY_CHUNK], bounds[s : s + QUERY_CHUNK], k, doubt))
                    sizes = [len(f[0]) for f in found]
                    scored = np.zeros(sum(sizes), np.int64)  # counted once a part, on its first row
                    scored[(np.cumsum([0, *sizes[:-1]]))[np.array(sizes) > 0]] = [f[2] for f in found if len(f[0])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[s : s + QUERY_CHUNK], sizes)), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found])), pa.array(scored)],
                        names=["query_id", "vec_id", "score", "scored"],
                    )

    once = Window.partitionBy("vec_id").orderBy("v")
    asking = rows.filter(F.col("vec_id") % query_every == 0).withColumn("__n", F.row_number().over(once)).filter("__n = 1").select("vec_id", "v")
    moved = coded.mapInArrow(to_parts, _MOVED).unionByName(asking.mapInArrow(ask, _MOVED))
    by_part = moved.repartition(max(n_parts, 1), "part").sortWithinPartitions("part", "asks")
    found = by_part.mapInArrow(rank, "query_id bigint, vec_id bigint, score double, scored bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("n_scored", F.sum("scored").over(Window.partitionBy("query_id"))).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "n_scored")
