"""Token ids packed by best fit decreasing, with the capacities of open rows in a segment tree.

Tokenising and packing run where the documents are read, without a shuffle: a task gathers at most
``group_tokens`` ids, packs them and goes on, so memory is bounded and a lost task is simply run again.

Documents longer than a row are split losslessly into pieces of one row's length and a rest; pieces carry
(doc_id, offset in the document's ids), so ids joined by offset give back the document exactly.  Each
output row holds the packed ids (little-endian, padded to ``row_tokens``), cumulative segment lengths, and
positions that restart at 0 with every segment.

Defined results: null and empty texts have no ids and give one row's entry in ``empty_doc_ids`` so that no
document vanishes; repeated rows are packed as often as they occur; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROW_TOKENS = 2048
#: Ids that a task packs at a time: bounds its memory, and is far above a row, so that little room is lost.
GROUP_TOKENS = 1 << 21
#: Word units whose ids a worker remembers; the memory is emptied when it is full.
CACHE_UNITS = 250_000
#: Unicode White_Space, as one class of a pattern.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of text that no pre-token of the byte-level pattern crosses: an optional space and a run without space, or a run of space.
UNITS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

SCHEMA = (
    "n_tokens int, ids binary, positions binary, cu_seqlens array<int>, "
    "doc_ids array<bigint>, offsets array<bigint>, empty_doc_ids array<bigint>"
)


class UnitIds(dict):
    """Unit of text -> its ids as bytes; the tokenizer is asked once a unit."""

    def __init__(self, encode, dtype):
        super().__init__()
        self.encode, self.dtype = encode, dtype

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE_UNITS:
            self.clear()
        ids = np.asarray(self.encode(unit), self.dtype).tobytes()
        if len(unit) <= 64:
            self[unit] = ids
        return ids


@functools.lru_cache(maxsize=2)
def unit_ids(vocabulary: bytes, pattern: str) -> UnitIds:
    """``vocabulary``: lines of base64 token and rank."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return UnitIds(encoding.encode_ordinary, np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32)


class RoomTree:
    """Segment tree over capacities 0..size: finds the smallest capacity, at least the one asked for, that an open row has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        k = room + self.leaves
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of the tightest fit, removed from the tree; None if nothing fits."""
        count, k = self.count, least + self.leaves
        if not count[k]:
            while k > 1 and (k & 1 or not count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if count[2 * k] else 2 * k + 1
        room = k - self.leaves
        row = self.rows[room].pop()
        while k:
            count[k] -= 1
            k >>= 1
        return room, row


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Rows of indexes of ``lengths`` (each at most ``size``), longest first, each into the fullest row that takes it."""
    tree, rows = RoomTree(size), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            rows.append([i])
            room, row = size, len(rows) - 1
        else:
            room, row = found
            rows[row].append(i)
        if room > need:
            tree.add(room - need, row)
    return rows


def pack_group(ids: list[bytes], doc_ids: list, width: int, dtype, size: int, empty: list) -> pa.RecordBatch:
    """Pack the ids (bytes of ``dtype``) of some documents into rows of ``size`` ids."""
    piece_doc, piece_at, piece_len = [], [], []
    for d, data in enumerate(ids):
        n = len(data) // width
        for at in range(0, n, size):
            piece_doc.append(d)
            piece_at.append(at)
            piece_len.append(min(size, n - at))
    rows = best_fit_decreasing(np.asarray(piece_len, np.int64), size) if piece_len else []
    steps = np.arange(size, dtype=dtype)
    out: dict[str, list] = {k: [] for k in ("n", "ids", "pos", "cu", "docs", "at", "empty")}
    for row in rows:
        lens = [piece_len[i] for i in row]
        used = sum(lens)
        parts = [ids[piece_doc[i]][piece_at[i] * width : (piece_at[i] + piece_len[i]) * width] for i in row]
        pad = bytes((size - used) * width)
        out["n"].append(used)
        out["ids"].append(b"".join([*parts, pad]))
        out["pos"].append(b"".join([*(steps[:n].tobytes() for n in lens), pad]))
        out["cu"].append(np.cumsum([0, *lens]).tolist())
        out["docs"].append([doc_ids[piece_doc[i]] for i in row])
        out["at"].append([piece_at[i] for i in row])
        out["empty"].append([])
    if empty:
        for k, v in zip(out, (0, bytes(size * width), bytes(size * width), [0], [], [], empty)):
            out[k].append(v)
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = ("n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "offsets", "empty_doc_ids")
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(names))


def pack(docs: DataFrame, vocabulary: str, pattern: str, row_tokens: int = ROW_TOKENS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows of all documents (columns: SCHEMA).

    ``vocabulary`` is the path, on the driver, of a file of base64 tokens and ranks; its bytes (about 1 MB,
    at most 16 MB are taken) go to the executors as a broadcast.
    """
    with open(vocabulary, "rb") as f:
        data = f.read()
    if len(data) > 16 << 20:
        raise ValueError("the vocabulary is too large to broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        known = unit_ids(shared.value, pattern)
        dtype, width = known.dtype, np.dtype(known.dtype).itemsize
        units, get = UNITS.findall, known.__getitem__
        ids, names, empty, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = b"".join(map(get, units(text.as_py() or "")))
                if not data:
                    empty.append(doc_id)
                    if len(empty) >= 100_000:
                        yield pack_group([], [], width, dtype, row_tokens, empty)
                        empty = []
                    continue
                ids.append(data)
                names.append(doc_id)
                held += len(data) // width
                if held >= group_tokens:
                    yield pack_group(ids, names, width, dtype, row_tokens, empty)
                    ids, names, empty, held = [], [], [], 0
        if ids or empty:
            yield pack_group(ids, names, width, dtype, row_tokens, empty)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
