"""Names for token sequences by recompression: runs and pairs are replaced by symbols, round by round.

A round names maximal runs of one symbol, or pairs whose left symbol has coin L and whose right symbol has
coin R in that round (the coin is a bit of the symbol's hash, so a pair never competes with another).
Inside a bucket names are hashes of what they stand for, so that buckets agree on what to ask about; after
some rounds all buckets' names meet in Spark, where each that occurs more than once gets a number, by which
the next rounds go on (``renamed``), and one that occurs once is known to be alone.

Each symbol carries its reach: the span of tokens that fixes its existence.  Wherever the tokens of the
reach recur, the symbol recurs at the same place; so a symbol that occurs once proves that no longer string
around its reach is repeated.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from orebody.llm.common import mix64

_FAR = np.int64(1) << np.int64(40)


class Symbols(NamedTuple):
    """Symbols in order: name, tokens [start, end), reach [lo, hi), sequence, and whether it is known to occur once."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    row: np.ndarray
    single: np.ndarray


def tokens_as_symbols(tokens: np.ndarray, bounds: np.ndarray) -> Symbols:
    """``tokens`` are uint64 hashes of all sequences end to end, ``bounds`` the sequences' edges (n + 1 long)."""
    start = np.arange(len(tokens), dtype=np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return Symbols(tokens.copy(), start, start + 1, start.copy(), start + 1, row, np.zeros(len(tokens), bool))


def advance(symbols: Symbols, first: int, rounds: int) -> Symbols:
    """Runs are named, then pairs in ``rounds`` rounds, the first of which has the number ``first``.

    What depends on a sequence's edge reaches far beyond it.
    """
    if len(symbols.name):
        symbols = name_runs(symbols, first)
    for t in range(first, first + rounds):
        if len(symbols.name):
            symbols = name_pairs(symbols, t)
    return symbols


def renamed(symbols: Symbols, numbers: np.ndarray) -> Symbols:
    """The symbols under their numbers; those of number 0 occur once and keep their names, which nothing else has."""
    single = numbers == 0
    return symbols._replace(name=np.where(single, symbols.name, mix64(numbers * np.uint64(0x9E3779B97F4A7C15))), single=single | symbols.single)


def neighbour(values: np.ndarray, row: np.ndarray, step: int, edge) -> np.ndarray:
    """values of the symbol before (-1) or after (+1) in the same sequence, or ``edge``."""
    out = np.full(len(values), edge, values.dtype)
    same = row[1:] == row[:-1]
    if step < 0:
        out[1:][same] = values[:-1][same]
    else:
        out[:-1][same] = values[1:][same]
    return out


def name_runs(symbols: Symbols, t: int) -> Symbols:
    """Runs of two or more become one symbol; what is next to a run, or to an equal symbol, is known to differ from it."""
    sym, start, end, lo, hi, row, single = symbols
    first = np.ones(len(sym), bool)
    first[1:] = (sym[1:] != sym[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(sym)) - 1
    length = (last - at + 1).astype(np.uint64)
    # a symbol recurs as it is, or in a run of the same length, only where its neighbours differ from it again
    new_lo = np.minimum(np.minimum.reduceat(lo, at), np.minimum(neighbour(lo, row, -1, -_FAR)[at], neighbour(lo, row, 1, start[-1])[last]))
    new_hi = np.maximum(np.maximum.reduceat(hi, at), np.maximum(neighbour(hi, row, 1, _FAR)[last], neighbour(hi, row, -1, 0)[at]))
    name = np.where(length > 1, mix64(sym[at] + mix64(length + np.uint64(t << 40))), sym[at])
    return Symbols(name, start[at], end[last], new_lo, new_hi, row[at], np.logical_or.reduceat(single, at))


def name_pairs(symbols: Symbols, t: int) -> Symbols:
    sym, start, end, lo, hi, row, single = symbols
    right = (mix64(sym + np.uint64(t + 1)) & np.uint64(1)).astype(bool)
    merge = np.zeros(len(sym), bool)  # with the next symbol
    merge[:-1] = ~right[:-1] & right[1:] & (row[1:] == row[:-1])
    taken = np.zeros(len(sym), bool)
    taken[1:] = merge[:-1]
    alone = ~merge & ~taken
    # a lone R is known not to follow an L, a lone L not to precede an R
    own_lo, own_hi = lo.copy(), hi.copy()
    a = alone & right
    own_lo[a] = np.minimum(lo[a], neighbour(lo, row, -1, -_FAR)[a])
    own_hi[a] = np.maximum(hi[a], neighbour(hi, row, -1, 0)[a])
    a = alone & ~right
    own_lo[a] = np.minimum(lo[a], neighbour(lo, row, 1, _FAR)[a])
    own_hi[a] = np.maximum(hi[a], neighbour(hi, row, 1, _FAR)[a])
    at = np.flatnonzero(~taken)
    pair = merge[at]
    mate = np.minimum(at + 1, len(sym) - 1)
    name = np.where(pair, mix64(mix64(sym[at] + np.uint64(0x51)) * np.uint64(3) + sym[mate]), sym[at])
    return Symbols(
        name,
        start[at],
        np.where(pair, end[mate], end[at]),
        np.where(pair, np.minimum(lo[at], lo[mate]), own_lo[at]),
        np.where(pair, np.maximum(hi[at], hi[mate]), own_hi[at]),
        row[at],
        single[at] | (pair & single[mate]),
    )
