"""Burrows-Wheeler transforms of shards of strings, merged by interleave refinement."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SYMBOLS = 7   # symbols of 9 bits (a byte or the end of a string) in a sort key


@dataclass
class Shard:
    """The transform of a shard of strings; rows are suffixes in sorted order.

    ``last`` is the symbol before each suffix (0: none, else byte + 1), ``before`` the row of the suffix that starts one earlier,
    ``place`` the place of each suffix in the shard's text.
    """

    last: np.ndarray
    before: np.ndarray
    place: np.ndarray
    strings: int


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a text of strings, each closed by 0; ends sort by their place."""
    n = len(symbols)
    padded = np.r_[symbols, np.zeros(_SYMBOLS, np.int64)]
    key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(_SYMBOLS):
        s = np.where(open_, padded[k:k + n], 0)
        open_ &= s > 0
        key = key << 9 | s
    order = np.argsort(key, kind="stable")
    new = np.r_[True, np.diff(key[order]) != 0] | ~open_[order]   # strings that ended are told apart
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    active, h = order[~(new & np.r_[new[1:], True])], _SYMBOLS
    while len(active):
        first, second = rank[active], rank[active + h]
        by = np.argsort(first * n + second, kind="stable")
        active, first, second = active[by], first[by], second[by]
        old = np.r_[True, first[1:] != first[:-1]]
        new = old | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(active))
        place = first + at - np.maximum.accumulate(np.where(old, at, 0))
        order[place] = active
        rank[active] = np.maximum.accumulate(np.where(new, place, 0))
        active, h = active[~(new & np.r_[new[1:], True])], h * 2
    return order


def transform(strings: list[bytes]) -> Shard:
    """The shard's transform; suffixes of one shard are sorted here and never again."""
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    if len(raw) and raw.max() == 255:
        raise ValueError("no byte of UTF-8 is 255")
    symbols = raw.astype(np.int64) + 1
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    symbols[ends] = 0
    place = suffix_order(symbols)
    row = np.empty(len(place), np.int64)
    row[place] = np.arange(len(place))
    prior = place - 1
    first = place == 0
    prior[first] = 0
    last = symbols[prior].astype(np.uint8)
    last[first] = 0
    return Shard(last, row[prior].astype(np.int32), place, len(strings))


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge transforms by refining their interleave ``depth`` times.

    Before refinement k the interleave is sorted by k - 1 symbols. Taking the
    rows in that order, those with a given symbol before them, moved one place
    back, are in order by k symbols: a stable deal by symbol is all it takes.
    Two neighbours part in the refinement in which they first differ, which
    gives their common prefix.

    Returns the rows' places in the merged order (shards' rows one after
    another), the common prefix of each row with the one before it (``depth``:
    at least that), and the first row of each interval of equal prefixes.
    """
    start = np.cumsum([0] + [len(s.last) for s in shards])
    last = np.concatenate([s.last for s in shards])
    before = np.concatenate([s.before + np.int32(a) for s, a in zip(shards, start)])
    ends = np.concatenate([np.arange(s.strings, dtype=np.int32) + np.int32(a) for s, a in zip(shards, start)])
    n, k = len(last), len(ends)
    order = np.arange(n, dtype=np.int32)
    block = np.zeros(n, np.int32)
    common = np.zeros(n, np.uint8)                          # refinements that a row went through with the one before
    new = np.ones(n, bool)
    for _ in range(depth):
        symbol = np.take(last, order)
        deal = np.argsort(symbol, kind="stable")[k:]       # the k rows that start a string have nothing before them
        symbol, old = np.take(symbol, deal), np.take(block, deal)
        order = np.concatenate((ends, np.take(before, np.take(order, deal))))
        np.not_equal(symbol[1:], symbol[:-1], out=new[k + 1:])
        new[k + 1:] |= old[1:] != old[:-1]
        common += ~new
        block = np.cumsum(new, dtype=np.int32)
        if block[-1] == n:
            break
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    return order, common, first
