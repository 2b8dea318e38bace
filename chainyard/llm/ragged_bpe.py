"""Byte-pair merging of many sequences at once, over ragged numpy arrays.

A batch of sequences is one flat symbol array with the number of each
symbol's sequence beside it.  Pair ranks come from an open-addressing table
that is probed for whole arrays.
"""

from __future__ import annotations

import numpy as np

#: Rank of a pair that no merge joins.
NO_MERGE = np.int32(2**31 - 1)


class PairRanks:
    """(left symbol, right symbol) -> merge rank, looked up for arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, n_symbols: int):
        key = left.astype(np.int64) * n_symbols + right
        self.n = np.int64(n_symbols)
        bits = max(4, int(np.ceil(np.log2(max(len(key), 1) * 8))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_MERGE, np.int32)
        slot, waiting = self._slot(key), np.arange(len(key))
        while waiting.size:
            at = slot[waiting]
            free = self.keys[at] < 0
            taken, first = np.unique(at[free], return_index=True)
            won = waiting[free][first]
            self.keys[taken], self.ranks[taken] = key[won], rank[won]
            placed = np.zeros(len(key), bool)
            placed[won] = True
            waiting = waiting[~placed[waiting]]
            slot[waiting] = (slot[waiting] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.n + right
        at = self._slot(key)
        found = self.keys[at]
        out = self.ranks[at]
        other = found != key
        out[other] = NO_MERGE
        todo = np.flatnonzero(other & (found >= 0))
        while todo.size:
            at = (at[todo] if at.size != todo.size else at) + 1 & self.mask
            found = self.keys[at]
            same = found == key[todo]
            out[todo[same]] = self.ranks[at[same]]
            on = (found >= 0) & ~same
            todo, at = todo[on], at[on]
        return out


def adjacent_ranks(syms: np.ndarray, seq: np.ndarray, ranks: PairRanks) -> np.ndarray:
    """Rank of each symbol with its right neighbour of the same sequence."""
    out = np.full(len(syms), NO_MERGE, np.int32)
    if len(syms) > 1:
        out[:-1] = ranks(syms[:-1], syms[1:])
        out[:-1][seq[:-1] != seq[1:]] = NO_MERGE
    return out


def merged_symbols(syms: np.ndarray, lens: np.ndarray, ranks: PairRanks, merged: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that are left after all merges, sequence by sequence, and
    their number in each.

    Round by round every sequence applies its lowest-rank pair at all its
    places at once (left to right where places overlap, as in ``a a a``);
    a sequence without a mergeable pair leaves the arrays.  ``merged`` maps
    a rank to the symbol that its merge makes.
    """
    n = len(lens)
    seq = np.repeat(np.arange(n, dtype=np.int32), lens)
    syms = syms.astype(np.int32)
    rank = adjacent_ranks(syms, seq, ranks)
    left, of = [], []
    while syms.size:
        first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
        best = np.minimum.reduceat(rank, first)
        size = np.diff(np.append(first, len(syms)))
        live = best != NO_MERGE
        if not live.all():
            keep = np.repeat(live, size)
            left.append(syms[~keep])
            of.append(seq[~keep])
            syms, seq, rank = syms[keep], seq[keep], rank[keep]
            best, size = best[live], size[live]
            if not syms.size:
                break
        at = np.flatnonzero(rank == np.repeat(best, size))
        close = np.diff(at) == 1
        if close.any():
            order = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.concatenate(([True], ~close)), order, 0))
            at = at[(order - run) % 2 == 0]
        syms[at] = merged[rank[at]]
        keep = np.ones(len(syms), bool)
        keep[at + 1] = False
        place = np.cumsum(keep)[at] - 1
        syms, seq, rank = syms[keep], seq[keep], rank[keep]
        again = np.concatenate((place, place[place > 0] - 1))
        last = again + 1 >= len(syms)
        rank[again[last]] = NO_MERGE
        again = again[~last]
        fresh = ranks(syms[again], syms[again + 1])
        fresh[seq[again] != seq[again + 1]] = NO_MERGE
        rank[again] = fresh
    if not left:
        return np.zeros(0, np.int32), np.zeros(n, np.int64)
    of = np.concatenate(of)
    return (np.concatenate(left)[np.argsort(of, kind="stable")],
            np.bincount(of, minlength=n).astype(np.int64))


def surviving_symbols(syms: np.ndarray, lens: np.ndarray, ranks: PairRanks,
                      merged: np.ndarray) -> np.ndarray:
    """Number of symbols that each sequence has after all merges."""
    return merged_symbols(syms, lens, ranks, merged)[1]
